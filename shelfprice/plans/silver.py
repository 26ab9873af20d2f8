"""Cleaned layers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfprice.functions import (
    clean_title_case,
    clean_title_cases,
    clean_with_pattern,
    date_key,
    fill_outlier_with_avg,
    guarded_date,
    guarded_double,
    guarded_int,
    handle_not_applicable,
    map_store_region,
    month_key,
    surrogate_key,
    validate_allowed_values,
)
from shelfprice.functions.dates import ISO_DATE, ISO_TIMESTAMP
from shelfprice.operators.joins import lookup_join

# Raw columns, merge keys, record types and the patterns of valid names.
COMPANY_COLUMNS = [
    "Record_Type", "Transaction_ID", "Date", "Store_ID", "Store_Name", "Store_City", "Store_Region", "Product_ID",
    "Product_Name", "Category", "Sub_Category", "Quantity", "Unit_Cost", "Unit_Retail", "Expense_Type",
    "Expense_Amount",
]
_COMPANY_TEXTS = {"Record_Type", "Store_City", "Store_Region", "Product_Name", "Category", "Sub_Category", "Expense_Type"}
COMPETITOR_COLUMNS = ["Scraped_At", "Competitor_Name", "Product_ID", "Product_Name", "Competitor_Price"]
COMPANY_KEYS = ["Store_Name", "Transaction_ID", "Store_ID"]
COMPETITOR_KEYS = ["Scraped_At", "Competitor_Name", "Product_ID"]
RECORD_TYPES = ["SALES", "STORE_EXPENSE"]
TRANSACTION_PATTERN = "^Tx-[0-9]+$"
STORE_PATTERN = "^Branch_[0-9]+$"
PRODUCT_PATTERN = "^Prod_[0-9]+$"
NO_EXPENSE = "Direct Sale"


def silver_company(raw: DataFrame, as_of: dt.date | str | None = None, date_format: str = ISO_DATE) -> DataFrame:
    """Typed and cleaned transactions; rows with a NULL in any raw column are dropped.

    Texts are title-cased in a first projection, as one array; the second
    looks at each of them as often as it needs without repeating that work.
    What matches the pattern of an id or a store has its title case already.
    """
    c = F.col
    texts = [n for n in COMPANY_COLUMNS if n in _COMPANY_TEXTS]
    cleaned = raw.na.drop("any").withColumn("_titled", clean_title_cases(*texts))
    titled = {n: c("_titled")[i] for i, n in enumerate(texts)}
    return cleaned.select(
        validate_allowed_values(c("Record_Type"), RECORD_TYPES, titled["Record_Type"]).alias("record_type"),
        clean_with_pattern(c("Transaction_ID"), TRANSACTION_PATTERN, F.trim(c("Transaction_ID"))).alias("transaction_id"),
        guarded_date(c("Date"), date_format, as_of).alias("transaction_date"),
        guarded_int(c("Store_ID")).alias("store_id"),
        clean_with_pattern(c("Store_Name"), STORE_PATTERN, F.trim(c("Store_Name"))).alias("store_name"),
        titled["Store_City"].alias("store_city"),
        map_store_region(c("Store_City"), c("Store_Region"), titled["Store_Region"]).alias("store_region"),
        handle_not_applicable(guarded_int(c("Product_ID"))).alias("product_id"),
        handle_not_applicable(titled["Product_Name"]).alias("product_name"),
        handle_not_applicable(titled["Category"]).alias("category"),
        handle_not_applicable(titled["Sub_Category"]).alias("sub_category"),
        guarded_int(c("Quantity")).alias("quantity"),
        guarded_double(c("Unit_Cost")).alias("unit_cost"),
        guarded_double(c("Unit_Retail")).alias("unit_retail"),
        handle_not_applicable(titled["Expense_Type"], NO_EXPENSE).alias("expense_type"),
        guarded_double(c("Expense_Amount")).alias("expense_amount"),
    )


def silver_sales(company: DataFrame, mapping: DataFrame) -> DataFrame:
    """Sales with a positive quantity, their product attributes overridden by the master mapping."""
    attributes = ["product_name", "category", "sub_category"]
    master = mapping.select(
        F.col("product_id").cast("string").alias("product_id"), *[F.col(a).alias(f"_m_{a}") for a in attributes]
    )
    sales = company.filter((F.col("record_type") == "Sales") & (F.col("quantity") > 0))
    joined = lookup_join(sales, master, ["product_id"])
    return joined.select(
        *[F.coalesce(f"_m_{n}", n).alias(n) if n in attributes else F.col(n) for n in company.columns],
        surrogate_key(F.col("product_id")).alias("product_key"),
        surrogate_key(F.col("store_id")).alias("store_key"),
        date_key(F.col("transaction_date")).alias("date_key"),
    )


def silver_expenses(company: DataFrame) -> DataFrame:
    return company.filter(F.col("record_type") == "Store_Expense").select(
        surrogate_key(F.col("transaction_id")).alias("expense_key"),
        month_key(F.col("transaction_date")).alias("month_key"),
        surrogate_key(F.col("store_id")).alias("store_key"),
        surrogate_key(F.col("expense_type")).alias("expense_type_key"),
        "transaction_id",
        "transaction_date",
        "store_id",
        "store_name",
        "store_city",
        "store_region",
        "expense_type",
        "expense_amount",
    )


def average_own_price(company: DataFrame) -> DataFrame:
    """Mean own retail price per product."""
    return company.groupBy("product_id").agg(F.avg("unit_retail").alias("our_unit_retail"))


def silver_competitor(
    raw: DataFrame, own_prices: DataFrame, as_of: dt.date | str | None = None, date_format: str = ISO_TIMESTAMP
) -> DataFrame:
    """Cleaned scrapes; a price far from our own average for the product is replaced by it."""
    c = F.col
    typed = raw.na.drop("any").select(
        guarded_date(c("Scraped_At"), date_format, as_of).alias("scraped_at"),
        clean_title_case(c("Competitor_Name")).alias("competitor_name"),
        guarded_int(c("Product_ID")).alias("product_id"),
        clean_with_pattern(c("Product_Name"), PRODUCT_PATTERN).alias("product_name"),
        c("Competitor_Price").try_cast("double").alias("_price"),
    )
    cleaned = typed.select(
        surrogate_key(c("competitor_name")).alias("competitor_key"),
        surrogate_key(c("product_id")).alias("product_key"),
        date_key(c("scraped_at")).alias("date_key"),
        "scraped_at",
        "competitor_name",
        "product_id",
        "product_name",
        "_price",
        c("product_id").cast("string").alias("_product"),
    )
    own = own_prices.withColumnRenamed("product_id", "_product")
    price = fill_outlier_with_avg(c("_price"), c("our_unit_retail"))
    return lookup_join(cleaned, own, ["_product"]).select(
        *[n for n in cleaned.columns if not n.startswith("_")], price.alias("competitor_price")
    )
