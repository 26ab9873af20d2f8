"""Facts. Every dimension lookup keeps the fact rows; unmatched keys become -1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfprice.functions import surrogate_key, unmatched, unmatched_int
from shelfprice.operators.history import as_of_join
from shelfprice.operators.joins import lookup_join


def _member(dim: DataFrame, key: str, *columns: str) -> DataFrame:
    """Lookup side of a dimension: its key, a copy that is NULL when unmatched, and the columns."""
    return dim.select(key, F.col(key).alias(f"_{key}"), *columns)


def _with_product(rows: DataFrame, products: DataFrame, at: str) -> DataFrame:
    versions = products.withColumn("_product_key", F.col("product_key")).withColumn(
        "_product_id", F.col("product_id")
    )
    return as_of_join(rows, versions, "product_key", at, ["_product_key", "_product_id"])


def fact_store_sales(sales: DataFrame, products: DataFrame, stores: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per transaction with the product version valid on its date."""
    rows = _with_product(sales, products, "transaction_date")
    rows = lookup_join(rows, _member(stores, "store_key"), ["store_key"])
    rows = lookup_join(rows, _member(dates, "date_key", "full_date"), ["date_key"])
    c = F.col
    return rows.select(
        surrogate_key(c("transaction_id")).alias("sales_key"),
        "transaction_id",
        unmatched(c("_product_key")).alias("product_key"),
        unmatched(c("_store_key")).alias("store_key"),
        unmatched_int(c("_date_key")).alias("date_key"),
        "full_date",
        "quantity",
        "unit_cost",
        "unit_retail",
        F.round(c("quantity") * c("unit_retail"), 2).alias("gross_revenue"),
        F.round(c("quantity") * (c("unit_retail") - c("unit_cost")), 2).alias("gross_margin_amount"),
    )


def monthly_expenses(expenses: DataFrame) -> DataFrame:
    """Expense total per store, type and month; a missing amount counts 0."""
    amount = F.sum(F.coalesce("expense_amount", F.lit(0.0)))
    return expenses.groupBy("store_key", "expense_type_key", "month_key").agg(amount.alias("expense_amount"))


def fact_store_expenses(expenses: DataFrame, stores: DataFrame, types: DataFrame, months: DataFrame) -> DataFrame:
    """Monthly expense totals. The key hashes the source keys, so unmatched rows stay apart."""
    rows = monthly_expenses(expenses)
    rows = lookup_join(rows, _member(stores, "store_key"), ["store_key"])
    rows = lookup_join(rows, _member(types, "expense_type_key"), ["expense_type_key"])
    rows = lookup_join(rows, _member(months, "month_key", "month_start_date"), ["month_key"])
    c = F.col
    return rows.select(
        surrogate_key(c("store_key"), c("expense_type_key"), c("month_key")).alias("expense_key"),
        unmatched_int(c("_month_key")).alias("month_date_key"),
        unmatched(c("_store_key")).alias("store_key"),
        unmatched(c("_expense_type_key")).alias("expense_type_key"),
        "month_start_date",
        "expense_amount",
    )


def fact_competitor_prices(
    competitor: DataFrame, products: DataFrame, competitors: DataFrame, dates: DataFrame
) -> DataFrame:
    """One row per scrape with the product version valid on its date."""
    rows = _with_product(competitor, products, "scraped_at")
    name = competitors.select("competitor_key", F.col("competitor_name").alias("_competitor_name"))
    rows = lookup_join(rows, name, ["competitor_key"])
    rows = lookup_join(rows, _member(dates, "date_key"), ["date_key"])
    c = F.col
    key = surrogate_key(c("scraped_at"), c("_product_id"), c("_competitor_name"), c("competitor_price"))
    return rows.select(
        key.alias("competitor_price_key"),
        unmatched(c("competitor_key")).alias("competitor_key"),
        unmatched(c("_product_key")).alias("product_key"),
        unmatched_int(c("_date_key")).alias("date_key"),
        "scraped_at",
        "competitor_price",
    )
