"""Queries over the cleaned layers, dimensions, facts and marts."""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.bindings import AS_OF, line_items, raw_company, raw_competitor, table
from catalog.oracle import (
    allowed,
    clean,
    key,
    matching,
    number,
    present,
    region,
    week,
    whole,
)
from catalog.spec import query
from shelfprice.functions import (
    clean_title_case,
    clean_with_pattern,
    guarded_date,
    guarded_double,
    guarded_int,
    handle_not_applicable,
    map_store_region,
    surrogate_key,
    validate_allowed_values,
    week_start,
)
from shelfprice.operators.dedup import duplicates, keep_latest
from shelfprice.operators.joins import lookup_join
from shelfprice.operators.series import weekly_spine
from shelfprice.plans import facts, marts, silver
from shelfprice.plans.warehouse import Warehouse
from shelfprice.sources import product_mapping, read_raw_csv, read_seed, shared_dir
from shelfprice.sources import write_layer as write_through


def warehouse(spark: SparkSession, sf_dir: str, read_once: Collection[str] = ()) -> Warehouse:
    """The layers named in ``read_once`` have a single reader in the query, which needs no copy on disk."""
    company, competitor = raw_company(spark, sf_dir), raw_competitor(spark, sf_dir)
    save = lambda df, label: df if label in read_once else write_through(df, label)
    return Warehouse(company, competitor, as_of=AS_OF, history_strategy="check", save=save)


def company_read_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned transactions for a query that reads them a single time, which needs no copy on disk."""
    company, competitor = raw_company(spark, sf_dir), raw_competitor(spark, sf_dir)
    return Warehouse(company, competitor, as_of=AS_OF, save=lambda df, _: df).company


@query(
    "p_brand c_nationkey:i sales_week:d avg_unit_retail:4 total_quantity_sold:i total_transactions:i",
    f"""SELECT p_brand, c_nationkey, {week('l_shipdate')} AS sales_week, avg(l_extendedprice / l_quantity) AS avg_unit_retail,
        sum(l_quantity) AS total_quantity_sold, count(DISTINCT l_orderkey) AS total_transactions
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey
        GROUP BY ALL""",
)
def weekly_store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_items(spark, sf_dir)
    lookups = [("orders", "o_orderkey", "l_orderkey", "o_custkey"), ("customer", "c_custkey", "o_custkey", "c_nationkey"),
               ("part", "p_partkey", "l_partkey", "p_brand")]
    for name, own, foreign, wanted in lookups:
        side = table(spark, sf_dir, name).select(F.col(own).alias(foreign), wanted)
        lines = lookup_join(lines, side, [foreign], "inner")
    return lines.groupBy("p_brand", "c_nationkey", week_start(F.col("l_shipdate")).alias("sales_week")).agg(
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("avg_unit_retail"),
        F.sum("l_quantity").alias("total_quantity_sold"),
        F.count_distinct("l_orderkey").alias("total_transactions"),
    )


@query(
    "record_type transaction_shape store_name store_city store_region product_name category expense_type n_rows:i",
    f"""SELECT {allowed('"Record_Type"', 'SALES', 'STORE_EXPENSE')} AS record_type,
        {matching('"Transaction_ID"', '^Tx-[0-9]+$')} IS NULL AS transaction_shape,
        {matching('"Store_Name"', '^Branch_[0-9]+$')} AS store_name, {clean('"Store_City"')} AS store_city,
        {region('"Store_City"', '"Store_Region"')} AS store_region, {present('(' + clean('"Product_Name"') + ')')} AS product_name,
        {present('"Category"')} AS category, {present('"Expense_Type"', 'Direct Sale')} AS expense_type, count(*) AS n_rows
        FROM raw_company GROUP BY ALL""",
)
def cleaned_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    shown = raw_company(spark, sf_dir).select(
        validate_allowed_values(c("Record_Type"), silver.RECORD_TYPES).alias("record_type"),
        clean_with_pattern(c("Transaction_ID"), silver.TRANSACTION_PATTERN).isNull().alias("transaction_shape"),
        clean_with_pattern(c("Store_Name"), silver.STORE_PATTERN).alias("store_name"),
        clean_title_case(c("Store_City")).alias("store_city"),
        map_store_region(c("Store_City"), c("Store_Region")).alias("store_region"),
        handle_not_applicable(clean_title_case(c("Product_Name"))).alias("product_name"),
        handle_not_applicable(c("Category")).alias("category"),
        handle_not_applicable(c("Expense_Type"), silver.NO_EXPENSE).alias("expense_type"),
    )
    return shown.groupBy(*shown.columns).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "store_id:i product_id:i quantity:i cost_known n_rows:i unit_cost:2 unit_retail:2",
    f"""SELECT {whole('"Store_ID"')} AS store_id, {whole('"Product_ID"')} AS product_id, {whole('"Quantity"')} AS quantity,
        {number('"Unit_Cost"')} IS NOT NULL AS cost_known, count(*) AS n_rows,
        sum({number('"Unit_Cost"')}) AS unit_cost, sum({number('"Unit_Retail"')}) AS unit_retail FROM raw_company GROUP BY ALL""",
)
def guarded_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    typed = raw_company(spark, sf_dir).select(
        guarded_int(c("Store_ID")).alias("store_id"),
        guarded_int(c("Product_ID")).alias("product_id"),
        guarded_int(c("Quantity")).alias("quantity"),
        guarded_double(c("Unit_Cost")).alias("_cost"),
        guarded_double(c("Unit_Retail")).alias("_retail"),
    )
    return typed.groupBy("store_id", "product_id", "quantity", c("_cost").isNotNull().alias("cost_known")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_cost").alias("unit_cost"), F.sum("_retail").alias("unit_retail")
    )


_DATE_TEXTS = {
    "iso": ("lpad(CAST(year(s) AS STRING), 4, '0') || '-' || lpad(CAST(month(s) AS STRING), 2, '0') || '-' || lpad(CAST(l_linenumber * 5 AS STRING), 2, '0')", "YYYY-MM-DD", "%Y-%m-%d"),
    "day_first": ("lpad(CAST(l_linenumber * 5 AS STRING), 2, '0') || '/' || lpad(CAST(month(s) AS STRING), 2, '0') || '/' || CAST(year(s) AS STRING)", "DD/MM/YYYY", "%d/%m/%Y"),
    "month_first": ("lpad(CAST(month(s) AS STRING), 2, '0') || '/' || lpad(CAST(l_linenumber * 5 AS STRING), 2, '0') || '/' || CAST(year(s) AS STRING)", "MM/DD/YYYY", "%m/%d/%Y"),
    "dashed": ("lpad(CAST(l_linenumber * 5 AS STRING), 2, '0') || '-' || lpad(CAST(month(s) AS STRING), 2, '0') || '-' || CAST(year(s) AS STRING)", "DD-MM-YYYY", "%d-%m-%Y"),
    "other": ("CAST(year(s) AS STRING) || '.' || CAST(month(s) AS STRING) || '.' || CAST(l_linenumber * 5 AS STRING)", "yyyy.M.d", "%Y.%m.%d"),
}


@query(
    " ".join(f"{n}:d" for n in _DATE_TEXTS) + " n_rows:i",
    "SELECT "
    + ", ".join(
        f"CASE WHEN try_strptime({text}, '{pattern}') IS NOT NULL THEN least(CAST(try_strptime({text}, '{pattern}') AS DATE), DATE '{AS_OF}') END AS {n}"
        for n, (text, _, pattern) in _DATE_TEXTS.items()
    )
    + ", count(*) AS n_rows FROM (SELECT l_shipdate AS s, l_linenumber FROM lineitem) GROUP BY ALL",
)
def guarded_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every accepted format; line number times five gives days 5 to 35, so some dates are impossible."""
    lines = line_items(spark, sf_dir).selectExpr("l_shipdate AS s", "l_linenumber")
    texts = lines.selectExpr(*[f"{text} AS {n}" for n, (text, _, _) in _DATE_TEXTS.items()])
    dates = texts.select(*[guarded_date(F.col(n), fmt, AS_OF).alias(n) for n, (_, fmt, _) in _DATE_TEXTS.items()])
    return dates.groupBy(*dates.columns).agg(F.count(F.lit(1)).alias("n_rows"))


_RAW = " ".join(silver.COMPANY_COLUMNS)
_US_DATE = "CAST(month(l_shipdate) AS STRING) || '/' || CAST(day(l_shipdate) AS STRING) || '/' || CAST(year(l_shipdate) AS STRING)"


@query(_RAW, "SELECT * FROM company_latest")
def deduplicated_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(raw_company(spark, sf_dir), silver.COMPANY_KEYS, "Date")


@query(" ".join(silver.COMPETITOR_COLUMNS), "SELECT * FROM competitor_latest")
def deduplicated_scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(raw_competitor(spark, sf_dir), silver.COMPETITOR_KEYS, "Scraped_At")


@query(
    "l_orderkey:i l_linenumber:i l_returnflag shipped l_quantity:2 l_extendedprice:2",
    f"""SELECT * FROM (SELECT l_orderkey, l_linenumber, l_returnflag, {_US_DATE} AS shipped, l_quantity, l_extendedprice, l_shipdate FROM lineitem)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag
            ORDER BY l_shipdate DESC, shipped DESC, l_quantity DESC, l_extendedprice DESC) = 1""",
)
def latest_by_us_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-first dates without padding must be compared as dates, not as text."""
    lines = line_items(spark, sf_dir).selectExpr(
        "l_orderkey", "l_linenumber", "l_returnflag", f"{_US_DATE} AS shipped", "l_quantity", "l_extendedprice"
    )
    return keep_latest(lines, ["l_orderkey", "l_linenumber", "l_returnflag"], "shipped", "M/d/yyyy")


@query(
    "Record_Type rows_kept:i",
    'SELECT "Record_Type", count(*) AS rows_kept FROM raw_company WHERE COLUMNS(*) IS NOT NULL GROUP BY ALL',
)
def rows_without_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = raw_company(spark, sf_dir).na.drop("any")
    return kept.groupBy("Record_Type").agg(F.count(F.lit(1)).alias("rows_kept"))


_COMPANY = (
    "record_type transaction_id transaction_date:d store_id:i store_name store_city store_region product_id product_name "
    "category sub_category quantity:i unit_cost:2 unit_retail:2 expense_type expense_amount:2"
)


@query(_COMPANY, "SELECT * FROM silver_company")
def silver_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).company


@query(_COMPANY + " product_key store_key date_key:i", "SELECT * FROM silver_sales")
def silver_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).sales


@query(
    "expense_key month_key:i store_key expense_type_key transaction_id transaction_date:d store_id:i store_name store_city "
    "store_region expense_type expense_amount:2",
    "SELECT * FROM silver_expenses",
)
def silver_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).expenses


@query(
    "competitor_key product_key date_key:i scraped_at:d competitor_name product_id:i product_name competitor_price:2",
    "SELECT * FROM silver_competitor",
)
def silver_competitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).competitor


@query("product_id our_unit_retail:4", "SELECT * FROM own_prices")
def average_own_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.average_own_price(company_read_once(spark, sf_dir))


@query(
    "brand_key n_rows:i",
    f"SELECT {key('p_brand', 'p_size', 'NULL')} AS brand_key, count(*) AS n_rows FROM part GROUP BY ALL",
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    hashed = surrogate_key(F.col("p_brand"), F.col("p_size"), F.lit(None))
    return parts.groupBy(hashed.alias("brand_key")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("date_key:i full_date:d day:i month:i quarter:i year:i is_weekend", "SELECT * FROM dim_date")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).dates


@query("month_key:i month_start_date:d month_end_date:d month_name quarter:i year:i", "SELECT * FROM dim_month")
def dim_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).months


@query("store_key store_id:i store_name store_city store_region create_at:d", "SELECT * FROM dim_stores")
def dim_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).stores


@query("competitor_key competitor_name create_at:d", "SELECT * FROM dim_competitors")
def dim_competitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).competitors


@query("expense_type_key expense_type create_at:d", "SELECT * FROM dim_expense_type")
def dim_expense_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).expense_types


VERSIONS = (
    "product_key product_id product_name category sub_category updated_at:d dbt_scd_id dbt_updated_at:d dbt_valid_from:d "
    "dbt_valid_to:d"
)


@query(VERSIONS, "SELECT * FROM dim_products")
def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).products


@query(
    "sales_key transaction_id product_key store_key date_key:i full_date:d quantity:i unit_cost:2 unit_retail:2 "
    "gross_revenue:2 gross_margin_amount:2",
    "SELECT * FROM fact_store_sales",
)
def fact_store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).sales_fact


@query(
    "expense_key month_date_key:i store_key expense_type_key month_start_date:d expense_amount:2",
    "SELECT * FROM fact_store_expenses",
)
def fact_store_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).expenses_fact


@query(
    "store_key expense_type_key month_key:i expense_amount:2",
    "SELECT * FROM monthly_expenses",
)
def monthly_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.monthly_expenses(warehouse(spark, sf_dir).expenses)


@query(
    "competitor_price_key competitor_key product_key date_key:i scraped_at:d competitor_price:2",
    "SELECT * FROM fact_competitor_prices",
)
def fact_competitor_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).competitor_fact


@query(
    "product_key store_key sales_week:d avg_unit_retail:4 avg_unit_cost:4 total_quantity_sold:i total_transactions:i",
    "SELECT * RENAME (quantity AS total_quantity_sold, transactions AS total_transactions) FROM weekly_sales",
)
def weekly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.weekly_sales(warehouse(spark, sf_dir).sales_fact, "product_key", "store_key")


@query(
    "product_key sales_week:d avg_competitor_price:4 min_competitor_price:2 max_competitor_price:2",
    "SELECT product_key, sales_week, a AS avg_competitor_price, lo AS min_competitor_price, hi AS max_competitor_price FROM weekly_competitor",
)
def weekly_competitor_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return marts.weekly_competitor(w.competitor_fact, w.dates)


@query(
    "sales_week:d",
    f"""SELECT DISTINCT {week('full_date')} AS sales_week FROM dim_date
        WHERE full_date BETWEEN (SELECT min(sales_week) FROM weekly_product_sales) AND (SELECT max(sales_week) FROM weekly_product_sales)""",
)
def week_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return weekly_spine(w.dates, w.save(marts.weekly_sales(w.sales_fact, "product_key"), "weekly-sales"))


_PRICES = (
    "avg_unit_retail:2 avg_unit_cost:2 avg_competitor_price:2 min_competitor_price:2 max_competitor_price:2 "
    "quantity_sold:i total_transactions:i"
)


@query(
    "product_id sales_week:d product_name category sub_category store_key store_id:i store_name store_region store_city "
    + _PRICES,
    "SELECT * FROM mart",
)
def pricing_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).pricing_mart


@query(
    "product_id sales_week:d product_name category sub_category " + _PRICES,
    "SELECT * FROM mart",
    mart="product_week_mart",
)
def product_week_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).product_week_mart


@query(
    "Transaction_ID occurrence_count:i",
    'SELECT "Transaction_ID", count(*) AS occurrence_count FROM raw_company GROUP BY ALL HAVING count(*) > 1',
)
def duplicate_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(raw_company(spark, sf_dir), "Transaction_ID")


@query(
    "Record_Type Store_Region Category n_rows:i id_chars:i regions:i",
    """SELECT "Record_Type", nullif("Store_Region", '') AS "Store_Region", "Category", count(*) AS n_rows,
        sum(length("Transaction_ID")) AS id_chars, count(nullif("Store_Region", '')) AS regions FROM raw_company GROUP BY ALL""",
)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table written as headered CSV and scanned with every column a string; CSV reads blank as NULL."""
    raw = raw_company(spark, sf_dir)
    path = f"{shared_dir(spark)}/shelfprice/csv-{uuid.uuid4().hex}"
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.write.options(header=True, **keep_blanks).csv(path)
    scanned = read_raw_csv(spark, path, raw.columns)
    return scanned.groupBy("Record_Type", "Store_Region", "Category").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.length("Transaction_ID")).alias("id_chars"),
        F.count("Store_Region").alias("regions"),
    )


@query(
    "product_id product_name category sub_category n_rows:i",
    "SELECT product_id, product_name, category, sub_category, count(*) AS n_rows FROM silver_sales GROUP BY ALL",
)
def sales_with_seed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales under a product mapping that is read from a CSV file."""
    path = f"{shared_dir(spark)}/shelfprice/seed-{uuid.uuid4().hex}"
    mapping = product_mapping(spark)
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    mapping.write.options(header=True, **keep_blanks).csv(path)
    w = warehouse(spark, sf_dir)
    seeded = Warehouse(w.raw_company, w.raw_competitor, read_seed(spark, path, mapping.schema), AS_OF)
    columns = ["product_id", "product_name", "category", "sub_category"]
    return seeded.sales.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "transaction_id transaction_date:d store_id:i product_id quantity:i",
    "SELECT * FROM silver_company WHERE transaction_date IS NOT NULL",
)
def month_first_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw tables with dates like 9/1/2024, deduplicated and parsed by their own format."""
    company, competitor = raw_company(spark, sf_dir), raw_competitor(spark, sf_dir)
    day = F.col("Date").try_cast("date")
    slashed = F.when(day.isNull(), "2/30/2024").otherwise(F.date_format(day, "M/d/yyyy"))
    w = Warehouse(company.withColumn("Date", slashed), competitor, as_of=AS_OF, company_date_format="M/d/yyyy")
    return w.company.filter(F.col("transaction_date").isNotNull())
