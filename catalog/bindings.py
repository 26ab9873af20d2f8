"""Raw retail tables derived from the driver tables.

A transaction is a line item, its product the part's brand, its store the
customer's nation; a scrape is a line item too, its competitor taken from the
supplier. Dirt (padding, odd case, impossible dates, signs, markers) is added by
row arithmetic over the whole tables. The texts below are valid in both
dialects apart from integer division, so both sides start from the same input.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession

from shelfprice.operators.joins import lookup_join

AS_OF = "2001-11-04"
LINES_PER_TASK = 250_000

_MONEY = "CAST({c} {{div}} 100 AS STRING) || '.' || lpad(CAST({c} % 100 AS STRING), 2, '0')"

# per line item: n drives the dirt, uc is the unit price in whole cents
BASE = {
    "n": "l_orderkey + l_linenumber",
    "t": "CAST(l_orderkey * 10 + l_linenumber AS STRING)",
    "pid": "89 + CAST(substr(p_brand, 7) AS INT)",
    "b": "CAST(substr(p_brand, 7) AS INT) + year(l_shipdate)",
    "q": "CAST(CAST(l_quantity AS INT) AS STRING)",
    "uc": "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) {div} CAST(l_quantity AS BIGINT)",
    "expense": "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) * CAST(floor(l_tax * 100 + 0.5) AS BIGINT) {div} 100",
    "d": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "l_returnflag": "l_returnflag",
    "l_suppkey": "l_suppkey",
    "l_linenumber": "l_linenumber",
}
STORE = {"nk": "CAST(c_nationkey AS STRING)", "c_nationkey": "c_nationkey"}

_IS_EXPENSE = "n % 10 = 3"
COMPANY = {
    "Record_Type": "CASE WHEN n % 10 = 3 THEN 'STORE_EXPENSE' WHEN n % 97 = 5 THEN 'refund' "
    "WHEN n % 10 = 4 THEN ' sales ' ELSE 'SALES' END",
    "Transaction_ID": "CASE WHEN n % 101 = 7 THEN 'tx-' || t WHEN n % 13 = 5 THEN ' Tx-' || t || ' ' ELSE 'Tx-' || t END",
    "Date": "CASE WHEN n % 211 = 9 THEN '2024-02-30' WHEN n % 223 = 11 THEN '2999-01-01' "
    "WHEN n % 11 = 2 THEN ' ' || d || ' ' ELSE d END",
    "Store_ID": "CASE WHEN n % 17 = 4 THEN '-' || nk WHEN n % 19 = 6 THEN nk || '.0' ELSE nk END",
    "Store_Name": "CASE WHEN n % 7 = 1 THEN ' Branch_' || nk || ' ' ELSE 'Branch_' || nk END",
    "Store_City": "CASE c_nationkey % 6 WHEN 0 THEN 'CAIRO' WHEN 1 THEN 'giza' WHEN 2 THEN 'Alexandria' "
    "WHEN 3 THEN ' tanta ' WHEN 4 THEN 'MANSOURA' ELSE 'ASWAN' END",
    "Store_Region": "CASE WHEN n % 61 = 10 THEN NULL WHEN c_nationkey % 6 = 5 THEN 'UPPER egypt' ELSE '' END",
    "Product_ID": f"CASE WHEN {_IS_EXPENSE} THEN 'NOT_APPLICABLE' WHEN n % 23 = 8 THEN '-' || CAST(pid AS STRING) "
    "WHEN n % 29 = 3 THEN CAST(pid AS STRING) || '.0' ELSE CAST(pid AS STRING) END",
    "Product_Name": f"CASE WHEN {_IS_EXPENSE} THEN 'N/A' WHEN n % 5 = 0 THEN 'PROD_' || CAST(pid AS STRING) "
    "ELSE 'Prod_' || CAST(pid AS STRING) END",
    "Category": f"CASE WHEN {_IS_EXPENSE} THEN 'NOT_APPLICABLE' WHEN b % 4 = 0 THEN 'BEVERAGES' "
    "WHEN b % 4 = 1 THEN 'groceries' WHEN b % 4 = 2 THEN 'Personal care' ELSE 'HOME CARE ' END",
    "Sub_Category": f"CASE WHEN {_IS_EXPENSE} THEN '' ELSE 'line-' || CAST(b % 3 AS STRING) END",
    "Quantity": f"CASE WHEN {_IS_EXPENSE} THEN '0' WHEN n % 41 = 0 THEN '0' WHEN n % 31 = 2 THEN '-' || q "
    "WHEN n % 37 = 5 THEN q || '.7' ELSE q END",
    "Unit_Cost": f"CASE WHEN {_IS_EXPENSE} THEN '0' WHEN n % 43 = 1 THEN 'abc' "
    f"ELSE {_MONEY.format(c='(uc * 8 {div} 10)')} END",
    "Unit_Retail": f"CASE WHEN {_IS_EXPENSE} THEN '0' WHEN n % 83 = 4 THEN '?' "
    f"WHEN n % 47 = 2 THEN CAST(uc {{div}} 100 AS STRING) || '.' "
    f"WHEN n % 53 = 3 THEN '-' || {_MONEY.format(c='uc')} ELSE {_MONEY.format(c='uc')} END",
    "Expense_Type": f"CASE WHEN NOT {_IS_EXPENSE} THEN 'Not_Applicable' WHEN l_returnflag = 'A' THEN 'RENT' "
    "WHEN l_returnflag = 'N' THEN 'utilities' ELSE ' salaries ' END",
    "Expense_Amount": f"CASE WHEN NOT {_IS_EXPENSE} THEN '0' WHEN n % 59 = 3 THEN ' ' "
    f"ELSE {_MONEY.format(c='expense')} END",
}
COMPETITOR = {
    "Scraped_At": "CASE WHEN n % 199 = 3 THEN d ELSE d || CASE WHEN n % 13 = 1 THEN 'T' ELSE ' ' END "
    "|| lpad(CAST(l_suppkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST(l_linenumber * 7 AS STRING), 2, '0') || ':00' "
    "|| CASE WHEN n % 17 = 2 THEN '.250' ELSE '' END END",
    "Competitor_Name": "CASE l_suppkey % 3 WHEN 0 THEN 'CARREFOUR' WHEN 1 THEN 'fathallah' ELSE ' Lulu ' END",
    "Product_ID": "CASE WHEN n % 67 = 4 THEN '999' WHEN n % 23 = 8 THEN '-' || CAST(pid AS STRING) ELSE CAST(pid AS STRING) END",
    "Product_Name": "CASE WHEN n % 73 = 6 THEN NULL WHEN n % 71 = 5 THEN 'Item x' ELSE 'Prod_' || CAST(pid AS STRING) END",
    "Competitor_Price": f"CASE WHEN n % 89 = 3 THEN 'n/a' ELSE {_MONEY.format(c='uc')} END",
}


def _fill(text: str, div: str) -> str:
    return text.replace("{div}", div)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by order, as the join with orders needs them; a single small file becomes several tasks."""
    return table(spark, sf_dir, "lineitem").repartition("l_orderkey")


def _exprs(columns: dict[str, str]) -> list[str]:
    return [f"{_fill(text, 'div')} AS {name}" for name, text in columns.items()]


def raw_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores are looked up by order, the shorter table. The join by order comes last, in as many tasks as there are
    lines for: the texts derived there are ten times as wide as what is shuffled, by whose bytes the planner goes."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey")
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem")
    tasks = max(spark.sparkContext.defaultParallelism, ceil(lines.count() / LINES_PER_TASK))
    lines = lookup_join(lines, parts, ["l_partkey"], "inner").repartition(tasks, "l_orderkey")
    lines = lookup_join(lines, lookup_join(orders, customers, ["o_custkey"], "inner"), ["l_orderkey"], "inner")
    return lines.selectExpr(*_exprs({**BASE, **STORE})).selectExpr(*_exprs(COMPANY))


def raw_competitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines are dealt out first only if too few tasks read them: the join with large parts deals them out anyway."""
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem")
    if lines.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        lines = line_items(spark, sf_dir)
    lines = lookup_join(lines, parts, ["l_partkey"], "inner")
    return lines.selectExpr(*_exprs(BASE)).selectExpr(*_exprs(COMPETITOR))


def _select(columns: dict[str, str], source: str) -> str:
    listed = ", ".join(f'{_fill(text, "//")} AS "{name}"' for name, text in columns.items())
    return f"SELECT {listed} FROM {source}"


_LINES = "lineitem JOIN part ON p_partkey = l_partkey"
_STORE_LINES = f"{_LINES} JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey"
RAW_COMPANY_SQL = _select(COMPANY, f"({_select({**BASE, **STORE}, _STORE_LINES)})")
RAW_COMPETITOR_SQL = _select(COMPETITOR, f"({_select(BASE, _LINES)})")
