"""Queries over the data-quality checks and anomaly monitors."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.bindings import AS_OF, line_items, raw_company, table
from catalog.layers import company_read_once, warehouse
from catalog.spec import REGISTRY, query
from shelfprice.operators import anomalies, checks
from shelfprice.operators.joins import lookup_join
from shelfprice.plans import facts, silver
from shelfprice.sources import shared_dir

_CITIES = ["Alexandria", "Cairo", "Giza", "Mansoura", "Tanta"]


@query("n_rows:i", "SELECT count(*) AS n_rows FROM silver_company WHERE unit_cost IS NULL HAVING count(*) > 0")
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.not_null(warehouse(spark, sf_dir).company, "unit_cost")


@query(
    "product_name n_rows:i",
    "SELECT product_name, count(*) AS n_rows FROM silver_company WHERE product_name IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
)
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique(warehouse(spark, sf_dir).company, "product_name")


@query(
    "duplicate_column occurrence_count:i",
    "SELECT transaction_id AS duplicate_column, count(*) AS occurrence_count FROM silver_company GROUP BY ALL HAVING count(*) > 1",
)
def check_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.no_duplicates(warehouse(spark, sf_dir).company, "transaction_id")


@query(
    "store_city n_rows:i",
    f"SELECT store_city, count(*) AS n_rows FROM silver_company WHERE store_city NOT IN {tuple(_CITIES)} GROUP BY ALL",
)
def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.accepted_values(warehouse(spark, sf_dir).company, "store_city", _CITIES)


@query(
    "product_key n_rows:i",
    """SELECT product_key, count(*) AS n_rows FROM silver_competitor WHERE scraped_at >= DATE '1996-01-01'
        AND product_key IS NOT NULL AND product_key NOT IN (SELECT product_key FROM dim_products) GROUP BY ALL""",
)
def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return checks.relationships(w.competitor, "product_key", w.products, "product_key", "scraped_at >= DATE '1996-01-01'")


@query(
    "sales_key transaction_id gross_revenue:2",
    "SELECT * FROM fact_store_sales WHERE NOT (gross_revenue < 100000)",
)
def check_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.expression_is_true(warehouse(spark, sf_dir).sales_fact, "gross_revenue < 100000")


@query(
    "Transaction_ID n_rows:i",
    """SELECT "Transaction_ID", count(*) AS n_rows FROM raw_company WHERE NOT regexp_matches("Transaction_ID", '^Tx-[0-9]+$') GROUP BY ALL""",
)
def check_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.matches_regex(raw_company(spark, sf_dir), "Transaction_ID", silver.TRANSACTION_PATTERN)


@query(
    "transaction_date:d n_rows:i",
    f"""SELECT transaction_date, count(*) AS n_rows FROM silver_company
        WHERE transaction_date < DATE '1995-06-01' OR transaction_date > DATE '{AS_OF}' GROUP BY ALL""",
)
def check_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.valid_date_range(company_read_once(spark, sf_dir), "transaction_date", "1995-06-01", AS_OF)


@query(
    "product_id price:2 avg_ref_price:4 n_rows:i",
    """WITH r AS (SELECT p_brand, avg(p_retailprice) AS a FROM part GROUP BY ALL),
        m AS (SELECT p_brand, CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS price FROM lineitem JOIN part ON p_partkey = l_partkey)
        SELECT p_brand AS product_id, price, a AS avg_ref_price, count(*) AS n_rows FROM m JOIN r USING (p_brand)
        WHERE price > a * 5 OR price < a * CAST(0.1 AS DOUBLE) GROUP BY ALL""",
)
def check_price_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit prices before any cleaning, against the mean list price of the brand."""
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_brand AS product_id", "p_retailprice")
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("price")
    brands = parts.select("l_partkey", "product_id")
    prices = lookup_join(line_items(spark, sf_dir), brands, ["l_partkey"], "inner").select("product_id", price)
    return checks.price_bounds(prices, "price", parts, "product_id", "p_retailprice")


@query(
    "total_rows:i unmatched_competitors:i unmatched_products:i unmatched_dates:i",
    """SELECT * FROM (SELECT count(*) AS total_rows, count(*) FILTER (competitor_key = '-1') AS unmatched_competitors,
        count(*) FILTER (product_key = '-1') AS unmatched_products, count(*) FILTER (date_key = -1) AS unmatched_dates
        FROM fact_competitor_prices)
        WHERE unmatched_competitors > 0.01 * total_rows OR unmatched_products > 0.01 * total_rows OR unmatched_dates > 0.01 * total_rows""",
)
def check_unmatched_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"unmatched_competitors": "competitor_key", "unmatched_products": "product_key", "unmatched_dates": "date_key"}
    return checks.unmatched_share(warehouse(spark, sf_dir).competitor_fact, names, threshold=0.01)


@query(
    "store_key product_key date_key:i row_count:i",
    "SELECT store_key, product_key, date_key, count(*) AS row_count FROM fact_store_sales GROUP BY ALL HAVING count(*) > 1",
)
def check_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.grain_is_unique(warehouse(spark, sf_dir).sales_fact, ["store_key", "product_key", "date_key"])


@query(
    "source_rows:i fact_rows:i",
    "SELECT (SELECT count(*) FROM silver_expenses) AS source_rows, (SELECT count(*) FROM fact_store_expenses) AS fact_rows",
)
def check_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact holds months, the source single expenses, so the counts differ and are reported."""
    w = warehouse(spark, sf_dir)
    return checks.row_counts_match(w.expenses, w.expenses_fact)


@query(
    "sales_key gross_revenue:2 gross_margin_amount:2 expected_gross_margin:2",
    """WITH f AS (SELECT * REPLACE (gross_margin_amount + CASE WHEN quantity % 13 = 0 THEN 1 ELSE 0 END AS gross_margin_amount) FROM fact_store_sales),
        e AS (SELECT sales_key, gross_revenue, round(gross_margin_amount, 2) AS gross_margin_amount,
              round(gross_revenue - quantity * unit_cost, 2) AS expected_gross_margin FROM f)
        SELECT * FROM e WHERE abs(gross_margin_amount - expected_gross_margin) > 0.005""",
)
def check_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every thirteenth quantity gets a margin that is off by one."""
    off = F.when(F.col("quantity") % 13 == 0, 1).otherwise(0)
    fact = warehouse(spark, sf_dir).sales_fact.withColumn("gross_margin_amount", F.col("gross_margin_amount") + off)
    return checks.margin_recomputes(fact)


@query(
    "scraped_at:d",
    """SELECT DISTINCT scraped_at FROM silver_competitor WHERE day(scraped_at) = 5 AND scraped_at <=
        (SELECT max(scraped_at) FROM silver_competitor WHERE day(scraped_at) <> 5)""",
)
def check_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that skipped the fifth of every month."""
    scrapes = warehouse(spark, sf_dir).competitor
    return checks.skipped_late_rows(scrapes, scrapes.filter(F.day("scraped_at") != 5), "scraped_at")


_REPORT = {
    "not_null unit_cost": ("error", "SELECT 1 FROM silver_company WHERE unit_cost IS NULL"),
    "unique transaction_id": ("warn", "SELECT transaction_id FROM silver_company GROUP BY ALL HAVING count(*) > 1"),
    "accepted store_city": ("warn", f"SELECT 1 FROM silver_company WHERE store_city NOT IN {tuple(_CITIES)}"),
    "positive quantity of sales": ("error", "SELECT 1 FROM silver_company WHERE record_type = 'Sales' AND NOT quantity > 0"),
    "expense grain": ("error", "SELECT 1 FROM fact_store_expenses GROUP BY store_key, expense_type_key, month_date_key HAVING count(*) > 1"),
    "expense rows": ("error", "SELECT 1 WHERE (SELECT count(*) FROM monthly_expenses) <> (SELECT count(*) FROM fact_store_expenses)"),
}


@query(
    "check_name severity failures:i status",
    " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, '{severity}' AS severity, count(*) AS failures, "
        f"CASE WHEN count(*) = 0 THEN 'pass' ELSE '{'warn' if severity == 'warn' else 'fail'}' END AS status FROM ({rows})"
        for name, (severity, rows) in _REPORT.items()
    ),
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scrapes are read once, for the span of their months."""
    w = warehouse(spark, sf_dir, read_once={"competitor"})
    company, expenses = w.company, w.save(w.expenses_fact, "fact-expenses")
    grain = ["store_key", "expense_type_key", "month_date_key"]
    rules = {
        "not_null unit_cost": (company, lambda df: checks.not_null(df, "unit_cost"), None),
        "unique transaction_id": (company, lambda df: checks.no_duplicates(df, "transaction_id"), None),
        "accepted store_city": (company, lambda df: checks.accepted_values(df, "store_city", _CITIES), None),
        "positive quantity of sales": (company, lambda df: checks.expression_is_true(df, "quantity > 0"), "record_type = 'Sales'"),
        "expense grain": (expenses, lambda df: checks.grain_is_unique(df, grain), None),
        "expense rows": (expenses, lambda df: checks.row_counts_match(facts.monthly_expenses(w.expenses), df), None),
    }
    return checks.run_checks(
        checks.Check(name, df, rule, severity=_REPORT[name][0], where=where) for name, (df, rule, where) in rules.items()
    )


_TABLE = {
    "unit_cost known": ("error", ["cost"], "unit_cost IS NULL"),
    "quantity known": ("warn", ["sales"], "quantity IS NULL"),
    "quantity positive": ("error", ["sales"], "record_type = 'Sales' AND quantity <= 0"),
    "cost below price": ("warn", ["cost", "sales"], "unit_cost >= unit_retail"),
    "city accepted": ("warn", ["store"], f"store_city NOT IN {tuple(_CITIES)}"),
    "region known": ("warn", ["store"], "store_region IS NULL"),
    "date in range": ("warn", ["sales"], "transaction_date < DATE '1993-01-01'"),
    "id has its shape": ("warn", ["keys"], "NOT (transaction_id LIKE 'Tx-%')"),
    "expense not negative": ("error", ["cost"], "expense_amount < 0"),
    "transaction once": ("warn", ["keys"], ("transaction_id",)),
    "transaction and store once": ("warn", ["keys"], ("transaction_id", "store_id")),
    "product and day once": ("warn", ["sales"], ("product_id", "transaction_date", "store_id")),
}


def _table_sql(tags: set[str]) -> str:
    def rows(rule) -> str:
        if isinstance(rule, str):
            return f"SELECT 1 FROM silver_company WHERE {rule}"
        return f"SELECT 1 FROM silver_company GROUP BY {', '.join(rule)} HAVING count(*) > 1"

    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, '{severity}' AS severity, count(*) AS failures, "
        f"CASE WHEN count(*) = 0 THEN 'pass' ELSE '{'warn' if severity == 'warn' else 'fail'}' END AS status FROM ({rows(rule)})"
        for name, (severity, own, rule) in _TABLE.items()
        if tags & set(own)
    )


def table_checks(df: DataFrame) -> list[checks.Check]:
    made = []
    for name, (severity, tags, rule) in _TABLE.items():
        options = {"severity": severity, "tags": tags}
        made.append(checks.Check.of_rows(name, df, F.expr(rule), **options) if isinstance(rule, str) else checks.Check.of_keys(name, df, *rule, **options))
    return made


@query("check_name severity failures:i status", _table_sql({"cost", "sales", "store", "keys"}))
def table_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve checks of one table in one scan."""
    return checks.run_checks(table_checks(company_read_once(spark, sf_dir)))


@query("check_name severity failures:i status", _table_sql({"cost", "keys"}))
def tagged_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks with one of two tags."""
    return checks.run_checks(table_checks(company_read_once(spark, sf_dir)), tags=["cost", "keys"])


_TYPE = "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' ELSE lower(column_type) END"


@query(
    "change column saved_type current_type",
    f"""WITH c AS (SELECT column_name AS name, {_TYPE} AS kind FROM (DESCRIBE part))
        SELECT 'added' AS change, 'p_margin' AS "column", CAST(NULL AS VARCHAR) AS saved_type, 'double' AS current_type
        UNION ALL SELECT 'removed', name, kind, NULL FROM c WHERE name = 'p_brand'
        UNION ALL SELECT 'type_changed', name, kind, 'string' FROM c WHERE name = 'p_size'""",
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's schema against that of a later load with a column more, one less and one of another type."""
    parts = table(spark, sf_dir, "part")
    later = parts.drop("p_brand").withColumns({"p_size": F.col("p_size").cast("string"), "p_margin": F.col("p_retailprice") * 0.1})
    return checks.schema_report(spark, parts.schema, later.schema)


@query(
    "column expected actual",
    f"""WITH c AS (SELECT column_name AS "column", {_TYPE} AS actual FROM (DESCRIBE part))
        SELECT "column", 'string' AS expected, actual FROM c WHERE actual <> 'string'""",
)
def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column that is not a text."""
    parts = table(spark, sf_dir, "part")
    return reduce(DataFrame.unionByName, [checks.column_is_of_type(parts, c, "string") for c in parts.columns])


def _monitor(metrics: str, period: str, trailing: int) -> str:
    """The trailing comparison as a calendar range join, over (bucket, metric, value)."""
    return f"""WITH {metrics},
        h AS (SELECT m.bucket, m.metric, count(p.value) AS n, avg(p.value) AS mean, stddev_samp(p.value) AS deviation
              FROM m LEFT JOIN m p ON p.metric = m.metric AND p.bucket < m.bucket AND p.bucket >= m.bucket - INTERVAL {trailing} {period}
              GROUP BY ALL),
        j AS (SELECT m.bucket, m.metric, m.value, CASE WHEN n >= {trailing} THEN mean END AS mean,
              CASE WHEN n >= {trailing} THEN deviation END AS deviation FROM m JOIN h USING (bucket, metric)),
        z AS (SELECT *, CASE WHEN deviation > 1e-9 THEN (value - mean) / deviation END AS z_score FROM j)
        SELECT *, coalesce(abs(z_score) > 3, false) AS is_anomaly FROM z"""


def _spine(period: str, counted: str) -> str:
    return f"""s AS (SELECT CAST(unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 {period})) AS DATE) AS bucket FROM {counted})"""


_SCORED = "bucket:d metric value:4 mean:4 deviation:4 z_score:4 is_anomaly"


@query(
    _SCORED,
    _monitor(
        f"""c AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS bucket, count(*) AS n FROM events GROUP BY ALL), {_spine('day', 'c')},
        m AS (SELECT bucket, 'row_count' AS metric, CAST(coalesce(n, 0) AS DOUBLE) AS value FROM s LEFT JOIN c USING (bucket))""",
        "day",
        14,
    ),
)
def event_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.volume_anomalies(table(spark, sf_dir, "events"), "ts")


@query(
    _SCORED,
    _monitor(
        f"""c AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS bucket, count(*) AS n FROM lineitem GROUP BY ALL), {_spine('month', 'c')},
        m AS (SELECT bucket, 'row_count' AS metric, CAST(coalesce(n, 0) AS DOUBLE) AS value FROM s LEFT JOIN c USING (bucket))""",
        "month",
        6,
    ),
)
def monthly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.volume_anomalies(table(spark, sf_dir, "lineitem"), "l_shipdate", "month", trailing=6)


@query(
    _SCORED,
    _monitor(
        f"""t AS (SELECT DISTINCT epoch_us(ts) AS t, CAST(date_trunc('day', ts) AS DATE) AS bucket FROM events),
        g AS (SELECT bucket, t, t - lag(t) OVER (PARTITION BY bucket ORDER BY t) AS gap FROM t),
        c AS (SELECT bucket, greatest(min(t) - epoch_us(CAST(bucket AS TIMESTAMP)),
                epoch_us(CAST(bucket + INTERVAL 1 DAY AS TIMESTAMP)) - max(t), coalesce(max(gap), 0)) AS longest FROM g GROUP BY bucket),
        {_spine('day', 'c')},
        m AS (SELECT bucket, 'seconds_without_data' AS metric, coalesce(longest, 86400000000) / 1000000.0 AS value
              FROM s LEFT JOIN c USING (bucket))""",
        "day",
        7,
    ),
)
def event_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.freshness_anomalies(table(spark, sf_dir, "events"), "ts", trailing=7)


_METRIC_SQL = {
    "sum": "sum(value)", "average": "avg(value)", "min": "min(value)", "max": "max(value)", "variance": "var_samp(value)",
    "null_percent": "avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) * 100",
}


@query(
    _SCORED,
    _monitor(
        "w AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS bucket, "
        + ", ".join(f'{sql} AS "{name}"' for name, sql in _METRIC_SQL.items())
        + " FROM (SELECT ts, CASE WHEN event_type <> 'error' THEN value END AS value FROM events) GROUP BY ALL), m AS ("
        + " UNION ALL ".join(f"SELECT bucket, '{n}' AS metric, CAST(\"{n}\" AS DOUBLE) AS value FROM w" for n in _METRIC_SQL)
        + ")",
        "day",
        10,
    ),
)
def event_value_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of error events count as missing."""
    events = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return anomalies.column_anomalies(events, "ts", "value", list(_METRIC_SQL), trailing=10)


@query(_SCORED, REGISTRY["event_value_anomalies"].sql)
def event_values_in_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from states that three loads have left, the last one with rows of all days."""
    events = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    late, day = F.pmod(F.xxhash64("ts", "value"), F.lit(5)) == 0, F.day("ts")
    path = f"{shared_dir(spark)}/shelfprice/states-{uuid.uuid4().hex}"
    for part in (events.filter((day < 15) & ~late), events.filter((day >= 15) & ~late), events.filter(late)):
        anomalies.bucket_states(part, "ts", "value").write.mode("append").parquet(path)
    return anomalies.state_anomalies(spark.read.parquet(path), list(_METRIC_SQL), trailing=10)
