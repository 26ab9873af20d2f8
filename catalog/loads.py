"""Queries over history, upserts, incremental loads and publishing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.bindings import AS_OF, raw_competitor
from catalog.layers import VERSIONS, warehouse
from catalog.oracle import from_the_start, newest_first, versions
from catalog.spec import query
from shelfprice.functions import week_start
from shelfprice.operators.dedup import keep_latest
from shelfprice.operators.history import apply_snapshot, as_of_join, build_history, overlapping_versions, splice_history
from shelfprice.operators.partitioned import Table, append, load, merge, refresh
from shelfprice.operators.publish import ingest, published
from shelfprice.operators.upsert import (
    above_watermark,
    append_missing,
    incremental_merge,
    merge_dimension,
    upsert,
    upsert_metrics,
)
from shelfprice.plans import silver
from shelfprice.plans.dims import PRODUCT_ATTRIBUTES
from shelfprice.plans.marts import weekly_sales
from shelfprice.sources import shared_dir
from shelfprice.sources import write_layer as write_through
from shelfprice.sources.staging import drop, rows_of, short_lived_layers

_ATTRIBUTES = ", ".join(PRODUCT_ATTRIBUTES)
_RUNS = ["1996-12-31", "1999-06-30", AS_OF]


def _run(i: int, until: str) -> str:
    return f"""run{i} AS (SELECT product_key, {_ATTRIBUTES}, transaction_date AS updated_at FROM silver_sales
        WHERE transaction_date <= DATE '{until}' QUALIFY row_number() OVER (PARTITION BY product_key
        ORDER BY transaction_date DESC, {newest_first(_ATTRIBUTES)}) = 1)"""


_SNAPSHOTS = f"""WITH {", ".join(_run(i, u) for i, u in enumerate(_RUNS))},
    opened AS (SELECT * FROM run0
        UNION ALL SELECT * FROM run1 r WHERE NOT EXISTS (SELECT 1 FROM run0 o WHERE o.product_key = r.product_key AND o.updated_at >= r.updated_at)
        UNION ALL SELECT * FROM run2 r WHERE NOT EXISTS (SELECT 1 FROM run1 o WHERE o.product_key = r.product_key AND o.updated_at >= r.updated_at)),
    closed AS (SELECT *, lead(updated_at) OVER (PARTITION BY product_key ORDER BY updated_at) AS valid_to FROM opened)
    {versions('closed')}"""


@query(VERSIONS, _SNAPSHOTS)
def snapshot_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshot runs over a growing log, the last one repeated to show that it changes nothing."""
    w = warehouse(spark, sf_dir)
    sales, history = w.sales, None
    for until in [*_RUNS, _RUNS[-1]]:
        log = sales.filter(F.col("transaction_date") <= F.lit(until).cast("date"))
        history = w.save(apply_snapshot(history, log, "product_key", PRODUCT_ATTRIBUTES, "transaction_date"), "snapshot")
    return history


@query(
    VERSIONS,
    f"""WITH days AS (SELECT *, lead(updated_at) OVER (PARTITION BY product_key ORDER BY updated_at) AS valid_to FROM product_days)
        {versions('days')}""",
)
def daily_product_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = warehouse(spark, sf_dir).sales
    return build_history(sales, "product_key", PRODUCT_ATTRIBUTES, "transaction_date", "timestamp")


@query(
    VERSIONS,
    f"""WITH days AS (SELECT *, lead(updated_at) OVER (PARTITION BY product_key ORDER BY updated_at) AS valid_to FROM product_days)
        {versions('days')}""",
)
def spliced_product_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the days first, then two late loads: the history is that of a log in order."""
    w = warehouse(spark, sf_dir)
    sales = w.save(w.sales.select("product_key", *PRODUCT_ATTRIBUTES, "transaction_date"), "sales")
    part = F.pmod(F.xxhash64("transaction_date", "product_key"), F.lit(6))
    history = build_history(sales.filter(part >= 2), "product_key", PRODUCT_ATTRIBUTES, "transaction_date", "timestamp")
    for i in (1, 0):
        history = splice_history(w.save(history, "history"), sales.filter(part == i), "product_key", PRODUCT_ATTRIBUTES, "transaction_date")
    return history


_WEEK = "product_key store_key sales_week:d avg_unit_retail:4 avg_unit_cost:4 total_quantity_sold:i total_transactions:i"


@query(_WEEK, "SELECT * RENAME (quantity AS total_quantity_sold, transactions AS total_transactions) FROM weekly_sales")
def weekly_sales_in_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of the fact, the last one late: only the weeks that a load touches are summed again."""
    w = warehouse(spark, sf_dir)
    with short_lived_layers(spark) as kept:
        fact = w.save(w.sales_fact, "fact-sales")
        kept.append(fact)
    root = f"{shared_dir(spark)}/shelfprice/weeks-{uuid.uuid4().hex}"
    rows = Table(spark, f"{root}/fact", fact.schema, week_start(F.col("full_date")))
    build = lambda df: weekly_sales(df, "product_key", "store_key")
    weeks = Table(spark, f"{root}/weekly", build(fact).schema, F.col("sales_week"))
    day = F.coalesce(F.col("full_date"), F.lit("1990-01-01").cast("date"))
    late = (F.year(day) == 1994) & (F.col("quantity") % 7 == 0)
    for picked in ((day < "1996-01-01") & ~late, day >= "1996-01-01", (day < "1996-01-01") & late):
        refresh(weeks, rows, append(rows, rows_of(fact, picked)), build)
    drop(fact)
    return weeks.read()


@query(
    "product_key transaction_date:d dbt_valid_from:d category n_rows:i",
    f"""WITH v AS (SELECT product_key, updated_at AS dbt_valid_from, category, {from_the_start('updated_at')} AS starts FROM product_changes)
        SELECT s.product_key, s.transaction_date, v.dbt_valid_from, v.category, count(*) AS n_rows
        FROM silver_sales s ASOF LEFT JOIN v ON s.product_key = v.product_key AND s.transaction_date >= v.starts GROUP BY ALL""",
)
def sales_as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    sales = w.sales.select("product_key", "transaction_date")
    matched = as_of_join(sales, w.products, "product_key", "transaction_date", ["dbt_valid_from", "category"])
    return matched.groupBy(*matched.columns).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "product_key window_a_start:d window_a_end:d window_b_start:d window_b_end:d n_open:i",
    """WITH w AS (SELECT product_key, category, min(transaction_date) AS f, max(transaction_date) AS t FROM silver_sales GROUP BY ALL),
        pairs AS (SELECT b.product_key, b.category, a.f AS af, a.t AS ae, b.f AS bf, b.t AS bt
            FROM w a JOIN w b ON a.product_key = b.product_key AND a.f < b.f AND a.t > b.f)
        SELECT product_key, af AS window_a_start, ae AS window_a_end, bf AS window_b_start, bt AS window_b_end,
            count(*) OVER (PARTITION BY product_key, category) AS n_open FROM pairs
        QUALIFY row_number() OVER (PARTITION BY product_key, category ORDER BY ae DESC, af DESC) = 1""",
)
def overlapping_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First to last sale of each category a product ever had; categories recur, so these windows overlap."""
    spans = warehouse(spark, sf_dir).sales.groupBy("product_key", "category").agg(
        F.min("transaction_date").alias("dbt_valid_from"), F.max("transaction_date").alias("dbt_valid_to")
    )
    return overlapping_versions(spans, "product_key")


_KEYS = ", ".join(f'"{k}"' for k in silver.COMPANY_KEYS)
_VALUES = [c for c in silver.COMPANY_COLUMNS if c not in silver.COMPANY_KEYS]
_REST = ", ".join(f'"{c}"' for c in _VALUES)


def _latest_where(condition: str) -> str:
    return f"""SELECT * FROM raw_company WHERE {condition} QUALIFY row_number() OVER (PARTITION BY {_KEYS}
        ORDER BY try_cast(trim("Date") AS TIMESTAMP) DESC NULLS LAST, {newest_first(_REST)}) = 1"""


_DIFFERS = " OR ".join(f's."{c}" IS DISTINCT FROM t."{c}"' for c in _VALUES)
_MATCH = " AND ".join(f't."{k}" = s."{k}"' for k in silver.COMPANY_KEYS)
_PICKED = ", ".join(f'CASE WHEN op = \'keep\' THEN "t_{c}" ELSE "s_{c}" END AS "{c}"' for c in silver.COMPANY_COLUMNS)
_BOTH = ", ".join(f't."{c}" AS "t_{c}", s."{c}" AS "s_{c}"' for c in silver.COMPANY_COLUMNS)
_MERGED = f"""WITH t AS ({_latest_where('"Date" < ' + "'1999'")}), s AS ({_latest_where('"Date" >= ' + "'1997'")}),
    merged AS (SELECT CASE WHEN t."Store_Name" IS NULL THEN 'insert' WHEN s."Store_Name" IS NULL THEN 'keep'
        WHEN {_DIFFERS} THEN 'update' ELSE 'keep' END AS op, {_BOTH} FROM t FULL JOIN s ON {_MATCH})"""


def _company_batches(spark: SparkSession, sf_dir: str, read_once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two overlapping extracts of the raw transactions, deduplicated. What reads each of them once needs no copy on disk."""
    w = warehouse(spark, sf_dir)
    raw = w.save(w.raw_company, "bronze")
    batches = [raw.filter(F.col("Date") < "1999"), raw.filter(F.col("Date") >= "1997")]
    if read_once:
        target, source = [keep_latest(b, silver.COMPANY_KEYS, "Date", hashed=True) for b in batches]
        return target, source
    target, source = [w.save(keep_latest(b, silver.COMPANY_KEYS, "Date"), "extract") for b in batches]
    drop(raw)
    return target, source


@query(" ".join(silver.COMPANY_COLUMNS) + " op", f"{_MERGED} SELECT op, {_PICKED} FROM merged")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(*_company_batches(spark, sf_dir, read_once=True), silver.COMPANY_KEYS, hashed=True).withColumnRenamed("_op", "op")


@query(
    "num_affected_rows:i num_inserted_rows:i num_updated_rows:i num_deleted_rows:i",
    f"""{_MERGED} SELECT count(*) FILTER (op <> 'keep') AS num_affected_rows, count(*) FILTER (op = 'insert') AS num_inserted_rows,
        count(*) FILTER (op = 'update') AS num_updated_rows, 0 AS num_deleted_rows FROM merged""",
)
def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_metrics(upsert(*_company_batches(spark, sf_dir, read_once=True), silver.COMPANY_KEYS, hashed=True))


def _by_year(spark: SparkSession, rows: DataFrame) -> Table:
    """A table of the raw transactions with a folder for each year (the first four characters of a date)."""
    path = f"{shared_dir(spark)}/shelfprice/by-year-{uuid.uuid4().hex}"
    return Table(spark, path, rows.schema, F.regexp_extract("Date", "^[0-9]{4}", 0))


@query(" ".join(silver.COMPANY_COLUMNS), f"{_MERGED} SELECT {_PICKED} FROM merged")
def merge_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert into a table laid out by year, which rewrites the years that the batch touches."""
    target, source = _company_batches(spark, sf_dir)
    table = _by_year(spark, target)
    load(table, target, silver.COMPANY_KEYS)
    drop(target)
    merge(table, source, silver.COMPANY_KEYS)
    drop(source)
    return table.read()


@query(
    "step:i action n_inserted:i n_updated:i n_rows:i",
    f"""{_MERGED} SELECT 1 AS step, 'created' AS action, count(*) AS n_inserted, 0 AS n_updated, count(*) AS n_rows FROM t
        UNION ALL SELECT 2, 'unchanged', 0, 0, count(*) FROM t
        UNION ALL SELECT 3, 'merged', count(*) FILTER (op = 'insert'), count(*) FILTER (op = 'update'), count(*) FROM merged""",
)
def repeated_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load three times: it creates the table, finds nothing new in the same batch, and merges the next one."""
    target, source = _company_batches(spark, sf_dir)
    table = _by_year(spark, target)
    steps = []
    for i, batch in enumerate((target, target, source), 1):
        done = load(table, batch, silver.COMPANY_KEYS)
        counts = table.read().agg(F.count(F.lit(1)).alias("n_rows")).first()
        steps.append((i, done.action, done.inserted, done.updated, counts.n_rows))
        if i > 1:
            drop(batch)
    return spark.createDataFrame(steps, "step int, action string, n_inserted long, n_updated long, n_rows long")


_SALE = "transaction_id transaction_date:d store_id:i product_id quantity:i unit_retail:2"
_CUT = "DATE '2000-01-01'"


@query(
    _SALE,
    f"""WITH target AS (SELECT * FROM silver_sales WHERE transaction_date < {_CUT}),
        batch AS (SELECT * REPLACE (quantity + 1 AS quantity) FROM silver_sales
                  WHERE transaction_date > (SELECT max(transaction_date) - 30 FROM target))
        SELECT * FROM batch
        UNION ALL SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.transaction_id = t.transaction_id)""",
)
def merge_above_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch with changed quantities, re-reading thirty days before the watermark."""
    w = warehouse(spark, sf_dir)
    sales = w.save(w.sales, "sales")
    target = sales.filter(F.col("transaction_date") < F.lit("2000-01-01").cast("date"))
    batch = sales.withColumn("quantity", F.col("quantity") + 1)
    return incremental_merge(target, batch, ["transaction_id"], "transaction_date", lookback_days=30)


@query(
    "sales_key transaction_id quantity:i gross_revenue:2",
    """SELECT * FROM fact_store_sales
        QUALIFY transaction_id IS NULL OR NOT coalesce(bool_or(quantity < 25) OVER (PARTITION BY transaction_id), false)""",
)
def append_new_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    fact = w.save(w.sales_fact, "fact-sales")
    return append_missing(fact.filter(F.col("quantity") < 25), fact, ["transaction_id"])


@query(
    "expense_key store_key month_date_key:i expense_amount:2",
    """WITH target AS (SELECT * FROM fact_store_expenses WHERE month_date_key < 200001) SELECT * FROM fact_store_expenses s
        WHERE NOT EXISTS (SELECT 1 FROM target f WHERE f.expense_key = s.expense_key)""",
)
def append_new_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    fact = w.save(w.expenses_fact, "fact-expenses")
    return append_missing(fact.filter(F.col("month_date_key") < 200001), fact, ["expense_key"])


@query(
    "competitor_price_key competitor_key product_key date_key:i scraped_at:d competitor_price:2",
    f"""SELECT * FROM fact_competitor_prices
        WHERE scraped_at > (SELECT max(scraped_at) FROM fact_competitor_prices WHERE scraped_at < {_CUT})""",
)
def append_new_scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    fact = w.save(w.competitor_fact, "fact-competitor")
    loaded = fact.filter(F.col("scraped_at") < F.lit("2000-01-01").cast("date"))
    return above_watermark(fact, loaded, "scraped_at")


@query("store_key store_id:i store_name create_at:d", "SELECT * FROM dim_stores")
def merged_store_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = warehouse(spark, sf_dir).stores
    return merge_dimension(stores.filter(F.col("store_id") < 10), stores, "store_key")


@query(
    "published_table n_rows:i n_dates:i",
    f"""{_MERGED} SELECT 'company' AS published_table, count(*) AS n_rows,
            count(DISTINCT CASE WHEN op = 'keep' THEN "t_Date" ELSE "s_Date" END) AS n_dates FROM merged
        UNION ALL SELECT 'competitor', count(*), count(DISTINCT "Scraped_At") FROM competitor_latest""",
)
def published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingest runs through staging, audit and publish; the counts are read back through the manifest."""
    root = f"{shared_dir(spark)}/shelfprice/bronze-{uuid.uuid4().hex}"
    # both runs read the scrapes: they are deduplicated once
    scrapes = write_through(keep_latest(raw_competitor(spark, sf_dir), silver.COMPETITOR_KEYS, "Scraped_At"), "scrapes")
    keys = {"company": silver.COMPANY_KEYS, "competitor": silver.COMPETITOR_KEYS}
    for i, batch in enumerate(_company_batches(spark, sf_dir)):
        ingest(spark, root, f"run{i}", {"company": batch, "competitor": scrapes}, keys)
    dates = {"company": "Date", "competitor": "Scraped_At"}
    counts = [
        published(spark, root, name).agg(
            F.lit(name).alias("published_table"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(d).alias("n_dates")
        )
        for name, d in dates.items()
    ]
    return counts[0].unionByName(counts[1])
