"""Registered queries against their SQL. A few by default, all with SHELFPRICE_ALL=1."""

import math
import os
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as driver
from catalog import REGISTRY, bindings, layers, loads
from shelfprice.sources import write_through

duckdb = pytest.importorskip("duckdb")

SF = os.environ.get("SHELFPRICE_SF", "/root/testdata/sf0.001")
FEW = [
    "weekly_store_sales", "deduplicated_company", "silver_sales", "guarded_dates", "dim_products", "snapshot_runs", "keyed_upsert",
    "fact_competitor_prices", "pricing_mart", "price_recommendations", "quality_report", "event_freshness",
    "append_new_transactions", "overlapping_windows", "month_first_dates", "sales_with_seed_file", "grid_elasticity",
]
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")
NAMES = list(REGISTRY) if os.environ.get("SHELFPRICE_ALL") else FEW


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, (float, Decimal)) and not isinstance(v, bool):
        return "nan" if math.isnan(v) else repr(float(v) + 0.0)
    return str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sql, name):
    df = driver.queries()[name](spark, SF)
    text = driver.oracle_sql().get(name)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if text is None:
        assert got
        return
    result = sql.sql(text)
    assert sorted(result.columns) == columns
    order = [result.columns.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(driver.oracle_sql()) and set(REGISTRY) <= set(driver.queries())


def test_entry(spark):
    assert not driver.entry(spark).isEmpty()


def test_a_company_layer_read_once_is_not_written(spark):
    """Queries that read the cleaned transactions a single time clean only the columns they need."""
    for name in ("average_own_price", "check_date_range"):
        plan = REGISTRY[name].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "lineitem" in plan or "l_orderkey" in plan
        assert "initcap" not in plan


def test_scrapes_are_deduplicated_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(loads, "write_through", lambda df, label: (calls.append(label), write_through(df, label))[1])
    assert REGISTRY["published_tables"].run(spark, "/root/testdata/sf0.001").count() == 2
    assert calls == ["scrapes"]


def line_items_under(spark, path, n=40):
    """Tables of ``n`` line items under ``path``."""
    lines = spark.range(n).selectExpr(
        "id AS l_orderkey", "id % 5 AS l_partkey", "id % 3 AS l_suppkey", "1 AS l_linenumber", "2.0D AS l_quantity", "10.0D AS l_extendedprice",
        "0.1D AS l_tax", "'A' AS l_returnflag", "timestamp'1998-03-04' + make_interval(0, 0, 0, int(id)) AS l_shipdate",
    )
    lines.write.parquet(f"{path}/lineitem.parquet")
    spark.range(n).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey").write.parquet(f"{path}/orders.parquet")
    spark.range(7).selectExpr("id AS c_custkey", "int(id) AS c_nationkey").write.parquet(f"{path}/customer.parquet")
    spark.range(5).selectExpr("id AS p_partkey", "'Brand#1' || id AS p_brand").write.parquet(f"{path}/part.parquet")
    return str(path)


def test_raw_transactions_are_derived_in_more_tasks_for_more_lines(spark, tmp_path, monkeypatch):
    d = line_items_under(spark, tmp_path)
    before = sorted(map(tuple, bindings.raw_company(spark, d).collect()), key=str)
    monkeypatch.setattr(bindings, "LINES_PER_TASK", 2)
    raw = bindings.raw_company(spark, d)
    assert sorted(map(tuple, raw.collect()), key=str) == before and len(before) == 40
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [l_orderkey" in plan and ", 20" in plan


def test_an_extract_read_once_is_not_written(spark, tmp_path):
    d = line_items_under(spark, tmp_path)
    merged = REGISTRY["upsert_counts"].run(spark, d)
    assert any("/bronze-" in f for f in merged.inputFiles()) and not any("/extract-" in f for f in merged.inputFiles())
    assert merged.first().num_updated_rows == 0


def test_scrapes_read_once_are_not_written(spark, tmp_path, monkeypatch):
    d, labels = line_items_under(spark, tmp_path), []
    monkeypatch.setattr(layers, "write_through", lambda df, label: (labels.append(label), write_through(df, label))[1], raising=False)
    assert REGISTRY["quality_report"].run(spark, d).count() == 6
    assert "company" in labels and "competitor" not in labels
