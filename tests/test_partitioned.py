"""Loads into partitioned tables against a merge of the whole table."""

from pathlib import Path

import pytest
from conftest import values
from pyspark.sql import functions as F

from shelfprice.operators.partitioned import CREATED, MERGED, PART, UNCHANGED, Table, append, load, load_above_watermark, merge, refresh
from shelfprice.operators.upsert import upsert

SCHEMA = "k string, day date, v int"


def files(path):
    return {p.name: p.stat().st_mtime_ns for p in Path(path).rglob("part-*.parquet")}


def by_folder(path):
    return {d.name.split("=")[1]: set(files(d)) for d in Path(path).glob(f"{PART}=*")}


@pytest.fixture
def table(spark, rows, tmp_path):
    import datetime as dt

    old = [(f"k{i}", dt.date(2024, 1 + i % 6, 1 + i % 28), i) for i in range(60)] + [(None, dt.date(2024, 2, 1), 7), ("kx", None, 1)]
    frame = rows(old, SCHEMA)
    made = Table(spark, str(tmp_path / "t"), frame.schema, F.trunc("day", "month"))
    assert load(made, frame, ["k"]).action == CREATED
    return made, frame


def batch(rows, *data):
    import datetime as dt

    return rows([(k, d and dt.date.fromisoformat(d), v) for k, d, v in data], SCHEMA)


def test_merge_equals_an_upsert_and_leaves_other_partitions(table, rows):
    made, old = table
    before = by_folder(made.path)
    new = batch(rows, ("k0", "2024-01-01", 100), ("k7", "2024-02-08", 7), ("new", "2024-01-09", 5), (None, "2024-01-09", 6))
    done = merge(made, new, ["k"])
    assert values(made.read()) == values(upsert(old, new, ["k"]).drop("_op"))
    assert (done.action, done.inserted, done.updated, done.written, done.removed) == (MERGED, 2, 1, ("p2024-01-01",), ())
    after = by_folder(made.path)
    assert {p for p in after if after[p] != before[p]} == {"p2024-01-01"}


def test_rows_that_move_leave_their_partition(table, rows):
    made, old = table
    moved = batch(rows, ("kx", "2024-07-07", 1), *[(f"k{i}", "2024-07-01", i) for i in range(3, 60, 6)])
    done = merge(made, moved, ["k"])
    assert values(made.read()) == values(upsert(old, moved, ["k"]).drop("_op"))
    assert set(done.removed) == {"p-none", "p2024-04-01"} and done.written == ("p2024-07-01",)
    assert set(by_folder(made.path)) == {"p2024-01-01", "p2024-02-01", "p2024-03-01", "p2024-05-01", "p2024-06-01", "p2024-07-01"}


def test_a_batch_that_brings_nothing_is_not_written(table, rows):
    made, old = table
    before = files(made.path)
    again = old.filter("k IS NOT NULL")
    assert load(made, again, ["k"]).action == UNCHANGED and files(made.path) == before
    changed = load(made, batch(rows, ("k1", "2024-02-02", 99)), ["k"])
    assert (changed.action, changed.updated, changed.inserted) == (MERGED, 1, 0)
    assert load(made, old.limit(0), ["k"]).action == UNCHANGED


def test_only_touched_partitions_are_read(table, rows):
    made, _ = table
    read = made.read(["p2024-03-01"])
    assert all("p2024-03-01" in f for f in read.inputFiles()) or "PartitionFilters: [" in read._jdf.queryExecution().toString()
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert f"{PART}" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_new_columns_and_watermarks(table, rows):
    import datetime as dt

    made, old = table
    wide = rows([("k0", dt.date(2024, 1, 1), 0, "x"), ("late", dt.date(2023, 12, 1), 1, "y"), ("z", dt.date(2024, 6, 29), 2, None)], f"{SCHEMA}, note string")
    done = load_above_watermark(made, wide, ["k"], "day", lookback_days=0)
    assert (done.inserted, done.updated) == (1, 0)
    merge(made, wide, ["k"])
    assert values(made.read()) == values(upsert(upsert(old, wide.filter("k = 'z'"), ["k"]).drop("_op"), wide, ["k"]).drop("_op"))


def test_a_summary_is_refreshed_where_a_load_wrote(spark, rows, tmp_path):
    import datetime as dt

    build = lambda df: df.groupBy(F.trunc("day", "month").alias("month")).agg(F.sum("v").alias("v"), F.count_distinct("k").alias("keys"))
    data = [(f"k{i % 4}", dt.date(2024, 1 + i % 3, 1 + i % 20), i) for i in range(60)]
    whole = rows(data, SCHEMA)
    facts = Table(spark, str(tmp_path / "facts"), whole.schema, F.trunc("day", "month"))
    months = Table(spark, str(tmp_path / "months"), build(whole).schema, F.col("month"))
    for part in (data[:30], data[30:50]):
        refresh(months, facts, append(facts, rows(part, SCHEMA)), build)
    before = by_folder(months.path)
    late = [r for r in data[50:] if r[1].month == 1]
    done = append(facts, rows(late, SCHEMA))
    refresh(months, facts, done, build)
    assert done.written == ("p2024-01-01",) and append(facts, whole.limit(0)).written == ()
    assert values(months.read()) == values(build(rows(data[:50] + late, SCHEMA)))
    after = by_folder(months.path)
    assert {p for p in after if after[p] != before[p]} == {"p2024-01-01"}


def test_rows_of_few_partitions_are_written_where_they_are(spark, tmp_path):
    """A shuffle by partition is for loads of many partitions, which would otherwise leave a file of each in every task."""
    from shelfprice.operators.partitioned import FEW_PARTS

    many = spark.range(0, 4000, 1, 4).selectExpr("CAST(id AS STRING) AS k", "CAST(id % 40 AS INT) AS v")
    for parts, per_folder in ((2, 4), (FEW_PARTS, 4), (40, 1)):
        made = Table(spark, str(tmp_path / f"t{parts}"), many.schema, F.col("v") % parts)
        done = load(made, many, ["k"])
        assert (done.action, done.inserted, len(done.written)) == (CREATED, 4000, parts)
        assert {len(f) for f in by_folder(made.path).values()} == {per_folder}
        assert values(made.read()) == values(many)
