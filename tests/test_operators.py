import datetime as dt
import random
from collections import Counter

import pytest
from conftest import values
from pyspark.sql import functions as F

from shelfprice.functions import clean_with_pattern
from shelfprice.operators import anomalies, checks
from shelfprice.operators.dedup import duplicates, keep_latest, latest_per_group
from shelfprice.operators.history import apply_snapshot, as_of_join, build_history, overlapping_versions, splice_history
from shelfprice.operators.joins import any_new, every_pair, lookup_join, not_in
from shelfprice.operators.publish import AuditError, StagedTable, audit, ingest, publish, published, stage
from shelfprice.operators.series import date_dimension, fill_weeks, forward_fill, month_dimension, price_points
from shelfprice.operators.upsert import (
    above_watermark,
    incremental_merge,
    merge_dimension,
    save_table,
    upsert,
    upsert_metrics,
)
from shelfprice.plans import silver
from shelfprice.sources import write_through


def day(text):
    return dt.date.fromisoformat(text)


def test_keep_latest_compares_dates_not_texts(rows):
    df = rows([("k", "9/1/2024", 1), ("k", "10/1/2024", 2), ("k", "bad", 9), ("j", None, 3)], "k string, d string, v int")
    assert values(keep_latest(df, ["k"], "d", "M/d/yyyy"), "k", "v") == [("j", 3), ("k", 2)]


def test_keep_latest_ties_are_settled_by_the_other_columns(rows):
    data = [("k", "2024-01-01", i % 7) for i in range(50)]
    df = rows(data, "k string, d string, v int")
    assert values(keep_latest(df.repartition(5), ["k"], "d")) == [("k", "2024-01-01", 6)]


def test_keep_latest_when_the_order_column_is_a_key(rows):
    df = rows([("2024-01-01", "a", 1), ("2024-01-01", "a", 2)], "d string, k string, v int")
    assert values(keep_latest(df, ["d", "k"], "d")) == [("2024-01-01", "a", 2)]


def test_duplicates_and_latest_per_group(rows):
    df = rows([(1, 1), (1, 2), (2, 5)], "k int, t int")
    assert values(duplicates(df, "k")) == [(1, 2)]
    assert values(latest_per_group(df, ["k"], "t")) == [(1, 2), (2, 5)]


def test_lookup_join_splits_what_a_hot_key_makes_too_large(spark, rows):
    rng = random.Random(3)
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    table = rows([(i, f"n{i}") for i in range(0, 50, 2)], "k int, name string")
    data = [(8 if rng.random() < 0.4 else rng.randint(0, 40) if rng.random() < 0.8 else None, i) for i in range(6000)]
    names = {i: f"n{i}" for i in range(0, 50, 2)}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        joined = lookup_join(rows(data, "k int, v int").repartition(24), table, ["k"])
        assert sorted(map(str, map(tuple, joined.collect()))) == sorted(str((k, v, names.get(k))) for k, v in data)
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    with pytest.raises(ValueError):
        lookup_join(table, table, ["k"], "right")


def test_anti_joins(rows):
    batch, loaded = rows([(1,), (2,), (None,)], "k int"), rows([(1,), (1,)], "k int")
    assert values(not_in(batch, loaded, ["k"])) == [(None,), (2,)]
    assert any_new(batch, loaded, ["k"])
    assert not any_new(loaded, loaded, ["k"])


def test_every_pair(rows):
    left, right = rows([(i,) for i in range(7)], "a int"), rows([(f"b{i}",) for i in range(90)], "b string")
    for size in (1_000_000, 50, 1):
        pairs = every_pair(left, right, size)
        assert pairs.count() == 630 and pairs.distinct().count() == 630
    assert every_pair(left.limit(0), right).isEmpty() and every_pair(left, right.limit(0)).isEmpty()


LOG = [
    ("p", "a", "2024-01-01"), ("p", "a", "2024-01-05"), ("p", "b", "2024-01-09"), ("p", "a", "2024-02-01"),
    ("q", None, "2024-01-03"), ("q", None, "2024-01-04"), ("q", "z", "2024-01-05"), ("r", "y", None),
]


def log(rows, until=None):
    data = [(k, a, day(d) if d else None) for k, a, d in LOG if until is None or (d and d <= until)]
    return rows(data, "k string, a string, d date")


def test_history_by_changed_attributes(rows):
    history = build_history(log(rows), "k", ["a"], "d", "check")
    assert values(history, "k", "a", "dbt_valid_from", "dbt_valid_to") == [
        ("p", "a", day("2024-01-01"), day("2024-01-09")),
        ("p", "a", day("2024-02-01"), None),
        ("p", "b", day("2024-01-09"), day("2024-02-01")),
        ("q", None, day("2024-01-03"), day("2024-01-05")),
        ("q", "z", day("2024-01-05"), None),
    ]
    assert overlapping_versions(history, "k").isEmpty()


def test_history_by_timestamp_opens_a_version_per_day(rows):
    assert build_history(log(rows), "k", ["a"], "d").count() == 7
    with pytest.raises(ValueError):
        build_history(log(rows), "k", ["a"], "d", "other")


def test_snapshots_close_and_open_and_repeat_without_change(rows):
    first = apply_snapshot(None, log(rows, "2024-01-05"), "k", ["a"], "d")
    second = apply_snapshot(first, log(rows), "k", ["a"], "d")
    assert values(second, "k", "a", "dbt_valid_from", "dbt_valid_to") == [
        ("p", "a", day("2024-01-05"), day("2024-02-01")),
        ("p", "a", day("2024-02-01"), None),
        ("q", "z", day("2024-01-05"), None),
    ]
    assert values(apply_snapshot(second, log(rows), "k", ["a"], "d")) == values(second)
    # the check strategy ignores a mere advance of the date
    assert values(apply_snapshot(first, log(rows), "k", ["a"], "d", "check")) == values(first)


def test_history_kept_day_by_day_equals_the_rebuilt_one(rows):
    kept = None
    for until in sorted({d for _, _, d in LOG if d}):
        kept = apply_snapshot(kept, log(rows, until), "k", ["a"], "d")
    assert values(kept) == values(build_history(log(rows), "k", ["a"], "d"))


def test_as_of_join_against_brute_force(rows):
    rng = random.Random(5)
    history = build_history(
        rows([(f"k{rng.randint(0, 4)}", rng.choice("abc"), day("2023-01-01") + dt.timedelta(rng.randint(50, 400))) for _ in range(80)],
             "k string, a string, d date"), "k", ["a"], "d")
    facts = [(i, f"k{rng.randint(0, 5)}" if rng.random() > 0.05 else None,
              day("2023-01-01") + dt.timedelta(rng.randint(0, 500)) if rng.random() > 0.05 else None) for i in range(400)]
    versions = [(r.k, r.a, r.dbt_valid_from, r.dbt_valid_to) for r in history.collect()]
    expected = []
    for i, k, t in facts:
        mine = sorted((f, e or day("9999-12-31"), a) for kk, a, f, e in versions if kk == k)
        hit = [a for f, e, a in mine if t and f <= t < e] or [a for _, _, a in mine[:1] if t and t < mine[0][0]]
        expected.append((i, k, t, hit[0] if hit else None))
    got = as_of_join(rows(facts, "i int, k string, t date"), history, "k", "t", ["a"])
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


def test_overlaps_are_complete(rows):
    rng = random.Random(9)
    data = [(rng.choice("pq"), rng.randint(0, 30), rng.choice([None, rng.randint(0, 45)])) for _ in range(60)]
    start = day("2024-01-01")
    spans = [(k, start + dt.timedelta(f), None if t is None else start + dt.timedelta(t)) for k, f, t in data]
    expected = []
    for k, f, t in spans:
        earlier = [(e or day("9999-12-31"), s, e) for kk, s, e in spans if kk == k and s < f and (e is None or e > f)]
        if earlier:
            _, s, e = max(earlier, key=lambda x: x[:2])
            expected.append((k, s, e, f, t, len(earlier)))
    got = overlapping_versions(rows(spans, "k string, dbt_valid_from date, dbt_valid_to date"), "k")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_upsert(rows):
    target = rows([(1, "a", 1), (2, "b", None), (3, "c", 3)], "k int, s string, n int")
    source = rows([(1, "a", 1), (2, "b", 5), (4, "d", 4), (None, "e", 0)], "k int, s string, n int")
    merged = upsert(target, source, ["k"])
    assert values(merged) == [
        (None, "e", 0, "insert"), (1, "a", 1, "keep"), (2, "b", 5, "update"), (3, "c", 3, "keep"), (4, "d", 4, "insert"),
    ]
    assert tuple(upsert_metrics(merged).first()) == (3, 2, 1, 0)
    again = upsert(merged.drop("_op").filter("k is not null"), source.filter("k is not null"), ["k"])
    assert upsert_metrics(again).first()["num_affected_rows"] == 0


def test_upsert_refuses_several_rows_of_a_key(rows):
    target = rows([(1, "a")], "k int, s string")
    for source in ([(1, "x"), (1, "y")], [(2, "x"), (2, "x")]):
        with pytest.raises(Exception, match="several source rows"):
            upsert(target, rows(source, "k int, s string"), ["k"]).collect()
    several_keyless = rows([(None, "x"), (None, "x")], "k int, s string")
    assert upsert(target, several_keyless, ["k"]).count() == 3


def test_upsert_sorts_the_batch_by_hash_without_a_sorted_aggregate(rows):
    target, source = rows([(1, "a"), (2, "b")], "k int, s string"), rows([(2, "x"), (3, "y")], "k int, s string")
    plan = upsert(target, source, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning(_hash") == 2


@pytest.mark.parametrize("kind", ["bigint", "double", "string", "int"])
def test_upsert_matches_keys_of_another_type(rows, kind):
    target = rows([(1, "a"), (2, "b"), (None, "n")], "k int, s string")
    source = rows([("2", "x"), ("3", "y"), (None, "m")], "k string, s string").withColumn("k", F.col("k").cast(kind))
    assert tuple(upsert_metrics(upsert(target, source, ["k"])).first()) == (3, 2, 1, 0)


def test_upsert_matches_floats_that_are_equal(rows):
    target, source = rows([(0.0, "a"), (float("nan"), "b")], "k double, s string"), rows([(-0.0, "x"), (float("nan"), "y")], "k double, s string")
    assert tuple(upsert_metrics(upsert(target, source, ["k"])).first()) == (2, 0, 2, 0)


def test_fused_checks_are_compiled(rows):
    table = rows([(1, "a"), (1, None), (2, "b")], "k int, s string")
    made = [checks.Check.of_rows("s", table, F.col("s").isNull()), checks.Check.of_keys("k", table, "k")]
    report = checks.run_checks(made)
    assert values(report, "check_name", "failures") == [("k", 1), ("s", 1)]
    assert "lambda" not in report._jdf.queryExecution().executedPlan().toString()


def test_upsert_merges_schemas(rows):
    target = rows([(1, "a"), (2, "b")], "k int, s string")
    merged = upsert(target, rows([(1, 9), (3, 7)], "k int, n int"), ["k"])
    assert values(merged, "k", "s", "n") == [(1, "a", 9), (2, "b", None), (3, None, 7)]


def test_watermark(rows):
    loaded = rows([(1, day("2024-01-10"))], "k int, d date")
    batch = rows([(1, day("2024-01-09")), (2, day("2024-01-10")), (3, day("2024-01-11"))], "k int, d date")
    assert values(above_watermark(batch, loaded, "d"), "k") == [(3,)]
    assert values(above_watermark(batch, loaded, "d", lookback_days=1), "k") == [(2,), (3,)]
    assert above_watermark(batch, loaded.filter("k > 5"), "d").count() == 3
    assert values(incremental_merge(loaded, batch, ["k"], "d"), "k") == [(1,), (3,)]


def test_dimension_merge_adds_late_members(rows):
    target = rows([("a", day("2024-05-01"))], "k string, create_at date")
    members = rows([("a", day("2024-05-01")), ("b", day("2024-01-01"))], "k string, create_at date")
    assert values(merge_dimension(target, members, "k"), "k") == [("a",), ("b",)]


def test_cold_start_table(spark, rows, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS cold LOCATION '{tmp_path}'")
    df = rows([(1, "a")], "k int, s string")
    assert save_table(df, "cold.first") is True
    assert save_table(df, "cold.first") is False
    assert spark.table("cold.first").count() == 1
    spark.sql("DROP DATABASE cold CASCADE")


KEYS = {"t": ["k"], "u": ["k"]}


def test_ingest_publishes_both_tables_together(spark, rows, tmp_path):
    root = str(tmp_path)
    t, u = rows([(1, "a"), (2, "b")], "k int, s string"), rows([(1, "x")], "k int, s string")
    assert published(spark, root, "t") is None
    ingest(spark, root, "run1", {"t": t, "u": u}, KEYS)
    staged = ingest(spark, root, "run2", {"t": rows([(2, "B"), (3, "c")], "k int, s string"), "u": u}, KEYS)
    assert (staged["t"].inserted, staged["t"].updated, staged["t"].affected, staged["u"].affected) == (1, 1, 2, 0)
    assert values(published(spark, root, "t")) == [(1, "a"), (2, "B"), (3, "c")]


def test_failed_ingest_leaves_published_tables(spark, rows, tmp_path):
    root = str(tmp_path)
    t = rows([(1, "a")], "k int, s string")
    ingest(spark, root, "run1", {"t": t, "u": t}, KEYS)
    for bad in (t.filter("k > 9"), rows([(None, "x")], "k int, s string")):
        with pytest.raises(AuditError):
            ingest(spark, root, "run2", {"t": rows([(2, "b")], "k int, s string"), "u": bad}, KEYS)
    assert values(published(spark, root, "t")) == [(1, "a")]


def test_staged_versions_are_invisible_and_audited(spark, rows, tmp_path):
    root = str(tmp_path)
    t = rows([(1, "a")], "k int, s string")
    staged = stage(spark, root, "run1", "t", t, ["k"])
    assert published(spark, root, "t") is None
    audit(spark, "t", staged, t, ["k"])
    with pytest.raises(AuditError):
        audit(spark, "t", staged, rows([(5, "z")], "k int, s string"), ["k"])
    with pytest.raises(AuditError):
        audit(spark, "t", StagedTable(staged.path, 5, 1, 1, 0), t, ["k"])
    publish(spark, root, "run1", {"t": staged})
    assert values(published(spark, root, "t")) == [(1, "a")]


def test_calendars(rows):
    dates = rows([(day("2023-03-05"),), (day("2024-07-01"),)], "d date")
    calendar = date_dimension(dates, "d")
    assert calendar.count() == 365 + 366
    weekend = calendar.filter("full_date between '2024-01-01' and '2024-01-07' and is_weekend")
    assert values(weekend, "date_key") == [(20240105,), (20240106,)]
    months = month_dimension(dates, "d")
    assert months.count() == 24
    row = months.filter("month_key = 202402").first()
    assert (row.month_end_date, row.month_name, row.quarter) == (day("2024-02-29"), "February", 1)


def test_price_points(rows):
    df = price_points(rows([(1, 10.0, 20.0)], "k int, lo double, hi double"), F.col("lo"), F.col("hi"), 5)
    assert values(df, "price") == [(10.0,), (12.5,), (15.0,), (17.5,), (20.0,)]
    assert values(price_points(rows([(10.0, 20.0)], "lo double, hi double"), F.col("lo"), F.col("hi"), 1), "price") == [(10.0,)]


def test_fill_weeks(rows):
    members = rows([("a",), ("b",)], "k string")
    observed = rows(
        [("a", day("2024-01-08"), 5.0, 1), ("a", day("2024-01-22"), None, 2), ("z", day("2024-01-01"), 1.0, 1)],
        "k string, sales_week date, p double, q int",
    )
    low, high = F.lit(day("2024-01-01")), F.lit(day("2024-01-29"))
    filled = fill_weeks(members, observed, ["k"], ["p"], ["q"], low, high)
    assert values(filled.filter("k = 'a'"), "sales_week", "p", "q") == [
        (day("2024-01-01"), None, 0), (day("2024-01-08"), 5.0, 1), (day("2024-01-15"), 5.0, 0),
        (day("2024-01-22"), 5.0, 2), (day("2024-01-29"), 5.0, 0),
    ]
    assert filled.filter("k = 'b' and p is null and q = 0").count() == 5
    assert filled.count() == 10


def test_forward_fill_keeps_observed_values(rows):
    df = rows([("a", 1, None), ("a", 2, 4.0), ("a", 3, None), ("a", 4, 6.0)], "k string, w int, p double")
    filled = forward_fill(df, ["k"], "w", F.col("p").isNotNull(), ["p"])
    assert [r[2] for r in values(filled, "k", "w", "p")] == [None, 4.0, 4.0, 6.0]


def test_checks(rows):
    df = rows([(1, "a"), (1, "b"), (2, None), (None, "a")], "k int, s string")
    assert values(checks.not_null(df, "s"), "n_rows") == [(1,)]
    assert values(checks.unique(df, "s")) == [("a", 2)]
    assert values(checks.accepted_values(df, "s", ["a"])) == [("b", 1)]
    parent = rows([(1,)], "id int")
    assert values(checks.relationships(df, "k", parent, "id")) == [(2, 1)]
    assert checks.relationships(df, "k", parent, "id", "k < 2").isEmpty()
    assert checks.expression_is_true(df, "k >= 1").isEmpty()
    assert checks.column_is_of_type(df, "k", "int").isEmpty()
    assert values(checks.column_is_of_type(df, "k", "string")) == [("k", "string", "int")]
    assert values(checks.matches_regex(df, "s", "^a$")) == [("b", 1)]
    dates = rows([(day("1800-01-01"),), (day("2024-01-01"),), (None,)], "d date")
    assert values(checks.valid_date_range(dates, "d", as_of="2024-06-01"), "n_rows") == [(1,)]
    assert checks.unmatched_share(rows([("-1",)] + [("a",)] * 99, "k string"), {"n": "k"}).isEmpty()
    assert values(checks.unmatched_share(rows([("-1",), ("a",)], "k string"), {"n": "k"})) == [(2, 1)]
    changes = checks.schema_changes(df.schema, rows([(1, 2.0)], "k bigint, x double").schema)
    assert changes == [("type_changed", "k", "int", "bigint"), ("removed", "s", "string", None), ("added", "x", None, "double")]


def test_check_runner(rows):
    df = rows([(1, "a"), (None, "b"), (None, "b")], "k int, s string")
    plan = [
        checks.Check("nulls", df, lambda t: checks.not_null(t, "k"), tags=["keys"]),
        checks.Check("some nulls", df, lambda t: checks.not_null(t, "k"), where="s = 'a'"),
        checks.Check("values", df, lambda t: checks.accepted_values(t, "s", ["a"]), severity="warn"),
    ]
    got = {r.check_name: (r.failures, r.status) for r in checks.run_checks(plan).collect()}
    assert got == {"nulls": (2, "fail"), "some nulls": (0, "pass"), "values": (2, "warn")}
    assert [r.check_name for r in checks.run_checks(plan, tags=["keys"]).collect()] == ["nulls"]


def test_volume_and_freshness_anomalies(rows):
    start = dt.datetime(2024, 1, 1)
    stamps = [(start + dt.timedelta(days=d, hours=h),) for d in range(20) for h in range(0, 24, 2) if d != 10 or h < 2]
    stamps += [(start + dt.timedelta(days=d, minutes=d),) for d in range(12, 19)]
    stamps += [(start + dt.timedelta(days=19, minutes=m),) for m in range(1, 400)]
    df = rows(stamps, "ts timestamp")
    volume = anomalies.volume_anomalies(df, "ts", trailing=10)
    assert [r.bucket for r in volume.filter("is_anomaly").collect()] == [day("2024-01-20")]
    assert volume.filter("bucket = '2024-01-11'").first().value == 1.0
    fresh = anomalies.freshness_anomalies(df, "ts", trailing=5)
    assert fresh.filter("bucket = '2024-01-02'").first().value == 7200.0
    assert fresh.filter("bucket = '2024-01-11'").first().value == 24 * 3600.0


def test_empty_bucket_counts_zero(rows):
    df = rows([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 3),)], "ts timestamp")
    assert [r[1] for r in values(anomalies.volume_anomalies(df, "ts"), "bucket", "value")] == [1.0, 0.0, 1.0]


def test_late_observations_in_any_order(rows):
    import itertools
    import random

    random.seed(2)
    log = [(random.choice("abc"), dt.date(2024, 1, 1) + dt.timedelta(days=random.randint(0, 70)), random.choice("xyz"), random.choice([None, 1, 2])) for _ in range(60)]
    log += [(None, dt.date(2024, 1, 5), "x", 1), ("a", None, "x", 1)]
    schema = "k string, day date, p string, q int"
    want = values(build_history(rows(log, schema).filter("k IS NOT NULL"), "k", ["p", "q"], "day"))
    parts = [log[0::3], log[1::3], log[2::3]]
    for order in itertools.permutations(parts):
        history = build_history(rows(order[0], schema).filter("k IS NOT NULL"), "k", ["p", "q"], "day")
        for late in (order[1], order[2], order[2]):
            history = splice_history(history, rows(late, schema).filter("k IS NOT NULL"), "k", ["p", "q"], "day")
        assert values(history.select("k", "p", "q", "updated_at", "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")) == want
    empty = rows([], schema)
    assert values(splice_history(build_history(empty, "k", ["p", "q"], "day"), rows(log, schema).filter("k IS NOT NULL"), "k", ["p", "q"], "day")) == want
    assert values(splice_history(build_history(rows(log, schema).filter("k IS NOT NULL"), "k", ["p", "q"], "day"), empty, "k", ["p", "q"], "day")) == want


def test_checks_of_a_table_share_a_scan(spark, rows, tmp_path):
    data = [(i, None if i % 5 == 0 else i % 7, "x" if i < 3 else f"n{i}") for i in range(40)] + [(1, None, None), (1, None, None)]
    rows(data, "id int, v int, name string").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    made = [
        checks.Check.of_rows("v known", table, F.col("v").isNull(), tags=["v"]),
        checks.Check.of_rows("v small", table, F.col("v") > 5, severity="warn"),
        checks.Check.of_rows("v small late", table, F.col("v") > 5, where="id >= 30"),
        checks.Check.of_keys("id once", table, "id", tags=["keys"]),
        checks.Check.of_keys("pair once", table, "v", "name"),
        checks.Check.of_keys("pair of values once", table, "v", "name", count_null=False, where="id <> 2"),
        checks.Check("any rows", table, lambda df: checks.not_null(df, "name")),
    ]
    got = {r.check_name: (r.failures, r.status) for r in checks.run_checks(made).collect()}
    pairs = lambda keep: sum(n > 1 for n in Counter((v, n) for i, v, n in data if keep(i, v, n)).values())
    assert got == {
        "v known": (sum(v is None for _, v, _ in data), "fail"),
        "v small": (sum(v is not None and v > 5 for _, v, _ in data), "warn"),
        "v small late": (sum(v is not None and v > 5 and i >= 30 for i, v, _ in data), "fail"),
        "id once": (1, "fail"),
        "pair once": (pairs(lambda i, v, n: True), "fail"),
        "pair of values once": (pairs(lambda i, v, n: v is not None and n is not None and i != 2), "pass" if not pairs(lambda i, v, n: v is not None and n is not None and i != 2) else "fail"),
        "any rows": (2, "fail"),
    }
    plan = checks.run_checks(made[:6])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert [r.check_name for r in checks.run_checks(made, tags=["keys"]).collect()] == ["id once"]
    assert {r.failures for r in checks.run_checks([checks.Check.of_rows("none", table.limit(0), F.lit(True))]).collect()} == {0}


def test_keep_latest_limits_rows_before_the_shuffle(spark):
    """One row per key leaves a map task, and no wide row goes through a sorted aggregate."""
    df = spark.createDataFrame([("k", "2024-01-01", "a"), ("k", "2024-01-02", None), ("k", "2024-01-02", "b"), ("k", "x", "c"), (None, "2024-01-01", "d"), (None, None, "e")], "k string, at string, v string")
    kept = keep_latest(df, ["k"], "at")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "SortAggregate" not in plan
    assert sorted(map(tuple, kept.collect()), key=str) == [("k", "2024-01-02", "b"), (None, "2024-01-01", "d")]


def test_checks_of_a_table_shuffle_no_flags(spark):
    """A key's entry is its rule, its key and a count, however many row checks there are."""
    df = spark.createDataFrame([(1, 1), (1, None), (None, -1), (2, -5)], "k int, v int")
    found = checks.run_checks([
        checks.Check.of_rows("positive", df, F.col("v") <= 0),
        checks.Check.of_rows("known", df, F.col("v").isNull()),
        checks.Check.of_rows("small", df, F.col("v") > 100),
        checks.Check.of_keys("once", df, "k"),
    ])
    assert {r.check_name: r.failures for r in found.collect()} == {"positive": 2, "known": 1, "small": 0, "once": 1}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    by_key = next(line for line in plan.splitlines() if "Aggregate [_rule" in line)
    assert "_f0" not in by_key and "count(1)" in by_key


def test_ids_that_match_have_their_title_case(spark):
    rows = [("Tx-12", "Branch_7", "Prod_3"), (" Tx-1 ", " Branch_0", "Prod_10 ")]
    df = spark.createDataFrame(rows, "t string, b string, p string")
    for name, pattern in (("t", silver.TRANSACTION_PATTERN), ("b", silver.STORE_PATTERN), ("p", silver.PRODUCT_PATTERN)):
        got = df.select(clean_with_pattern(F.col(name), pattern), clean_with_pattern(F.col(name), pattern, F.trim(F.col(name)))).collect()
        assert all(r[0] == r[1] is not None for r in got)


def test_a_history_hashes_its_log_to_tuples_of_a_day(spark, rows):
    """The planner keeps the distinct below the largest tuple, so the rows of the log are not sorted for it."""
    seen = rows([("a", day("2024-01-01"), "x", None), ("a", day("2024-01-01"), "y", "n"), ("a", day("2024-01-01"), "y", "m")] * 3
                + [("a", day("2024-01-02"), None, "n"), (None, day("2024-01-01"), "x", "n"), ("a", None, "z", "z")], "k string, d date, p string, q string")
    history = build_history(seen, "k", ["p", "q"], "d")
    assert values(history, "k", "p", "q", "updated_at") == [
        (None, "x", "n", day("2024-01-01")), ("a", None, "n", day("2024-01-02")), ("a", "y", "n", day("2024-01-01"))
    ]
    plan = history._jdf.queryExecution().executedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert "HashAggregate" in aggregates[-1] and "SortAggregate" not in aggregates[-1]


def test_a_layer_is_not_written_a_second_time(rows):
    layer = write_through(rows([(1, "a")], "k int, v string"), "layer")
    assert write_through(layer, "copy") is layer
    narrowed = write_through(layer.select("k"), "narrowed")
    assert narrowed.inputFiles() != layer.inputFiles() and values(narrowed) == [(1,)]
