"""What layers and loads leave on disk, and that the results are the same."""

from pathlib import Path

import pytest
from catalog import REGISTRY, bindings, layers
from conftest import values
from pyspark.sql import functions as F
from test_catalog import line_items_under

from shelfprice.operators.dedup import HASH, keep_latest
from shelfprice.operators.partitioned import MERGED, UNCHANGED, Table, append, load, merge
from shelfprice.operators.upsert import upsert
from shelfprice.sources import shared_dir, write_layer, write_through
from shelfprice.sources.staging import CLEANUP_CONF, drop, rows_of, short_lived_layers, shuffles_dropped


def shuffles(spark):
    """Names of the shuffle files on this machine."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {Path(found.apply(i).getPath()).name for i in range(found.length()) if found.apply(i).getName().startswith("shuffle_")}


def folder(layer):
    return Path(layer.inputFiles()[0].removeprefix("file://")).parent


def layers_now(spark):
    return {p.name for p in Path(shared_dir(spark), "shelfprice").glob("*")}


def labels(names):
    return {n.rsplit("-", 1)[0] for n in names}


def test_a_written_layer_leaves_no_shuffle(spark):
    before, setting = shuffles(spark), spark.conf.get(CLEANUP_CONF)
    shuffled = spark.range(1000).repartition(3, "id").groupBy("id").count()
    layer = write_layer(shuffled, "shuffled")
    assert not shuffles(spark) - before and spark.conf.get(CLEANUP_CONF) == setting
    assert all(".zstd." in f for f in layer.inputFiles())
    assert values(layer) == values(shuffled)


def test_a_frame_that_is_run_again_shuffles_again(spark):
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    with shuffles_dropped(spark):
        first = values(sums)
        assert values(sums) == first and sums.count() == 7
    assert values(sums) == first


def test_layers_of_the_warehouse_leave_no_shuffle(spark, tmp_path):
    w, before = layers.warehouse(spark, line_items_under(spark, tmp_path)), shuffles(spark)
    company = w.company
    assert not shuffles(spark) - before and all(".zstd." in f for f in company.inputFiles())
    assert company.count() == 39  # one has no region


def test_layers_that_are_kept_or_dropped(spark):
    with short_lived_layers(spark) as kept:
        gone, stays = folder(write_layer(spark.range(3), "gone")), write_layer(spark.range(3), "stays")
        kept.append(stays)
    assert not gone.exists() and folder(stays).exists()
    path = folder(stays)
    drop(spark.range(3), stays)
    assert not path.exists()


def test_rows_of_a_layer_are_not_written_again(spark):
    layer = write_layer(spark.range(10), "whole")
    some = rows_of(layer, F.col("id") < 3)
    assert write_layer(some, "copy") is some and some.count() == 3
    assert write_layer(layer.filter("id < 3"), "copy").inputFiles() != layer.inputFiles()
    plain = spark.range(10)
    assert write_through(rows_of(plain, F.col("id") < 3), "copy").count() == 3


KEYED = "k string, j int, at string, v string"


def extracts(rows):
    old = rows([("a", 1, "2024-01-01", "x"), ("a", 1, "2024-01-02", "y"), ("b", 1, "bad", "z"), (None, 1, "2024-01-01", "n"), ("c", 2, "2024-01-01", "c")], KEYED)
    new = rows([("a", 1, "2024-01-03", "new"), ("b", 1, "bad", "z"), ("d", 1, "2024-01-01", "d"), (None, 1, "2024-02-01", "m"), (None, 1, "2024-02-02", "o")], KEYED)
    return old, new


def test_extracts_are_merged_where_they_were_deduplicated(rows):
    old, new = extracts(rows)
    keys = ["k", "j"]
    plain = upsert(*[keep_latest(b, keys, "at") for b in (old, new)], keys)
    shared = upsert(*[keep_latest(b, keys, "at", hashed=True) for b in (old, new)], keys, hashed=True)
    assert shared.columns == plain.columns and values(shared) == values(plain)
    assert [r["_op"] for r in shared.filter("k = 'a'").collect()] == ["update"]

    def exchanges(df):
        return df.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    # one for each extract, and one for the rows without a key
    assert exchanges(shared) == 3 and exchanges(plain) == 5


def test_hashes_of_unlike_keys_are_refused(rows):
    old, new = rows([(1, "a")], "k int, at string"), rows([(1, "a")], "k bigint, at string")
    with pytest.raises(ValueError, match="one type"):
        upsert(*[keep_latest(b, ["k"], "at", hashed=True) for b in (old, new)], ["k"], hashed=True)
    kept = keep_latest(old, ["k"], "at", hashed=True)
    assert kept.columns == ["k", "at", HASH] and values(kept, "k", "at") == [(1, "a")]


def test_a_stamp_in_the_key_is_not_shuffled_twice(rows):
    data = [("2024-01-01", "a", 1), ("2024-01-01", "a", 3), ("2024-01-01", "b", None), ("bad", "a", 2), ("bad", "a", None), (None, "a", 5), (None, "a", 6)]
    latest = keep_latest(rows(data, "at string, k string, v int"), ["at", "k"], "at")
    assert values(latest) == values(rows([data[1], data[2], data[3], data[6]], "at string, k string, v int"))
    assert "_at" not in latest._jdf.queryExecution().optimizedPlan().toString()
    assert keep_latest(rows([("a",), ("a",)], "k string"), ["k"], "k").count() == 1


def test_loads_leave_only_their_table(spark, rows, tmp_path):
    old = rows([(f"k{i}", i % 3, i) for i in range(12)], "k string, p int, v int")
    made = Table(spark, str(tmp_path / "t"), old.schema, F.col("p"))
    before, shuffled = layers_now(spark), shuffles(spark)
    assert load(made, old, ["k"]).inserted == 12
    assert append(made, rows([("z", 7, 1)], "k string, p int, v int")).written == ("p7",)
    new = rows([("k1", 1, 50), ("n", 2, 1), (None, 0, 2)], "k string, p int, v int")
    done = merge(made, new, ["k"])
    assert (done.action, done.inserted, done.updated) == (MERGED, 2, 1)
    assert not {f for f in shuffles(spark) - shuffled if f.endswith(".data")}
    assert load(made, new.filter("k IS NOT NULL"), ["k"]).action == UNCHANGED
    assert load(made, rows([(None, 0, 2)], "k string, p int, v int"), ["k"]).inserted == 1
    assert layers_now(spark) == before
    assert made.read().count() == 16


def test_a_layer_given_to_a_load_stays(spark, tmp_path):
    layer = write_layer(spark.range(4).selectExpr("id AS k", "CAST(id % 2 AS INT) AS p"), "given")
    made = Table(spark, str(tmp_path / "t"), layer.schema, F.col("p"))
    before = layers_now(spark)
    assert append(made, rows_of(layer, F.col("p") == 1)).inserted == 2 and load(made, layer, ["k"]).inserted == 2
    assert layers_now(spark) == before and layer.count() == 4 == made.read().count()


@pytest.mark.parametrize(
    "name, left",
    [("repeated_loads", {"by-year"}), ("merge_by_partition", {"by-year"}), ("keyed_upsert", {"bronze"}), ("weekly_sales_in_loads", {"weeks"})],
)
def test_loads_keep_no_layer_that_nothing_reads(spark, tmp_path, name, left):
    d, before = line_items_under(spark, tmp_path), layers_now(spark)
    assert REGISTRY[name].run(spark, d).count() > 0
    assert labels(layers_now(spark) - before) == left


def test_a_fitted_model_keeps_no_layer_of_the_mart(spark):
    from catalog import pricing

    before = layers_now(spark)
    root, _ = pricing._fitted(spark, "/root/testdata/sf0.001", trees=1)
    assert not labels(layers_now(spark) - before) & {"company", "competitor", "weekly-sales", "weekly-market", "dim-products"}
    assert {p.name for p in Path(root).glob("*")} == {"mart", "model"}


def test_scrapes_of_many_splits_are_dealt_out_once(spark, tmp_path, monkeypatch):
    d = line_items_under(spark, tmp_path)
    few = values(bindings.raw_competitor(spark, d))
    monkeypatch.setattr(bindings, "line_items", None)  # not called for a table that enough tasks read
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        many = bindings.raw_competitor(spark, d)
        assert values(many) == few and len(few) == 40
        assert "Repartition" not in many._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
