"""Keyed upsert and incremental loads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfprice.operators.dedup import HASH
from shelfprice.operators.joins import not_in

INSERTED, UPDATED, KEPT = "insert", "update", "keep"

# Types of which equal values have equal hashes (floats and collated texts are left to the join).
_HASHED = {"string", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "boolean"}


def _aligned(target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the union of their columns, the target's order first."""
    empty = {c: f for f in (*target.schema.fields, *source.schema.fields) for c in [f.name]}
    order = [*target.columns, *[c for c in source.columns if c not in target.columns]]

    def widen(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(empty[c].dataType).alias(c) for c in order])

    return widen(target), widen(source)


def _hashable(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys that have one type on both sides, of which equal values have equal hashes."""
    kinds = [(k, target.schema[k].dataType, source.schema[k].dataType) for k in keys]
    return [k for k, a, b in kinds if a == b and a.simpleString() in _HASHED]


def _key_hash(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> Column:
    """Hash of the keys that allow it, else a constant; the join compares the keys all the same."""
    same = _hashable(target, source, keys)
    return F.xxhash64(*same) if same else F.lit(0).cast("bigint")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], hashed: bool = False) -> DataFrame:
    """``target`` after merging ``source`` on ``keys``, with the action per row in ``_op``.

    A matched row is replaced only when a non-key column differs (NULL equals
    NULL). A column present on one side only is kept and filled with NULL. A
    row without a key matches nothing and is inserted.

    One full outer join. The rows of a key in the batch are numbered, which
    shares the shuffle and the sort of the join; a key with several rows is
    ambiguous and fails the job. The hash in front of the keys lets the sorts
    compare numbers, not texts. ``hashed`` tells that both sides bring it from
    ``keep_latest`` on these keys in this order; they are not shuffled again.
    """
    keys = list(keys)
    if hashed and _hashable(target, source, keys) != keys:
        raise ValueError("hashes can be compared for keys of one type on both sides, and not for every type")
    brought = F.col(HASH) if hashed else _key_hash(target, source, keys)
    target, source = target.withColumn(HASH, brought), source.withColumn(HASH, brought)
    fresh_columns = set(source.columns)
    target, source = _aligned(target, source)
    columns = [c for c in target.columns if c != HASH]
    values = [c for c in columns if c not in keys and c in fresh_columns]
    keyless = reduce(or_, [F.col(k).isNull() for k in keys])
    in_batch = Window.partitionBy(HASH, *keys).orderBy(HASH)
    several = F.concat(F.lit("several source rows for one key: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    incoming = (
        source.filter(~keyless)
        .withColumn("_n", F.row_number().over(in_batch))
        .select(
            HASH,
            *keys,
            *[F.col(c).alias(f"_s_{c}") for c in values],
            F.when(F.col("_n") > 1, F.raise_error(several).cast("boolean")).otherwise(F.lit(True)).alias("_in_source"),
        )
    )
    changed = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in values], F.lit(False))

    def merged(c: str, replace: Column) -> Column:
        return (F.when(replace, F.col(f"_s_{c}")).otherwise(F.col(c)) if c in values else F.col(c)).alias(c)

    both = target.withColumn("_in_target", F.lit(True)).join(incoming, [HASH, *keys], "full_outer")
    insert = F.col("_in_target").isNull()
    update = F.coalesce("_in_source", F.lit(False)) & ~insert & changed
    action = F.when(insert & F.col("_in_source"), INSERTED).when(update, UPDATED).otherwise(KEPT).alias("_op")
    joined = both.select(*[merged(c, insert | update) for c in columns], action)
    return joined.unionByName(source.filter(keyless).drop(HASH).withColumn("_op", F.lit(INSERTED)))


def upsert_metrics(merged: DataFrame) -> DataFrame:
    """Counts of an ``upsert`` result: affected, inserted, updated, deleted rows."""
    return merged.agg(
        F.count_if(F.col("_op") != KEPT).alias("num_affected_rows"),
        F.count_if(F.col("_op") == INSERTED).alias("num_inserted_rows"),
        F.count_if(F.col("_op") == UPDATED).alias("num_updated_rows"),
        F.lit(0).cast("bigint").alias("num_deleted_rows"),
    )


def above_watermark(batch: DataFrame, target: DataFrame, ts: str, lookback_days: int = 0) -> DataFrame:
    """Rows of ``batch`` newer than the newest ``ts`` in ``target``.

    The bound is read first and used as a literal, so it reaches the scan as a
    pushed filter. An empty target lets everything through. ``lookback_days``
    re-reads that many days before the bound, for late rows.
    """
    high = target.agg(F.max(ts)).first()[0]
    if high is None:
        return batch
    bound = F.date_sub(F.lit(high), lookback_days) if lookback_days else F.lit(high)
    return batch.filter(F.col(ts) > bound)


def incremental_merge(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], ts: str, lookback_days: int = 0
) -> DataFrame:
    """``target`` after upserting the rows of ``batch`` above its watermark."""
    return upsert(target, above_watermark(batch, target, ts, lookback_days), keys).drop("_op")


def append_missing(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` to append: those whose key the target lacks."""
    return not_in(batch, target, keys)


def merge_dimension(target: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Type-1 dimension after adding the members it lacks.

    Membership is tested on the key, not on the first-seen date, so a member
    whose first sale arrives late is still added.
    """
    return target.unionByName(not_in(members, target, [key]))


def save_table(df: DataFrame, table: str) -> bool:
    """Cold start: create ``table`` from ``df`` if the catalog lacks it; tells whether it did."""
    spark: SparkSession = df.sparkSession
    if spark.catalog.tableExists(table):
        return False
    df.write.mode("append").option("mergeSchema", True).saveAsTable(table)
    return True
