"""Tables in a folder per partition, and loads that rewrite only the partitions that a batch touches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfprice.operators.joins import any_new
from shelfprice.operators.upsert import INSERTED, KEPT, UPDATED, above_watermark, upsert
from shelfprice.sources.staging import CODEC, delete, drop, exists, shuffles_dropped, write_layer

#: The folder column. Its values begin with a letter, so that no reader takes them for numbers or dates.
PART = "_part"
#: Rows of up to so many partitions are written by the tasks that hold them; for more, that makes too many small files.
FEW_PARTS = 16
CREATED, UNCHANGED, MERGED, APPENDED = "created", "unchanged", "merged", "appended"


class Table:
    """A table at a path, laid out by an expression over a row.

    The expression should have as many values as a calendar has months or days:
    the driver lists them. ``columns`` are those of the rows; a batch may bring
    further ones, which are NULL in what is there already.
    """

    def __init__(self, spark: SparkSession, path: str, columns: T.StructType, by: Column):
        self.spark, self.path, self.columns, self.by = spark, path, columns, by

    def exists(self) -> bool:
        return exists(self.spark, self.path)

    def read(self, parts: Sequence[str] | None = None) -> DataFrame:
        """The table, or some of its partitions, whose folders alone are listed and read."""
        return self.with_part(parts).drop(PART)

    def with_part(self, parts: Sequence[str] | None = None) -> DataFrame:
        fields = [T.StructField(f.name, f.dataType) for f in self.columns.fields]
        rows = self.spark.read.schema(T.StructType([*fields, T.StructField(PART, T.StringType())])).parquet(self.path)
        return rows if parts is None else rows.filter(F.col(PART).isin(list(parts)))

    def widen(self, schema: T.StructType) -> None:
        known = set(self.columns.names)
        self.columns = T.StructType([*self.columns.fields, *[f for f in schema.fields if f.name not in known]])

    def placed(self, rows: DataFrame, *extra: str) -> DataFrame:
        """The rows with the partition that they belong to."""
        name = F.concat(F.lit("p"), F.coalesce(self.by.cast("string"), F.lit("-none")))
        own = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.columns.fields]
        return rows.select(*own, *extra).withColumn(PART, name)

    def write(self, rows: DataFrame, over: bool = False, parts: int | None = None) -> None:
        """Adds rows; with ``over``, in place of all rows of the partitions that they belong to.

        Rows are dealt by partition into tasks of like size, so that a small
        partition gets one file and a large one is split. If the caller knows
        that they belong to few partitions (``parts``), they are not moved.
        """
        spread = self.placed(rows)
        if parts is None or parts > FEW_PARTS:
            spread = spread.hint("rebalance", F.col(PART))
        writer = spread.write.partitionBy(PART).mode("overwrite" if over else "append").option("compression", CODEC)
        with shuffles_dropped(self.spark):
            writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)


@dataclass
class Load:
    """What a load did, the rows it inserted and updated, and the partitions it wrote or removed."""

    action: str
    inserted: int = 0
    updated: int = 0
    written: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()


def _parts(rows: DataFrame, column: str = PART) -> set[str]:
    with shuffles_dropped(rows.sparkSession):
        return {r[0] for r in rows.select(column).distinct().collect()}


def touched_partitions(table: Table, source: DataFrame, keys: Sequence[str]) -> list[str]:
    """The partitions that hold a key of the batch, and those that its rows belong to.

    Of the table, only the key columns are read for this.
    """
    own = source.select(*keys).distinct()
    held = table.with_part().select(*keys, PART).join(own, list(keys), "left_semi")
    return sorted(_parts(held) | _parts(table.placed(source)))


@contextmanager
def _written_aside(batch: DataFrame) -> Iterator[DataFrame]:
    """A batch that is read several times, as a layer; if it was not one, the layer is deleted at the end.

    Nothing that is run inside leaves its shuffle files.
    """
    source = write_layer(batch, "batch")
    try:
        with shuffles_dropped(batch.sparkSession):
            yield source
    finally:
        if source is not batch:
            drop(source)


def _merge(table: Table, source: DataFrame, keys: Sequence[str], touched: Sequence[str]) -> Load:
    target = table.with_part(touched).withColumnRenamed(PART, "_was")
    result = upsert(target, source, keys).withColumnRenamed("_op", "_action")
    merged = write_layer(table.placed(result, "_action", "_was"), "merged")
    moved = F.col("_was").isNull() | (F.col("_was") != F.col(PART))
    changed = merged.filter((F.col("_action") != KEPT) | moved)
    gains, left = _parts(changed), _parts(merged)
    losses = _parts(changed.filter(F.col("_was") != F.col(PART)), "_was")
    written, removed = sorted((gains | losses) & left), sorted(losses - left)
    if losses:
        staying = merged.filter((F.col("_was") == F.col(PART)) & F.col(PART).isin(sorted(losses)))
        table.write(staying, over=True, parts=len(losses))
        for part in losses - _parts(staying):
            delete(table.spark, f"{table.path}/{PART}={part}")
    if written:
        table.write(merged.filter(F.col(PART).isin(written)), over=True, parts=len(written))
    counts = {r["_action"]: r["n"] for r in merged.groupBy("_action").agg(F.count(F.lit(1)).alias("n")).collect()}
    drop(merged)
    return Load(MERGED, counts.get(INSERTED, 0), counts.get(UPDATED, 0), tuple(written), tuple(removed))


def merge(table: Table, source: DataFrame, keys: Sequence[str]) -> Load:
    """``upsert`` of a batch into a table, of which only the touched partitions are read in full and rewritten.

    A row whose partition changes leaves the old one, and a partition that is
    left without rows is removed. The result is written aside before the table
    is changed. Partitions are replaced one after the other, and rows that move
    are taken out of all old ones before they stand in a new one: a merge that
    was broken off leaves no row twice, and is simply run again.
    """
    with _written_aside(source) as source:
        table.widen(source.schema)
        return _merge(table, source, keys, touched_partitions(table, source, keys))


def load(table: Table, batch: DataFrame, keys: Sequence[str]) -> Load:
    """Creates the table from its first batch, leaves it alone if a batch brings nothing, and merges otherwise.

    A batch brings nothing if its keys are all there and none of its rows
    differs; that is seen from the keys first, then from the touched partitions.
    """
    with _written_aside(batch) as source:
        table.widen(source.schema)
        if not table.exists():
            parts = _parts(table.placed(source))
            table.write(source, parts=len(parts))
            return Load(CREATED, source.count(), 0, tuple(sorted(parts)))
        touched = touched_partitions(table, source, keys)
        if not any_new(source, table.read(), keys):
            same = table.read(touched).select(*source.columns)
            if source.subtract(same).isEmpty():
                return Load(UNCHANGED)
        return _merge(table, source, keys, touched)


def append(table: Table, batch: DataFrame) -> Load:
    """Adds the rows of a batch, and creates the table if need be; nothing is read or rewritten."""
    with _written_aside(batch) as source:
        table.widen(source.schema)
        placed = table.placed(source)
        counts = {r[PART]: r["n"] for r in placed.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()}
        if counts:
            table.write(source, parts=len(counts))
    return Load(APPENDED, sum(counts.values()), 0, tuple(sorted(counts)))


def load_above_watermark(table: Table, batch: DataFrame, keys: Sequence[str], ts: str, lookback_days: int = 0) -> Load:
    """``load`` of the rows of a batch that are newer than the newest ``ts`` of the table, or little older."""
    newer = above_watermark(batch, table.read(), ts, lookback_days) if table.exists() else batch
    return load(table, newer, keys)


def refresh(summary: Table, source: Table, done: Load, build: Callable[[DataFrame], DataFrame]) -> None:
    """Brings a summary of a table up to date after a load: its touched partitions alone are read and summed again.

    Both tables are laid out by the same period, and ``build`` makes from the
    rows of a period the summary of that period. Sums, means and distinct counts
    are exact, as they are taken over all rows of the period.
    """
    if done.written:
        summary.write(build(source.read(done.written)), over=True)
    for part in done.removed:
        delete(summary.spark, f"{summary.path}/{PART}={part}")
