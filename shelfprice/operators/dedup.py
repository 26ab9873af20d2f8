"""Keep-latest deduplication and duplicate reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The hash of the keys of a row.
HASH = "_hash"


def keep_latest(
    df: DataFrame, keys: Sequence[str], order_by: str, date_format: str | None = None, hashed: bool = False
) -> DataFrame:
    """One row per key: the newest by ``order_by`` parsed as a timestamp.

    Ties and unparsable stamps are settled by the remaining columns, so the
    pick does not depend on row order. The planner limits each key to its first
    row per map task before the shuffle, so a key that owns a third of all rows
    sends one row per task, not all. The hash in front of the keys lets the
    sort compare numbers, not texts. With ``hashed`` it stays in the rows, so
    that an ``upsert`` on the same keys joins them where they are.
    """
    stamp = F.col(order_by)
    parsed = F.try_to_timestamp(stamp, F.lit(date_format)) if date_format else stamp.try_cast("timestamp")
    others = [c for c in df.columns if c not in keys]
    # rows of one key have one stamp if it is part of the key
    at = {} if order_by in keys else {"_at": parsed}
    order = [F.col(c).desc_nulls_last() for c in [*at, *others]] or [F.col(HASH)]
    newest_first = Window.partitionBy(HASH, *keys).orderBy(*order)
    ranked = df.withColumns({HASH: F.xxhash64(*keys), **at}).withColumn("_rank", F.row_number().over(newest_first))
    return ranked.filter(F.col("_rank") == 1).select(*df.columns, *([HASH] if hashed else []))


def latest_per_group(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """Newest row per group, pre-aggregated before the shuffle."""
    others = [c for c in df.columns if c not in keys and c != order_by]
    newest = df.groupBy(*keys).agg(F.max(F.struct(order_by, *others)).alias("_newest"))
    return newest.select(*[c if c in keys else F.col("_newest")[c].alias(c) for c in df.columns])


def duplicates(df: DataFrame, *keys: str, count_as: str = "occurrence_count") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).filter(F.col(count_as) > 1)
