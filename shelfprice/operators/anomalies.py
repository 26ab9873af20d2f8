"""Anomalies per time bucket against the trailing buckets.

All four monitors share one shape: metrics per bucket, then each bucket is
compared with the ``trailing`` buckets before it. The history is formed by
sending every bucket to the buckets that look back on it and aggregating,
not by a window over all buckets, so nothing is funnelled through one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRAILING = 14
Z_LIMIT = 3.0

# The supported column metrics.
METRICS = {
    "sum": F.sum,
    "average": F.avg,
    "min": F.min,
    "max": F.max,
    "variance": F.var_samp,
    "null_percent": lambda c: F.avg(F.col(c).isNull().cast("double")) * 100,
}


def _bucket(ts: str, period: str):
    return F.date_trunc(period, ts).cast("date")


def _step(period: str, n: int = 1):
    return F.expr(f"interval {n} {period}")


def _spine(buckets: DataFrame, period: str) -> DataFrame:
    """Every bucket between the first and the last one."""
    bounds = buckets.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", _step(period))).alias("bucket"))


def flag_anomalies(metrics: DataFrame, period: str, trailing: int = TRAILING, z_limit: float = Z_LIMIT) -> DataFrame:
    """Adds mean, deviation and z-score of the trailing buckets to (bucket, metric, value).

    A bucket is judged once it has ``trailing`` earlier values; one whose
    history does not vary has no z-score.
    """
    first, last = F.col("bucket") + _step(period), F.col("bucket") + _step(period, trailing)
    looked_back = metrics.select(
        F.explode(F.sequence(first.cast("date"), last.cast("date"), _step(period))).alias("bucket"), "metric", "value"
    )
    history = looked_back.groupBy("bucket", "metric").agg(
        F.count("value").alias("_n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("deviation")
    )
    judged = F.col("_n") >= trailing
    scored = (
        metrics.join(history, ["bucket", "metric"], "left")
        .withColumn("mean", F.when(judged, F.col("mean")))
        .withColumn("deviation", F.when(judged, F.col("deviation")))
        .withColumn("z_score", F.when(F.col("deviation") > 1e-9, (F.col("value") - F.col("mean")) / F.col("deviation")))
    )
    anomalous = F.coalesce(F.abs("z_score") > z_limit, F.lit(False))
    return scored.select("bucket", "metric", "value", "mean", "deviation", "z_score", anomalous.alias("is_anomaly"))


def volume_anomalies(df: DataFrame, ts: str, period: str = "day", **limits) -> DataFrame:
    """Row count per bucket; a bucket without rows counts 0."""
    counts = df.filter(F.col(ts).isNotNull()).groupBy(_bucket(ts, period).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    dense = _spine(counts, period).join(counts, "bucket", "left")
    metrics = dense.select("bucket", F.lit("row_count").alias("metric"), F.coalesce("n", F.lit(0)).cast("double").alias("value"))
    return flag_anomalies(metrics, period, **limits)


def freshness_anomalies(df: DataFrame, ts: str, period: str = "day", **limits) -> DataFrame:
    """Longest stretch of a bucket, in seconds, without a new record.

    Stretches run from the bucket's start to its first record, between
    records, and from the last record to the bucket's end. Timestamps are made
    distinct first and compared minute by minute, then minute to minute, so
    neither a busy day nor many copies of one stamp land in one task whole.
    """
    # microseconds as integers: exact and cheap to subtract
    stamps = df.select(F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), _bucket(ts, period).alias("bucket"))
    stamps = stamps.filter(F.col("t").isNotNull()).distinct()
    minute = F.col("t") - F.pmod(F.col("t"), F.lit(60_000_000))
    in_minute = Window.partitionBy("bucket", "_minute").orderBy("t")
    minutes = (
        stamps.withColumn("_minute", minute)
        .withColumn("_gap", F.col("t") - F.lag("t").over(in_minute))
        .groupBy("bucket", "_minute")
        .agg(F.min("t").alias("_first"), F.max("t").alias("_last"), F.max("_gap").alias("_inner"))
    )
    in_bucket = Window.partitionBy("bucket").orderBy("_minute")
    gaps = minutes.withColumn("_between", F.col("_first") - F.lag("_last").over(in_bucket))
    per_bucket = gaps.groupBy("bucket").agg(
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.greatest(F.max("_inner"), F.max("_between")).alias("_inside"),
    )
    start = F.unix_micros(F.col("bucket").cast("timestamp"))
    end = F.unix_micros((F.col("bucket") + _step(period)).cast("timestamp"))
    longest = F.greatest(F.col("_first") - start, end - F.col("_last"), F.col("_inside"))
    dense = _spine(per_bucket, period).join(per_bucket, "bucket", "left")
    metrics = dense.select(
        "bucket",
        F.lit("seconds_without_data").alias("metric"),
        (F.coalesce(longest, end - start) / F.lit(1_000_000)).alias("value"),
    )
    return flag_anomalies(metrics, period, **limits)


def column_anomalies(
    df: DataFrame, ts: str, column: str, metrics: Sequence[str], period: str = "day", **limits
) -> DataFrame:
    """Column metrics per bucket, in long form."""
    known = df.filter(F.col(ts).isNotNull())
    wide = known.groupBy(_bucket(ts, period).alias("bucket")).agg(
        *[METRICS[m](column).cast("double").alias(m) for m in metrics]
    )
    return flag_anomalies(wide.unpivot("bucket", list(metrics), "metric", "value"), period, **limits)


# What a bucket's state holds, and how states of one bucket are put together.
STATE = {"n_rows": F.sum, "n_known": F.sum, "total": F.sum, "squares": F.sum, "lowest": F.min, "highest": F.max}


def bucket_states(df: DataFrame, ts: str, column: str, period: str = "day") -> DataFrame:
    """(bucket, state): counts, sums and extremes of a column, from which every metric follows.

    States of different loads can be put together (``merge_states``), so a load
    only reads its own rows, late ones included.
    """
    value = F.col(column).cast("double")
    return df.filter(F.col(ts).isNotNull()).groupBy(_bucket(ts, period).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("n_known"),
        F.sum(value).alias("total"),
        F.sum(value * value).alias("squares"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per bucket from those of several loads."""
    return states.groupBy("bucket").agg(*[how(c).alias(c) for c, how in STATE.items()])


def state_anomalies(states: DataFrame, metrics: Sequence[str], period: str = "day", **limits) -> DataFrame:
    """``column_anomalies`` from kept states; ``row_count`` stands for ``volume_anomalies``."""
    whole, n = merge_states(states), F.col("n_known")
    values = {
        "sum": F.col("total"),
        "average": F.try_divide(F.col("total"), n),
        "min": F.col("lowest"),
        "max": F.col("highest"),
        "variance": F.try_divide(F.greatest(F.col("squares") - F.col("total") * F.col("total") / F.nullif(n, F.lit(0)), F.lit(0.0)), F.nullif(n - 1, F.lit(-1))),
        "null_percent": (F.col("n_rows") - n) / F.col("n_rows") * 100,
    }
    columns = [m for m in metrics if m != "row_count"]
    wide = whole.select("bucket", *[values[m].cast("double").alias(m) for m in columns])
    parts = [wide.unpivot("bucket", columns, "metric", "value")] if columns else []
    if "row_count" in metrics:
        dense = _spine(whole, period).join(whole, "bucket", "left")
        parts.append(dense.select("bucket", F.lit("row_count").alias("metric"), F.coalesce("n_rows", F.lit(0)).cast("double").alias("value")))
    return flag_anomalies(reduce(DataFrame.unionByName, parts), period, **limits)
