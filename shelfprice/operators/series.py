"""Calendar spines, price grids and gap filling on weekly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from shelfprice.functions import date_key, month_key

# Days counted as weekend, with Sunday = 1 (Friday and Saturday).
WEEKEND_DAYS = [6, 7]
WEEK = "interval 7 days"


def _whole_years(dates: DataFrame, ts: str, step: str) -> DataFrame:
    """One row per step, from the start of the first year to the end of the last."""
    bounds = dates.agg(F.trunc(F.min(ts), "year").alias("first"), F.trunc(F.max(ts), "year").alias("last"))
    last_day = F.date_sub(F.add_months("last", 12), 1)
    return bounds.select(F.explode(F.sequence(F.col("first"), last_day, F.expr(step))).alias("day"))


def date_dimension(dates: DataFrame, ts: str, weekend: Sequence[int] = WEEKEND_DAYS) -> DataFrame:
    """One row per day of every year touched by ``ts``."""
    d = F.col("day")
    return _whole_years(dates, ts, "interval 1 day").select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.day(d).alias("day"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.dayofweek(d).isin(list(weekend)).alias("is_weekend"),
    )


def month_dimension(dates: DataFrame, ts: str) -> DataFrame:
    """One row per month of every year touched by ``ts``."""
    d = F.col("day")
    return _whole_years(dates, ts, "interval 1 month").select(
        month_key(d).alias("month_key"),
        d.alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
    )


def integer_series(df: DataFrame, n: int, name: str = "n") -> DataFrame:
    """Each row repeated for ``name`` = 1..n."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(n))))


def weekly_spine(calendar: DataFrame, weeks: DataFrame, week: str = "sales_week") -> DataFrame:
    """Distinct week starts of the calendar between the first and last week in ``weeks``."""
    low, high = weeks.agg(F.min(week)).scalar(), weeks.agg(F.max(week)).scalar()
    inside = calendar.filter((F.col("full_date") >= low) & (F.col("full_date") <= high))
    return inside.select(F.trunc("full_date", "week").alias(week)).distinct()


def price_points(df: DataFrame, low: Column, high: Column, n: int, name: str = "price") -> DataFrame:
    """Each row repeated over ``n`` evenly spaced values from ``low`` to ``high``."""
    step = (high - low) / F.lit(max(n - 1, 1))
    return (
        df.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        .withColumn(name, low + F.col("_i") * step)
        .drop("_i")
    )


def fill_weeks(
    members: DataFrame,
    observed: DataFrame,
    keys: Sequence[str],
    carried: Sequence[str],
    counted: Sequence[str],
    first_week: Column,
    last_week: Column,
    week: str = "sales_week",
    shown_from: Column | None = None,
    by_week: DataFrame | None = None,
) -> DataFrame:
    """One row per member and week from ``first_week`` to ``last_week``.

    With ``shown_from``, only weeks from that one on are produced; they carry
    what was known before it as well. ``by_week`` (see ``week_arrays``) adds
    further columns by the week: its arrays are joined to the ranges, and each
    week takes its own entry, so nothing is joined to the dense rows.

    ``carried`` columns come from the last week in which the first of them was
    known (NULL before that); ``counted`` columns are 0 in weeks without
    observation. Works on the sparse observations: each one covers the weeks
    up to the next, and the dense rows are produced at the very end by
    exploding those ranges, so the dense grid is never shuffled, sorted or
    joined here. A key has one row per observed week, so its window is bounded
    by the calendar.
    """
    by_key = Window.partitionBy(*keys).orderBy(week)
    ranges = (
        forward_fill(
            observed.filter((F.col(week) >= first_week) & (F.col(week) <= last_week)),
            keys,
            week,
            F.col(carried[0]).isNotNull(),
            carried,
        )
        .withColumn("_next", F.lead(week).over(by_key))
        .withColumn("_opens", F.lag(week).over(by_key).isNull())
        .withColumnRenamed(week, "_observed")
    )
    covered = (
        members.join(ranges, list(keys), "left")
        .withColumn("_from", F.when(F.col("_opens"), first_week).otherwise(F.coalesce("_observed", first_week)))
        .withColumn("_to", F.coalesce(F.date_sub("_next", 7), last_week))
        .withColumn("_from", F.greatest("_from", first_week if shown_from is None else shown_from))
        .filter(F.col("_from") <= F.col("_to"))
    )
    added = [] if by_week is None else [c for c in by_week.columns if isinstance(by_week.schema[c].dataType, ArrayType)]
    if by_week is not None:
        covered = covered.join(by_week, [c for c in by_week.columns if c not in added], "left")
    start = first_week if shown_from is None else shown_from
    covered = covered.withColumn(week, F.explode(F.sequence("_from", "_to", F.expr(WEEK))))
    entry = (F.date_diff(F.col(week), start) / 7).cast("int")
    known = F.col(week) >= F.col("_observed")
    exact = F.col(week).eqNullSafe(F.col("_observed"))
    return covered.select(
        *members.columns,
        week,
        *[F.when(known, F.col(c)).alias(c) for c in carried],
        *[F.coalesce(F.when(exact, F.col(c)), F.lit(0)).alias(c) for c in counted],
        *[F.get(F.col(c), entry).alias(c) for c in added],
    )


def week_arrays(filled: DataFrame, keys: Sequence[str], columns: Sequence[str], week: str = "sales_week") -> DataFrame:
    """One row per key of ``fill_weeks`` rows: each column as an array with an entry for every week, in order.

    The length of an array is that of the calendar.
    """
    rows = F.array_sort(F.collect_list(F.struct(week, *columns)))
    gathered = filled.groupBy(*keys).agg(rows.alias("_rows"))
    return gathered.select(*keys, *[F.col("_rows")[c].alias(c) for c in columns])


def forward_fill(df: DataFrame, keys: Sequence[str], order_by: str, flag: Column, columns: Sequence[str]) -> DataFrame:
    """Carry ``columns`` from the last row where ``flag`` held.

    The columns travel as one struct guarded by the flag: a struct of NULLs is
    itself not NULL and would otherwise stop the carry.
    """
    up_to_now = Window.partitionBy(*keys).orderBy(order_by).rowsBetween(Window.unboundedPreceding, 0)
    carried = F.last(F.when(flag, F.struct(*columns)), ignorenulls=True).over(up_to_now)
    others = [c for c in df.columns if c not in columns]
    return df.withColumn("_carried", carried).select(*others, *[F.col("_carried")[c].alias(c) for c in columns])
