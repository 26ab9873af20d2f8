"""Type-2 history: build, extend, look up as of a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfprice.operators.joins import lookup_join

# The open end of a version and the day before all history.
OPEN_END = "9999-12-31"
FLOOR = "0001-01-01"


def open_end(c: Column) -> Column:
    return F.coalesce(c, F.lit(OPEN_END).cast("date"))


def version_id(key: Column, updated_at: Column) -> Column:
    """Hash of key and change date, naming one version of one member."""
    return F.md5(F.concat_ws("|", key.cast("string"), updated_at.cast("string")))


def newest_attributes(log: DataFrame, key: str, attrs: Sequence[str], ts: str) -> DataFrame:
    """One row per key: its newest attribute tuple and the date it was last seen."""
    newest = F.max(F.struct(F.col(ts).alias("updated_at"), *attrs)).alias("_v")
    rows = log.filter(F.col(ts).isNotNull()).groupBy(key).agg(newest)
    return rows.select(key, *[F.col("_v")[a].alias(a) for a in attrs], F.col("_v.updated_at").alias("updated_at"))


def _versioned(rows: DataFrame, key: str, attrs: Sequence[str], valid_to: Column) -> DataFrame:
    return rows.select(
        key,
        *attrs,
        "updated_at",
        version_id(F.col(key), F.col("updated_at")).alias("dbt_scd_id"),
        F.col("updated_at").alias("dbt_updated_at"),
        F.col("updated_at").alias("dbt_valid_from"),
        valid_to.cast("date").alias("dbt_valid_to"),
    )


def build_history(log: DataFrame, key: str, attrs: Sequence[str], ts: str, strategy: str = "timestamp") -> DataFrame:
    """Whole history of a dimension from the full log of observations.

    ``check`` opens a version when the attributes change, ``timestamp`` on
    every day the key is seen. The log is first reduced to its different
    tuples per key and day before the shuffle, by hashing, which needs no sort
    of the rows; the largest tuple of a day is taken from those. So a window
    over a key is bounded by the calendar however many rows a hot key has.
    """
    # not max: copies make no difference to it, so the planner would drop the distinct and sort all rows
    tuple_of_day = F.max_by(F.struct(*attrs), F.struct(*attrs)).alias("_attrs")
    seen = log.filter(F.col(ts).isNotNull()).select(key, F.col(ts).alias("updated_at"), *attrs).distinct()
    daily = seen.groupBy(key, "updated_at").agg(tuple_of_day)
    by_key = Window.partitionBy(key).orderBy("updated_at")
    if strategy == "check":
        # wrapped in a struct so the first day (no previous row) is told from NULL attributes
        previous = F.lag(F.struct("_attrs")).over(by_key)
        daily = daily.withColumn("_previous", previous).filter(
            F.col("_previous").isNull() | ~F.col("_previous._attrs").eqNullSafe(F.col("_attrs"))
        )
    elif strategy != "timestamp":
        raise ValueError(f"unknown strategy: {strategy}")
    rows = daily.withColumn("_next", F.lead("updated_at").over(by_key)).select(
        key, *[F.col("_attrs")[a].alias(a) for a in attrs], "updated_at", "_next"
    )
    return _versioned(rows, key, attrs, F.col("_next"))


def apply_snapshot(
    history: DataFrame | None,
    log: DataFrame,
    key: str,
    attrs: Sequence[str],
    ts: str,
    strategy: str = "timestamp",
) -> DataFrame:
    """History after one more snapshot run over the current log.

    ``timestamp`` opens a version when the key's last-seen date advanced,
    ``check`` when the date advanced and an attribute changed. The open version
    it replaces is closed at the new version's date. Running it twice on the
    same log changes nothing.
    """
    incoming = newest_attributes(log, key, attrs, ts)
    if history is None:
        return _versioned(incoming, key, attrs, F.lit(None))
    current = history.filter(F.col("dbt_valid_to").isNull()).select(
        key, F.col("dbt_updated_at").alias("_seen"), F.struct(*attrs).alias("_old")
    )
    changed = F.col("_seen").isNull() | (F.col("updated_at") > F.col("_seen"))
    if strategy == "check":
        same = F.struct(*attrs).eqNullSafe(F.col("_old"))
        changed = F.col("_seen").isNull() | ((F.col("updated_at") > F.col("_seen")) & ~same)
    elif strategy != "timestamp":
        raise ValueError(f"unknown strategy: {strategy}")
    opened = incoming.join(current, key, "left").filter(changed).select(incoming.columns)
    closing = opened.select(key, F.col("updated_at").alias("_closed_at"))
    kept = (
        history.join(closing, key, "left")
        .withColumn("dbt_valid_to", F.coalesce("dbt_valid_to", "_closed_at"))
        .select(history.columns)
    )
    return kept.unionByName(_versioned(opened, key, attrs, F.lit(None)))


def splice_history(history: DataFrame, late: DataFrame, key: str, attrs: Sequence[str], ts: str) -> DataFrame:
    """``build_history`` of the log and the ``late`` observations, from the history of the log alone.

    ``history`` has a version for every day a key was seen (``timestamp``).
    Only versions around late dates change: the one that holds a late date is
    closed there and the late one opened up to where it ended; one that starts
    on that date takes the larger tuple of the two; a date before all versions
    opens the first one. All other versions pass through. The order in which
    observations arrive makes no difference, and repeating them none either.
    Observations without a key or date are left out.
    """
    daily = late.filter(F.col(ts).isNotNull() & F.col(key).isNotNull()).groupBy(key, F.col(ts).alias("_day")).agg(F.max(F.struct(*attrs)).alias("_late"))
    span = daily.agg(F.min("_day"), F.max("_day")).first()
    held = as_of_join(daily, history, key, "_day", ["dbt_valid_from", "dbt_valid_to"], tuple(span) if span[0] else None)
    same = F.col("_day") == F.col("dbt_valid_from")
    before = F.col("dbt_valid_from").isNull() | (F.col("_day") < F.col("dbt_valid_from"))
    # of the dates in one interval (or before the first version), each one's version ends at the next date or with the interval
    ends = F.when(before, F.col("dbt_valid_from")).otherwise(F.col("dbt_valid_to"))
    inside = held.filter(~F.coalesce(same, F.lit(False))).select(key, "_day", "_late", before.alias("_before"), "dbt_valid_from", ends.alias("_end"))
    interval = Window.partitionBy(key, "_before", "dbt_valid_from").orderBy("_day")
    opened = inside.withColumn("_next", F.coalesce(F.lead("_day").over(interval), "_end"))
    opened = opened.select(key, *[F.col("_late")[a].alias(a) for a in attrs], F.col("_day").alias("updated_at"), "_next")

    at = [F.col(key).alias("_key"), F.col("dbt_valid_from").alias("_start")]
    touched = inside.filter(~F.col("_before")).select(*at, F.col("_day").alias("_closed"), F.lit(None).cast(daily.schema["_late"].dataType).alias("_late"))
    touched = touched.unionByName(held.filter(same).select(*at, F.lit(None).cast("date").alias("_closed"), "_late"))
    touched = touched.groupBy("_key", "_start").agg(F.min("_closed").alias("_closed"), F.max("_late").alias("_late"))
    kept = history.join(touched, F.col(key).eqNullSafe(F.col("_key")) & (F.col("dbt_valid_from") == F.col("_start")), "left")
    newest = F.greatest(F.struct(*attrs), F.col("_late"))
    kept = kept.select(
        *[F.when(F.col("_late").isNull(), F.col(c)).otherwise(newest[c]).alias(c) if c in attrs else F.col(c) for c in history.columns if c != "dbt_valid_to"],
        F.coalesce("_closed", "dbt_valid_to").alias("dbt_valid_to"),
    )
    return kept.unionByName(_versioned(opened, key, attrs, F.col("_next")))


def with_first_version(versions: DataFrame, key: str, valid_from: str = "dbt_valid_from") -> DataFrame:
    """Adds ``first_valid_from``: start of the key's first version."""
    return versions.withColumn("first_valid_from", F.min(valid_from).over(Window.partitionBy(key)))


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    span: tuple | None = None,
) -> DataFrame:
    """Attach ``columns`` of the version of ``key`` that was valid at ``at``.

    A fact dated before the first version takes the first version; one without
    key or date takes none. Versions are laid out by month, so the join is an
    equi-join on key and month and a fact only meets the versions of its own
    month, not all versions of its key. ``span`` is the first and last date in
    the facts; when not given it is read from the ``at`` column.
    """
    low, high = span or facts.agg(F.min(at), F.max(at)).first()
    if low is None:
        low = high = FLOOR
    low, high = F.lit(low).cast("date"), F.lit(high).cast("date")
    started = F.when(F.col("dbt_valid_from") == F.col("first_valid_from"), F.lit(FLOOR).cast("date"))
    bounded = with_first_version(versions, key).select(
        key,
        *[F.col(c).alias(f"_v_{c}") for c in columns],
        F.coalesce(started, "dbt_valid_from").alias("_from"),
        open_end(F.col("dbt_valid_to")).alias("_to"),
    )
    first_month = F.trunc(F.greatest("_from", low), "month")
    last_month = F.trunc(F.least(F.date_sub("_to", 1), high), "month")
    by_month = bounded.filter(first_month <= last_month).withColumn(
        "_month", F.explode(F.sequence(first_month, last_month, F.expr("interval 1 month")))
    )
    within = (F.col(at) >= F.col("_from")) & (F.col(at) < F.col("_to"))
    joined = lookup_join(
        facts.withColumn("_month", F.trunc(at, "month")), by_month, [key, "_month"], "left", within
    )
    return joined.select(*facts.columns, *[F.col(f"_v_{c}").alias(c) for c in columns])


def overlapping_versions(
    versions: DataFrame, key: str, valid_from: str = "dbt_valid_from", valid_to: str = "dbt_valid_to"
) -> DataFrame:
    """Every version that starts while an earlier version of the same key is still open.

    One row per version (versions with the same start are kept apart, none of
    them is earlier than the other), with the number of earlier versions that
    are open at its start and the one that stays open longest. Openings and
    closings are summed along each key in the order of their dates, so the work
    is linear and no pairs are made; ``n_open`` summed over the rows is the
    number of pairs.
    """
    rows = versions.select(key, F.col(valid_from).alias("_from"), open_end(F.col(valid_to)).alias("_to"))
    real = rows.filter(F.col("_to") > F.col("_from"))
    # at one date closings come first, then the starts that are judged, then openings
    marks = F.array(
        F.struct(F.col("_to").alias("at"), F.lit(0).alias("turn"), F.lit(-1).alias("step")),
        F.struct(F.col("_from").alias("at"), F.lit(2).alias("turn"), F.lit(1).alias("step")),
    )
    events = real.select(key, F.inline(marks), F.lit(None).cast("date").alias("_to"))
    judged = rows.select(key, F.col("_from").alias("at"), F.lit(1).alias("turn"), F.lit(0).alias("step"), "_to")
    opened = real.select(key, "_from", "_to").groupBy(key, "_from").agg(F.max("_to").alias("_longest"))
    earlier = Window.partitionBy(key).orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    witness = opened.union(rows.select(key, "_from", F.lit(None).cast("date")).distinct()).groupBy(key, "_from").agg(F.max("_longest").alias("_longest"))
    longest = F.max(F.struct(F.col("_longest"), F.col("_from").alias("_start"))).over(earlier)
    so_far = Window.partitionBy(key).orderBy("at", "turn")
    counted = events.unionByName(judged).withColumn("n_open", F.sum("step").over(so_far)).filter((F.col("turn") == 1) & (F.col("n_open") > 0))
    witnesses = witness.select(key, F.col("_from").alias("at"), longest.alias("_w"))
    closed = lambda c: F.nullif(c, F.lit(OPEN_END).cast("date"))
    return counted.join(witnesses, [key, "at"]).select(
        key,
        F.col("_w._start").alias("window_a_start"),
        closed(F.col("_w._longest")).alias("window_a_end"),
        F.col("at").alias("window_b_start"),
        closed(F.col("_to")).alias("window_b_end"),
        "n_open",
    )
