"""Data-quality checks. Each one returns the violating rows; none means it passed.

Violations are grouped by value with their number of rows, so a bad value that
fills a third of the table is one row of the report, counted before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfprice.functions import UNMATCHED
from shelfprice.functions.dates import as_of_date
from shelfprice.operators.dedup import duplicates
from shelfprice.operators.joins import not_in

# Thresholds of the checks.
UNMATCHED_SHARE = 0.05
MIN_DATE = "1900-01-01"


def _counted(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return _counted(df.filter(F.col(column).isNull()), column)


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once; NULL is not a value."""
    return duplicates(df.filter(F.col(column).isNotNull()), column, count_as="n_rows")


def no_duplicates(df: DataFrame, column: str) -> DataFrame:
    """Like ``unique``, but NULL counts as a value too."""
    report = duplicates(df, column)
    return report.withColumnRenamed(column, "duplicate_column")


def grain_is_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return duplicates(df, *columns, count_as="row_count")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return _counted(df.filter(~F.col(column).isin(list(values))), column)


def relationships(child: DataFrame, column: str, parent: DataFrame, field_: str, where: str | None = None) -> DataFrame:
    """Child keys without a parent. Child keys are counted first, then anti-joined."""
    rows = child.filter(where) if where else child
    used = _counted(rows.filter(F.col(column).isNotNull()), column)
    return not_in(used, parent.select(F.col(field_).alias(column)), [column])


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    held = F.expr(expression) if isinstance(expression, str) else expression
    return df.filter(~held)


def column_is_of_type(df: DataFrame, column: str, expected: str) -> DataFrame:
    """One row when the column has another type. Looks at the schema only."""
    actual = df.schema[column].dataType.simpleString()
    report = df.sparkSession.range(0 if actual == expected else 1)
    return report.select(
        F.lit(column).alias("column"), F.lit(expected).alias("expected"), F.lit(actual).alias("actual")
    )


def matches_regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    text = F.col(column).cast("string")
    return _counted(df.filter(text.isNotNull() & ~text.rlike(pattern)), column)


def valid_date_range(
    df: DataFrame, column: str, min_date: str = MIN_DATE, as_of: dt.date | str | None = None
) -> DataFrame:
    day = F.col(column).cast("date")
    return _counted(df.filter((day < F.lit(min_date).cast("date")) | (day > as_of_date(as_of))), column)


def price_bounds(
    df: DataFrame,
    column: str,
    reference: DataFrame,
    group_by: str,
    price: str,
    upper: float = 5,
    lower: float = 0.1,
    on: str = "product_id",
) -> DataFrame:
    """Prices outside the allowed band around the reference average of their group."""
    averages = reference.groupBy(F.col(group_by).cast("string").alias("_ref")).agg(
        F.avg(F.col(price).cast("double")).alias("avg_ref_price")
    )
    # one row per distinct price before the join, so a hot product is not shuffled row by row
    prices = _counted(df.filter(F.col(column).isNotNull()), on, column)
    joined = prices.join(averages, F.col(on).cast("string") == F.col("_ref"), "inner")
    value, avg = F.col(column), F.col("avg_ref_price")
    return joined.filter((value > avg * upper) | (value < avg * lower)).select(on, column, "avg_ref_price", "n_rows")


def unmatched_share(df: DataFrame, columns: Mapping[str, str], threshold: float = UNMATCHED_SHARE) -> DataFrame:
    """Counts of unmatched keys, when any of them exceeds its share of the rows.

    ``columns`` maps the name of each count to the key column it looks at.
    """
    counts = {n: F.count_if(F.col(c).cast("string") == UNMATCHED) for n, c in columns.items()}
    stats = df.agg(F.count(F.lit(1)).alias("total_rows"), *[c.alias(n) for n, c in counts.items()])
    over = reduce(lambda a, b: a | b, [F.col(n) > F.lit(threshold) * F.col("total_rows") for n in columns])
    return stats.filter(over)


def row_counts_match(source: DataFrame, fact: DataFrame) -> DataFrame:
    """Both counts, when they differ."""
    counts = source.agg(F.count(F.lit(1)).alias("source_rows")).withColumn(
        "fact_rows", fact.agg(F.count(F.lit(1))).scalar()
    )
    return counts.filter(F.col("source_rows") != F.col("fact_rows"))


def margin_recomputes(df: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Rows whose stored margin is not revenue minus cost; cents of doubles are compared with a tolerance."""
    expected = F.round(F.col("gross_revenue") - F.col("quantity") * F.col("unit_cost"), 2)
    rows = df.select(
        "sales_key",
        F.round("gross_revenue", 2).alias("gross_revenue"),
        F.round("gross_margin_amount", 2).alias("gross_margin_amount"),
        expected.alias("expected_gross_margin"),
    )
    return rows.filter(F.abs(F.col("gross_margin_amount") - F.col("expected_gross_margin")) > tolerance)


def skipped_late_rows(source: DataFrame, loaded: DataFrame, ts: str) -> DataFrame:
    """Source dates up to the loaded maximum that were never loaded."""
    newest = loaded.agg(F.max(ts)).scalar()
    due = source.filter(F.col(ts) <= newest).select(ts).distinct()
    return not_in(due, loaded, [ts])


def schema_changes(saved: T.StructType, current: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(change, column, saved type, current type) for each difference."""
    before = {f.name: f.dataType.simpleString() for f in saved}
    after = {f.name: f.dataType.simpleString() for f in current}
    changes = []
    for name in [*before, *[c for c in after if c not in before]]:
        old, new = before.get(name), after.get(name)
        if old != new:
            kind = "added" if old is None else "removed" if new is None else "type_changed"
            changes.append((kind, name, old, new))
    return changes


def schema_report(spark: SparkSession, saved: T.StructType, current: T.StructType) -> DataFrame:
    """``schema_changes`` as a frame."""
    return spark.createDataFrame(schema_changes(saved, current), "change string, column string, saved_type string, current_type string")


@dataclass
class Check:
    """A named check over one table: ``violations`` maps the (filtered) table to violating rows.

    A check made by ``of_rows`` or ``of_keys`` says what it looks at instead,
    and is counted together with all others of its table.
    """

    name: str
    table: DataFrame
    violations: Callable[[DataFrame], DataFrame] | None = None
    severity: str = "error"
    tags: Sequence[str] = field(default_factory=tuple)
    where: str | None = None
    broken: Column | None = None
    key: Sequence[str] = ()
    count_null: bool = True

    @staticmethod
    def of_rows(name: str, table: DataFrame, broken: Column, **options) -> Check:
        """Counts the rows for which ``broken`` holds; NULL does not."""
        return Check(name, table, broken=broken, **options)

    @staticmethod
    def of_keys(name: str, table: DataFrame, *key: str, **options) -> Check:
        """Counts the keys that occur more than once. Without ``count_null``, a key with a NULL is not one."""
        return Check(name, table, key=key, **options)


def _fused(table: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failures of all row and key checks of one table, from one scan and one shuffle.

    A row sends one entry for each row check that it breaks, which are counted
    before the shuffle, and one for its key in each key check.
    """
    by_row, by_key = [c for c in checks if c.broken is not None], [c for c in checks if c.key]
    chosen = lambda c: F.expr(c.where) if c.where else F.lit(True)
    nothing = F.lit(None).cast("string").alias("_key")
    entries = [F.when(chosen(c) & c.broken, F.struct(F.lit(-1 - i).alias("_rule"), nothing)) for i, c in enumerate(by_row)]
    for i, c in enumerate(by_key):
        value = F.to_json(F.struct(*c.key), {"ignoreNullFields": "false"})
        counted = chosen(c) if c.count_null else chosen(c) & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in c.key])
        entries.append(F.when(counted, F.struct(F.lit(i).alias("_rule"), value.alias("_key"))))
    # a filter after the explode is compiled with it; array_compact would evaluate all entries in interpreted code
    sent = table.select(F.explode(F.array(*entries)).alias("_e")).filter(F.col("_e").isNotNull()).select("_e.*")
    grouped = sent.groupBy("_rule", "_key").agg(F.count(F.lit(1)).alias("_n"))
    broken = [F.coalesce(F.sum(F.when(F.col("_rule") == -1 - j, F.col("_n"))), F.lit(0)).alias(f"_f{j}") for j in range(len(by_row))]
    several = [F.count_if((F.col("_rule") == i) & (F.col("_n") > 1)).alias(f"_k{i}") for i in range(len(by_key))]
    counts = grouped.agg(*broken, *several)
    named = [(c, f"_f{i}") for i, c in enumerate(by_row)] + [(c, f"_k{i}") for i, c in enumerate(by_key)]
    rows = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(n).cast("bigint").alias("failures")) for c, n in named]
    return counts.select(F.inline(F.array(*rows)))


def run_checks(checks: Iterable[Check], tags: Sequence[str] | None = None) -> DataFrame:
    """One row per check: its severity, number of violating rows and status.

    Row and key checks of a table share one scan of it. A check that groups its
    violations says how many rows a group has in ``n_rows``; these are summed.
    The counts are one plan, so Spark runs the checks in one job.
    """
    chosen = [c for c in checks if tags is None or set(tags) & set(c.tags)]
    if not chosen:
        raise ValueError("no check selected")

    def counted(check: Check) -> DataFrame:
        table = check.table.filter(check.where) if check.where else check.table
        found = check.violations(table)
        rows = F.coalesce(F.sum("n_rows"), F.lit(0)) if "n_rows" in found.columns else F.count(F.lit(1))
        return found.agg(
            F.lit(check.name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
            rows.cast("bigint").alias("failures"),
        )

    together: dict[int, list[Check]] = {}
    for c in chosen:
        if c.violations is None:
            together.setdefault(id(c.table), []).append(c)
    fused = [_fused(group[0].table, group) for group in together.values()]
    results = reduce(DataFrame.unionByName, [*fused, *[counted(c) for c in chosen if c.violations is not None]])
    failed = F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    return results.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(failed))
