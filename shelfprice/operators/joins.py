"""Joins. Strategy and the splitting of hot keys are left to the planner, which knows the bytes of both sides."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(
    facts: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left", residual: Column | None = None
) -> DataFrame:
    """Join ``facts`` to a looked-up ``table`` on the columns ``on``.

    A plain equi-join without a hint: the planner broadcasts a side only below
    its byte threshold and at run time splits the partitions of ``facts`` that
    a hot key, or rows without a key, make too large. That splitting follows
    partition bytes, so the largest task stays the same size as data grows.
    It holds for the kinds that may split the left side, so others are refused.
    ``residual`` may use the non-key columns of both sides, whose names must
    then differ.
    """
    if how not in ("left", "inner", "left_anti", "left_semi"):
        raise ValueError(f"facts cannot be split in a {how} join")
    on = list(on)
    if residual is None:
        return facts.join(table, on, how)
    renamed = table.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = residual
    for c in on:
        condition = condition & (F.col(c) == F.col(f"_r_{c}"))
    return facts.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def not_in(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``existing``; a NULL key is always absent.

    Existing keys are made distinct before the shuffle, so copies of one key
    never pile up in a task.
    """
    return lookup_join(df, existing.select(*keys).distinct(), keys, "left_anti")


def any_new(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the batch holds any row whose key is not loaded yet."""
    return not not_in(df, existing, keys).isEmpty()


def every_pair(left: DataFrame, right: DataFrame, pairs_per_cell: int = 1_000_000) -> DataFrame:
    """Every left row with every right row, for two dimensions whose full grid is the result.

    Both sides are hashed, and a cell joins one part of each through an
    equi-join. The number of cells follows from the rows of both sides (which
    should be scans), so a cell holds about ``pairs_per_cell`` pairs whatever
    the size of the dimensions, and a row is repeated about as often as the
    square root of the number of cells.
    """
    rows, columns = left.count(), right.count()
    cells = max(1, ceil(rows * columns / pairs_per_cell))
    across = min(max(1, columns), ceil(sqrt(cells)))
    down = max(1, ceil(cells / across))

    def part(df: DataFrame, n: int) -> Column:
        return F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int")

    visits = left.withColumn("_down", part(left, down)).withColumn("_across", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    hosts = right.withColumn("_across", part(right, across)).withColumn("_down", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    return visits.join(hosts, ["_down", "_across"]).drop("_down", "_across")
