"""One column list for both sides of a query, so that names and types agree.

``name`` is taken as it is, ``name:d`` as the text of a date, ``name:i`` as a
BIGINT, ``name:3`` as a DOUBLE rounded to three places (through a decimal, so
that the last bits of a mean do not decide a tie).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.oracle import statement


def _parts(spec: str) -> list[tuple[str, str]]:
    return [(name, kind) for name, _, kind in (item.partition(":") for item in spec.split())]


def _spark_column(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind == "d":
        c = c.cast("string")
    elif kind == "i":
        c = c.cast("bigint")
    elif kind:
        c = F.round(c.cast("decimal(38,9)"), int(kind)).cast("double")
    return c.alias(name)


def _sql_column(name: str, kind: str) -> str:
    quoted = f'"{name}"'
    if kind == "d":
        return f"CAST({quoted} AS VARCHAR) AS {quoted}"
    if kind == "i":
        return f"CAST({quoted} AS BIGINT) AS {quoted}"
    return f"CAST(round(CAST({quoted} AS DECIMAL(38, 9)), {kind}) AS DOUBLE) AS {quoted}" if kind else quoted


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    spec: str
    sql: str | None
    mart: str

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(spark, sf_dir).select(*[_spark_column(n, k) for n, k in _parts(self.spec)])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        listed = ", ".join(_sql_column(n, k) for n, k in _parts(self.spec))
        return f"SELECT {listed} FROM (\n{statement(self.sql, self.mart)}\n) AS result"


REGISTRY: dict[str, Query] = {}


def query(spec: str, sql: str | None = None, mart: str = "pricing_mart"):
    """Registers the decorated function under its own name."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[build.__name__] = Query(build, spec, sql, mart)
        return build

    return register
