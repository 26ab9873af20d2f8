"""Write, audit, publish: stage new table versions, check them, make them current together.

A root folder holds one folder per staged run and a manifest. Readers resolve a
table through the newest manifest entry, so a staged version is invisible until
``publish`` adds the one manifest file that names all its tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfprice.operators.upsert import INSERTED, UPDATED, upsert
from shelfprice.sources.staging import write_layer

MANIFEST_SCHEMA = "sequence bigint, run_id string, tables map<string,string>"


class AuditError(ValueError):
    """A staged load did not pass its checks; nothing was published."""


@dataclass
class StagedTable:
    path: str
    source_rows: int
    rows: int
    inserted: int
    updated: int

    @property
    def affected(self) -> int:
        return self.inserted + self.updated


def _entries(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/_manifest")
    except AnalysisException as error:
        # only a missing manifest means "nothing published"; any other failure must surface
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _latest(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    entries = _entries(spark, root)
    row = entries.orderBy(F.col("sequence").desc()).first() if entries is not None else None
    return (0, {}) if row is None else (row.sequence, dict(row.tables))


def published(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """Current version of ``table``; None before its first publish."""
    path = _latest(spark, root)[1].get(table)
    return None if path is None else spark.read.parquet(path)


def require_rows(sources: Mapping[str, DataFrame]) -> None:
    """Guardrail: no source may be empty. Reads one row of each, not a count."""
    empty = [name for name, df in sources.items() if df.isEmpty()]
    if empty:
        raise AuditError(f"empty source: {', '.join(empty)}")


def require_keys(sources: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> None:
    """Guardrail: no NULL in a merge key; such rows never match and would pile up on every run."""
    for name, df in sources.items():
        if not df.filter(reduce(or_, [F.col(k).isNull() for k in keys[name]])).isEmpty():
            raise AuditError(f"NULL merge key in {name}")


def stage(spark: SparkSession, root: str, run_id: str, name: str, source: DataFrame, keys: Sequence[str]) -> StagedTable:
    """Upsert ``source`` onto the published version and write the result under the run's folder.

    The counts are observed during the pass that writes the table.
    """
    current = published(spark, root, name)
    merged = source.withColumn("_op", F.lit(INSERTED)) if current is None else upsert(current, source, keys)
    result = Observation()
    path = f"{root}/{run_id}/{name}"
    merged.observe(
        result,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_op") == INSERTED).alias("inserted"),
        F.count_if(F.col("_op") == UPDATED).alias("updated"),
    ).drop("_op").write.mode("error").parquet(path)
    return StagedTable(path=path, source_rows=source.count(), **result.get)


def audit(spark: SparkSession, name: str, staged: StagedTable, source: DataFrame, keys: Sequence[str]) -> None:
    """No row may be lost: enough rows written, and every source key among them."""
    if staged.rows < staged.source_rows:
        raise AuditError(f"{name}: {staged.source_rows} source rows, {staged.rows} written")
    written = spark.read.parquet(staged.path)
    if not source.join(written.select(*keys), list(keys), "left_anti").isEmpty():
        raise AuditError(f"{name}: source keys missing from the staged version")


def publish(spark: SparkSession, root: str, run_id: str, staged: Mapping[str, StagedTable]) -> int:
    """Make all staged versions current with one manifest entry; returns its sequence number."""
    sequence, tables = _latest(spark, root)
    tables.update({name: s.path for name, s in staged.items()})
    entry = spark.createDataFrame([(sequence + 1, run_id, tables)], MANIFEST_SCHEMA)
    entry.coalesce(1).write.mode("append").json(f"{root}/_manifest")
    return sequence + 1


def ingest(
    spark: SparkSession,
    root: str,
    run_id: str,
    sources: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
) -> dict[str, StagedTable]:
    """Whole load: guard, stage every table, audit every table, publish them together.

    Sources are written through first, so their cleaning and dedup run once
    however many checks read them. Any failure is raised and leaves the
    published versions as they were. The staged folder stays for inspection; a
    run id cannot be reused. One run at a time may publish to a root.
    """
    sources = {name: write_layer(df, name) for name, df in sources.items()}
    require_rows(sources)
    require_keys(sources, keys)
    staged = {name: stage(spark, root, run_id, name, df, keys[name]) for name, df in sources.items()}
    for name, df in sources.items():
        audit(spark, name, staged[name], df, keys[name])
    publish(spark, root, run_id, staged)
    return staged
