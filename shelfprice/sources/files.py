"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfprice.functions import nan_to_null


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Headered CSV with every column a string.

    The schema is given, so no pass over the files is spent on inference, and
    the header is checked against it instead of being trusted by position.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_seed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Small static lookup kept as headered CSV."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet table; ``merge_schema`` unions the columns of files written at different times."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Parquet table: ``overwrite`` is a full refresh, ``append`` adds files."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per row; NaN is written as null."""
    nan_to_null(df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], order: Sequence[str], buckets: int) -> DataFrame:
    """A table in files by a hash of ``keys``, each sorted by keys and ``order``; its readers need not shuffle by the keys.

    The rows are dealt out by the same hash first, so that a bucket is one file.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, *order)
    writer.option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
