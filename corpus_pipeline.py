"""Documents to training sequences: filter, deduplicate, decontaminate, redact and pack."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfprice.llm.decontaminate import without_items
from shelfprice.llm.jaccard_join import first_of_each
from shelfprice.llm.packing import pack
from shelfprice.llm.pii import redact
from shelfprice.llm.quality_rules import kept_documents
from shelfprice.llm.queries import table, tokenizer
from shelfprice.sources.staging import shared_dir, short_lived_layers


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules learned from the labels reject go."""
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays."""
    return first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item occurs go."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, and words that disclose it are removed."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token sequences."""
    return pack(docs, tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL knows neither learned rules nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.

    Every stage is written to the shared folder and read again by the next one; the layers that a stage needs on the
    way are deleted once it is written.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}/{name}"
        with short_lived_layers(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
