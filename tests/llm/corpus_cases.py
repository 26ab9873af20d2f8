"""Fixtures and helpers of the corpus tests."""

import pytest

SF = "/root/testdata/sf0.001"

#: Nulls, empty and blank texts, ties, repeated rows and clashing column names.
LONG = " ".join(f"w{i * 7919 % 1009}" for i in range(40_000))
ODD = [
    (900_001, None, "en"),
    (900_002, "", "en"),
    (900_003, " \n\t ", None),
    (None, "a text whose id is missing " * 20, "en"),
    (None, "a text whose id is missing " * 20, "en"),
    (900_004, "é" * 150 + "x" * 150, "fr"),
    (900_005, "é" * 150 + "x" * 150, "fr"),
    (900_005, "é" * 150 + "x" * 150, "fr"),
    (900_006, LONG, "en"),
    (900_007, "one two three", "en"),
    (900_008, "one two three", "en"),
    (900_009, "1 2 3 - ! 4", "de"),
]
CLASHES = ["block", "bucket", "n_words", "spans", "doc", "node", "label", "score", "_kept", "_doc_key", "_found_spans", "_place"]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with the odd cases, with columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(ODD, "doc_id long, text string, lang string").withColumns({"source": F.lit("odd"), "n_chars": F.length("text").cast("long")})
    return frame.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
