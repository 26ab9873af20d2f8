"""Ranked search against a plain evaluation of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from corpus_cases import SF, docs, empty, odd, rows, texts  # noqa: F401

from shelfprice.llm.lexical_search import length_factors, search


def split(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)


def ranked(documents, items, k=20):
    """What the contract says, document by document."""
    held = [(i, Counter(w), len(w)) for i, t in documents if (w := split(t))]
    total, df = sum(n for *_, n in held), Counter(t for _, c, _ in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * len(held) + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 75 + 25 * n * len(held) // total
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in split(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def pairs(frame):
    return [(r.item_id, r.text) for r in frame.collect()]


@pytest.mark.parametrize("options", [{}, {"k": 3, "block_bytes": 300}])
def test_search_equals_brute_force(docs, items, options):
    found = search(docs, items, **options)
    assert rows(found) == ranked(texts(docs), pairs(items), options.get("k", 20))


def test_odd_rows_and_ties(spark, docs, odd):
    made = [
        (1, None, "x"),
        (2, "", "x"),
        (3, "!?", "x"),
        (None, "one two W7 \u00e9\u00e9", "x"),
        (4, "ONE one TWO three", "x"),
        (4, "text missing id", "x"),
        (5, " ".join(f"w{i}" for i in range(300)) + " three", "x"),
    ]
    items = spark.createDataFrame(made, "item_id long, text string, doc_id string")
    both = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    for frame in (odd, both):
        for batch in ("2", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch if frame is odd else "10000")
            assert rows(search(frame, items, k=4)) == ranked(texts(frame), pairs(items), 4)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_many_equal_documents_are_ranked_by_id(spark):
    documents = [(i, "same words here" if i % 3 else "other words") for i in range(500)]
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    items = spark.createDataFrame([(7, "here same"), (8, "words")], "item_id long, text string")
    found = rows(search(frame.repartition(8), items))
    assert found == ranked(documents, [(7, "here same"), (8, "words")])
    assert [r[2] for r in sorted(found, key=lambda r: r[1])] == [i for i in range(500) if i % 3][:20]


def test_a_document_beyond_a_slice(spark):
    documents = [(1, "alpha " * 1_200_000 + "beta"), (2, "alpha beta"), (3, "gamma")]
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    items = spark.createDataFrame([(1, "beta"), (2, "Alpha alpha")], "item_id long, text string")
    assert rows(search(frame, items)) == ranked(documents, [(1, "beta"), (2, "Alpha alpha")])


def test_lengths_beyond_64_bits():
    n = np.array([1, 10**7, 10**9])
    documents, total = 10**12, 3 * 10**14
    assert length_factors(n, documents, total).tolist() == [75 + 25 * x * documents // total for x in n.tolist()]


def test_empty_tables(docs, empty, items, spark):
    assert search(empty, items).count() == 0
    assert search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert search(docs, items.limit(0)).count() == 0
