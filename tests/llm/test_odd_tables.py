"""Further columns with names that operators use themselves, and texts larger than any slice or block."""

import hashlib

import pytest
from corpus_cases import CLASHES, docs, labels, odd, rows, texts  # noqa: F401
from pyspark.sql import functions as F

from shelfprice.llm.decontaminate import find_items
from shelfprice.llm.jaccard_join import first_of_each, similar_documents
from shelfprice.llm.language import identify_languages
from shelfprice.llm.lexical_search import search
from shelfprice.llm.lm_score import score_documents
from shelfprice.llm.packing import pack
from shelfprice.llm.pii import redact, report
from shelfprice.llm.quality_model import score_quality
from shelfprice.llm.quality_rules import judge, kept_documents
from shelfprice.llm.queries import tokenizer
from shelfprice.llm.substring_dedup import remove_repeated_passages
from shelfprice.llm.suffix_dedup import remove_repeated_bytes
from shelfprice.llm.token_counts import count_tokens

NAMES = [*CLASHES, "Statistics", "Text_", "held", "content", "entity", "terms", "body", "row", "term", "n", "tile", "part", "home", "doc_ID_"]


@pytest.fixture(scope="module")
def few(docs, odd):
    return docs.select("doc_id", "text", "lang", "source", "n_chars").limit(60).unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars")).cache()


def pieces(frame):
    """Sequences are numbered by task, so only what a document's pieces are is compared."""
    return pack(frame, tokenizer()).select("doc_id", "start", "length", "ids_crc32", "doc_tokens")


OPERATORS = {
    "report": lambda f, _: report(f),
    "items": lambda f, _: find_items(f, f.limit(5).select(F.col("doc_id").alias("item_id"), "text")),
    "pack": lambda f, _: pieces(f),
    "passages": lambda f, _: remove_repeated_passages(f),
    "quality": lambda f, labels: score_quality(f, labels).drop("score"),
    "bytes": lambda f, _: remove_repeated_bytes(f),
    "rules": lambda f, labels: judge(f, labels),
    "language": lambda f, _: identify_languages(f).drop("score"),
    "similar": lambda f, _: similar_documents(f),
    "score": lambda f, _: score_documents(f).drop("score", "base_score"),
    "counts": lambda f, _: count_tokens(f, tokenizer("byte_bpe_50k.json")),
    "search": lambda f, _: search(f, f.limit(5).select(F.col("doc_id").alias("item_id"), "text"), k=2),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_further_columns_change_nothing(few, labels, name):
    clashing = few.withColumns({c: F.lit(c) for c in NAMES})
    assert rows(OPERATORS[name](clashing, labels)) == rows(OPERATORS[name](few, labels))


@pytest.mark.parametrize("stage", [kept_documents, lambda f, _: redact(f), lambda f, _: first_of_each(f)])
def test_stages_keep_all_columns(few, labels, stage):
    clashing = few.withColumns({c: F.lit(c) for c in NAMES})
    got = stage(clashing, labels)
    assert got.columns == clashing.columns
    assert rows(got.select(few.columns)) == rows(stage(few, labels))


@pytest.fixture(scope="module")
def long(spark):
    """A text of six megabytes, part of which another document repeats."""
    words = [f"k{i * 7919 % 1_000_003}" for i in range(800_000)]
    data = [(1, " ".join(words)), (2, "before " + " ".join(words[500_000:500_300]) + " after"), (3, "short and alone")]
    return spark.createDataFrame(data, "doc_id long, text string"), words


def test_long_texts(long):
    frame, words = long
    passages = {r.doc_id: r for r in remove_repeated_passages(frame).collect()}
    assert (passages[1].n_words, passages[1].n_removed, passages[2].n_removed) == (800_000, 0, 300)
    assert passages[2].kept_sha256 == hashlib.sha256(b"before after").hexdigest()
    repeated = len(" ".join(words[500_000:500_300])) + 2
    found = {r.doc_id: r for r in remove_repeated_bytes(frame).collect()}
    assert found[1].n_removed in (repeated, repeated - 1, repeated - 2) and found[1].n_spans == found[2].n_spans == 1
    counts = {r.doc_id: r.n_tokens for r in score_documents(frame).collect()}
    assert counts == {1: 800_001, 2: 303, 3: 4}
    assert {r.doc_id: r.n_links for r in similar_documents(frame).collect()} == {1: 0, 2: 0, 3: 0}
    assert report(frame).count() == 3
