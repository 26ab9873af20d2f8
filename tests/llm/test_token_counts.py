"""Token counts against the library at its defaults, text by text."""

import json
import random

import public_tokenizers
import pytest
from corpus_cases import docs, empty, odd, rows, texts  # noqa: F401
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shelfprice.llm.token_counts import Pieces, count_tokens, counter, cuts_are_safe, keys

JSON = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(JSON)


def expected(data, limit=1024, count=lambda t: len(PLAIN.encode(t, add_special_tokens=False).ids)):
    found = [(i, len((t or "").encode()), count(t or "")) for i, t in data]
    return sorted([(*r, r[2] > limit) for r in found], key=str)


@pytest.mark.parametrize("options", [{}, {"known_pieces": 50, "batch_bytes": 200}])
def test_counts_equal_the_library(docs, odd, options):
    for frame in (docs, odd):
        assert rows(count_tokens(frame, JSON, **options)) == expected(texts(frame))


def test_special_strings_and_long_texts(rows_of):
    made = [
        (1, "a <|endoftext|> b<|endoftext|>c <|endoftext|>"),
        (2, "no blank in it" .replace(" ", "") * 40_000),
        (3, "one, two. three;\r\n\r\n four  five\t six\n" * 30_000),
        (4, "\u65e5\u672c\u8a9e \u3000\u30c6\u30ad\u30b9\u30c8 " * 500),
    ]
    assert rows(count_tokens(rows_of(made), JSON)) == expected(made)


@pytest.fixture
def rows_of(spark):
    return lambda data: spark.createDataFrame(data, "doc_id long, text string")


def test_cuts_change_no_count():
    random.seed(3)
    marks = " \n\t\r\0a'sZ1.,!<|endoftext|>\u00e9\u3000\u0085\u0301\x1c"
    made = ["".join(random.choices(marks + "  ", k=random.randint(0, 40))) for _ in range(20_000)]
    count, safe = counter(JSON)
    assert safe
    assert Pieces(count, 1_000, 500)([keys(t) for t in made]) == [len(e) for e in PLAIN.encode_batch(made, add_special_tokens=False)]


def test_sentencepiece_texts_go_whole(docs, odd):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    data = [(i, t) for i, t in texts(odd)]
    assert rows(count_tokens(odd, path)) == expected(data, count=lambda t: len(model.encode(t)))


def test_other_tokenizers_are_not_cut():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        assert not cuts_are_safe(json.load(f))
    with open(JSON, encoding="utf-8") as f:
        model = json.load(f)
    assert not cuts_are_safe(model | {"added_tokens": [{"content": "two words"}]})
    assert not cuts_are_safe(model | {"added_tokens": [{"content": "a.b"}]})


def test_empty_table_and_limit(empty, rows_of):
    assert count_tokens(empty, JSON).count() == 0
    assert rows(count_tokens(rows_of([(1, "a b c"), (2, "a b c d")]), JSON, limit=3)) == [(1, 5, 3, False), (2, 7, 4, True)]
