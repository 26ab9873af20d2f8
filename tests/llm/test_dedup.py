"""Repeated passages and byte strings against brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from corpus_cases import docs, empty, odd, rows, texts  # noqa: F401

from shelfprice.llm import blocks
from shelfprice.llm.packed import BASE, BYTE_VALUE, Hashes, Words, utf8
from shelfprice.llm.substring_dedup import remove_repeated_passages
from shelfprice.llm.suffix_dedup import remove_repeated_bytes


def passages(data, k=13):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in data]
    rank = lambda i: float("inf") if i is None else i
    first = {}
    for i, w in split:
        for j in range(len(w) - k + 1):
            key = tuple(w[j : j + k])
            first[key] = min(first.get(key, float("inf")), rank(i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            if first[tuple(w[j : j + k])] < rank(i):
                gone[j : j + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def strings(data, width=200):
    seen, out = {}, []
    raw = [(i, (t or "").encode()) for i, t in data]
    for _, b in raw:
        for j in range(len(b) - width + 1):
            seen[b[j : j + width]] = seen.get(b[j : j + width], 0) + 1
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for j in range(len(b) - width + 1):
            if seen[b[j : j + width]] > 1:
                gone[j : j + width] = True
        gone = gone[:-1]
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1 << 14, 4 << 20])
def test_passages_equal_brute_force(docs, odd, block_bytes):
    for frame in (docs, odd):
        assert rows(remove_repeated_passages(frame, block_bytes=block_bytes, bucket_edges=5_000)) == passages(texts(frame))


@pytest.mark.parametrize("block_bytes", [1 << 14, 4 << 20])
def test_strings_equal_brute_force(docs, odd, block_bytes):
    for frame in (docs, odd):
        assert rows(remove_repeated_bytes(frame, block_bytes=block_bytes, bucket_bytes=1 << 16)) == strings(texts(frame))


def test_a_common_passage_with_different_ends(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    data = [(i, " ".join(f"a{i}x{j}" for j in range(i % 30)) + f" {passage[: 330 - i]} " + " ".join(f"b{i}x{j}" for j in range(40))) for i in range(120)]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(7)
    assert rows(remove_repeated_passages(frame, block_bytes=5_000)) == passages(data)
    assert rows(remove_repeated_bytes(frame, block_bytes=5_000, bucket_bytes=20_000)) == strings(data)


def test_periodic_texts(spark):
    data = [(1, "ab" * 300), (2, "x" * 199), (3, "x" * 200), (4, "x" * 201), (5, "the end " * 80), (6, "of the end " * 60)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(remove_repeated_bytes(frame)) == strings(data)
    assert rows(remove_repeated_passages(frame)) == passages(data)


def test_empty_tables(empty):
    assert remove_repeated_passages(empty).count() == remove_repeated_bytes(empty).count() == 0


def test_hashes_do_not_depend_on_the_place():
    import pyarrow as pa

    data, offsets = utf8(pa.array(["one two one", None, "", "two  one\n"]))
    words = Words(data, offsets)
    h = words.hashes(data)
    assert words.first.tolist() == [0, 3, 3, 3, 5]
    assert h[0] == h[2] == h[4] and h[1] == h[3] and h[0] != h[1]
    assert Hashes(BYTE_VALUE[data], BASE).windows(3)[0] == h[0]


def test_counts_are_wide_and_cells_without_keys_are_not_sent():
    keys = np.array([3, 1 << 40, 1 << 63], np.uint64)
    sent = [blocks.ask(b, keys, np.array([2**33, 0, 5]), 16, b"state") for b in (0, 1)]
    assert [r["bucket"] for r in sent[0].to_pylist()] == [0, 8]
    low = pa.concat_tables([t.filter(pa.compute.equal(t["bucket"], 0)) for t in sent])
    answers = blocks.count_keys(low).to_pylist()
    assert [blocks.expanded(r["totals"], np.int64).tolist() for r in answers] == [[2**34, 0]] * 2
    assert sum(r["n"] for r in answers) == 2**34 and sum(r["distinct_keys"] for r in answers) == 1
    assert blocks.count_keys(blocks.ask(7, keys[:0], keys[:0], 16, b"s")).to_pylist()[0]["state"] == b"s"


def test_blocks_and_buckets_grow_with_the_corpus():
    """Cells that a block sends to a bucket, per byte of text, from a tenth of a gigabyte to 50 terabytes."""
    for total in (10**8, 5 * 10**8, 3 * 10**10, 10**12, 5 * 10**13):
        size = blocks.block_size(total, 4 << 20)
        cells = total / size * blocks.bucket_count(total, 32 << 20, size, 4 << 20)
        assert cells / total <= 1 / 400


def test_null_ids_and_copies_are_spread_over_blocks(spark):
    made = spark.range(20_000, numPartitions=8).selectExpr("cast(null as long) as doc_id", "if(id % 2 = 0, 'the same text', concat('text ', lpad(id, 6, '0'))) as text")
    dealt, _, _ = blocks.blocked(made, "doc_id", "text", 1 << 14)
    counts = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert len(counts) > 12 and max(counts) < 4_000
