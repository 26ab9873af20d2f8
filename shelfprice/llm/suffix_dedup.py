"""Long byte strings that occur twice, from a suffix array built bucket by bucket.

Every suffix is looked at up to ``width`` bytes. A cover is a sample of positions such that two equal strings of
that width have a sampled position at the same offset, so that a tie between two long suffixes is settled by what is
known of their samples. A difference cover fixes the sample by position modulo a period and keeps at least one byte
in ten; here the content fixes it (the smallest hash of a ``gram`` in every window), which has the same property
with one byte in eighty.

1. Samples. The stretch of all windows that share a sample is one string. Counts of these strings and of the
   samples' grams rank the samples: a stretch seen twice settles all its suffixes as repeated, a gram whose stretches
   are all one string settles the rest.
2. Suffix buckets. Only suffixes left open go to buckets, ranges of the suffixes' fingerprints, which are sorted one
   at a time; equal neighbours are repeated strings. A stretch that occurs in many blocks is sent by the first one.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfprice.llm import blocks
from shelfprice.llm.packed import BASE, BYTE_VALUE, U64, Hashes, mixed, slices, utf8

_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of this width."""
    n = x.size - width + 1
    padded = np.full(-(-x.size // width) * width, np.iinfo(np.uint64).max, U64)
    padded[: x.size] = x
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _stretches(data: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """First and last start of the windows that share a sample, the key of their whole string, the key of the gram."""
    n = data.size - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    depth = np.zeros(data.size + 1, np.int32)
    long = np.diff(offsets) >= width
    np.add.at(depth, offsets[:-1][long], 1)
    np.add.at(depth, offsets[1:][long] - width + 1, -1)
    start = np.flatnonzero(np.cumsum(depth[:n]))
    if not start.size:
        return start, start, np.zeros(0, U64), np.zeros(0, U64)
    hashes = Hashes(BYTE_VALUE[data], BASE)
    grams = hashes.windows(gram)
    low = U64(0xFFFFFFFF)
    place = np.arange(grams.size, dtype=U64)
    sample = (_smallest((grams & ~low) | place, width - gram + 1)[start] & low).astype(np.int64)
    new = np.append(True, (sample[1:] != sample[:-1]) | (start[1:] != start[:-1] + 1))
    begin = np.flatnonzero(new)
    first, last, sample = start[begin], start[np.append(begin[1:], start.size) - 1], sample[begin]
    whole = mixed(hashes.spans(first, last + width) + (sample - first).astype(U64) * U64(0xFF51AFD7ED558CCD) + U64(1))
    return first, last, whole, mixed(grams[sample] + U64(2))


def _block(table: pa.Table, width: int, gram: int):
    data, offsets = utf8(blocks.in_order(table)["text"])
    found = []
    for a, _, part, own in slices(data, offsets):
        first, last, whole, key = _stretches(part, own, width, gram)
        found.append((first + offsets[a], last + offsets[a], whole, key))
    found = found or [_stretches(data, offsets, width, gram)]
    return data, offsets, *(np.concatenate(x) for x in zip(*found, strict=True))


def _every(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the ranges."""
    n = last - first + 1
    return np.arange(n.sum()) + np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) if n.size else np.zeros(0, np.int64)


def _suffixes(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of the strings at these (rising) starts."""
    keys = np.empty(starts.size, U64)
    for a, b, part, _ in slices(data, offsets):
        lo, hi = np.searchsorted(starts, (offsets[a], offsets[b]))
        if lo < hi:
            at = starts[lo:hi] - offsets[a]
            keys[lo:hi] = Hashes(BYTE_VALUE[part], BASE).spans(at, at + width)
    return keys


def _ask_samples(width: int, gram: int, buckets: int, key, table: pa.Table) -> pa.Table:
    _, _, _, _, whole, grams = _block(table, width, gram)
    return blocks.ask(key[0].as_py(), *np.unique(np.concatenate([whole, grams]), return_counts=True), buckets)


def _ask_suffixes(width: int, gram: int, buckets: int, key, table: pa.Table, answers: pa.Table) -> pa.Table:
    data, offsets, first, last, whole, grams = _block(table, width, gram)
    keys, place = np.unique(np.concatenate([whole, grams]), return_inverse=True)
    totals, own = blocks.answered(answers, keys.size)
    of_whole, of_gram = place[: whole.size], place[whole.size :]
    repeated = totals[of_whole] > 1
    mixed_gram = totals[of_gram] > totals[of_whole]
    sent = mixed_gram & (~repeated | own[of_whole])
    state = pickle.dumps((first[repeated], last[repeated], first[sent], last[sent]))
    starts = _every(first[sent], last[sent])
    keys, counts = np.unique(_suffixes(data, offsets, starts, width), return_counts=True)
    return blocks.ask(key[0].as_py(), keys, counts, buckets, blocks.squeezed(np.frombuffer(state, np.uint8)))


def _cut(width: int, table: pa.Table, answers: pa.Table) -> pa.Table:
    table = blocks.in_order(table)
    data, offsets = utf8(table["text"])
    state = next(r for r in answers["state"].to_pylist() if r)
    first, last, sent_first, sent_last = pickle.loads(blocks.expanded(state, np.uint8).tobytes())
    starts = _every(sent_first, sent_last)
    keys, place = np.unique(_suffixes(data, offsets, starts, width), return_inverse=True)
    totals, _ = blocks.answered(answers, keys.size)
    starts = starts[totals[place] > 1]
    depth = np.zeros(data.size + 1, np.int32)
    np.add.at(depth, first, 1)
    np.add.at(depth, last + width, -1)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + width, -1)
    removed = np.cumsum(depth[:-1]) > 0
    begins = removed.copy()
    begins[1:] &= ~removed[:-1]
    inner = offsets[offsets < data.size]
    begins[inner] |= removed[inner]
    n_removed, n_spans = (np.diff(np.append(0, np.cumsum(x))[offsets]) for x in (removed, begins))
    raw, kept = data.tobytes(), ~removed
    sha = [
        hashlib.sha256(data[a:b][kept[a:b]].tobytes() if n else raw[a:b]).hexdigest()
        for a, b, n in zip(offsets[:-1].tolist(), offsets[1:].tolist(), n_removed.tolist(), strict=True)
    ]
    return pa.Table.from_arrays(
        [table["doc_id"], *(pa.array(x, pa.int64()) for x in (np.diff(offsets), n_removed, n_spans)), pa.array(sha, pa.string())],
        schema=pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")), ("kept_sha256", pa.string())]),
    )


def remove_repeated_bytes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 200, gram: int = 40, block_bytes: int = 4 << 20, bucket_bytes: int = 32 << 20) -> DataFrame:
    """Per document: its UTF-8 bytes, how many are removed in how many runs, and the digest of the bytes kept.

    A byte is removed if a string of ``width`` bytes that covers it also starts anywhere else, in the same document
    (overlaps included) or another. Strings are judged on the input and never cross documents.

    ``block_bytes`` of text are one task's share (a longer document is a share of its own), and there is a bucket for
    every ``bucket_bytes`` of text. Neither changes the result, nor does ``gram``.

    A null text is empty; rows with a null or repeated id are documents like all others, each with its own row.
    Further columns are ignored. An empty table gives none.
    """
    texts, total, size = blocks.blocked(docs, doc_id, text, block_bytes)
    buckets = blocks.bucket_count(total, bucket_bytes, size, block_bytes)
    grouped = texts.groupBy("block")
    samples = grouped.applyInArrow(lambda key, t: _ask_samples(width, gram, buckets, key, t), blocks.ASK)
    ranks = samples.groupBy("bucket").applyInArrow(blocks.count_keys, blocks.ANSWER)
    suffixes = grouped.cogroup(ranks.groupBy("block")).applyInArrow(lambda key, t, a: _ask_suffixes(width, gram, buckets, key, t, a), blocks.ASK)
    repeats = suffixes.groupBy("bucket").applyInArrow(blocks.count_keys, blocks.ANSWER)
    return grouped.cogroup(repeats.groupBy("block")).applyInArrow(lambda t, a: _cut(width, t, a), _RESULT)
