"""Repeated passages of words, found by compaction of a de Bruijn graph.

An edge of the graph is a k-mer of ``k`` consecutive words; its nodes are the two (k-1)-mers in it. Edges that also
start in a document with a smaller id are repeated; each gets the coordinates of its first occurrence (smallest id,
then position). Consecutive repeated edges whose first occurrences are consecutive too form a nonbranching path with
regard to that source and compact into one span. The words of every span are compared, through a digest, with the
words at its source coordinates; only confirmed spans are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfprice.llm import blocks
from shelfprice.llm.packed import U64, WORD_BASE, Hashes, Words, utf8

_EDGES = "bucket int, block int, keys binary, words binary, ids binary, counts binary"
_SOURCES = "block int, bucket int, entries binary, source_blocks binary, source_words binary"
_PATH = ["block", "word", "n", "digest"]
_PATHS = "block int, word int, n int, digest binary, to_block int, targets binary"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class _Edges:
    """The distinct edges of a block in the order of their first occurrence, dealt to buckets."""

    def __init__(self, table: pa.Table, k: int, buckets: int):
        table = blocks.in_order(table)
        self.ids = blocks.ids(table)
        self.data, offsets = utf8(table["text"])
        self.words = Words(self.data, offsets)
        self.start = self.words.windows(k)
        keys = Hashes(self.words.hashes(self.data), WORD_BASE).windows(k)[self.start] if self.start.size else np.zeros(0, U64)
        distinct, first, self.inverse = np.unique(keys, return_index=True, return_inverse=True)
        order = np.argsort(first)
        order = order[np.argsort(blocks.bucket_of(distinct[order], buckets), kind="stable")]
        self.keys = distinct[order]
        self.word = self.start[first[order]]  # the block's word at which an edge starts first
        rank = np.empty(order.size, np.int64)
        rank[order] = np.arange(order.size)
        self.inverse = rank[self.inverse]  # of every window, the place of its edge
        self.parts = dict(blocks.parts(blocks.bucket_of(self.keys, buckets)))


def _ask(k: int, buckets: int, key, table: pa.Table) -> pa.Table:
    e = _Edges(table, k, buckets)
    out = []
    for bucket, at in e.parts.items():
        owner = e.words.doc[e.word[at]]
        change = np.flatnonzero(np.diff(owner, prepend=-1))
        out.append({
            "bucket": bucket,
            "block": key[0].as_py(),
            "keys": e.keys[at].tobytes(),
            "words": blocks.steps(e.word[at]),
            "ids": blocks.squeezed(e.ids[owner[change]]),
            "counts": blocks.squeezed(np.diff(change, append=owner.size).astype(np.int32)),
        })
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), *((n, pa.binary()) for n in ("keys", "words", "ids", "counts"))])
    return pa.Table.from_pylist(out, schema)


def _first(table: pa.Table) -> pa.Table:
    """For each edge of a bucket that starts in a document with a smaller id: the coordinates of the first one."""
    keys, word, doc, block, entry = [], [], [], [], []
    for r in table.to_pylist():
        raw = np.frombuffer(r["keys"], U64)
        keys.append(raw)
        word.append(blocks.unstepped(r["words"]).astype(np.int32))
        doc.append(np.repeat(blocks.expanded(r["ids"], np.int64), blocks.expanded(r["counts"], np.int32)))
        block.append(np.full(len(raw), r["block"], np.int32))
        entry.append(np.arange(len(raw), dtype=np.int32))
    keys, word, doc, block, entry = map(np.concatenate, (keys, word, doc, block, entry))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    shared = order[np.append(False, same) | np.append(same, False)]
    keys, word, doc, block, entry = (a[shared] for a in (keys, word, doc, block, entry))
    order = np.lexsort((word, block, doc, keys))
    keys, word, doc, block, entry = (a[order] for a in (keys, word, doc, block, entry))
    new = np.append(True, keys[1:] != keys[:-1]) if keys.size else np.zeros(0, bool)
    source = np.flatnonzero(new)[np.cumsum(new) - 1] if keys.size else np.zeros(0, np.int64)
    later = doc[source] < doc
    word, block_of, entry, source_block = word[source][later], block[later], entry[later], block[source][later]
    order = np.lexsort((entry, block_of))
    word, block_of, entry, source_block = word[order], block_of[order], entry[order], source_block[order]
    bounds = np.flatnonzero(np.diff(block_of, prepend=-1)).tolist() + [block_of.size]
    bucket = table["bucket"][0].as_py()
    out = [
        {"block": int(block_of[a]), "bucket": bucket, "entries": blocks.steps(entry[a:b]), "source_blocks": blocks.squeezed(source_block[a:b]), "source_words": blocks.squeezed(word[a:b].astype(np.int32))}
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]
    schema = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), *((n, pa.binary()) for n in ("entries", "source_blocks", "source_words"))])
    return pa.Table.from_pylist(out, schema)


def _digest(data: np.ndarray, words: Words, first: int, n: int) -> bytes:
    return hashlib.blake2b(b" ".join(data[words.start[first] : words.end[first + n - 1]].tobytes().split()), digest_size=16).digest()


def _compact(k: int, buckets: int, key, table: pa.Table, answers: pa.Table) -> pa.Table:
    """The block's repeated edges as paths along their sources; each path with all places where it stands."""
    block = key[0].as_py()
    types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
    schema = pa.schema(list(zip([*_PATH, "to_block", "targets"], types, strict=True)))
    e = _Edges(table, k, buckets)
    if not e.start.size:
        return pa.Table.from_pylist([], schema)
    source_block = np.full(e.keys.size, block, np.int64)
    source_word = e.word.astype(np.int64)
    elsewhere = np.zeros(e.keys.size, bool)
    for r in answers.to_pylist():
        at = e.parts[r["bucket"]].start + blocks.unstepped(r["entries"])
        source_block[at] = blocks.expanded(r["source_blocks"], np.int32)
        source_word[at] = blocks.expanded(r["source_words"], np.int32)
        elsewhere[at] = True
    edge = e.inverse
    doc = e.words.doc[e.start]
    repeated = elsewhere[edge] | (e.ids[doc] > e.ids[e.words.doc[e.word[edge]]])
    at = np.flatnonzero(repeated)
    start, edge = e.start[at], edge[at]
    ahead = np.append(
        False,
        (start[1:] == start[:-1] + 1)
        & (doc[at[1:]] == doc[at[:-1]])
        & (source_block[edge[1:]] == source_block[edge[:-1]])
        & (source_word[edge[1:]] == source_word[edge[:-1]] + 1),
    )[: at.size]
    begin = np.flatnonzero(~ahead)
    n = np.diff(begin, append=at.size) + k - 1
    places: dict[tuple, list[int]] = {}
    for source, first, size, word in zip(source_block[edge[begin]].tolist(), source_word[edge[begin]].tolist(), n.tolist(), start[begin].tolist(), strict=True):
        places.setdefault((source, first, size, _digest(e.data, e.words, word, size)), []).append(word)
    rows = [(*path, block, blocks.steps(np.array(words))) for path, words in places.items()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 6, types, strict=True)], schema=schema)


def _confirm(table: pa.Table, paths: pa.Table) -> pa.Table:
    """Of the paths whose words stand at their source coordinates: the block, length and places to cut."""
    schema = pa.schema([("block", pa.int32()), ("n", pa.int32()), ("targets", pa.binary())])
    if not paths.num_rows:
        return pa.Table.from_pylist([], schema)
    data, offsets = utf8(blocks.in_order(table)["text"])
    words = Words(data, offsets)
    seen: dict[tuple[int, int], bytes] = {}
    good = []
    for first, n, digest in zip(*(paths[c].to_pylist() for c in ("word", "n", "digest")), strict=True):
        if (first, n) not in seen:
            seen[first, n] = _digest(data, words, first, n)
        good.append(seen[first, n] == digest)
    kept = paths.filter(pa.array(good, pa.bool_()))
    return pa.Table.from_arrays([kept["to_block"], kept["n"], kept["targets"]], schema=schema)


def _cut(table: pa.Table, spans: pa.Table) -> pa.Table:
    table = blocks.in_order(table)
    data, offsets = utf8(table["text"])
    words = Words(data, offsets)
    depth = np.zeros(words.start.size + 1, np.int64)
    for n, targets in zip(spans["n"].to_pylist(), spans["targets"].to_pylist(), strict=True):
        first = blocks.unstepped(targets)  # rising, so no place stands twice
        depth[first] += 1
        depth[first + n] -= 1
    removed = np.cumsum(depth[:-1]) > 0
    before = np.append(0, np.cumsum(removed))
    n_removed = before[words.first[1:]] - before[words.first[:-1]]
    raw, sha = data.tobytes(), []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        own = raw[a:b].split()
        if n_removed[i]:
            gone = removed[words.first[i] : words.first[i + 1]].tolist()
            own = [w for w, g in zip(own, gone, strict=True) if not g]
        sha.append(hashlib.sha256(b" ".join(own)).hexdigest())
    return pa.Table.from_arrays(
        [table["doc_id"], pa.array(np.diff(words.first), pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())],
        schema=pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]),
    )


def remove_repeated_passages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 13, block_bytes: int = 4 << 20, bucket_edges: int = 4 << 20) -> DataFrame:
    """Per document: its words, how many are removed, and the digest of the words kept.

    A word is removed if a window of ``k`` words that covers it also starts in a document with a smaller id. Words
    are runs of other characters than the six ASCII blanks, unchanged. Windows are judged on the input.

    ``block_bytes`` of text are one task's share (a longer document is a share of its own); a bucket compares about
    ``bucket_edges`` edges. Neither changes the result.

    A null text has no words; a null id counts as larger than every other id; rows that repeat an id count as one
    document's, so none of them removes words of the other. Further columns are ignored. An empty table gives none.
    """
    texts, total, size = blocks.blocked(docs, doc_id, text, block_bytes)
    buckets = blocks.bucket_count(total, 6 * bucket_edges, size, block_bytes)
    grouped = texts.groupBy("block")
    edges = grouped.applyInArrow(lambda key, t: _ask(k, buckets, key, t), _EDGES)
    sources = edges.groupBy("bucket").applyInArrow(_first, _SOURCES)
    paths = grouped.cogroup(sources.groupBy("block")).applyInArrow(lambda key, t, a: _compact(k, buckets, key, t, a), _PATHS)
    spans = grouped.cogroup(paths.groupBy("block")).applyInArrow(_confirm, "block int, n int, targets binary")
    return grouped.cogroup(spans.groupBy("block")).applyInArrow(_cut, _RESULT)
