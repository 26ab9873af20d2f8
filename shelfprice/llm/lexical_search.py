"""Ranked lexical search: the best documents for each item, exactly, with documents grouped by the terms they hold.

1. A pass over the documents keeps, of each, its length and the query terms in it with their frequencies. Corpus
   counts come from these postings. Items are taken to the tasks in blocks of bounded size.
2. In a task, every document of an Arrow batch gets for each item a bit mask of the item's terms that it holds;
   documents with the same mask form a group. What a term can add at most in the batch bounds the score of a mask.
   Masks are evaluated from the highest bound down, until no further one can reach the item's best documents so far.
3. The best of all tasks are ranked in two steps, so that no task gets an item's rows of all tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfprice.llm.packed import runs, slices, utf8
from shelfprice.sources.staging import write_through

_POSTINGS = "doc_id long, n long, terms binary, tfs binary"
_BEST = "item int, doc_id long, score long"

#: Bytes of terms: digits, letters, and all bytes of characters beyond ASCII.
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANKS = bytes(b if _INSIDE[b] else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order: runs of ASCII digits and letters and of other characters, A-Z in lower case."""
    return (text or "").encode().lower().translate(_BLANKS).split()


def _matched(data: np.ndarray, offsets: np.ndarray, vocabulary: pa.Array) -> tuple[np.ndarray, ...]:
    """(number of terms of each text; text, index in the vocabulary and frequency of each query term in a text)."""
    inside = _INSIDE[data]
    start, end = runs(inside, offsets)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(offsets.size - 1), np.diff(first))
    bounds = np.append(0, np.cumsum(end - start))
    words = pa.Array.from_buffers(pa.large_binary(), start.size, [None, pa.py_buffer(bounds), pa.py_buffer(_LOWER[data[inside]])])
    place = pc.fill_null(pc.index_in(words, vocabulary), -1).to_numpy()
    known = place >= 0
    key, tf = np.unique(doc[known] * len(vocabulary) + place[known], return_counts=True)
    return np.diff(first), key // max(1, len(vocabulary)), key % max(1, len(vocabulary)), tf


def _post(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary = pa.array(shared.value, pa.large_binary())
    for batch in batches:
        for a, b, data, offsets in slices(*utf8(batch.column(1)), most=4 << 20):
            n, doc, term, tf = _matched(data, offsets, vocabulary)
            at = pa.py_buffer(np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32) * 4)
            lists = [pa.Array.from_buffers(pa.binary(), b - a, [None, at, pa.py_buffer(x.astype(np.int32))]) for x in (term, tf)]
            yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers of all rows, and where each row's begin; one more entry for the end."""
    data, offsets = utf8(column)
    return np.ascontiguousarray(data).view(np.int32).astype(np.int64), offsets // 4


def _document_counts(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(size, np.int64)
    for batch in batches:
        df += np.bincount(_numbers(batch.column(0))[0], minlength=size)
    at = np.flatnonzero(df)
    yield pa.record_batch([pa.array(at, pa.int32()), pa.array(df[at])], ["term", "df"])


def length_factors(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """100 - 25 + (25 * n * documents) div total, of each length."""
    if int(n.max(initial=0)) * 25 * documents < 1 << 63:
        return 75 + 25 * n * documents // max(total, 1)
    return np.array([75 + 25 * x * documents // total for x in n.tolist()], np.int64)


class _Postings:
    """The postings of a batch, by document and by term, with what each adds per unit of its term's weight."""

    def __init__(self, batch: pa.RecordBatch, documents: int, total: int, size: int):
        self.ids = batch.column(0)
        self.term, self.first = _numbers(batch.column(2))
        tf, _ = _numbers(batch.column(3))
        m = length_factors(batch.column(1).to_numpy(), documents, total)
        self.doc = np.repeat(np.arange(m.size), np.diff(self.first))
        self.factor = 1_000_000_000 * tf // (1000 * tf + 12 * m[self.doc])
        order = np.argsort(self.term, kind="stable")
        self.by_term = self.doc[order]
        self.begin = np.searchsorted(self.term[order], np.arange(size + 1))
        self.most = np.zeros(size, np.int64)
        np.maximum.at(self.most, self.term, self.factor)

    def groups(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents ordered by their mask, masks by falling bound: (documents, start of each mask, bounds)."""
        mask = np.zeros((len(self.ids), -(-terms.size // 64)), np.uint64)
        for bit, t in enumerate(terms.tolist()):
            mask[self.by_term[self.begin[t] : self.begin[t + 1]], bit >> 6] |= np.uint64(1 << (bit & 63))
        docs = np.flatnonzero(mask.any(1))
        mask = np.ascontiguousarray(mask[docs])
        names = mask[:, 0] if mask.shape[1] == 1 else mask.view(f"V{8 * mask.shape[1]}")[:, 0]
        _, index, inverse = np.unique(names, return_index=True, return_inverse=True)
        bits = np.unpackbits(mask[index].astype("<u8").view(np.uint8).reshape(index.size, 8 * mask.shape[1]), axis=1, bitorder="little")[:, : terms.size]
        bound = bits.astype(np.float64) @ (weights * self.most[terms]).astype(np.float64)  # whole numbers below 2**53
        order = np.argsort(-bound, kind="stable")
        rank = np.empty(order.size, np.int64)
        rank[order] = np.arange(order.size)
        rank = rank[inverse]
        by_mask = np.argsort(rank, kind="stable")
        return docs[by_mask], np.searchsorted(rank[by_mask], np.arange(order.size + 1)), bound[order]

    def scores(self, docs: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores of documents that hold at least one term."""
        size = self.first[docs + 1] - self.first[docs]
        start = np.append(0, np.cumsum(size)[:-1])
        at = np.arange(size.sum()) + np.repeat(self.first[docs] - start, size)
        return np.add.reduceat(weight_of[self.term[at]] * self.factor[at], start)


class _Top:
    """The best documents of an item so far: score, then id (a null id is last)."""

    def __init__(self, k: int):
        self.k, self.score, self.null, self.id = k, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def least(self) -> int:
        """A document below this score does not come in."""
        return int(self.score[-1]) if self.score.size == self.k else 1

    def add(self, score: np.ndarray, ids: pa.Array) -> None:
        good = score >= self.least()
        ids = ids.filter(pa.array(good))
        self.score = np.append(self.score, score[good])
        self.null = np.append(self.null, ids.is_null().to_numpy(zero_copy_only=False))
        self.id = np.append(self.id, pc.fill_null(ids, 0).to_numpy())
        order = np.lexsort((self.id, self.null, -self.score))[: self.k]
        self.score, self.null, self.id = self.score[order], self.null[order], self.id[order]


def _search(shared, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    items, weights, documents, total = shared.value
    best = [_Top(k) for _ in items]
    weight_of = np.zeros(weights.size, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        postings = _Postings(batch, documents, total, weights.size)
        for top, (terms, times) in zip(best, items, strict=True):
            own = weights[terms] * times
            docs, begin, bound = postings.groups(terms, own)
            weight_of[terms] = own
            at, step = 0, 16
            while at < bound.size and bound[at] >= top.least():
                stop = min(at + step, int(np.searchsorted(-bound, -top.least(), side="right")))
                some = docs[begin[at] : begin[stop]]
                top.add(postings.scores(some, weight_of), postings.ids.take(pa.array(some)))
                at, step = stop, 2 * step
            weight_of[terms] = 0
    for i, top in enumerate(best):
        if top.score.size:
            columns = [pa.array(np.full(top.score.size, i), pa.int32()), pa.array(top.id, pa.int64(), mask=top.null), pa.array(top.score)]
            yield pa.record_batch(columns, ["item", "doc_id", "score"])


def _blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[tuple[list[int | None], list[Counter]]]:
    """Ids and terms of the items that have terms, in blocks of about this many bytes, each row seen once."""
    ids: list[int | None] = []
    terms: list[Counter] = []
    size = 0
    for r in items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).toLocalIterator():
        if found := terms_of(r.text):
            ids.append(r.item_id)
            terms.append(Counter(found))
            size += len(r.text)
            if size >= block_bytes:
                yield ids, terms
                ids, terms, size = [], [], 0
    if ids:
        yield ids, terms


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item, first within 64 shares of its rows, then of what is left."""
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    shared = found.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    few = shared.withColumn("place", F.row_number().over(Window.partitionBy("item", "share").orderBy(*order))).filter(F.col("place") <= k)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = 20, block_bytes: int = 4 << 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest score above 0 for each item.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z in lower case. N documents
    have terms, L in all; a document has n of them, a term stands tf times in it and in df documents. A term weighs
    w = floor(1000 ln((2 N + 2) / (2 df + 1))) and adds w * (10**9 tf div (1000 tf + 12 m)) for each time the item has
    it, with m = 75 + 25 n N div L. Equal scores are ranked by id.

    Items are taken to the tasks in blocks of about ``block_bytes``, each in a pass over the documents; ``k`` rows an
    item leave a task. The result is exact.

    A null or empty text of either side has no terms: such a document is in no result, such an item has no rows. Every
    row of ``items`` is an item of its own, also with a null or repeated id; rows with a repeated document id are
    documents of their own, a null id ranks behind equal scores. Further columns are ignored. Empty tables give none.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for ids, terms in _blocks(items, item_id, item_text, block_bytes):
        vocabulary = sorted(set().union(*terms))
        shared = spark.sparkContext.broadcast(vocabulary)
        postings = write_through(own.mapInArrow(lambda b, shared=shared: _post(shared, b), _POSTINGS).filter("n > 0"), "postings")
        documents, total = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        counted = postings.select("terms").mapInArrow(lambda b, size=len(vocabulary): _document_counts(size, b), "term int, df long")
        df = np.zeros(len(vocabulary), np.int64)
        for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():  # as many as the block has terms
            df[r.term] = r.df
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        place = {t: i for i, t in enumerate(vocabulary)}
        queries = [(np.array([place[t] for t in c]), np.array(list(c.values()))) for c in terms]
        given = spark.sparkContext.broadcast((queries, weights, documents, total))
        found = postings.mapInArrow(lambda b, given=given: _search(given, k, b), _BEST)
        names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")
        result = result.unionByName(_ranked(found, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return result

