"""Code length of documents by prediction by partial matching, and a smoothed unigram base.

The model has the counts of all training documents in byte contexts up to ``depth`` bytes deep: a symbol is coded in
its longest known context; if it is new there, an escape (method C: as likely as there are different symbols in the
context) leads to the next shorter one, where the symbols of the longer context are excluded. Below the empty context,
the symbols left are equally likely. A text starts in a context of its own and ends with an end symbol, so the
probabilities of all texts sum to one.

Contexts of up to two bytes are a trie of at most 256**3 counts, which is gathered and broadcast. Longer contexts grow
with the corpus and stay distributed: blocks of documents send their distinct grams (a context of full depth and its
symbol) to buckets, which add up the counts. The sums are dealt out by the last three bytes of the context, so that a
gram meets all that its shorter contexts are made of, rated there, and go back over the buckets to the blocks.

The base needs the corpus count of every word; blocks of documents ask buckets of words for them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.llm import blocks
from shelfprice.llm.packed import U64, Words, mixed, slices, utf8

#: Bytes that UTF-8 never has.
START, END = 0xFF, 0xFE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
END_TOKEN = U64(0x5851F42D4C957F2D)
_GRAMS = "gram int, n long"
_ASKED = "bucket int, block int, keys binary, counts binary"
_SUMS = "suffix int, bucket int, keys binary, counts binary"
_RATED = "bucket int, suffix int, logs binary"
_RATINGS = "block int, bucket int, logs binary"
_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _framed(data: np.ndarray, offsets: np.ndarray, depth: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The texts, each after ``depth`` start symbols and before an end symbol."""
    docs, more = np.arange(offsets.size - 1), depth + 1
    out = np.full(data.size + more * docs.size, START, np.uint8)
    out[np.arange(data.size) + np.repeat(more * docs + depth, np.diff(offsets))] = data
    out[offsets[1:] + more * docs + depth] = END
    return out, offsets + more * np.arange(offsets.size)


def _symbols(framed: np.ndarray, offsets: np.ndarray, depth: int = 2) -> np.ndarray:
    """Index of every symbol that is coded: all but the starts of each text."""
    coded = np.ones(framed.size, bool)
    for i in range(depth):
        coded[offsets[:-1] + i] = False
    return np.flatnonzero(coded)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, part, own in slices(*utf8(batch.column(0)), most=8 << 20):
            framed, own = _framed(part, own)
            present = np.flatnonzero(np.bincount(framed, minlength=256))
            place = np.zeros(256, np.int32)
            place[present] = np.arange(present.size)
            x, at, size = place[framed], _symbols(framed, own), present.size
            n = np.bincount((x[at - 2] * size + x[at - 1]) * size + x[at], minlength=size**3)
            code = np.flatnonzero(n)
            gram = (present[code // size**2] << 16) | (present[code // size % size] << 8) | present[code % size]
            yield pa.record_batch([pa.array(gram, pa.int32()), pa.array(n[code], pa.int64())], ["gram", "n"])


def _blend(levels: list[np.ndarray]) -> np.ndarray:
    """Probabilities of all symbols, from counts in the longest context to the shortest."""
    p, left, excluded = np.zeros(256), 1.0, np.zeros(256, bool)
    for counts in levels:
        new = (counts > 0) & ~excluded
        kinds, n = int(new.sum()), counts[new].sum()
        if not kinds:
            continue
        excluded = excluded | new
        if excluded.all():
            p[new] = left * counts[new] / n
            return p
        p[new] = left * counts[new] / (n + kinds)
        left *= kinds / (n + kinds)
    p[~excluded] = left / (~excluded).sum()
    return p


def fit_contexts(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of a context, log10 probability of a symbol by row). A context never seen has the row of its last byte."""
    one, zero = np.zeros((256, 256), np.int64), np.zeros(256, np.int64)
    np.add.at(one, (grams >> 8 & 255, grams & 255), n)
    np.add.at(zero, grams & 255, n)
    order = np.argsort(grams)
    grams, n = grams[order], n[order]
    contexts, begin = np.unique(grams >> 8, return_index=True)
    table = np.empty((256 + contexts.size, 256), np.float32)
    for last in range(256):
        table[last] = np.log10(_blend([one[last], zero]))
    row = np.tile(np.arange(256, dtype=np.int32), 256)
    for i, (c, a, b) in enumerate(zip(contexts.tolist(), begin.tolist(), np.append(begin, grams.size)[1:].tolist(), strict=True)):
        two = np.zeros(256, np.int64)
        two[grams[a:b] & 255] = n[a:b]
        table[256 + i] = np.log10(_blend([two, one[c & 255], zero]))
        row[c] = 256 + i
    return row, table


def code_lengths(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, table: np.ndarray) -> np.ndarray:
    """log10 probability of each text."""
    out = [np.zeros(0)]
    for _, _, part, own in slices(data, offsets):
        framed, own = _framed(part, own)
        wide, at = framed.astype(np.int32), _symbols(framed, own)
        p = table[row[wide[at - 2] << 8 | wide[at - 1]], framed[at]].astype(np.float64)
        out.append(np.add.reduceat(p, own[:-1] - 2 * np.arange(own.size - 1)))
    return np.concatenate(out)


class Contexts:
    """The counts in contexts of up to two bytes, and what is blended from them (see ``fit_contexts``)."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.row, self.table = fit_contexts(grams, n)
        order = np.argsort(grams)
        self.grams, self.n = grams[order], n[order]
        self.total, self.kinds = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        np.add.at(self.total, grams >> 8, n)
        np.add.at(self.kinds, grams >> 8, 1)

    def counts(self, grams: np.ndarray) -> np.ndarray:
        if not self.grams.size:
            return np.zeros(grams.size, np.int64)
        at = np.minimum(np.searchsorted(self.grams, grams), self.grams.size - 1)
        return np.where(self.grams[at] == grams, self.n[at], 0)


def _grams_of(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every symbol, and where the symbols of each text start.

    A gram has the bytes of its context, the nearest one first, and then the symbol: grams whose contexts end alike
    are neighbours.
    """
    framed, own = _framed(data, offsets, depth)
    at, key = _symbols(framed, own, depth), U64(0)
    for back in [*range(1, depth + 1), 0]:
        key = key << U64(8) | framed[at - back].astype(U64)
    return key, own[:-1] - depth * np.arange(own.size - 1)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: keys.size])
    return keys[first], np.add.reduceat(n[order], first) if first.size else n


def rate_grams(keys: np.ndarray, n: np.ndarray, depth: int, low: Contexts) -> np.ndarray:
    """log10 probability of the symbol of each gram in its context, from sorted grams and their training counts.

    All grams whose contexts share their last three bytes have to be there. A count of 0 is a gram that training
    documents do not have. A symbol of a context is one of each shorter context, too: the counts that exclusion takes
    from a context are thus a sum over the symbols of the context that is one byte longer.
    """
    symbol, logs, open_ = keys & U64(255), np.zeros(keys.size), np.ones(keys.size, bool)
    longer = None  # of the level before: first row and counts of its grams, starts of its contexts, context of each row

    def code(count, total, kinds, escape=0.0):
        """Codes what this level knows, with ``escape`` on top of the escape of all others."""
        nonlocal open_
        lost, known = np.zeros(keys.size, np.int64), np.zeros(keys.size, np.int64)
        if longer is not None:
            rows, counts, starts, context = longer
            lost = np.add.reduceat(np.where(counts > 0, count[rows], 0), starts)[context]
            known = np.add.reduceat((counts > 0).astype(np.int64), starts)[context]
        new, mass = kinds - known, total - lost
        size = np.log10(np.maximum(mass + new, 1))
        hit = open_ & (count > 0)
        logs[hit] += np.log10(np.maximum(count, 1))[hit] - size[hit]
        open_ = open_ & ~hit
        logs[:] += np.where(open_, np.where(new > 0, np.log10(np.maximum(new, 1)) - size, 0) + escape, 0)

    for order in range(depth, 2, -1):
        context = keys >> U64(8 * (depth + 1 - order))
        gram, first, place = np.unique(context << U64(8) | symbol, return_index=True, return_inverse=True)
        counts = np.bincount(place, weights=n).astype(np.int64)
        starts = np.flatnonzero(np.append(True, gram[1:] >> U64(8) != gram[:-1] >> U64(8)))
        of_gram = np.repeat(np.arange(starts.size), np.diff(np.append(starts, gram.size)))
        row_context = of_gram[place]
        total, kinds = np.add.reduceat(counts, starts), np.add.reduceat((counts > 0).astype(np.int64), starts)
        code(counts[place], total[row_context], kinds[row_context])
        longer = first, counts, starts, row_context

    last, before = keys >> U64(8 * depth), keys >> U64(8 * (depth - 1)) & U64(255)
    two = (before << U64(8) | last).astype(np.int64)
    total, kinds = low.total[two], low.kinds[two]
    # the table blends the orders below two behind an escape from two without exclusion, which is taken out of it
    plain = np.where(kinds > 0, np.log10(np.maximum(kinds, 1)) - np.log10(np.maximum(total + kinds, 1)), 0)
    code(low.counts(two << 8 | symbol.astype(np.int64)), total, kinds, low.table[low.row[two], symbol.astype(np.int64)] - plain)
    return logs


def _planes(a: np.ndarray) -> bytes:
    """Numbers by their first, second, ... bytes, which zstd packs better."""
    return blocks.squeezed(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T)


def _from_planes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(blocks.expanded(b, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _dealt(where: np.ndarray, keys: np.ndarray, n: np.ndarray, name: str, **of_all) -> list[dict]:
    """A row for each bucket: its keys, as steps, and their counts."""
    order = np.argsort(where, kind="stable")
    keys, n = keys[order], n[order].astype(np.int64)
    return [
        {name: b, **of_all, "keys": _planes(np.diff(keys[at], prepend=U64(0))), "counts": _planes(n[at])}
        for b, at in blocks.parts(where[order])
    ]


def _received(rows: list[dict]) -> tuple[list[np.ndarray], np.ndarray]:
    """The keys of each row, and the counts of all."""
    keys = [np.cumsum(_from_planes(r["keys"], U64), dtype=U64) for r in rows]
    return keys, np.concatenate([_from_planes(r["counts"], np.int64) for r in rows])


def _rows(rows: list[dict], fields: str) -> pa.Table:
    types = {"int": pa.int32(), "binary": pa.binary()}
    return pa.Table.from_pylist(rows, pa.schema([(f.split()[0], types[f.split()[1]]) for f in fields.split(", ")]))


def _gram_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return blocks.bucket_of(mixed(keys), buckets)


def _suffix_bucket(keys: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    """By the last three bytes of the context."""
    return blocks.bucket_of(mixed(keys >> U64(8 * (depth - 2))), buckets)


def _block_grams(table: pa.Table, folds: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of a block, and their counts in its training documents."""
    held, keys, counts = _held_out(table["doc_id"], folds), [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for first, last, part, own in slices(*utf8(table["text"]), most=8 << 20):
        grams, start = _grams_of(part, own, depth)
        out = np.repeat(held[first:last], np.diff(np.append(start, grams.size)))
        known, n = np.unique(grams[~out], return_counts=True)
        new = np.unique(grams[out])
        keys += [known, new]
        counts += [n, np.zeros(new.size, np.int64)]
    return _summed(np.concatenate(keys), np.concatenate(counts))


def _ask_grams(folds: int, depth: int, buckets: int, key, table: pa.Table) -> pa.Table:
    keys, counts = _block_grams(table, folds, depth)
    return _rows(_dealt(_gram_bucket(keys, buckets), keys, counts, "bucket", block=key[0].as_py()), _ASKED)


def _sum_grams(depth: int, buckets: int, key, table: pa.Table) -> pa.Table:
    keys, counts = _received(table.to_pylist())
    keys, counts = _summed(np.concatenate(keys), counts)
    return _rows(_dealt(_suffix_bucket(keys, depth, buckets), keys, counts, "suffix", bucket=key[0].as_py()), _SUMS)


def _rate_suffixes(depth: int, model, table: pa.Table, part: int = 1 << 20) -> pa.Table:
    rows = table.to_pylist()
    keys, n = _received(rows)
    ends = np.cumsum([k.size for k in keys])
    keys = np.concatenate(keys)
    order = np.argsort(keys)
    keys, n, logs = keys[order], n[order], np.empty(keys.size, np.float32)
    suffix = keys >> U64(8 * (depth - 2))
    starts = np.flatnonzero(np.append(True, suffix[1:] != suffix[:-1]))
    at = 0
    while at < keys.size:  # whole suffixes, about ``part`` grams at a time
        later = starts[np.searchsorted(starts, at + part) :]
        to = int(later[0]) if later.size else keys.size
        logs[order[at:to]] = rate_grams(keys[at:to], n[at:to], depth, model.value)
        at = to
    return _rows([{"bucket": r["bucket"], "suffix": r["suffix"], "logs": _planes(a)} for r, a in zip(rows, np.split(logs, ends[:-1]), strict=True)], _RATED)


def _answer_grams(depth: int, buckets: int, asked: pa.Table, rated: pa.Table) -> pa.Table:
    rows, ratings = asked.to_pylist(), sorted(rated.to_pylist(), key=lambda r: r["suffix"])
    own, counts = _received(rows)
    keys, _ = _summed(np.concatenate(own), counts)
    logs = np.empty(keys.size, np.float32)
    logs[np.argsort(_suffix_bucket(keys, depth, buckets), kind="stable")] = np.concatenate([_from_planes(r["logs"], np.float32) for r in ratings])
    return _rows([{"block": r["block"], "bucket": r["bucket"], "logs": _planes(logs[np.searchsorted(keys, k)])} for r, k in zip(rows, own, strict=True)], _RATINGS)


def _deep_lengths(table: pa.Table, answers: pa.Table, depth: int, buckets: int) -> np.ndarray:
    """log10 probability of each text, from the ratings of the block's grams."""
    sorted_, found = [], [np.zeros(0, U64)]
    for _, _, part, own in slices(*utf8(table["text"]), most=8 << 20):
        grams, start = _grams_of(part, own, depth)
        order = np.argsort(grams)
        grams = grams[order]
        first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
        found.append(grams[first])
        sorted_.append((order, np.diff(np.append(first, grams.size)), start))
    keys = np.unique(np.concatenate(found))
    rows = sorted(answers.select(["bucket", "logs"]).to_pylist(), key=lambda r: r["bucket"])
    logs = np.empty(keys.size)
    logs[np.argsort(_gram_bucket(keys, buckets), kind="stable")] = np.concatenate([_from_planes(r["logs"], np.float32) for r in rows])
    out = [np.zeros(0)]
    for own, (order, n, start) in zip(found[1:], sorted_, strict=True):
        of_symbol = np.empty(order.size)
        of_symbol[order] = np.repeat(logs[np.searchsorted(keys, own)], n)
        out.append(np.add.reduceat(of_symbol, start))
    return np.concatenate(out)


def _held_out(doc_ids: pa.ChunkedArray, folds: int) -> np.ndarray:
    return np.array([zlib.crc32(b"" if d is None else str(d).encode()) % folds == 0 for d in doc_ids.to_pylist()], bool)


def _words(table: pa.Table) -> tuple[Words, np.ndarray, np.ndarray]:
    """The block's words, its distinct keys (the end token among them), and the place of each word's key."""
    data, offsets = utf8(table["text"])
    data = LOWER[data]
    words = Words(data, offsets)
    keys, place = np.unique(np.append(words.hashes(data), END_TOKEN), return_inverse=True)
    return words, keys, place


def _ask(folds: int, buckets: int, key, table: pa.Table) -> pa.Table:
    table = blocks.in_order(table)
    words, keys, place = _words(table)
    train = ~_held_out(table["doc_id"], folds)
    counts = np.bincount(place[:-1][train[words.doc]], minlength=keys.size)
    counts[place[-1]] += train.sum()
    return blocks.ask(key[0].as_py(), keys, counts, buckets)


def _score(folds: int, alpha: float, depth: int, buckets: int, model, table: pa.Table, answers: pa.Table) -> pa.Table:
    table = blocks.in_order(table)
    words, keys, place = _words(table)
    of_grams = pc.is_valid(answers["logs"])
    ratings, answers = answers.filter(of_grams), answers.filter(pc.invert(of_grams))
    totals, _ = blocks.answered(answers, keys.size)
    n, distinct = answers["n"][0].as_py(), answers["distinct_keys"][0].as_py()
    logs, known = np.log10(totals + alpha), totals > 0
    docs, end = table.num_rows, place[-1]
    tokens = np.diff(words.first) + 1
    sums = np.bincount(words.doc, weights=logs[place[:-1]], minlength=docs) + logs[end]
    n_known = np.bincount(words.doc, weights=known[place[:-1]], minlength=docs).astype(np.int64) + int(known[end])
    base = sums - tokens * np.log10(n + alpha * (distinct + 1))
    if depth > 2:
        score = _deep_lengths(table, ratings, depth, buckets)
    else:
        score = code_lengths(*utf8(table["text"]), model.value.row, model.value.table)
    return pa.Table.from_arrays(
        [table["doc_id"], pa.array(_held_out(table["doc_id"], folds)), pa.array(tokens, pa.int64()), pa.array(n_known), pa.array(np.full(docs, n), pa.int64()), pa.array(base), pa.array(score)],
        schema=pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]),
    )


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of an id's text leaves this remainder; a null id's text is empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def score_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", folds: int = 10, alpha: float = 0.1, depth: int = 5, block_bytes: int = 4 << 20, bucket_bytes: int = 64 << 20) -> DataFrame:
    """Per document: log10 probability by the context model (``score``) and by smoothed word counts (``base_score``).

    Both learn from the documents whose CRC-32 of the id's text modulo ``folds`` is not 0. Words are runs of other
    characters than the six ASCII blanks, with A-Z in lower case; every text ends with one more token. ``n_known``
    counts the tokens that training documents have. A context has up to ``depth`` bytes (2 to 7).

    ``block_bytes`` of text are one task's share (a longer document is a share of its own), with a bucket of words for
    every ``bucket_bytes``. A null text is empty; a null id's text is empty too, so that such a row is held out; rows
    that repeat an id are documents of their own. Without training documents, every symbol is equally likely. Further
    columns are ignored. An empty table gives none.
    """
    if not 2 <= depth <= 7:
        raise ValueError(f"a gram of depth {depth} is not two to seven bytes of context and a symbol")
    spark = docs.sparkSession
    train = docs.filter(~in_fold(F.col(doc_id), folds, 0)).select(F.col(text).alias("text"))
    grams = train.mapInArrow(_count_grams, _GRAMS).groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    model = spark.sparkContext.broadcast(Contexts(grams["gram"].to_numpy().astype(np.int64), grams["n"].to_numpy()))
    texts, total, size = blocks.blocked(docs, doc_id, text, block_bytes)
    buckets = blocks.bucket_count(total, bucket_bytes, size, block_bytes)
    grouped = texts.groupBy("block")
    asked = grouped.applyInArrow(lambda key, t: _ask(folds, buckets, key, t), blocks.ASK)
    counts = asked.groupBy("bucket").applyInArrow(blocks.count_keys, blocks.ANSWER)
    # a subquery of the same plan, so that its shuffles are those of the counts themselves
    whole = counts.agg(F.struct(F.sum("n").alias("n"), F.sum("distinct_keys").alias("distinct_keys"))).scalar()
    answers = counts.withColumn("whole", whole).withColumns({"n": F.col("whole.n"), "distinct_keys": F.col("whole.distinct_keys"), "logs": F.lit(None).cast("binary")}).drop("whole")
    # a block has far more grams than words
    parts = blocks.bucket_count(total, bucket_bytes // 2, size, block_bytes)
    if depth > 2:
        sent = grouped.applyInArrow(lambda key, t: _ask_grams(folds, depth, parts, key, t), _ASKED)
        sums = sent.groupBy("bucket").applyInArrow(lambda key, t: _sum_grams(depth, parts, key, t), _SUMS)
        rated = sums.groupBy("suffix").applyInArrow(lambda t: _rate_suffixes(depth, model, t), _RATED)
        found = sent.groupBy("bucket").cogroup(rated.groupBy("bucket")).applyInArrow(lambda a, r: _answer_grams(depth, parts, a, r), _RATINGS)
        answers = answers.unionByName(found, allowMissingColumns=True)
    return grouped.cogroup(answers.groupBy("block")).applyInArrow(lambda t, a: _score(folds, alpha, depth, parts, model, t, a), _RESULT)
