"""Corpus-wide questions about hashes, asked by blocks of documents and answered by buckets of hashes.

A block is a group of documents of bounded size that one task holds. It sends each of its distinct hashes once, so
that a passage in a third of all documents costs one entry a block, packed into one row for each bucket. A bucket is
a range of hash values; it compares what the blocks have sent and answers each block. Rows are Arrow binaries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST = np.iinfo(np.int64).max


def document_digest(doc_id: Column, text: Column) -> Column:
    """A digest of an id (a number) and a text that tells nulls from everything else."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("n")), F.lit(":"), F.coalesce(F.concat(F.lit("t"), text), F.lit("n"))).cast("binary"))


def block_size(total: int, least: int, most: int = 64 << 20) -> int:
    """Bytes of text of a block. They grow with the root of the corpus, as do those of a bucket (see bucket_count).

    Blocks times buckets then grow with the corpus, not with its square: a block sends a bucket some hundred bytes at
    least as long as ``most``, a task's memory, allows it (up to 64 TB of text).
    """
    return max(least, min(most, int((64 * total) ** 0.5)))


def bucket_count(total: int, bucket_bytes: int, block_bytes: int, least: int) -> int:
    """Buckets for ``total`` bytes of text, larger by the factor by which blocks are."""
    return max(1, -(-total * least // (bucket_bytes * block_bytes)))


def blocked(docs: DataFrame, doc_id: str, text: str, least: int) -> tuple[DataFrame, int, int]:
    """(block, doc_id, text), the bytes of all texts and those of a block, ``least`` or more.

    Rows are dealt by id, text and the partition that they are read in, so that neither null ids nor copies of one row
    meet in one block.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    size = block_size(total, least)
    n = max(1, -(-total // size))
    block = F.pmod(F.xxhash64(F.col(doc_id), F.col(text), F.spark_partition_id()), F.lit(n)).cast("int")
    return docs.select(block.alias("block"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), total, size


def in_order(table: pa.Table) -> pa.Table:
    """A block's rows in an order that does not depend on how they arrived."""
    order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")])
    return table.take(order)


def ids(table: pa.Table) -> np.ndarray:
    """The ids; a null counts as the largest."""
    return pc.fill_null(table["doc_id"], LAST).to_numpy()


def squeezed(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def expanded(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def steps(a: np.ndarray) -> bytes:
    """Rising 32-bit numbers, by their differences."""
    return squeezed(np.diff(a, prepend=0).astype(np.int32))


def unstepped(b: bytes) -> np.ndarray:
    return np.cumsum(expanded(b, np.int32), dtype=np.int64)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the highest 24 bits, so that sorted keys have sorted buckets."""
    return ((keys >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int32)


def parts(bucket: np.ndarray) -> list[tuple[int, slice]]:
    """(bucket, where its keys are), of the buckets that have keys."""
    start = np.flatnonzero(np.diff(bucket, prepend=-1))
    if not start.size:
        return []
    return [(b, slice(i, j)) for b, i, j in zip(bucket[start].tolist(), start.tolist(), np.append(start[1:], bucket.size).tolist(), strict=True)]


ASK = "bucket int, block int, keys binary, counts binary, state binary"
ANSWER = "block int, bucket int, totals binary, first binary, n long, distinct_keys long, state binary"


def ask(block: int, keys: np.ndarray, counts: np.ndarray, buckets: int, state: bytes = b"") -> pa.Table:
    """Rows that carry a block's sorted distinct keys and their counts to the buckets that have some of them.

    The row of the first bucket also carries ``state``, which comes back with its answer; a block without keys sends it
    to bucket 0.
    """
    found = parts(bucket_of(keys, buckets)) or [(0, slice(0, 0))]
    out = [
        {"bucket": b, "block": block, "keys": keys[at].tobytes(), "counts": squeezed(counts[at].astype(np.int64)), "state": state if i == 0 else b""}
        for i, (b, at) in enumerate(found)
    ]
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("state", pa.binary())])
    return pa.Table.from_pylist(out, schema)


def count_keys(table: pa.Table) -> pa.Table:
    """Answers a bucket's blocks: for each key its count over all blocks, and whether the block is the first to have it.

    ``n`` and ``distinct_keys``, in one row of the bucket and 0 in all others: the sum of all counts, and the number of
    keys whose count is not 0.
    """
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
    counts = np.concatenate([expanded(r["counts"], np.int64) for r in rows])
    order = np.argsort(keys, kind="stable")
    new = np.append(True, keys[order[1:]] != keys[order[:-1]])[: keys.size]
    sums = np.add.reduceat(counts[order], np.flatnonzero(new)) if keys.size else counts
    totals = np.empty(keys.size, np.int64)
    totals[order] = sums[np.cumsum(new) - 1] if keys.size else 0
    first = np.empty(keys.size, bool)
    first[order] = new
    out, at, n, distinct = [], 0, int(counts.sum()), int((sums > 0).sum())
    for r in rows:
        own = slice(at, at := at + len(r["keys"]) // 8)
        out.append({"block": r["block"], "bucket": r["bucket"], "totals": squeezed(totals[own]), "first": np.packbits(first[own]).tobytes(), "n": n, "distinct_keys": distinct, "state": r["state"]})
        n = distinct = 0
    schema = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("totals", pa.binary()), ("first", pa.binary()), ("n", pa.int64()), ("distinct_keys", pa.int64()), ("state", pa.binary())])
    return pa.Table.from_pylist(out, schema)


def answered(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(totals, first) of a block's sorted keys, from the answers of all buckets."""
    rows = sorted(table.select(["bucket", "totals", "first"]).to_pylist(), key=lambda r: r["bucket"])
    totals = [expanded(r["totals"], np.int64) for r in rows]
    first = [np.unpackbits(np.frombuffer(r["first"], np.uint8), count=t.size).astype(bool) for r, t in zip(rows, totals, strict=True)]
    totals, first = np.concatenate([np.zeros(0, np.int64), *totals]), np.concatenate([np.zeros(0, bool), *first])
    assert totals.size == size
    return totals, first
