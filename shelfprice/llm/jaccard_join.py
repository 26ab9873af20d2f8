"""Join of documents whose shingle sets are alike, with Bayesian pruning of candidates.

1. Documents with the same set of word shingles form a class, which is compared once.
2. Classes that agree in a band of MinHash values are candidates. A class's home is the largest band bucket it is in,
   and a home of which a fair share lies in another home is folded into that one, so that a group of near copies has
   one or two homes. Classes meet in jobs, one for each pair of homes that share a bucket. A job is dealt out in tiles
   of bounded size, so that neither a bucket with a third of all classes nor its pairs reach one task or become rows.
3. In a tile, MinHash values are compared a few at a time. With a uniform prior, the similarity of a pair that agrees
   in m of n values is at least t with probability P(Binomial(n + 1, t) <= m); a pair below a share of the tolerance
   is dropped. The share is such that all looks together lose at most the tolerance.
4. Classes with a pair left are compared by their whole shingle sets. A tile returns the number of links of each of
   its classes and a spanning forest of them; connected components of the forests are the groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.llm import blocks
from shelfprice.llm.packed import U64, WORD_BASE, Hashes, Words, mixed, slices, utf8
from shelfprice.sources.staging import TEXTS_A_FILE, in_few_files, write_through

ROWS = 4
_SKETCH = "doc_id long, doc string, node binary, n int, signature binary"
_HOMES = "node binary, n int, band long, size long, home long"
#: Of a home's classes, in one other home, for it to be folded into that one.
FOLDED = 0.25
#: Classes asked for at a time, and bytes of shingles in one side of a tile.
BLOCK, TILE_BYTES = 2048, 16 << 20


def _shingles(texts: pa.Array | pa.ChunkedArray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text. A text with fewer words than ``width`` has one, of all its words."""
    for _, _, data, offsets in slices(*utf8(texts)):
        words = Words(data, offsets)
        hashes = Hashes(words.hashes(data), WORD_BASE)
        windows = hashes.windows(width)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            if b - a >= width:
                yield np.unique(windows[a : b - width + 1])
            else:
                yield hashes.spans(np.array([a]), np.array([b]))[: b > a]


def _signatures(sets: list[np.ndarray], values: int) -> np.ndarray:
    """MinHash values, one row per (non-empty) set. Each value mixes the shingles with a seed of its own.

    Bands and pruning need independent values; multiples of a step added to a hash are not.
    """
    keys = np.concatenate(sets)
    start = np.append(0, np.cumsum([s.size for s in sets])[:-1])
    seeds = mixed(np.arange(1, values + 1, dtype=U64) * U64(0x5BE0CD19137E2179))
    out = np.empty((len(sets), values), np.uint32)
    for j in range(values):
        out[:, j] = np.minimum.reduceat(mixed(keys ^ seeds[j]), start) >> U64(32)
    return out


def _sketch(width: int, values: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            sets = list(_shingles(part.column(2), width))
            real = [s for s in sets if s.size]
            signed = iter(_signatures(real, values)) if real else iter(())
            columns = [
                part.column(0),
                part.column(1),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if s.size else None for s in sets], pa.binary()),
                pa.array([s.size for s in sets], pa.int32()),
                pa.array([next(signed).tobytes() if s.size else None for s in sets], pa.binary()),
            ]
            yield pa.record_batch(columns, ["doc_id", "doc", "node", "n", "signature"])


def _bands(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """(nodes, one key per node and band) in an order that does not depend on how rows arrived."""
    rows = sorted(zip(table["node"].to_pylist(), table["signature"].to_pylist(), strict=True))
    signed = np.frombuffer(b"".join(s for _, s in rows), np.uint32).reshape(len(rows), -1, ROWS).astype(U64)
    keys = np.broadcast_to(np.arange(signed.shape[1], dtype=U64) + U64(1), signed.shape[:2])
    for k in range(ROWS):
        keys = mixed(keys * U64(0x9E3779B97F4A7C15) + signed[:, :, k])
    return [n for n, _ in rows], keys


def _ask_bands(buckets: int, key, table: pa.Table) -> pa.Table:
    return blocks.ask(key[0].as_py(), *np.unique(_bands(table)[1], return_counts=True), buckets)


def _homes(table: pa.Table, answers: pa.Table) -> pa.Table:
    nodes, keys = _bands(table)
    distinct, place = np.unique(keys, return_inverse=True)
    totals, _ = blocks.answered(answers, distinct.size)
    total = totals[place.reshape(keys.shape)]
    best = np.lexsort((keys, -total.astype(np.int64)), axis=1)[:, 0]  # the largest bucket, then the smallest key
    home = keys[np.arange(len(nodes)), best]
    at, band = np.nonzero(total > 1)
    n = dict(zip(table["node"].to_pylist(), table["n"].to_pylist(), strict=True))
    return pa.Table.from_arrays(
        [pa.array([nodes[i] for i in at.tolist()], pa.binary()), pa.array([n[nodes[i]] for i in at.tolist()], pa.int32()), pa.array(keys[at, band].view(np.int64)), pa.array(total[at, band].astype(np.int64)), pa.array(home[at].view(np.int64))],
        schema=pa.schema([("node", pa.binary()), ("n", pa.int32()), ("band", pa.int64()), ("size", pa.int64()), ("home", pa.int64())]),
    )


def _folded(homes: DataFrame) -> DataFrame:
    """(node, n, band, home), with every home in place of which most classes that moved away went to one other.

    Each class is in as many buckets as there are bands, so the homes folded into one have at most bands / FOLDED times
    its classes. Two classes that share a bucket still do so under any names of their homes.
    """
    shares = homes.groupBy("band", "home").agg(F.count("*").alias("n"), F.first("size").alias("size"))
    shares = write_through(shares, "shares", homes.count())
    own = shares.select(F.col("home").alias("of")).distinct()
    moved = shares.filter("band != home").join(own, F.col("band") == F.col("of"), "left_semi").filter(F.col("n") >= FOLDED * F.col("size"))
    into = write_through(moved.groupBy("band").agg(F.max(F.struct("n", "home"))["home"].alias("into")), "folded", shares.count())
    once = into.select(F.col("band").alias("home"), F.col("into").alias("first"))
    twice = into.select(F.col("band").alias("first"), F.col("into").alias("second"))
    target = once.join(twice, "first", "left").select("home", F.coalesce("second", "first").alias("target"))
    return homes.join(target, "home", "left").select("node", "n", "band", F.coalesce("target", "home").alias("home"))


def least_matches(values: int, threshold: float, tolerance: float) -> list[int]:
    """For each number n of values compared: the fewest agreements at which a pair may still reach the threshold."""
    out = []
    for n in range(values + 1):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out.append(m)
    return out


def lost_at(threshold: float, least: list[int], step: int = 16) -> float:
    """The probability that a pair of exactly this similarity is dropped at one of the looks of _pairs_left."""
    agreed, lost = np.zeros(len(least)), 0.0
    agreed[0] = 1.0
    for n in range(1, len(least)):
        agreed[1:] = agreed[1:] * (1 - threshold) + agreed[:-1] * threshold
        agreed[0] *= 1 - threshold
        if n % step == 0 or n == len(least) - 1:
            lost += agreed[: least[n]].sum()
            agreed[: least[n]] = 0
    return lost


def pruning_rule(values: int, threshold: float, tolerance: float) -> list[int]:
    """The fewest agreements by number of values, with which all looks together lose at most ``tolerance``."""
    share = tolerance
    while lost_at(threshold, least := least_matches(values, threshold, share)) > tolerance:
        share /= 2
    return least


def _pairs_left(a: np.ndarray, b: np.ndarray, least: list[int], step: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (row of a, row of b) that no look at their values drops."""
    agree = np.zeros((len(a), len(b)), np.uint8)
    for j in range(step):
        agree += a[:, None, j] == b[None, :, j]
    x, y = np.nonzero(agree >= least[step])
    m = agree[x, y].astype(np.int32)
    for n in range(step, a.shape[1], step):
        m += (a[x, n : n + step] == b[y, n : n + step]).sum(1)
        keep = m >= least[min(n + step, a.shape[1])]
        x, y, m = x[keep], y[keep], m[keep]
    return x, y


def _tiles(table: pa.Table) -> Iterator[tuple[tuple, pa.Table]]:
    """The tiles of a group; in each, rows in the order of side and node."""
    table = table.sort_by([("tile", "ascending"), ("side", "ascending"), ("node", "ascending")]).combine_chunks()
    names = table["tile"].to_numpy(zero_copy_only=False)
    bounds = [*np.flatnonzero(np.append(True, names[1:] != names[:-1])).tolist(), len(names)]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield names[a], table.slice(a, b - a)


def _sides(tile: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows to compare with rows, and whether both are the same. Side 0 alone is compared with itself."""
    side = tile["side"].to_numpy()
    own = bool((side == 0).all()) and tile["alone"][0].as_py()
    return np.flatnonzero(side == 0), np.flatnonzero(side == 0 if own else side == 1), own


def _prune(least: list[int], table: pa.Table) -> pa.Table:
    found = []
    for _, tile in _tiles(table):
        signed = np.frombuffer(b"".join(tile["signature"].to_pylist()), np.uint32).reshape(tile.num_rows, -1)
        p, q, own = _sides(tile)
        x, y = _pairs_left(signed[p], signed[q], least)
        if own:
            x, y = x[x < y], y[x < y]
        if x.size:
            found.append(tile.take(np.unique(np.append(p[x], q[y]))).select(["tile", "side", "alone", "node", "n"]))
    empty = table.slice(0, 0).select(["tile", "side", "alone", "node", "n"])
    return pa.concat_tables([empty, *found])


def _common(sets: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sizes of the intersections, sets of p by sets of q."""
    if len(p) * len(q) <= 64:
        return np.array([[np.intersect1d(sets[i], sets[j], assume_unique=True).size for j in q] for i in p]).reshape(len(p), len(q))
    owner = np.repeat(np.arange(len(sets)), [s.size for s in sets])
    _, place, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(n > 1) - 1
    use = n[place] > 1
    owner, place = owner[use], shared[place[use]]
    out, width = np.zeros((len(p), len(q)), np.float32), 4096
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for low in range(0, int(place[-1]) + 1 if place.size else 0, width):
        a, b = np.searchsorted(place, (low, low + width))
        present = np.zeros((len(sets), width), np.float32)
        present[owner[a:b], place[a:b] - low] = 1
        out += present[p] @ present[q].T
    return np.rint(out).astype(np.int64)


def _verify(threshold: float, table: pa.Table) -> pa.Table:
    """Links of each class of each tile, and the class that stands for those it is linked with in the tile."""
    rows = []
    for _, tile in _tiles(table):
        nodes = tile["node"].to_pylist()
        sets = [np.frombuffer(s, U64) for s in tile["shingles"].to_pylist()]
        size = np.array([s.size for s in sets])
        p, q, own = _sides(tile)
        if not len(p) or not len(q):
            continue
        common = _common(sets, p, q)
        union = size[p][:, None] + size[q][None, :] - common
        linked = common >= threshold * union - 1e-9
        if own:
            np.fill_diagonal(linked, False)
        links = np.zeros(len(nodes), np.int64)
        links[p] += linked.sum(1)
        if not own:
            links[q] += linked.sum(0)
        root = np.arange(len(nodes))
        for i in np.flatnonzero(linked.any(1)).tolist():  # joins the trees of a row's links
            trees = np.unique(np.append(root[q[linked[i]]], root[p[i]]))
            root[np.isin(root, trees)] = trees[0]
        rows += [(nodes[i], int(links[i]), nodes[root[i]]) for i in np.flatnonzero(links).tolist()]
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.Table.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], names=["node", "links", "root"])


def _with_sets(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "tile", "side", "alone", "node", "shingles"]
    for batch in batches:
        for a in range(0, batch.num_rows, 64):
            part = batch.slice(a, 64)
            rows = []
            for s, r in zip(_shingles(part.column(0), width), part.drop_columns(["text"]).to_pylist(), strict=True):
                raw = s.tobytes()
                if hashlib.blake2b(raw, digest_size=16).digest() == r["node"]:
                    rows += [(t["part"], t["tile"], t["side"], t["alone"], r["node"], raw) for t in r["tiles"]]
            types = [pa.int32(), pa.string(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component, for edges (node, root).

    In each round a node takes the smallest label among its neighbours, then the label of its label, until none
    changes. Rounds are written to the shared folder.
    """
    edges = write_through(edges, "links")
    both = write_through(edges.filter("node != root").distinct().select(F.explode(F.array(F.struct("node", F.col("root").alias("to")), F.struct(F.col("root").alias("node"), F.col("node").alias("to")))).alias("e")).select("e.*"), "edges", 2 * edges.count())
    n = both.count()
    labels = write_through(both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("label")), "labels", n)
    while True:
        near = both.join(labels.select(F.col("node").alias("to"), "label"), "to").groupBy("node").agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = write_through(lower.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")), "labels", n)
        labels = new.select("node", "label")
        if new.filter("label != was").isEmpty():
            return labels


def _tiled(homes: DataFrame, n_homes: int, chunk: int, group: int) -> DataFrame:
    """(part, tile, side, alone, node): every class in each tile of each of its jobs."""
    met = homes.select("band", F.col("home").alias("other")).distinct()
    job = F.struct(F.least("home", "other").alias("low"), F.greatest("home", "other").alias("high"))
    members = homes.join(met, "band").select("node", "n", job.alias("job"), (F.col("home") > F.col("other")).cast("int").alias("side")).distinct()
    members = write_through(members, "members", n_homes)
    weight = [F.sum(F.when(F.col("side") == i, F.col("n").cast("long") * 8).otherwise(0)).alias(f"w{i}") for i in (0, 1)]
    sizes = members.groupBy("job").agg(F.sum(1 - F.col("side")).alias("n0"), F.sum("side").alias("n1"), *weight)
    alone = F.col("job.low") == F.col("job.high")
    sizes = sizes.filter(F.when(alone, F.col("n0") > 1).otherwise((F.col("n0") > 0) & (F.col("n1") > 0)))
    parts = {f"n{i}": F.greatest(F.ceil(F.col(f"n{i}") / chunk), F.ceil(F.col(f"w{i}") / TILE_BYTES)).cast("int") for i in (0, 1)}
    own = F.pmod(F.xxhash64("node"), F.when(F.col("side") == 0, parts["n0"]).otherwise(parts["n1"])).cast("int")
    facing = F.when(alone, parts["n0"]).otherwise(F.when(F.col("side") == 0, parts["n1"]).otherwise(parts["n0"]))
    rows = members.join(sizes, "job").select("node", "n", "job", "side", alone.alias("alone"), own.alias("own"), F.explode(F.sequence(F.lit(0), facing - 1)).alias("facing"))
    low, high = F.least("own", "facing"), F.greatest("own", "facing")
    same = F.col("alone") & (F.col("own") == F.col("facing"))
    place = F.when(F.col("alone") | (F.col("side") == 0), F.concat_ws(":", F.when(F.col("alone"), low).otherwise(F.col("own")), F.when(F.col("alone"), high).otherwise(F.col("facing")))).otherwise(F.concat_ws(":", "facing", "own"))
    side = F.when(F.col("alone"), (F.col("own") > F.col("facing")).cast("int")).otherwise(F.col("side"))
    tile = F.concat_ws(":", F.col("job.low"), F.col("job.high"), place)
    per_job = F.when(alone, F.col("n0") * parts["n0"]).otherwise(F.col("n0") * parts["n1"] + F.col("n1") * parts["n0"])
    n = sizes.agg(F.coalesce(F.sum(per_job), F.lit(0))).first()[0]
    rows = write_through(rows.select(tile.alias("tile"), side.alias("side"), same.alias("alone"), "node", "n"), "tiles", n)
    groups = 1 + n // group
    return rows.withColumn("part", F.pmod(F.xxhash64("tile"), F.lit(groups)).cast("int"))


def _grouped(docs: DataFrame, doc_id: str, text: str, width: int, threshold: float, bands: int, tolerance: float, chunk: int, group: int) -> tuple[DataFrame, int]:
    """(doc_id, doc, label, n_copies, n_links) and the number of rows; the label of a text without words is null."""
    values = bands * ROWS
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), blocks.document_digest(F.col(doc_id).cast("long"), F.col(text)).alias("doc"), F.col(text).alias("text"))
    sketches = write_through(own.mapInArrow(lambda b: _sketch(width, values, b), _SKETCH), "sketches")
    n_docs = sketches.count()
    classes = write_through(sketches.filter("n > 0").groupBy("node").agg(F.min("doc").alias("doc"), F.count("*").alias("n_copies"), F.first("signature").alias("signature"), F.first("n").alias("n")), "classes", n_docs, TEXTS_A_FILE)
    n = classes.count()
    buckets, n_blocks = 1 + n // (4 * BLOCK), 1 + n // BLOCK
    grouped = classes.select(F.pmod(F.xxhash64("node"), F.lit(n_blocks)).cast("int").alias("block"), "node", "signature", "n").groupBy("block")
    asked = grouped.applyInArrow(lambda key, t: _ask_bands(buckets, key, t), blocks.ASK)
    answers = asked.groupBy("bucket").applyInArrow(blocks.count_keys, blocks.ANSWER)
    homes = write_through(grouped.cogroup(answers.groupBy("block")).applyInArrow(_homes, _HOMES), "homes")

    least = pruning_rule(values, threshold, tolerance)
    tiles = _tiled(_folded(homes), homes.count(), chunk, group).join(classes.select("node", "signature"), "node").select("part", "tile", "side", "alone", "node", "n", "signature")
    left = tiles.groupBy("part").applyInArrow(lambda t: _prune(least, t), "tile string, side int, alone boolean, node binary, n int")
    left = write_through(left, "candidates")
    rows, shingles = left.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups = 1 + max(rows // max(1, group // 8), 8 * shingles // TILE_BYTES)
    place = F.struct(F.pmod(F.xxhash64("tile"), F.lit(groups)).cast("int").alias("part"), "tile", "side", "alone")
    wanted = left.groupBy("node").agg(F.collect_list(place).alias("tiles")).join(classes.select("node", "doc"), "node")
    texts = own.select("doc", "text").join(wanted, "doc").select("text", "node", "tiles").dropDuplicates(["node"])
    sets = texts.mapInArrow(lambda b: _with_sets(width, b), "part int, tile string, side int, alone boolean, node binary, shingles binary")
    verified = write_through(sets.groupBy("part").applyInArrow(lambda t: _verify(threshold, t), "node binary, links long, root binary"), "links")

    links = verified.groupBy("node").agg(F.sum("links").alias("n_links"))
    groups_of = classes.select("node", "n_copies").join(links, "node", "left").join(components(verified), "node", "left")
    groups_of = groups_of.select("node", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("label", "node").alias("label"))
    rows = sketches.select("doc_id", "doc", "node").join(groups_of, "node", "left")
    return rows.select("doc_id", "doc", "label", F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), n_docs


def similar_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8, bands: int = 28, tolerance: float = 1e-6, chunk: int = 512, group: int = 4096) -> DataFrame:
    """Per document: (doc_id, doc, class_id, n_copies, n_links).

    Two texts are linked if the Jaccard similarity of their sets of ``width``-word shingles is at least ``threshold``.
    ``n_copies`` is the number of documents with the same set (this one included), ``n_links`` the number of other
    sets linked with it; ``class_id`` is the smallest id of the connected component. Words are runs of other characters
    than the six ASCII blanks; a text with fewer words than ``width`` has one shingle, of all its words.

    A pair at the threshold misses all bands of four values with probability (1 - threshold**4)**bands, 4e-7 as set,
    and one that meets is dropped at one of the looks of pruning with at most ``tolerance``. ``chunk`` classes a side make a tile, about
    ``group`` rows of tiles a task's share; neither changes the result.

    A null or empty text, or one of blanks, is alike to none, not even to another one: its class is its own id. Rows
    with a repeated id are documents of their own; a class whose ids are all null has a null id. ``doc`` is a digest
    of id and text. Further columns are ignored. An empty table gives none.
    """
    found, n_docs = _grouped(docs, doc_id, text, width, threshold, bands, tolerance, chunk, group)
    rows = write_through(found, "membership", n_docs)
    first = rows.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return rows.join(first, "label", "left").select(
        "doc_id",
        "doc",
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "n_copies",
        "n_links",
    )


def first_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8, bands: int = 28, tolerance: float = 1e-6, chunk: int = 512, group: int = 4096) -> DataFrame:
    """One document of each group: the one with the smallest id (the smallest digest breaks ties, a null id is last).

    Documents without words all stay. Of rows that agree in id and text one stays. For the options and the groups see
    similar_documents.
    """
    found, n_docs = _grouped(docs, doc_id, text, width, threshold, bands, tolerance, chunk, group)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "doc")
    name = F.coalesce(F.hex("label"), F.concat(F.lit("alone:"), F.col("doc")))
    keep = found.groupBy(name.alias("name")).agg(F.min(order).alias("first")).select(F.col("first.doc").alias("doc"))
    whole = docs.select(F.struct("*").alias("row"), blocks.document_digest(F.col(doc_id).cast("long"), F.col(text)).alias("doc"))
    return in_few_files(whole.join(keep, "doc").dropDuplicates(["doc"]).select("row.*"), n_docs, TEXTS_A_FILE)
