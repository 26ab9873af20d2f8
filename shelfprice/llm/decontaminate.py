"""Benchmark decontamination: test items found in documents with a bounded number of edits.

An item may occur with up to k edits, a fixed share of its length. Cut into k + 1 pieces, at least one piece of it
then stands unchanged in the document (pigeonhole). An Aho-Corasick automaton finds the pieces in one pass over a
text; around each hit, Myers' bit-parallel algorithm gives the edit distance of the whole item.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HITS = "doc_id long, item_id long, distance int, start long, end long"


def normalised(text: str) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join(text.lower().split())


def original_places(text: str) -> np.ndarray:
    """For each character of the normalised text, its place in the text."""
    places, blank = [], False
    for i, c in enumerate(text):
        if c.isspace():
            blank = True
            continue
        if blank and places:
            places.append(i - 1)
        blank = False
        places += [i] * len(c.lower())
    return np.array(places, np.int64)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item in ``edits`` + 1 parts of nearly equal length, with their places."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _distances(item: str, text: str, anchored: bool) -> Iterator[int]:
    """After each character of the text: the smallest number of edits from the item to a string that ends there.

    The string starts anywhere, or at the text's start if anchored. One bit stands for one character of the item.
    """
    size = len(item)
    full, top = (1 << size) - 1, 1 << (size - 1)
    where: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        where[c] |= 1 << i
    more, less, score = full, 0, size
    for c in text:
        same = where.get(c, 0)
        down = same | less
        across = (((same & more) + more) ^ more) | same
        up = less | ~(across | more) & full
        fall = more & across
        score += bool(up & top) - bool(fall & top)
        up = (up << 1 | anchored) & full
        fall = fall << 1 & full
        more = fall | ~(down | up) & full
        less = up & down
        yield score


def best_match(item: str, text: str) -> tuple[int, int, int]:
    """(edits, start, end) of the string in the text that is nearest to the item; the first end, then the shortest."""
    edits, end = len(item), 0
    for j, d in enumerate(_distances(item, text, False), 1):
        if d < edits:
            edits, end = d, j
    if not end:
        return edits, 0, 0
    for j, d in enumerate(_distances(item[::-1], text[:end][::-1], True), 1):
        if d == edits:
            return edits, end - j, end
    return edits, 0, end


@dataclass
class Items:
    """Distinct normalised items with their ids."""

    ids: dict[str, list[int | None]]
    rate: float

    def edits(self, item: str) -> int:
        return int(len(item) * self.rate)

    def automaton(self):
        import ahocorasick

        found: dict[str, list[tuple[str, int]]] = defaultdict(list)
        for item in self.ids:
            for at, piece in pieces(item, self.edits(item)):
                found[piece].append((item, at))
        machine = ahocorasick.Automaton()
        for piece, uses in found.items():
            machine.add_word(piece, (len(piece), uses))
        machine.make_automaton()
        return machine

    def matches(self, machine, text: str) -> dict[str, tuple[int, int, int]]:
        """Of each item in the (normalised) text: edits, start and end of its nearest occurrence."""
        best: dict[str, tuple[int, int, int]] = {}
        tried: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for last, (size, uses) in machine.iter(text):
            for item, at in uses:
                if best.get(item, (1,))[0] == 0:
                    continue
                k, start = self.edits(item), last + 1 - size - at
                low, high = max(0, start - k), start + len(item) + k
                if any(a <= low and high <= b for a, b in tried[item][-1:]):
                    continue
                if text.startswith(item, start) if start >= 0 else False:
                    best[item] = (0, start, start + len(item))
                    continue
                reach = high + 2 * k  # the next pieces of the same occurrence fall into this stretch
                low = max(0, low - 2 * k)
                tried[item].append((low, reach))
                d, a, b = best_match(item, text[low:reach])
                if d <= k and d < best.get(item, (k + 1,))[0]:
                    best[item] = (d, low + a, low + b)
        return best


def _blocks(items: DataFrame, item_id: str, text: str, rate: float, block_bytes: int) -> Iterator[Items]:
    """The items in blocks of about this many bytes, by a hash of their text."""
    own = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).filter("text is not null")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for block in range(n):
        ids: dict[str, list[int | None]] = defaultdict(list)
        for r in own.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == block).toLocalIterator():
            if item := normalised(r.text):
                ids[item].append(r.item_id)
        if ids:
            yield Items(dict(ids), rate)


def _find(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    items = Items(*shared.value)
    machine = items.automaton()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text and (found := items.matches(machine, normalised(text))):
                places = original_places(text)
                for item, (d, a, b) in found.items():
                    rows += [(doc_id, i, d, int(places[a]), int(places[b - 1]) + 1) for i in items.ids[item]]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "item_id", "distance", "start", "end"])


def find_items(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = 0.05, block_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, item_id, distance, start, end): the nearest occurrence of each item in each document that has it.

    Both sides in lower case with runs of white space as one space; an item may occur with up to ``rate`` times its
    length edits (an item of under 1 / ``rate`` characters only unchanged). Places are code points of the document,
    end exclusive. Of equally near occurrences, the one met first counts.

    Items are taken to the tasks in blocks of about ``block_bytes``, each in a pass over the documents. Null and empty
    texts of either side match nothing; equal items are reported each with its id; rows with a null or repeated id are
    documents of their own. Further columns are ignored. Empty tables give none.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = spark.createDataFrame([], HITS)
    for block in _blocks(items, item_id, item_text, rate, block_bytes):
        shared = spark.sparkContext.broadcast((block.ids, block.rate))
        found = found.unionByName(own.mapInArrow(lambda b, shared=shared: _find(shared, b), HITS))
    return found


def _clean(shared, column: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    items = Items(*shared.value)
    machine = items.automaton()
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
        yield batch.filter(pa.array([not (t and items.matches(machine, normalised(t))) for t in texts], pa.bool_()))


def without_items(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = 0.05, block_bytes: int = 4 << 20) -> DataFrame:
    """The documents, with all columns, in which no item occurs; see find_items."""
    for block in _blocks(items, item_id, item_text, rate, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast((block.ids, block.rate))
        docs = docs.mapInArrow(lambda b, shared=shared: _clean(shared, text, b), docs.schema)
    return docs
