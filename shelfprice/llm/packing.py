"""Packing of token sequences by best-fit decreasing.

A document's tokens are cut into full windows and a rest. The rests (and the full windows, which fill a window each)
are dealt evenly to tasks; a task takes them in large groups, longest first, and puts each into the open window with
the smallest sufficient room. A segment tree over the room that is left finds that window.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long"


#: Characters of words that are encoded in bulk: for these, letters and lower case have never changed.
_PLAIN = re.compile("[!-~\u00c0-\u012f\u0131-\u024f]+")
#: The tokenizer's pattern of pieces (a fixed value).
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_END = "\0"


def _byte_of() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, those from 256 on for the other bytes in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Bulk:
    """The vocabulary's merges over whole lists of words.

    A piece ends with a zero byte in place of the vocabulary's word end, and a merge has the rank of its result, so
    the merges happen in the same order. Tokens that end a piece tell where its ids end.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab, suffix, byte = model["model"]["vocab"], model["model"]["end_of_word_suffix"], _byte_of()
        special = self.added = sorted({t["content"] for t in model["added_tokens"]})
        ranks = {}
        self.ends = np.zeros(max(vocab.values()) + 2, bool)
        for token, i in vocab.items():
            if token not in special:
                end = token.endswith(suffix)
                self.ends[i] = end
                ranks[bytes(byte[c] for c in token.removesuffix(suffix)) + (b"\0" if end else b"")] = i
        self.merges = tiktoken.Encoding("pieces", pat_str=f"[^{_END}]+{_END}", mergeable_ranks=ranks, special_tokens={})

    def __call__(self, words: list[str]) -> list[bytes]:
        marked = _PIECE.sub(r"\g<0>" + _END, " ".join(words).lower())
        n = np.cumsum([w.count(_END) for w in marked.split(" ")])
        ids = np.array(self.merges.encode_ordinary(marked.replace(" ", "")), "<u4")
        bounds = [0, *(np.flatnonzero(self.ends[ids])[n - 1] + 1).tolist()]
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class _Encoder:
    """Token ids of texts as little-endian bytes.

    The tokenizer joins nothing across an ASCII blank and looks at lower case only, so texts are encoded word by word
    and the ids of up to ``most`` different words are remembered. Words of other than Latin characters are left to
    the tokenizer itself, and so are whole texts that hold one of its added tokens, which it looks for as they stand.
    """

    def __init__(self, path: str, most: int):
        self.plain, self.tokenizer, self.bulk, self.most, self.known = Tokenizer.from_file(path), Tokenizer.from_file(path), _Bulk(path), most, {}
        self.tokenizer.encode_special_tokens = True  # a lower-case word is never an added token
        self.added = re.compile("|".join(map(re.escape, self.bulk.added)) or "(?!)")

    def _learn(self, words: set[bytes]) -> None:
        plain, other = [], []
        for w in words:
            text = w.decode()
            (plain if _PLAIN.fullmatch(text) else other).append((w, text))
        for group, encode in ((plain, self.bulk), (other, self._one_by_one)):
            for i in range(0, len(group), 10_000):
                keys, texts = zip(*group[i : i + 10_000], strict=True)
                self.known.update(zip(keys, encode(list(texts)), strict=True))

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def __call__(self, texts: Iterable[str | None]) -> list[bytes]:
        texts = list(texts)
        whole = {i: np.array(self.plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for i, t in enumerate(texts) if t and self.added.search(t)}
        split = [[] if i in whole else (t or "").encode().lower().split() for i, t in enumerate(texts)]
        missing = set().union(*split).difference(self.known)
        if len(self.known) + len(missing) > self.most:
            self.known, missing = {}, set().union(*split)
        self._learn(missing)
        ids = self.known.__getitem__
        return [whole[i] if i in whole else b"".join(map(ids, words)) for i, words in enumerate(split)]


def _pieces(path: str, end_id: int, window: int, known_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    encode, end, step = _Encoder(path, known_words), np.array([end_id], "<u4").tobytes(), 4 * window
    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            part = batch.slice(a, 512)
            out = []
            for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                ids += end
                out += [(doc_id, s // 4, len(p) // 4, zlib.crc32(p), len(ids) // 4) for s in range(0, len(ids), step) for p in (ids[s : s + step],)]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])


class OpenWindows:
    """Open windows by the room that is left: leaf r of a binary tree counts those with r tokens of room."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.by_room: dict[int, list[int]] = defaultdict(list)

    def _add(self, room: int, n: int) -> None:
        node, count = self.leaves + room, self.count
        while node:
            count[node] += n
            node >>= 1

    def put(self, room: int, name: int) -> None:
        if room:
            self.by_room[room].append(name)
            self._add(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The tightest window with at least this room: (room, name); it is no longer open."""
        node, count = self.leaves + length, self.count
        while not count[node]:
            while node & 1:  # a right child: what follows lies beyond its parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not count[node]:
                node += 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.by_room[room].pop()


def best_fit(lengths: Iterable[int], window: int) -> tuple[list[int], list[int]]:
    """Window and offset for each length, in the given order (decreasing for the best result)."""
    windows = OpenWindows(window)
    names, offsets, n = [], [], 0
    for length in lengths:
        found = windows.take(length)
        if found is None:
            found, n = (window, n), n + 1
        room, name = found
        names.append(name)
        offsets.append(window - room)
        windows.put(room - length, name)
    return names, offsets


def _pack(window: int, group: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[pa.RecordBatch] = []
    used = 0

    def packed() -> pa.RecordBatch:
        nonlocal used
        t = pa.Table.from_batches(waiting).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]).combine_chunks()
        names, offsets = best_fit(t["length"].to_pylist(), window)
        sequence = np.array(names, np.int64) + used + (TaskContext.get().partitionId() << 36)
        used += max(names) + 1
        return pa.Table.from_arrays([*t.columns, pa.array(sequence), pa.array(offsets, pa.int64())], names=[*t.column_names, "sequence_id", "offset"]).to_batches()[0]

    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= group:
            yield packed()
            waiting = []
    if sum(b.num_rows for b in waiting):
        yield packed()


def pack(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, window: int = 4096, known_words: int = 400_000, group: int = 200_000) -> DataFrame:
    """Per piece of a document: where it lies in the document and in its sequence of at most ``window`` tokens.

    ``tokenizer`` is the path of a tokenizer file on every machine, for a tokenizer that separates at ASCII blanks.
    A document's tokens are those of its whole text, then ``end_id``. Pieces of a sequence follow each other from
    offset 0 without a gap. A task packs ``group`` pieces at a time; ``known_words`` bounds the words it remembers.

    A null or empty text, or one of blanks, is the end token alone. Rows with a null or repeated id are documents of
    their own. Further columns are ignored. An empty table gives none.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = texts.mapInArrow(lambda b: _pieces(tokenizer, end_id, window, known_words, b), PIECES)
    return pieces.hint("rebalance").mapInArrow(lambda b: _pack(window, group, b), PACKED)
