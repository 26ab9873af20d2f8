"""Statistics of whole documents, for rules and classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.llm.packed import BASE, BYTE_VALUE, SPACE, U64, WORD_BASE, Hashes, Words, mixed, slices, utf8
from shelfprice.sources.staging import shared_dir

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks", "n_letters"]


def _set(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL = _set(SYMBOLS)
_UPPER = _set(bytes(range(65, 91)))
_DIGIT = _set(bytes(range(48, 58)))
_LETTER = _set(bytes([*range(65, 91), *range(97, 123), *range(0xC2, 0xF5)]))
_CHAR = ~SPACE & ~_set(bytes(range(0x80, 0xC0)))
_MARK = _set(bytes(range(33, 127))) & ~_DIGIT & ~_LETTER & ~_SYMBOL


def _again(keys: np.ndarray) -> np.ndarray:
    """Whether a key stands further ahead too."""
    out = np.ones(keys.size, bool)
    out[np.unique(keys, return_index=True)[1]] = False
    return out


def _stats(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    docs = offsets.size - 1

    def per_doc(inside: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(inside))[offsets])

    hashes = Hashes(BYTE_VALUE[data], BASE)
    words = Words(data, offsets)
    word = hashes.spans(words.start, words.end)
    own = mixed(np.arange(docs, dtype=U64) + U64(1))

    start = words.windows(3)
    repeated = np.zeros(words.doc.size, bool)
    if start.size:
        keys = Hashes(word, WORD_BASE).windows(3)[start] + own[words.doc[start]]
        _, place, n = np.unique(keys, return_inverse=True, return_counts=True)
        at = start[n[place] > 1]
        for k in range(3):
            repeated[at + k] = True

    breaks = np.flatnonzero(data == 10)
    begin = np.union1d(offsets[:-1], breaks + 1)
    begin = begin[begin < data.size]
    end = np.append(begin[1:], data.size)[: begin.size]
    line_doc = np.searchsorted(offsets, begin, side="right") - 1
    end = end - (data[end - 1] == 10) if begin.size else end
    text = np.append(0, np.cumsum(~SPACE[data]))
    real = text[end] > text[begin]
    begin, end, line_doc = begin[real], end[real], line_doc[real]
    again = _again(hashes.spans(begin, end) + own[line_doc])

    count = lambda doc: np.bincount(doc, minlength=docs)
    return [
        np.diff(words.first),
        per_doc(_CHAR[data]),
        per_doc(_SYMBOL[data]),
        count(line_doc[again]),
        count(words.doc[repeated]),
        count(line_doc),
        count(words.doc[~_again(word + own[words.doc])]),
        per_doc(_UPPER[data]),
        per_doc(_DIGIT[data]),
        per_doc(_MARK[data]),
        per_doc(_LETTER[data]),
    ]


def text_stats(column: pa.Array | pa.ChunkedArray) -> dict[str, np.ndarray]:
    """Every statistic of every text."""
    parts = [_stats(part, own) for _, _, part, own in slices(*utf8(column))]
    return {name: np.concatenate([np.zeros(0, np.int64), *(p[i] for p in parts)]).astype(np.int64) for i, name in enumerate(STATS)}


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        stats = text_stats(b.column(1))
        yield pa.record_batch([b.column(0), *(pa.array(stats[n], pa.int64()) for n in STATS)], ["doc_id", *STATS])


def document_stats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id and its statistics.

    Words are runs of other characters than the six ASCII blanks; ``word_chars`` their code points; ``n_symbols`` the
    characters of ``#*$%&|<>``; lines are separated by a line feed and count if they have a word; ``n_dup_lines`` are
    equal to an earlier line; ``n_repeat_words`` lie in a window of three words that the text has more than once.
    ``n_upper`` and ``n_digits`` are ASCII, ``n_marks`` other ASCII marks than symbols, ``n_letters`` ASCII letters
    and code points beyond ASCII. A null text has 0 everywhere. Further columns are ignored.
    """
    schema = "doc_id long, " + ", ".join(f"{n} long" for n in STATS)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_batches, schema)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows from the folder that all executors share."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def hashed_share(share: Column | float, *columns: str) -> Column:
    """Whether a row's hash of these columns falls into this share of all hashes."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 31)) < F.lit(1 << 31) * share


def bounded_sample(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, the first by a hash of all columns; ``rows`` are read twice.

    A share of the hashes that holds about twice as many is taken first, so that tasks do not each send ``most`` rows.
    """
    share = min(1.0, 2 * most / max(1, rows.count()))
    return rows.filter(hashed_share(share, *rows.columns)).orderBy(F.xxhash64(*rows.columns), *rows.columns).limit(most)
