"""Language identification with string kernels.

The kernel of two texts is the number of n-grams (n from 1 to 3, blended) that both have, over the geometric mean of
their numbers: the blended-spectrum presence kernel. Landmark texts span the space (Nyström), in which kernel ridge
regression learns one score per language against the rest. n-grams are over 64 classes of bytes (blank and marks,
the 26 letters whatever their case, 37 classes of bytes beyond ASCII), so there are at most 64 + 64**2 + 64**3.
Texts are scored in batches as two matrix products: presence by landmarks, kernel by weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfprice.llm.doc_stats import hashed_share
from shelfprice.llm.lm_score import in_fold
from shelfprice.llm.packed import slices, utf8

SPACE_SIZE = 64 + 64**2 + 64**3
CLASS = np.zeros(256, np.int32)
CLASS[65:91] = CLASS[97:123] = np.arange(1, 27)
CLASS[128:] = 27 + np.arange(128) % 37
UNKNOWN = "und"


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, n-gram) of every position and length; n-grams of blanks only are left out."""
    c = CLASS[data]
    doc = np.repeat(np.arange(offsets.size - 1, dtype=np.int32), np.diff(offsets))
    docs, codes = [], []
    code, first = np.zeros(data.size, np.int32), 0
    for n in (1, 2, 3):
        size = data.size - n + 1
        if size <= 0:
            break
        code = code[:size] * 64 + c[n - 1 : n - 1 + size]
        real = (doc[:size] == doc[n - 1 : n - 1 + size]) & (code > 0)
        docs.append(doc[:size][real])
        codes.append(code[real] + first)
        first += 64**n
    empty = np.zeros(0, np.int32)
    return np.concatenate([empty, *docs]), np.concatenate([empty, *codes])


def _gram_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        sets = [np.unique(_grams(data[a:b], np.array([0, b - a]))[1]).astype(np.int32).tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], ["lang", "grams"])


@dataclass
class KernelModel:
    """languages; place: of an n-gram among those of the landmarks (or -1); landmarks: presence of their n-grams, each
    landmark divided by the root of its number; weights: from kernel values to one score per language."""

    languages: list[str]
    place: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray

    def _kernel(self, presence: np.ndarray) -> np.ndarray:
        n = np.sqrt(np.maximum(presence.sum(1, keepdims=True), 1))
        return presence @ self.landmarks / n

    @classmethod
    def fit(cls, languages: list[str], label: np.ndarray, sets: list[np.ndarray], per_language: int, ridge: float) -> KernelModel:
        """From n-gram sets of texts and the place of their language. The first texts of each language are landmarks."""
        chosen = np.concatenate([np.flatnonzero(label == k)[:per_language] for k in range(len(languages))])
        used = np.unique(np.concatenate([sets[i] for i in chosen]))
        place = np.full(SPACE_SIZE, -1, np.int32)
        place[used] = np.arange(used.size)
        landmarks = np.zeros((used.size, chosen.size), np.float32)
        for j, i in enumerate(chosen):
            landmarks[place[sets[i]], j] = 1 / np.sqrt(max(len(sets[i]), 1))
        model = cls(languages, place, landmarks, np.zeros(0))
        kernel = np.concatenate([model._kernel(model._presence([sets[i] for i in range(a, min(a + 256, len(sets)))])) for a in range(0, len(sets), 256)]).astype(np.float64)
        values, vectors = np.linalg.eigh(kernel[chosen])
        keep = values > 1e-4 * values.max()
        root = vectors[:, keep] / np.sqrt(values[keep])  # kernel values to Nyström features
        x = kernel @ root
        y = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
        balance = 1 / np.bincount(label, minlength=len(languages))[label]  # every language weighs the same
        solved = np.linalg.solve((x * balance[:, None]).T @ x + ridge * np.eye(x.shape[1]), (x * balance[:, None]).T @ y)
        model.weights = (root @ solved).astype(np.float32)
        return model

    def _presence(self, sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), self.landmarks.shape[0]), np.float32)
        for row, s in zip(out, sets, strict=True):
            at = self.place[s]
            row[at[at >= 0]] = 1
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row per text, one column per language."""
        out = np.zeros((offsets.size - 1, len(self.languages)), np.float32)
        for a, _, part, own in slices(data, offsets, most=1 << 18):
            for i in range(0, own.size - 1, 256):
                some = own[i : i + 257]
                doc, code = _grams(part[some[0] : some[-1]], some - some[0])
                at = self.place[code]
                presence = np.zeros((some.size - 1, self.landmarks.shape[0]), np.float32)
                presence[doc[at >= 0], at[at >= 0]] = 1
                out[a + i : a + i + some.size - 1] = self._kernel(presence) @ self.weights
        return out


def fit_languages(train: DataFrame, *, landmarks: int = 32, sample: int = 400, ridge: float = 1e-3) -> KernelModel | None:
    """Learns from ``train`` (doc_id, lang, text), all with a language.

    Of each language the first ``sample`` documents by a hash teach, and the first ``landmarks`` of these
    are landmarks: a bounded sample, of which only the sets of n-grams reach the driver, with one count per language.
    """
    counts = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    if not counts:
        return None
    # about twice the sample by hash, of which the first are taken: tasks do not each send a whole sample
    shares = F.create_map(*(F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, 2 * sample / n))))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text")
    some = train.filter(hashed_share(shares[F.col("lang")], "doc_id", "text"))
    rows = some.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= sample).select("lang", "text")
    got = sorted(((r.lang, bytes(r.grams)) for r in rows.mapInArrow(_gram_sets, "lang string, grams binary").collect()), key=lambda r: (r[0], zlib.crc32(r[1]), r[1]))
    sets = [np.frombuffer(g, np.int32) for _, g in got]
    usable = [i for i, s in enumerate(sets) if s.size]
    if not usable:
        return None
    languages = sorted({got[i][0] for i in usable})
    label = np.array([languages.index(got[i][0]) for i in usable])
    return KernelModel.fit(languages, label, [sets[i] for i in usable], landmarks, ridge)


def _predict(model: KernelModel | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        known = np.array([any(c.isalpha() for c in t or "") for t in batch.column(2).to_pylist()], bool)
        best, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
        if model:
            scores = model.scores(data, offsets)
            winner = scores.argmax(1)
            best = [model.languages[w] if k else UNKNOWN for w, k in zip(winner, known, strict=True)]
            score = np.where(known, np.clip((scores.max(1) + 1) / 2, 0, 1), 0).astype(np.float64)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(best, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])


def identify_languages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, held_out: int = 1, **fit) -> DataFrame:
    """Per document: whether it is held out, the language predicted from its whole text, and a score from 0 to 1.

    Learns from documents with a language whose CRC-32 of the id's text modulo ``folds`` is not ``held_out``. A text
    that is null or has no letter is ``und`` with score 0, as is every text if there is nothing to learn from. A null
    id's text is empty; rows that repeat an id are documents of their own. Further columns are ignored. An empty table
    gives none. ``fit``: see fit_languages.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    out = in_fold(F.col("doc_id"), folds, held_out)
    model = fit_languages(own.filter(~out & F.col("lang").isNotNull() & F.col("text").isNotNull()), **fit)
    rows = own.select("doc_id", out.alias("held_out"), "text")
    return rows.mapInArrow(lambda b: _predict(model, b), "doc_id long, held_out boolean, lang_pred string, score double")
