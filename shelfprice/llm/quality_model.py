"""Quality scores by regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfprice.llm.doc_stats import STATS, checkpointed, document_stats
from shelfprice.llm.lm_score import in_fold

FEATURES = 10


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Statistics as shares and logarithms, whose distributions are closer to normal. One row per document."""
    s = {k: v.astype(np.float64) for k, v in stats.items()}
    words, chars, lines = (np.maximum(s[k], 1) for k in ("n_words", "word_chars", "n_lines"))

    def share(n: str, of: np.ndarray) -> np.ndarray:
        return np.log(s[n] / of + 0.01)

    return np.stack([
        np.log1p(s["n_words"]),
        np.log(chars / words),
        share("n_symbols", chars),
        share("n_dup_lines", lines),
        share("n_repeat_words", words),
        share("n_upper", chars),
        share("n_digits", chars),
        share("n_marks", chars),
        np.log(words / lines),
        s["n_distinct_words"] / words,
    ], axis=1)


@dataclass
class QuadraticDiscriminant:
    """Two normal distributions over standardised features, held by the Cholesky factors of their precisions.

    white: of each class, the matrix that makes its features uncorrelated with variance 1.
    """

    mean: np.ndarray
    scale: np.ndarray
    centre: list[np.ndarray]
    white: list[np.ndarray]
    constant: list[float]

    @classmethod
    def fit(cls, n: np.ndarray, sums: np.ndarray, products: np.ndarray, shrinkage: float, ridge: float) -> QuadraticDiscriminant:
        """From each class's number of rows, sums of features and sums of their products."""
        d = sums.shape[1]
        mean = sums.sum(0) / n.sum()
        scale = np.sqrt(np.maximum(np.diag(products.sum(0)) / n.sum() - mean**2, 1e-6))
        covariance, centre = [], []
        for k in range(2):
            m = sums[k] / n[k]
            covariance.append((products[k] / n[k] - np.outer(m, m)) / np.outer(scale, scale))
            centre.append((m - mean) / scale)
        pooled = sum(c * w for c, w in zip(covariance, n / n.sum(), strict=True))
        white, constant = [], []
        for k in range(2):
            s = (1 - shrinkage) * covariance[k] + shrinkage * pooled + ridge * np.eye(d)
            root = np.linalg.cholesky(s)
            white.append(np.linalg.inv(root))
            constant.append(float(np.log(n[k] / n.sum()) - np.log(np.diag(root)).sum()))
        return cls(mean, scale, centre, white, constant)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        z = (x - self.mean) / self.scale
        density = [c - 0.5 * (((z - m) @ w.T) ** 2).sum(1) for m, w, c in zip(self.centre, self.white, self.constant, strict=True)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums, products = np.zeros(2), np.zeros((2, FEATURES)), np.zeros((2, FEATURES, FEATURES))
    for b in batches:
        x = features({name: b.column(name).to_numpy() for name in STATS})
        label = b.column("label").to_numpy()
        for k in range(2):
            own = x[label == k]
            n[k] += len(own)
            sums[k] += own.sum(0)
            products[k] += own.T @ own
    flat = np.concatenate([n, sums.ravel(), products.ravel()])
    yield pa.record_batch([pa.array(np.arange(flat.size), pa.int32()), pa.array(flat)], ["place", "value"])


def fit_quality(stats: DataFrame, labels: DataFrame, *, shrinkage: float = 0.1, ridge: float = 0.02) -> QuadraticDiscriminant | None:
    """Learns from all rows of ``stats`` with a label; ``labels`` has (doc_id, label 0 or 1). None without both classes."""
    marked = labels.filter(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = stats.join(marked, "doc_id").mapInArrow(_moments, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    flat = np.zeros(2 + 2 * FEATURES + 2 * FEATURES**2)
    for r in rows.collect():
        flat[r.place] = r.value
    n, sums, products = flat[:2], flat[2 : 2 + 2 * FEATURES].reshape(2, -1), flat[2 + 2 * FEATURES :].reshape(2, FEATURES, FEATURES)
    return QuadraticDiscriminant.fit(n, sums, products, shrinkage, ridge) if n.min() > 0 else None


def _scored(model: QuadraticDiscriminant | None, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = features({name: b.column(name).to_numpy() for name in STATS})
        score = model.score(x) if model else np.full(len(x), 0.5)
        yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])


def score_quality(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """Per document: whether it is held out, the probability of label 1, and whether that reaches ``threshold``.

    Learns from the labelled documents whose CRC-32 of the id's text modulo ``folds`` is not 0. Only statistics of
    the text enter a score. Labels other than 0 and 1 and null ids teach nothing; of several labels of one id the
    largest counts; rows that repeat an id are documents of their own. A null text is empty and is scored like every
    other text. Without both labels every score is 0.5. Further columns are ignored. An empty table gives none.
    """
    stats = checkpointed(document_stats(docs, doc_id=doc_id, text=text).withColumn("held_out", in_fold(F.col("doc_id"), folds, 0)))
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    model = fit_quality(stats.filter("not held_out"), known)
    return stats.mapInArrow(lambda b: _scored(model, threshold, b), "doc_id long, held_out boolean, score double, predicted int")
