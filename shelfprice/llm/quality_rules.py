"""Quality rules learned as a decision list by sequential covering.

Rules for the documents to reject are learned one after the other: a rule grows by the threshold condition with the
largest information gain, is pruned on rows it has not seen, and takes the rows it covers away. The list is emitted
as one Spark conditional expression over the columns of document statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfprice.llm.doc_stats import STATS, bounded_sample, checkpointed, document_stats, text_stats

#: Shares that conditions may test: numerator and denominator, both statistics.
SHARES = {
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "mark_share": ("n_marks", "word_chars"),
    "letter_share": ("n_letters", "word_chars"),
    "word_length": ("word_chars", "n_words"),
    "line_words": ("n_words", "n_lines"),
}


def share(name: str, at: str = "") -> Column:
    above, below = SHARES[name]
    return F.col(at + above) / F.greatest(F.col(at + below), F.lit(1))


def measured(stats: dict[str, np.ndarray]) -> np.ndarray:
    """The shares of every document, one column each."""
    return np.stack([stats[a] / np.maximum(stats[b], 1) for a, b in SHARES.values()], axis=1)


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, list(SHARES).index(self.name)]
        return v >= self.threshold if self.above else v <= self.threshold

    def column(self, at: str = "") -> Column:
        return share(self.name, at) >= self.threshold if self.above else share(self.name, at) <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<='} {self.threshold:g}"


def _holds(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([c.holds(x) for c in rule]) if rule else np.ones(len(x), bool)


@dataclass
class DecisionList:
    """Rules in order; a document that meets one is rejected, one that meets none is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rejects(self, x: np.ndarray) -> np.ndarray:
        return np.logical_or.reduce([_holds(r, x) for r in self.rules]) if self.rules else np.zeros(len(x), bool)

    def kept(self, at: str = "") -> Column:
        """The list as a conditional expression; ``at`` stands before the names of the statistics."""
        verdict = None
        for rule in self.rules:
            met = rule[0].column(at)
            for c in rule[1:]:
                met = met & c.column(at)
            verdict = F.when(met, F.lit(False)) if verdict is None else verdict.when(met, F.lit(False))
        return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))


def _grow(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray], longest: int) -> list[Condition]:
    rule: list[Condition] = []
    names = list(SHARES)
    covered = np.ones(len(x), bool)
    while len(rule) < longest and (~bad[covered]).any():
        p0, n0 = bad[covered].sum(), (~bad[covered]).sum()
        best, gain = None, 1e-9
        for j, name in enumerate(names):
            v = x[covered, j]
            place = np.searchsorted(cuts[j], v, side="right")  # cuts up to this one lie at or below the value
            p = np.bincount(place, weights=bad[covered], minlength=cuts[j].size + 1)
            n = np.bincount(place, weights=~bad[covered], minlength=cuts[j].size + 1)
            below = np.searchsorted(cuts[j], v, side="left")
            q = np.bincount(below, weights=bad[covered], minlength=cuts[j].size + 1)
            m = np.bincount(below, weights=~bad[covered], minlength=cuts[j].size + 1)
            for above, ps, ns in ((True, p[::-1].cumsum()[::-1][1:], n[::-1].cumsum()[::-1][1:]), (False, q.cumsum()[:-1], m.cumsum()[:-1])):
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - np.log2(p0 / (p0 + n0))), -1)
                if g.size and g.max() > gain:
                    k = int(g.argmax())
                    best, gain = Condition(name, above, float(cuts[j][k])), g[k]
        if best is None:
            break
        rule.append(best)
        covered &= best.holds(x)
    return rule


def _prune(rule: list[Condition], x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    def worth(r: list[Condition]) -> float:
        met = _holds(r, x)
        p, n = bad[met].sum(), (~bad[met]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)


def learn_rules(x: np.ndarray, bad: np.ndarray, *, precision: float = 0.98, support: int = 5, most_rules: int = 32, longest: int = 4, thresholds: int = 200) -> DecisionList:
    """A list that rejects the rows marked bad. x has the shares as columns.

    A rule must reject at least ``support`` bad rows, and bad rows must be ``precision`` of what it rejects, in the
    rows it grew on and in all rows left. Thresholds are quantiles of the shares. Rows are split two to one, by their
    place, into rows to grow and rows to prune on.
    """
    found = DecisionList()
    if not len(x):
        return found
    cuts = [np.unique(np.quantile(np.unique(x[:, j]), np.linspace(0, 1, thresholds))) for j in range(x.shape[1])]
    left, grown = np.ones(len(x), bool), np.arange(len(x)) % 3 != 2
    while len(found.rules) < most_rules and (bad & left & grown).sum() >= support:
        rule = _grow(x[left & grown], bad[left & grown], cuts, longest)
        if not rule:
            break
        rule = _prune(rule, x[left & ~grown], bad[left & ~grown]) if (left & ~grown).any() else rule
        met = _holds(rule, x) & left
        if bad[met].sum() < support or bad[met].mean() < precision:
            break
        found.rules.append(rule)
        left &= ~met
    return found


def rules_from_labels(stats: DataFrame, labels: DataFrame, *, sample: int = 50_000) -> DecisionList:
    """Learns from at most ``sample`` labelled documents, the first by a hash; ``labels``: (doc_id, label)."""
    marked = labels.filter(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    known = checkpointed(stats.join(marked, "doc_id").select("doc_id", "label", *STATS))
    rows = bounded_sample(known, sample).toArrow()
    return learn_rules(measured({n: rows[n].to_numpy() for n in STATS}), rows["label"].to_numpy() == 0)


def base_failed(at: str = "") -> Column:
    n_words, n_repeat = F.col(f"{at}n_words"), F.col(f"{at}n_repeat_words")
    return (n_words < 50) | (100 * n_repeat > 50 * n_words)


def verdict(rules: DecisionList, at: str = "") -> Column:
    return F.when(base_failed(at), F.lit(False)).otherwise(rules.kept(at))


def _learned(stats: DataFrame, labels: DataFrame, doc_id: str, label: str) -> DecisionList:
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    return rules_from_labels(stats.filter(~base_failed()), known)


def judge(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Per document: its statistics, whether it fails the base rule, and whether it is kept.

    A document fails the base rule with fewer than 50 words, or if more than half of its words lie in repeated windows
    of three. Others are kept unless a learned rule rejects them. Labels other than 0 and 1 and null ids teach nothing;
    of several labels of one id the largest counts; without labels no rule is learned. Rows that repeat an id are
    documents of their own. A null or empty text has 0 words and fails. Further columns are ignored. An empty table
    gives none.
    """
    stats = checkpointed(document_stats(docs, doc_id=doc_id, text=text))
    rules = _learned(stats, labels, doc_id, label)
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", verdict(rules))


def _with_stats(column: str, name: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        stats = text_stats(b.column(b.schema.get_field_index(column)))
        packed = pa.StructArray.from_arrays([pa.array(stats[n], pa.int64()) for n in STATS], names=STATS)
        yield pa.RecordBatch.from_arrays([*b.columns, packed], names=[*b.schema.names, name])


def kept_documents(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The documents that ``judge`` keeps, with all columns."""
    rules = _learned(document_stats(docs, doc_id=doc_id, text=text), labels, doc_id, label)
    name = "statistics"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    schema = StructType([*docs.schema.fields, StructField(name, StructType([StructField(n, LongType()) for n in STATS]))])
    return docs.mapInArrow(lambda b: _with_stats(text, name, b), schema).filter(verdict(rules, f"{name}.")).drop(name)
