"""Boosted regression trees with monotone features, from histograms that Spark adds up.

Inputs are cut into bins once; bin 0 holds what is missing. For each level of a tree, tasks sum residuals and rows by
node, feature and bin, and only these sums come to the driver, as many whatever the number of rows. A split sends
missing values to the side that fits better. On a falling feature a split is refused when its right side would be above
its left one; of the others, the middle between the two sides bounds everything below them. Predictions therefore never
rise with any of the falling features, nor with several that rise together.

A category is the mean target of its level, drawn to the mean of all rows where the level has few, and is then cut into
bins like a number: however many levels there are, bins and histograms stay the same. A level that training has not
seen is missing.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.sources.staging import delete, shared_dir, write_layer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows in a block, which is one row of the binned layer.
BLOCK_ROWS = 1 << 16
#: Partial sums that come to the driver at once.
SHARES = 64
#: Rows of the mean of all by which the mean of a level is drawn to it.
SMOOTHING = 10.0
_BLOCK = "bins binary, target binary, fitted binary"
_SUMS = "task int, sums binary"


@dataclass
class Tree:
    """A complete binary tree in an array: the children of node i are 2 i + 1 and 2 i + 2. A leaf has feature -1."""

    feature: np.ndarray
    last_left: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = (2 << depth) - 1
        return Tree(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, bool), np.zeros(n))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node at which each column of ``bins`` (features x rows) ends."""
        node, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        for _ in range(self.feature.size.bit_length() - 1):
            feature = self.feature[node]
            own = bins[feature, rows]
            left = np.where(own == 0, self.missing_left[node], own <= self.last_left[node])
            node = np.where(feature < 0, node, 2 * node + 2 - left)
        return node


def _blocks(features: int, cuts: Sequence[np.ndarray], base: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(a, BLOCK_ROWS)
            bins = binned([part.column(i) for i in range(features)], cuts)
            target = part.column(features).to_numpy(zero_copy_only=False).astype(np.float64)
            row = [[bins.tobytes()], [target.tobytes()], [np.full(target.size, base).tobytes()]]
            yield pa.record_batch([pa.array(c, pa.binary()) for c in row], ["bins", "target", "fitted"])


def binned(columns: Sequence[pa.Array], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of all columns (features x rows): 0 for a missing value, else one more than the cuts below it."""
    out = np.empty((len(columns), len(columns[0])), np.uint8)
    for i, (column, cut) in enumerate(zip(columns, cuts, strict=True)):
        x = column.to_numpy(zero_copy_only=False).astype(np.float64)
        out[i] = np.where(np.isnan(x), 0, 1 + np.searchsorted(cut, x, side="left"))
    return out


def _opened(batch: pa.RecordBatch, features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for bins, target, fitted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        yield np.frombuffer(bins, np.uint8).reshape(features, -1), np.frombuffer(target), np.frombuffer(fitted)


def added(bins: np.ndarray, fitted: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    """The predictions after these trees, added one by one, as in scoring."""
    for tree in trees:
        fitted = fitted + tree.value[tree.nodes(bins)]
    return fitted


def _histograms(features: int, n_bins: int, trees: Sequence[Tree], tree: Tree, active: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of residuals and rows by active node, feature and bin, over all blocks of the task."""
    place = np.full(tree.feature.size, -1)
    place[active] = np.arange(active.size)
    size = active.size * n_bins
    sums = np.zeros((2, features, size))
    for batch in batches:
        for bins, target, fitted in _opened(batch, features):
            slot = place[tree.nodes(bins)]
            here = np.flatnonzero(slot >= 0)
            residual = (target - added(bins, fitted, trees))[here]
            offset = slot[here] * n_bins
            for f in range(features):
                key = offset + bins[f, here]
                sums[0, f] += np.bincount(key, residual, size)
                sums[1, f] += np.bincount(key, minlength=size)
    yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["task", "sums"])


def _added_up(table: pa.Table) -> pa.Table:
    table = table.sort_by("task")
    total = np.sum([np.frombuffer(s) for s in table["sums"].to_pylist()], axis=0)
    return pa.table({"task": table["task"].slice(0, 1).cast(pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})


def _refit(features: int, trees: Sequence[Tree], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fitted = [added(bins, f, trees).tobytes() for bins, _, f in _opened(batch, features)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fitted, pa.binary())], ["bins", "target", "fitted"])


@dataclass
class Bounds:
    """What the predictions of the nodes of one level may be."""

    low: np.ndarray
    high: np.ndarray


def best_splits(sums: np.ndarray, rows: np.ndarray, bounds: Bounds, falling: np.ndarray, min_rows: int) -> dict[str, np.ndarray]:
    """The best split of each node, from sums of residuals and rows (nodes x features x bins).

    ``gain`` is 0 where no split is allowed. ``left`` and ``right`` are the values of the sides within the bounds.
    """
    low, high = bounds.low[:, None, None, None], bounds.high[:, None, None, None]
    total, n = sums[:, :1].sum(-1)[..., None, None], rows[:, :1].sum(-1)[..., None, None]

    def value(s: np.ndarray, k: np.ndarray) -> np.ndarray:
        return np.clip(s / np.maximum(k, 1), low, high)

    def quality(s: np.ndarray, k: np.ndarray, v: np.ndarray) -> np.ndarray:
        return 2 * s * v - k * v * v

    # axis 2: whether missing values go left; axis 3: the last bin of the left side
    missing = [x[:, :, None, :1] * np.array([0, 1])[:, None] for x in (sums, rows)]
    s_left, n_left = (np.cumsum(x[:, :, None, 1:], -1) + m for x, m in zip((sums, rows), missing, strict=True))
    s_right, n_right = total - s_left, n - n_left
    left, right = value(s_left, n_left), value(s_right, n_right)
    gain = quality(s_left, n_left, left) + quality(s_right, n_right, right) - quality(total, n, value(total, n))
    allowed = (n_left >= min_rows) & (n_right >= min_rows) & (~falling[:, None, None] | (left >= right))
    gain = np.where(allowed, gain, 0.0)
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(1)
    feature, side, last = np.unravel_index(best, gain.shape[1:])
    at = (np.arange(len(gain)), feature, side, last)
    return {"gain": flat[at[0], best], "feature": feature, "missing_left": side == 1, "last_left": last + 1, "left": left[at], "right": right[at]}


class _Grower:
    """Grows trees on the binned layer, which holds the predictions of all trees but the recent ones."""

    def __init__(self, layer: DataFrame, features: int, n_bins: int, falling: np.ndarray, step: float, depth: int, min_rows: int):
        self.layer, self.features, self.n_bins, self.falling = layer, features, n_bins, falling
        self.step, self.depth, self.min_rows = step, depth, min_rows
        self.tasks = layer.rdd.getNumPartitions()
        self.recent: list[Tree] = []

    def _sums(self, tree: Tree, active: np.ndarray) -> np.ndarray:
        features, n_bins, recent = self.features, self.n_bins, list(self.recent)
        parts = self.layer.mapInArrow(lambda b: _histograms(features, n_bins, recent, tree, active, b), _SUMS)
        if self.tasks > SHARES:
            parts = parts.groupBy(F.pmod("task", F.lit(SHARES))).applyInArrow(_added_up, _SUMS)
        total = np.frombuffer(_added_up(parts.toArrow())["sums"][0].as_py())
        return total.reshape(2, features, active.size, n_bins).transpose(0, 2, 1, 3)

    def grow(self) -> Tree:
        tree = Tree.empty(self.depth)
        active, bounds = np.array([0]), Bounds(np.array([-np.inf]), np.array([np.inf]))
        for _ in range(self.depth):
            sums, rows = self._sums(tree, active)
            if not rows.any():
                break
            if active[0] == 0:
                tree.value[0] = sums[0, 0].sum() / rows[0, 0].sum()
            split = best_splits(sums, rows, bounds, self.falling, self.min_rows)
            good = split["gain"] > 1e-9
            parents = active[good]
            if not parents.size:
                break
            tree.feature[parents], tree.last_left[parents], tree.missing_left[parents] = (split[k][good] for k in ("feature", "last_left", "missing_left"))
            left, right = split["left"][good], split["right"][good]
            tree.value[2 * parents + 1], tree.value[2 * parents + 2] = left, right
            low, high, fall = bounds.low[good], bounds.high[good], self.falling[split["feature"][good]]
            middle = (left + right) / 2
            lows, highs = np.where(fall, np.maximum(low, middle), low), np.where(fall, np.minimum(high, middle), high)
            active = np.stack([2 * parents + 1, 2 * parents + 2], 1).ravel()
            bounds = Bounds(np.stack([lows, low], 1).ravel(), np.stack([high, highs], 1).ravel())
        tree.value *= self.step
        self.recent.append(tree)
        return tree

    def renew(self) -> None:
        """Writes the layer with the predictions of the recent trees, so that no task applies many trees again."""
        features, recent = self.features, list(self.recent)
        path = _layer_path(self.layer.sparkSession)
        self.layer.mapInArrow(lambda b: _refit(features, recent, b), _BLOCK).write.parquet(path)
        self.drop()
        self.layer, self.path, self.recent = self.layer.sparkSession.read.schema(_BLOCK).parquet(path), path, []
        self.tasks = self.layer.rdd.getNumPartitions()

    path: str | None = None

    def drop(self) -> None:
        if self.path:
            delete(self.layer.sparkSession, self.path)


def _layer_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/shelfprice/boosting-{uuid.uuid4().hex}"


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def level_means(rows: DataFrame, category: str, target: str) -> DataFrame:
    """(level, mean) of a category: the mean target of its rows, drawn to the mean of all rows."""
    overall = F.lit(rows.agg(F.avg(target)).first()[0])
    found = rows.groupBy(_text(category).alias("_level")).agg(F.sum(target).alias("_sum"), F.count(target).alias("_n"))
    return found.select("_level", ((F.col("_sum") + SMOOTHING * overall) / (F.col("_n") + SMOOTHING)).alias("_mean"))


@dataclass
class BoostedTrees:
    """A fitted model. ``levels`` holds (category, level, mean); all else is small and of a size set by the options."""

    features: list[str]
    categories: list[str]
    cuts: list[np.ndarray]
    base: float
    trees: list[Tree]
    levels: DataFrame

    def _numbers(self, df: DataFrame) -> DataFrame:
        """``df`` with the model's inputs as columns ``_x0`` and so on."""
        names = {c: f"_x{i}" for i, c in enumerate(self.features)}
        out = df.withColumns({x: F.col(c).cast("double") for c, x in names.items() if c not in self.categories})
        for c in self.categories:
            own = self.levels.filter(F.col("category") == c).select(F.col("level").alias("_level"), F.col("mean").alias(names[c]))
            out = out.withColumn("_level", _text(c)).join(own, "_level", "left").drop("_level")
        return out

    def transform(self, df: DataFrame, prediction: str) -> DataFrame:
        """``df`` with the model's prediction. Missing inputs and unknown levels go where training sent them."""
        # plain arrays: what is broadcast is not pickled by value
        arrays = [(t.feature, t.last_left, t.missing_left, t.value) for t in self.trees]
        shared = df.sparkSession.sparkContext.broadcast((self.cuts, self.base, arrays))

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cuts, base, arrays = shared.value
            trees = [Tree(*a) for a in arrays]
            for batch in batches:
                inputs = [batch.column(batch.num_columns - len(cuts) + i) for i in range(len(cuts))]
                bins = binned(inputs, cuts)
                kept = batch.columns[: batch.num_columns - len(cuts)]
                out = added(bins, np.full(bins.shape[1], base), trees)
                yield pa.record_batch([*kept, pa.array(out, from_pandas=True)], [*batch.schema.names[: len(kept)], prediction])

        own = df.drop(prediction)
        schema = own.withColumn(prediction, F.lit(None).cast("double")).schema
        inputs = [f"_x{i}" for i in range(len(self.features))]
        return self._numbers(own).select(*own.columns, *inputs).mapInArrow(predict, schema)

    def save(self, path: str) -> None:
        spark = self.levels.sparkSession
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")
        cuts = [(i, f, f in self.categories, c.tolist()) for i, (f, c) in enumerate(zip(self.features, self.cuts, strict=True))]
        spark.createDataFrame(cuts, "place int, feature string, category boolean, cuts array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/cuts")
        trees = [(i, t.feature.tolist(), t.last_left.tolist(), t.missing_left.tolist(), t.value.tolist()) for i, t in enumerate(self.trees)]
        schema = "place int, feature array<int>, last_left array<int>, missing_left array<boolean>, value array<double>"
        spark.createDataFrame([(-1, [], [], [], [self.base]), *trees], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        cuts = spark.read.parquet(f"{path}/cuts").orderBy("place").collect()
        base, *trees = spark.read.parquet(f"{path}/trees").orderBy("place").collect()
        return BoostedTrees(
            [r.feature for r in cuts],
            [r.feature for r in cuts if r.category],
            [np.array(r.cuts, np.float64) for r in cuts],
            base.value[0],
            [Tree(np.array(t.feature, np.int32), np.array(t.last_left, np.int32), np.array(t.missing_left, bool), np.array(t.value)) for t in trees],
            spark.read.parquet(f"{path}/levels"),
        )


def fit(
    rows: DataFrame,
    features: Sequence[str],
    target: str,
    categories: Sequence[str] = (),
    falling: Sequence[str] = (),
    max_iter: int = 500,
    step_size: float = 0.05,
    max_depth: int = 6,
    max_bins: int = 64,
    min_rows: int = 20,
    refresh: int = 25,
) -> BoostedTrees:
    """Trees that predict ``target`` and never rise with a ``falling`` feature.

    ``rows`` should be a scan: it is read a few times. Rows without a target are left out; without any row the model
    has no prediction. ``max_bins`` counts the bin of missing values and is at most 256; cuts are approximate quantiles.
    A side of a split has ``min_rows`` rows at least. After ``refresh`` trees the layer is written anew with their
    predictions, so that what a task repeats stays bounded, also when it has to be run again.
    """
    if not 3 <= max_bins <= 256:
        raise ValueError("max_bins lies between 3 and 256")
    spark, features, categories = rows.sparkSession, list(features), [c for c in features if c in set(categories)]
    rows = rows.filter(F.col(target).isNotNull())
    found = [level_means(rows, c, target).select(F.lit(c).alias("category"), F.col("_level").alias("level"), F.col("_mean").alias("mean")) for c in categories]
    levels = spark.createDataFrame([], "category string, level string, mean double")
    for frame in found:
        levels = levels.unionByName(frame)
    model = BoostedTrees(features, categories, [], 0.0, [], write_layer(levels, "levels"))
    inputs = [f"_x{i}" for i in range(len(features))]
    numbers = write_layer(model._numbers(rows).select(*inputs, F.col(target).cast("double").alias("_target")), "inputs")
    shares = [i / (max_bins - 1) for i in range(1, max_bins - 1)]
    quantiles = numbers.approxQuantile(inputs, shares, 1 / (8 * max_bins))
    model.cuts = [np.unique(np.array(q, np.float64)) for q in quantiles]
    base = numbers.agg(F.avg("_target")).first()[0]
    model.base = float("nan") if base is None else base
    if base is None:
        return model
    cuts, n = model.cuts, len(features)
    tasks = max(spark.sparkContext.defaultParallelism, numbers.rdd.getNumPartitions())
    layer = write_layer(numbers.repartition(tasks).mapInArrow(lambda b: _blocks(n, cuts, base, b), _BLOCK), "binned")
    grower = _Grower(layer, n, max_bins, np.isin(features, list(falling)), step_size, max_depth, min_rows)
    for i in range(max_iter):
        tree = grower.grow()
        model.trees.append(tree)
        if tree.feature[0] < 0:  # nothing is left to split: further trees would be the same
            break
        if (i + 1) % refresh == 0 and i + 1 < max_iter:
            grower.renew()
    grower.drop()
    return model
