"""Boosted trees: splits against a search over all of them, falling features, missing values, wide categories."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfprice.plans import boosting
from shelfprice.plans.boosting import BoostedTrees, Bounds, Tree, best_splits, fit

N = 600


def made(spark, n=N, seed=1):
    """Demand that falls with the price on the whole, with a rise in the middle; missing values that say something."""
    rng = np.random.default_rng(seed)
    price = rng.uniform(1, 10, n)
    other = rng.normal(size=n)
    gone = rng.random(n) < 0.3
    y = 5 - 0.4 * price + 2 * ((price > 4) & (price < 6)) + np.where(gone, 1.5, 0.3 * other) + rng.normal(0, 0.05, n)
    level = [f"l{i % 7}" for i in range(n)]
    y += np.array([i % 7 for i in range(n)]) * 0.2
    data = [(float(p), 2 * float(p) + 1, None if g else float(o), c, float(v)) for p, o, g, c, v in zip(price, other, gone, level, y)]
    return spark.createDataFrame(data, "price double, price_too double, other double, level string, y double")


FEATURES = ["price", "price_too", "other", "level"]


@pytest.fixture(scope="module")
def data(spark):
    return made(spark).cache()


@pytest.fixture(scope="module")
def model(data):
    return fit(data, FEATURES, "y", ["level"], ["price", "price_too"], max_iter=30, step_size=0.2, max_depth=4, min_rows=5, refresh=7)


def grid(spark, n=200):
    rows = [(p, 2 * p + 1, o, c) for o in (None, -1.0, 0.5) for c in ("l0", "l6", "new", None) for p in (0.5 + 10 * i / n for i in range(n))]
    return spark.createDataFrame(rows, "price double, price_too double, other double, level string")


def rises(frame):
    """How often a prediction lies above that of the next lower price."""
    by = {}
    for r in frame.collect():
        by.setdefault((r.other, r.level), []).append((r.price, r.p))
    return sum(b > a for held in by.values() for (_, a), (_, b) in zip(sorted(held), sorted(held)[1:]))


def test_predictions_never_rise_with_the_price(spark, data, model):
    assert rises(model.transform(grid(spark), "p")) == 0
    free = fit(data, FEATURES, "y", ["level"], max_iter=30, step_size=0.2, max_depth=4, min_rows=5)
    assert rises(free.transform(grid(spark), "p")) > 0


def test_the_model_learns_and_survives_saving(spark, data, model, tmp_path):
    error = lambda m: m.transform(data, "p").agg(F.avg(F.abs(F.col("p") - F.col("y")))).first()[0]
    mean = data.agg(F.avg("y")).first()[0]
    assert error(model) < 0.6 * data.agg(F.avg(F.abs(F.col("y") - mean))).first()[0]
    model.save(str(tmp_path / "m"))
    again = BoostedTrees.load(spark, str(tmp_path / "m"))
    assert sorted(again.transform(data, "p").collect()) == sorted(model.transform(data, "p").collect())
    with pytest.raises(Exception):
        BoostedTrees.load(spark, str(tmp_path / "none"))


def test_missing_values_get_a_side_of_their_own(spark):
    rows = [(None, 9.0) if i % 3 == 0 else (float(i), 1.0) for i in range(90)]
    frame = spark.createDataFrame(rows, "x double, y double")
    fitted = fit(frame, ["x"], "y", max_iter=1, step_size=1.0, max_depth=1, min_rows=5)
    got = {r.x: r.p for r in fitted.transform(frame, "p").collect()}
    assert math.isclose(got[None], 9.0) and math.isclose(got[1.0], 1.0)


def searched(sums, rows, low, high, falling, min_rows):
    """The gain of the best split of one node, by trying all of them."""
    best = 0.0
    quality = lambda s, k, v: 2 * s * v - k * v * v
    total, n = sums[0].sum(), rows[0].sum()
    whole = quality(total, n, min(max(total / n, low), high))
    for f in range(len(sums)):
        for side in (False, True):
            for last in range(1, sums.shape[1]):
                s = sums[f, 1 : last + 1].sum() + side * sums[f, 0]
                k = rows[f, 1 : last + 1].sum() + side * rows[f, 0]
                if k < min_rows or n - k < min_rows:
                    continue
                left, right = min(max(s / k, low), high), min(max((total - s) / (n - k), low), high)
                if falling[f] and left < right:
                    continue
                best = max(best, quality(s, k, left) + quality(total - s, n - k, right) - whole)
    return best


def test_splits_equal_a_search_over_all():
    rng = np.random.default_rng(3)
    for case in range(40):
        nodes, features, bins, per = 3, 4, 6, 50
        sums, rows = np.zeros((nodes, features, bins)), np.zeros((nodes, features, bins))
        for node in range(nodes):
            residual = rng.normal(size=per)
            for f in range(features):
                b = rng.integers(0, bins, per)
                sums[node, f], rows[node, f] = np.bincount(b, residual, bins), np.bincount(b, minlength=bins)
        bounds = Bounds(np.array([-np.inf, -0.1, 0.0]), np.array([np.inf, 0.1, 0.05]))
        falling = rng.random(features) < 0.5
        got = best_splits(sums, rows, bounds, falling, 3)
        for node in range(nodes):
            want = searched(sums[node], rows[node], bounds.low[node], bounds.high[node], falling, 3)
            assert math.isclose(got["gain"][node], want, abs_tol=1e-9), case
            if want and falling[got["feature"][node]]:
                assert got["left"][node] >= got["right"][node]


def test_a_tree_sends_rows_to_its_leaves():
    tree = Tree.empty(2)
    tree.feature[[0, 1]] = [0, 1]
    tree.last_left[[0, 1]] = [2, 1]
    tree.missing_left[0] = True
    bins = np.array([[0, 1, 2, 3, 0], [1, 2, 0, 1, 0]], np.uint8)
    assert tree.nodes(bins).tolist() == [3, 4, 4, 2, 4]


def test_categories_of_any_width(spark):
    """100,000 levels: histograms stay at the bins of a number, and levels that sell more are told from the others."""
    wide = spark.range(300_000, numPartitions=8).select(
        F.concat(F.lit("c"), F.col("id") % 100_000).alias("level"),
        (F.col("id") % 50).cast("double").alias("x"),
        (F.when(F.col("id") % 100_000 < 50_000, 3.0).otherwise(1.0) + (F.col("id") % 7) / 100).alias("y"),
    )
    fitted = fit(wide, ["x", "level"], "y", ["level"], max_iter=3, step_size=0.9, max_depth=2)
    assert max(c.size for c in fitted.cuts) <= 62
    probe = spark.createDataFrame([("c7", 0.0), ("c99999", 0.0), ("unseen", 0.0)], "level string, x double")
    got = {r.level: r.p for r in fitted.transform(probe, "p").collect()}
    assert got["c7"] > 2.7 and got["c99999"] < 1.3 and 0.5 < got["unseen"] < 3.5


def test_sums_of_many_tasks_and_renewed_layers(data, model, monkeypatch):
    monkeypatch.setattr(boosting, "SHARES", 2)
    again = fit(data, FEATURES, "y", ["level"], ["price", "price_too"], max_iter=5, step_size=0.2, max_depth=4, min_rows=5, refresh=2)
    for a, b in zip(again.trees, model.trees):
        assert a.feature.tolist() == b.feature.tolist() and np.allclose(a.value, b.value)


def test_no_rows_and_constant_targets(spark, data):
    none = fit(data.limit(0), FEATURES, "y", ["level"], max_iter=3)
    assert [r.p for r in none.transform(data.limit(2), "p").collect()] == [None, None]
    flat = data.withColumn("y", F.lit(2.0))
    fitted = fit(flat, FEATURES, "y", ["level"], max_iter=9)
    assert len(fitted.trees) == 1
    assert all(math.isclose(r.p, 2.0) for r in fitted.transform(flat.limit(3), "p").collect())
