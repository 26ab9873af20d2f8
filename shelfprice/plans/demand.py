"""Demand models: they add ``predicted_log_quantity`` to a frame of features."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.operators.series import price_points
from shelfprice.plans.boosting import BoostedTrees, fit
from shelfprice.plans.features import CATEGORIES, FEATURES, RISING_WITH_PRICE, SERIES, TARGET, time_split, training_frame
from shelfprice.sources.staging import write_layer

PREDICTION = "predicted_log_quantity"
Predictor = Callable[[DataFrame], DataFrame]


def naive_elasticity(df: DataFrame) -> DataFrame:
    """Least-squares slope of log quantity on log price, as a one-row frame."""
    return df.agg(F.regr_slope(TARGET, "log_unit_retail").alias("elasticity"))


def constant_elasticity(elasticity: float | Column) -> Predictor:
    """Demand that scales the recent quantity by ``(price / current price) ** elasticity``.

    The elasticity is one number or an expression over the row. A row without
    a price has no prediction.
    """
    power = elasticity if isinstance(elasticity, Column) else F.lit(float(elasticity))

    def predict(df: DataFrame) -> DataFrame:
        recent = F.log1p(F.col("quantity_rolling_avg_4_weeks"))
        moved = F.col("log_unit_retail") - F.ln(F.col("avg_unit_retail"))
        return df.withColumn(PREDICTION, recent + power * moved)

    return predict


def mean_absolute_error(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(F.abs(F.col(TARGET) - F.col(PREDICTION))).alias("mae"), F.count(F.lit(1)).alias("n_rows"))


def model_predictor(model: BoostedTrees) -> Predictor:
    """Scores with a fitted model; only the prediction is added."""
    return lambda df: model.transform(df, PREDICTION)


@dataclass
class TrainResult:
    model: BoostedTrees
    train_mae: float
    test_mae: float
    naive_elasticity: float


def train(features: DataFrame, test_days: int = 28, **options) -> TrainResult:
    """Fit on all but the last ``test_days`` days and measure both sides.

    The demand model is boosted trees (see ``boosting.fit`` for the options)
    whose prediction never rises with the price, nor with the features that
    rise with it. The training frame is written through once: fitting reads it
    several times, and a lost executor must not send it back to the raw tables.
    """
    rows = write_layer(training_frame(features).select("sales_week", TARGET, *FEATURES), "training")
    train_rows, test_rows, _ = time_split(rows, test_days)
    model = fit(train_rows, FEATURES, TARGET, CATEGORIES, RISING_WITH_PRICE, **options)
    predict = model_predictor(model)
    return TrainResult(
        model=model,
        train_mae=mean_absolute_error(predict(train_rows)).first()["mae"],
        test_mae=mean_absolute_error(predict(test_rows)).first()["mae"],
        naive_elasticity=naive_elasticity(train_rows).first()["elasticity"],
    )


def save_model(model: BoostedTrees, path: str) -> None:
    model.save(path)


def load_model(spark: SparkSession, path: str) -> BoostedTrees:
    """A saved model. A missing one is an error: scoring never trains on its own."""
    return BoostedTrees.load(spark, path)


def implied_elasticity(
    rows: DataFrame, predict: Predictor, low: float = 0.9, high: float = 1.1, n_points: int = 20
) -> DataFrame:
    """Slope of the prediction over log price per series, on a grid around the current price; NULL without a price."""
    price = F.col("avg_unit_retail")
    grid = price_points(rows, price * low, price * high, n_points, "_price")
    scored = predict(grid.withColumn("log_unit_retail", F.ln("_price")))
    return scored.groupBy(*SERIES).agg(F.regr_slope(PREDICTION, "log_unit_retail").alias("implied_elasticity"))
