"""Constrained price recommendations, their roll-ups and the batch jobs around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfprice.operators.series import price_points
from shelfprice.plans.demand import (
    PREDICTION,
    Predictor,
    TrainResult,
    load_model,
    model_predictor,
    save_model,
    train,
)
from shelfprice.plans.features import FEATURE_WEEKS, SERIES, build_features, latest_rows, prepare, price_features
from shelfprice.sources.files import read_table, write_table
from shelfprice.sources.staging import shuffles_dropped

# Defaults of the optimizer.
MIN_MARGIN_PCT = 0.10
MAX_GAP_PCT = 0.05
N_CANDIDATES = 50
FALLBACK_GAP_PCT = 0.15


def price_band(rows: DataFrame, min_margin_pct: float = MIN_MARGIN_PCT, max_gap_pct: float = MAX_GAP_PCT) -> DataFrame:
    """Adds ``price_low`` and ``price_high``.

    The band is the competitor price plus or minus the gap, or the current
    price plus or minus 15 % when no competitor price is known, and never
    starts below cost plus the minimum margin. When that floor lies above the
    band, the band shrinks to one percent above it and ``band_violated`` is set.
    """
    competitor = F.nullif(F.col("avg_competitor_price"), F.lit(0.0))
    anchor = F.coalesce(competitor, F.col("avg_unit_retail"))
    gap = F.when(competitor.isNotNull(), F.lit(max_gap_pct)).otherwise(F.lit(FALLBACK_GAP_PCT))
    low = F.greatest(F.col("avg_unit_cost") * (1 + min_margin_pct), anchor * (1 - gap))
    return (
        rows.withColumn("price_low", low)
        .withColumn("_top", anchor * (1 + gap))
        .withColumn("price_high", F.greatest(F.col("price_low") * 1.01, "_top"))
        .withColumn("band_violated", F.col("price_high") > F.col("_top"))
        .drop("_top")
    )


def candidates(
    rows: DataFrame,
    predict: Predictor,
    min_margin_pct: float = MIN_MARGIN_PCT,
    max_gap_pct: float = MAX_GAP_PCT,
    n_candidates: int = N_CANDIDATES,
) -> DataFrame:
    """Every candidate price of every row with its predicted quantity and margin.

    Predicted demand is made non-increasing in price by a running minimum, the
    monotone guarantee a plain tree ensemble lacks. A window holds the
    ``n_candidates`` rows of one series.
    """
    banded = price_band(rows, min_margin_pct, max_gap_pct).withColumn("_current_margin", F.col("current_profit_margin_pct"))
    grid = price_points(banded, F.col("price_low"), F.col("price_high"), n_candidates, "candidate_price")
    scored = predict(grid.withColumns(price_features(F.col("candidate_price"))))
    cheaper = Window.partitionBy(*SERIES).orderBy("candidate_price").rowsBetween(Window.unboundedPreceding, 0)
    quantity = F.greatest(F.expm1(PREDICTION), F.lit(0.0))
    return scored.withColumn("predicted_quantity", F.min(quantity).over(cheaper)).withColumn(
        "predicted_margin", F.col("predicted_quantity") * (F.col("candidate_price") - F.col("avg_unit_cost"))
    )


def recommend(rows: DataFrame, predict: Predictor, days_ahead: int = 1, **limits) -> DataFrame:
    """Best candidate per product and store; of equal margins the lowest price."""
    carried = ["store_id", "category", "sales_week", "avg_unit_retail", "quantity_sold", "_current_margin", "band_violated"]
    rank = F.struct(
        F.col("predicted_margin").alias("margin"),
        (-F.col("candidate_price")).alias("minus_price"),
        F.col("predicted_quantity").alias("quantity"),
    )
    best = candidates(rows, predict, **limits).groupBy(*SERIES, *carried).agg(F.max(rank).alias("best"))
    return best.select(
        "product_id",
        "store_key",
        "store_id",
        "category",
        F.date_add("sales_week", days_ahead).alias("target_sales_week"),
        F.col("avg_unit_retail").alias("current_price"),
        F.col("quantity_sold").alias("current_weekly_quantity"),
        F.col("_current_margin").alias("current_weekly_margin"),
        (-F.col("best.minus_price")).alias("recommended_price"),
        F.col("best.quantity").alias("predicted_weekly_quantity"),
        F.col("best.margin").alias("predicted_weekly_margin"),
        "band_violated",
    )


def _whole(c: str) -> Column:
    """Rounded to a whole number, halves to even."""
    return F.bround(F.col(c), 0).cast("bigint").alias(c)


def rounded(recommendations: DataFrame) -> DataFrame:
    results = ("recommended_price", "predicted_weekly_quantity", "predicted_weekly_margin")
    return recommendations.select(*[_whole(c) if c in results else c for c in recommendations.columns])


def roll_up(recommendations: DataFrame, *keys: str) -> DataFrame:
    """Recommendations per ``keys``: mean prices, total quantities and margins."""
    return (
        recommendations.groupBy(*keys)
        .agg(
            F.avg("current_price").alias("current_price"),
            F.sum("current_weekly_quantity").alias("current_weekly_quantity"),
            F.avg("current_weekly_margin").alias("_margin_pct"),
            F.avg("recommended_price").alias("recommended_price"),
            F.sum("predicted_weekly_quantity").alias("predicted_weekly_quantity"),
            F.sum("predicted_weekly_margin").alias("predicted_weekly_margin"),
        )
        .withColumn("_amount", F.col("current_weekly_quantity") * F.col("current_price") * F.col("_margin_pct"))
        .select(
            *keys,
            "current_price",
            "current_weekly_quantity",
            F.bround("_amount", 0).cast("bigint").alias("current_weekly_margin"),
            "recommended_price",
            "predicted_weekly_quantity",
            "predicted_weekly_margin",
        )
    )


def score(
    mart: DataFrame,
    predict: Predictor,
    product_ids: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    **limits,
) -> DataFrame:
    """Recommendations per product and store, from the latest row of each series.

    A product or category filter is applied before the features, so only the
    history of those series is read; lags are the same as in a full run.
    """
    rows = mart
    if product_ids is not None:
        rows = rows.filter(F.col("product_id").isin([str(p) for p in product_ids]))
    if categories is not None:
        rows = rows.filter(F.col("category").isin(list(categories)))
    return rounded(recommend(latest_rows(build_features(prepare(rows))), predict, **limits))


def train_and_save(spark: SparkSession, mart_path: str, model_path: str, **estimator) -> TrainResult:
    """Batch training job: read the mart, fit, save the model."""
    result = train(build_features(prepare(read_table(spark, mart_path))), **estimator)
    save_model(result.model, model_path)
    return result


def write_mart(mart: DataFrame, path: str) -> None:
    """The dense mart with a folder for each week, so that a reader of the last weeks opens those alone.

    Rows are dealt by week into tasks of like size: a week gets few files, however large it is.
    """
    with shuffles_dropped(mart.sparkSession):
        mart.hint("rebalance", F.col("sales_week")).write.mode("overwrite").partitionBy("sales_week").parquet(path)


def recent_weeks(mart: DataFrame) -> DataFrame:
    """The weeks of a dense mart that the features of its last week look at.

    The last week is read first and used as a literal, which prunes the folders of a mart laid out by week.
    """
    last = mart.agg(F.max(F.col("sales_week").cast("date"))).first()[0]
    return mart if last is None else mart.filter(F.col("sales_week") >= F.date_sub(F.lit(last), 7 * (FEATURE_WEEKS - 1)))


def score_all(spark: SparkSession, mart_path: str, model_path: str, output_path: str, **limits) -> DataFrame:
    """Batch scoring job: recommendations per product and target week, written as Parquet.

    A mart has every series in every week, so only the last weeks are read.
    """
    predict = model_predictor(load_model(spark, model_path))
    mart = recent_weeks(read_table(spark, mart_path))
    result = roll_up(score(mart, predict, **limits), "product_id", "target_sales_week")
    write_table(result, output_path)
    return read_table(spark, output_path)


def predict_products(
    spark: SparkSession, mart_path: str, model_path: str, product_ids: Sequence[str], **limits
) -> DataFrame:
    """On-demand scoring of some products, rolled up per product."""
    predict = model_predictor(load_model(spark, model_path))
    return roll_up(score(recent_weeks(read_table(spark, mart_path)), predict, product_ids, **limits), "product_id")
