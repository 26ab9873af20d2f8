"""Demand-model features over the weekly pricing mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Feature names, in model order.
FEATURES = [
    "category", "sub_category", "store_region", "log_unit_retail", "avg_unit_cost", "avg_competitor_price",
    "min_competitor_price", "max_competitor_price", "competitor_price_ratio", "price_difference",
    "competitor_price_gap_pct", "current_profit_margin_pct", "is_higher_than_competitor", "is_undercut",
    "quantity_lag_1_week", "quantity_lag_4_weeks", "quantity_rolling_avg_4_weeks", "price_change_pct_weekly",
    "price_rolling_avg_4_weeks", "month", "quarter", "week_of_year",
]
CATEGORIES = ["category", "sub_category", "store_region"]
# what price_features makes of a price, all of which rise with it
RISING_WITH_PRICE = [
    "log_unit_retail", "competitor_price_ratio", "price_difference", "competitor_price_gap_pct", "current_profit_margin_pct",
    "is_higher_than_competitor", "is_undercut",
]
TARGET = "log_quantity"
RAW_PRICES = [
    "avg_unit_retail", "avg_unit_cost", "avg_competitor_price", "min_competitor_price", "max_competitor_price",
]

SERIES = ["product_id", "store_key"]
# a row looks back on this many weeks, its own included
FEATURE_WEEKS = 5


def prepare(mart: DataFrame) -> DataFrame:
    """Prices as doubles (unreadable ones NULL) and the week as a date."""
    typed = {c: F.col(c).try_cast("double") for c in RAW_PRICES if c in mart.columns}
    return mart.withColumns({**typed, "sales_week": F.col("sales_week").cast("date")})


def price_features(price: Column) -> dict[str, Column]:
    """Features that follow from a price and the competitor prices of the row.

    Division by zero and the logarithm of zero give NULL. ``is_undercut`` is 1
    when the price is above the lowest competitor price.
    """
    competitor = F.col("avg_competitor_price")
    return {
        "log_unit_retail": F.ln(price),
        "competitor_price_ratio": F.try_divide(price, competitor),
        "price_difference": price - competitor,
        "competitor_price_gap_pct": F.try_divide(price - competitor, competitor),
        "current_profit_margin_pct": F.try_divide(price - F.col("avg_unit_cost"), price),
        "is_higher_than_competitor": (price > competitor).cast("double"),
        "is_undercut": (price > F.col("min_competitor_price")).cast("double"),
    }


def build_features(prepared: DataFrame) -> DataFrame:
    """All features. One shuffle: every window shares its keys and order, with one row per week."""
    series = Window.partitionBy(*SERIES).orderBy("sales_week")
    last_four = series.rowsBetween(-4, -1)
    price, quantity, week = F.col("avg_unit_retail"), F.col("quantity_sold"), F.col("sales_week")
    return prepared.withColumns(
        {
            **price_features(price),
            "quantity_lag_1_week": F.lag(quantity, 1).over(series),
            "quantity_lag_4_weeks": F.lag(quantity, 4).over(series),
            "price_change_pct_weekly": F.try_divide(price, F.lag(price, 1).over(series)) - 1,
            "quantity_rolling_avg_4_weeks": F.avg(quantity).over(last_four),
            "price_rolling_avg_4_weeks": F.avg(price).over(last_four),
            "month": F.month(week),
            "quarter": F.quarter(week),
            "week_of_year": F.weekofyear(week),
        }
    )


def latest_rows(features: DataFrame) -> DataFrame:
    """Most recent row of each series; reuses the order of the feature windows."""
    following = F.lead("sales_week").over(Window.partitionBy(*SERIES).orderBy("sales_week"))
    return features.withColumn("_next", following).filter(F.col("_next").isNull()).drop("_next")


def training_frame(features: DataFrame) -> DataFrame:
    """Rows with four weeks of history, and the log of the quantity as target."""
    return features.withColumn(TARGET, F.log1p(F.col("quantity_sold").cast("double"))).na.drop(
        subset=["quantity_lag_4_weeks"]
    )


def time_split(df: DataFrame, test_days: int = 28) -> tuple[DataFrame, DataFrame, dt.date]:
    """Rows up to the cutoff, rows after it, and the cutoff: the last week minus ``test_days``."""
    first, last = df.agg(F.min("sales_week"), F.max("sales_week")).first()
    cutoff = None if last is None else last - dt.timedelta(days=test_days)
    if cutoff is None or first > cutoff or test_days <= 0:
        raise ValueError(f"splitting {test_days} days off a history from {first} to {last} leaves an empty side")
    bound = F.lit(cutoff)
    return df.filter(F.col("sales_week") <= bound), df.filter(F.col("sales_week") > bound), cutoff
