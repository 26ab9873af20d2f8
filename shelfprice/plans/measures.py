"""Business measures over the pricing mart and the recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def last_week(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("sales_week") == mart.agg(F.max("sales_week")).scalar())


def weekly_totals(mart: DataFrame) -> DataFrame:
    """Revenue and margin per week."""
    price, cost, quantity = _double("avg_unit_retail"), _double("avg_unit_cost"), F.col("quantity_sold")
    return mart.groupBy("sales_week").agg(
        F.sum(price * quantity).alias("revenue"), F.sum((price - cost) * quantity).alias("margin")
    )


def expected_uplift(recommendations: DataFrame) -> DataFrame:
    """Predicted minus current revenue and margin, absolute and relative, over all products."""
    revenue = F.col("current_price") * F.col("current_weekly_quantity")
    totals = recommendations.agg(
        F.sum(revenue).alias("current_revenue"),
        F.sum(F.col("recommended_price") * F.col("predicted_weekly_quantity")).alias("predicted_revenue"),
        F.sum("current_weekly_margin").alias("current_margin"),
        F.sum("predicted_weekly_margin").alias("predicted_margin"),
    )
    return totals.select(
        "*",
        (F.col("predicted_revenue") - F.col("current_revenue")).alias("revenue_uplift"),
        (F.try_divide("predicted_revenue", "current_revenue") - 1).alias("revenue_uplift_pct"),
        (F.col("predicted_margin") - F.col("current_margin")).alias("margin_uplift"),
        (F.try_divide("predicted_margin", "current_margin") - 1).alias("margin_uplift_pct"),
    )


def priced_above_market(mart: DataFrame) -> DataFrame:
    """Number of products dearer than the mean competitor price in the last week."""
    dearer = F.col("avg_unit_retail") > F.col("avg_competitor_price")
    return last_week(mart).agg(F.count_distinct(F.when(dearer, F.col("product_id"))).alias("products_above_market"))


def price_pairs(mart: DataFrame) -> DataFrame:
    """Own and competitor mean price per product."""
    return mart.groupBy("product_id").agg(
        F.avg(_double("avg_unit_retail")).alias("our_price"),
        F.avg(_double("avg_competitor_price")).alias("competitor_price"),
    )


def competitive_gap_trend(mart: DataFrame) -> DataFrame:
    """Mean relative gap to the competitor price per week."""
    gap = F.try_divide(_double("avg_unit_retail") - _double("avg_competitor_price"), _double("avg_competitor_price"))
    return mart.groupBy("sales_week").agg(F.avg(gap).alias("gap_pct"))


def top_opportunities(recommendations: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` products with the largest expected margin uplift."""
    uplift = F.col("predicted_weekly_margin") - F.col("current_weekly_margin")
    return (
        recommendations.select(
            "product_id",
            "recommended_price",
            uplift.alias("margin_uplift"),
            F.try_divide(uplift, "current_weekly_margin").alias("margin_uplift_pct"),
        )
        .orderBy(F.col("margin_uplift").desc(), "product_id")
        .limit(k)
    )
