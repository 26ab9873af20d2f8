"""Weekly marts on a dense grid with carried-forward prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.functions import UNMATCHED, UNMATCHED_INT, price_fallback, week_start
from shelfprice.operators.joins import every_pair, lookup_join
from shelfprice.operators.series import fill_weeks, week_arrays
from shelfprice.plans.dims import PRODUCT_ATTRIBUTES, STORE_ATTRIBUTES, active_products, active_stores
from shelfprice.sources.staging import write_layer

_SALES = ["avg_unit_retail", "avg_unit_cost"]
_COUNTS = ["total_quantity_sold", "total_transactions"]
_COMPETITOR = ["avg_competitor_price", "min_competitor_price", "max_competitor_price"]


def _matched_sales(fact: DataFrame) -> DataFrame:
    # full_date came from the date dimension when the fact was built: no second join
    known = (F.col("product_key") != UNMATCHED) & (F.col("store_key") != UNMATCHED)
    return fact.filter(known & (F.col("date_key") != UNMATCHED_INT))


def weekly_sales(fact: DataFrame, *keys: str) -> DataFrame:
    """Sales per ``keys`` and week: mean price and cost, quantity, distinct transactions."""
    return (
        _matched_sales(fact)
        .groupBy(*keys, week_start(F.col("full_date")).alias("sales_week"))
        .agg(
            F.avg("unit_retail").alias("avg_unit_retail"),
            F.avg("unit_cost").alias("avg_unit_cost"),
            F.sum("quantity").alias("total_quantity_sold"),
            F.count_distinct("transaction_id").alias("total_transactions"),
        )
    )


def weekly_competitor(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Competitor prices per product and week: mean, lowest, highest."""
    known = fact.filter(F.col("product_key") != UNMATCHED)
    rows = lookup_join(known, dates.select("date_key", "full_date"), ["date_key"], "inner")
    return rows.groupBy("product_key", week_start(F.col("full_date")).alias("sales_week")).agg(
        F.avg("competitor_price").alias("avg_competitor_price"),
        F.min("competitor_price").alias("min_competitor_price"),
        F.max("competitor_price").alias("max_competitor_price"),
    )


def _weekly_mart(
    members: DataFrame,
    keys: list[str],
    attributes: list[Column],
    sales: DataFrame,
    competitor: DataFrame,
    products: DataFrame,
    last_weeks: int | None,
) -> DataFrame:
    sales = write_layer(sales, "weekly-sales")
    low, high = sales.agg(F.min("sales_week"), F.max("sales_week")).first()
    low, high = F.lit(low).cast("date"), F.lit(high).cast("date")
    shown = low if last_weeks is None else F.greatest(low, F.date_sub(high, 7 * (last_weeks - 1)))

    # competitor prices have no store: they are carried once per product, whose weeks go to the ranges of every store
    market = fill_weeks(products.select("product_key"), competitor, ["product_key"], _COMPETITOR, [], low, high, shown_from=shown)
    market = write_layer(week_arrays(market, ["product_key"], _COMPETITOR), "weekly-market")
    filled = fill_weeks(members, sales, keys, _SALES, _COUNTS, low, high, shown_from=shown, by_week=market)

    retail = F.col("avg_unit_retail")
    return filled.select(
        "product_id",
        "sales_week",
        *PRODUCT_ATTRIBUTES[1:],
        *attributes,
        *[price_fallback(F.col(c)).alias(c) for c in _SALES],
        *[price_fallback(F.col(c), retail).alias(c) for c in _COMPETITOR],
        F.col("total_quantity_sold").alias("quantity_sold"),
        "total_transactions",
    )


def pricing_mart(
    sales_fact: DataFrame,
    competitor_fact: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    dates: DataFrame,
    last_weeks: int | None = None,
) -> DataFrame:
    """Product x store x week: own and competitor prices carried forward, sales of the week.

    With ``last_weeks``, only that many weeks at the end, with the same values.
    """
    keys = ["product_key", "store_key"]
    current = active_products(products)
    members = every_pair(current, active_stores(stores))
    attributes = [F.col(c) for c in ("store_key", *STORE_ATTRIBUTES)]
    sales = weekly_sales(sales_fact, *keys)
    return _weekly_mart(members, keys, attributes, sales, weekly_competitor(competitor_fact, dates), current, last_weeks)


def product_week_mart(
    sales_fact: DataFrame, competitor_fact: DataFrame, products: DataFrame, dates: DataFrame
) -> DataFrame:
    """Product x week, all stores together."""
    current = active_products(products)
    sales = weekly_sales(sales_fact, "product_key")
    return _weekly_mart(current, ["product_key"], [], sales, weekly_competitor(competitor_fact, dates), current, None)
