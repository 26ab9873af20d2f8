"""Dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfprice.functions import UNMATCHED

PRODUCT_ATTRIBUTES = ["product_id", "product_name", "category", "sub_category"]
STORE_ATTRIBUTES = ["store_id", "store_name", "store_city", "store_region"]

# The member that stands for a missing product.
UNKNOWN_PRODUCT = {
    "product_id": UNMATCHED,
    "product_name": "Unknown / Missing Product",
    "category": "Undefined",
    "sub_category": "Undefined",
    "dbt_scd_id": "placeholder_unknown_product_key_-1",
}
UNKNOWN_SINCE = "1970-01-01"


def first_seen(log: DataFrame, key: str, attributes: Sequence[str], ts: str) -> DataFrame:
    """Members of a dimension with the date each was first seen."""
    return log.groupBy(key, *attributes).agg(F.min(ts).alias("create_at"))


def dim_stores(sales: DataFrame) -> DataFrame:
    return first_seen(sales, "store_key", STORE_ATTRIBUTES, "transaction_date")


def dim_competitors(competitor: DataFrame) -> DataFrame:
    return first_seen(competitor, "competitor_key", ["competitor_name"], "scraped_at")


def dim_expense_type(expenses: DataFrame) -> DataFrame:
    return first_seen(expenses, "expense_type_key", ["expense_type"], "transaction_date")


def dim_products(history: DataFrame) -> DataFrame:
    """Product history plus the unknown member."""
    since = F.lit(UNKNOWN_SINCE).cast("date")
    unknown = history.sparkSession.range(1).select(
        F.lit(UNMATCHED).alias("product_key"),
        *[F.lit(v).alias(c) for c, v in UNKNOWN_PRODUCT.items()],
        *[since.alias(c) for c in ("updated_at", "dbt_updated_at", "dbt_valid_from")],
        F.lit(None).cast("date").alias("dbt_valid_to"),
    )
    return unknown.unionByName(history).select(history.columns)


def active_products(products: DataFrame) -> DataFrame:
    """Current version of every known product."""
    current = products.filter(F.col("dbt_valid_to").isNull() & (F.col("product_key") != UNMATCHED))
    return current.select("product_key", *PRODUCT_ATTRIBUTES)


def active_stores(stores: DataFrame) -> DataFrame:
    return stores.filter(F.col("store_key") != UNMATCHED).select("store_key", *STORE_ATTRIBUTES)
