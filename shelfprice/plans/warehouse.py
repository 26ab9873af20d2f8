"""The layers of one warehouse, from raw tables to marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfprice.operators.dedup import keep_latest
from shelfprice.operators.history import build_history
from shelfprice.operators.series import date_dimension, month_dimension
from shelfprice.plans import dims, facts, marts, silver
from shelfprice.plans.features import FEATURE_WEEKS
from shelfprice.sources import product_mapping, write_layer


class Warehouse:
    """Builds each layer on first use.

    Layers with several consumers are written once (``save``) and scanned from
    there: the raw tables are cleaned and deduplicated a single time, later
    reads fetch only the columns they need, and the size of every dimension is
    known when it is joined.

    The date formats are those of the raw tables, used both to keep the latest
    row and to parse it; without one, dates must be in ISO form.
    """

    def __init__(
        self,
        raw_company: DataFrame,
        raw_competitor: DataFrame,
        mapping: DataFrame | None = None,
        as_of: dt.date | str | None = None,
        company_date_format: str | None = None,
        competitor_date_format: str | None = None,
        history_strategy: str = "timestamp",
        save: Callable[[DataFrame, str], DataFrame] = write_layer,
    ):
        self.raw_company = raw_company
        self.raw_competitor = raw_competitor
        self.mapping = product_mapping(raw_company.sparkSession) if mapping is None else mapping
        self.as_of = as_of
        self.company_date_format = company_date_format
        self.competitor_date_format = competitor_date_format
        self.history_strategy = history_strategy
        self.save = save

    @cached_property
    def company(self) -> DataFrame:
        latest = keep_latest(self.raw_company, silver.COMPANY_KEYS, "Date", self.company_date_format)
        return self.save(silver.silver_company(latest, self.as_of, self.company_date_format or silver.ISO_DATE), "company")

    @cached_property
    def sales(self) -> DataFrame:
        return silver.silver_sales(self.company, self.mapping)

    @cached_property
    def expenses(self) -> DataFrame:
        return silver.silver_expenses(self.company)

    @cached_property
    def own_prices(self) -> DataFrame:
        return self.save(silver.average_own_price(self.company), "own-prices")

    @cached_property
    def competitor(self) -> DataFrame:
        latest = keep_latest(self.raw_competitor, silver.COMPETITOR_KEYS, "Scraped_At", self.competitor_date_format)
        cleaned = silver.silver_competitor(
            latest, self.own_prices, self.as_of, self.competitor_date_format or silver.ISO_TIMESTAMP
        )
        return self.save(cleaned, "competitor")

    @cached_property
    def products(self) -> DataFrame:
        history = build_history(self.sales, "product_key", dims.PRODUCT_ATTRIBUTES, "transaction_date", self.history_strategy)
        return self.save(dims.dim_products(history), "dim-products")

    @cached_property
    def stores(self) -> DataFrame:
        return self.save(dims.dim_stores(self.sales), "dim-stores")

    @cached_property
    def competitors(self) -> DataFrame:
        return self.save(dims.dim_competitors(self.competitor), "dim-competitors")

    @cached_property
    def expense_types(self) -> DataFrame:
        return self.save(dims.dim_expense_type(self.expenses), "dim-expense-type")

    @cached_property
    def dates(self) -> DataFrame:
        return self.save(date_dimension(self.sales, "transaction_date"), "dim-date")

    @cached_property
    def months(self) -> DataFrame:
        """Spans expenses and scrapes, so that no expense month is missing."""
        days = self.expenses.select(F.col("transaction_date").alias("day")).unionByName(
            self.competitor.select(F.col("scraped_at").alias("day"))
        )
        return self.save(month_dimension(days, "day"), "dim-month")

    @cached_property
    def sales_fact(self) -> DataFrame:
        return facts.fact_store_sales(self.sales, self.products, self.stores, self.dates)

    @cached_property
    def expenses_fact(self) -> DataFrame:
        return facts.fact_store_expenses(self.expenses, self.stores, self.expense_types, self.months)

    @cached_property
    def competitor_fact(self) -> DataFrame:
        return facts.fact_competitor_prices(self.competitor, self.products, self.competitors, self.dates)

    @cached_property
    def pricing_mart(self) -> DataFrame:
        return marts.pricing_mart(self.sales_fact, self.competitor_fact, self.products, self.stores, self.dates)

    @cached_property
    def recent_mart(self) -> DataFrame:
        """The weeks that the features of the latest week look at."""
        return marts.pricing_mart(
            self.sales_fact, self.competitor_fact, self.products, self.stores, self.dates, last_weeks=FEATURE_WEEKS
        )

    @cached_property
    def product_week_mart(self) -> DataFrame:
        return marts.product_week_mart(self.sales_fact, self.competitor_fact, self.products, self.dates)
