"""Queries over features, demand, price recommendations and measures."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog.layers import warehouse
from catalog.spec import query
from shelfprice.operators.dedup import latest_per_group
from shelfprice.operators.series import forward_fill, integer_series, price_points
from shelfprice.plans import measures, pricing
from shelfprice.plans.demand import (
    PREDICTION,
    constant_elasticity,
    implied_elasticity,
    load_model,
    mean_absolute_error,
    model_predictor,
    naive_elasticity,
    TrainResult,
)
from shelfprice.plans.features import SERIES, TARGET, build_features, latest_rows, prepare, price_features, time_split, training_frame
from shelfprice.sources import read_table, shared_dir, write_bucketed, write_json, write_table
from shelfprice.sources.staging import short_lived_layers

# demand model of the SQL-checked queries
ELASTICITY = -4.0
_N = 50
# of the fitted model in the queries that apply one; the report fits the library's default of 500
TREES = 20


def _mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return w.save(w.pricing_mart, "pricing-mart")


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(prepare(warehouse(spark, sf_dir).pricing_mart))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the latest week, from the weeks that they look at."""
    return latest_rows(build_features(prepare(warehouse(spark, sf_dir).recent_mart)))


_FEATURES = (
    "product_id store_key sales_week:d quantity_sold:i avg_unit_retail:2 log_unit_retail:6 competitor_price_ratio:6 "
    "price_difference:2 competitor_price_gap_pct:6 current_profit_margin_pct:6 is_higher_than_competitor:0 is_undercut:0 "
    "quantity_lag_1_week:i quantity_lag_4_weeks:i price_change_pct_weekly:6 quantity_rolling_avg_4_weeks:4 "
    "price_rolling_avg_4_weeks:4 month:i quarter:i week_of_year:i"
)


@query(_FEATURES, "SELECT * FROM features")
def demand_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


@query(_FEATURES, "SELECT * FROM features")
def features_from_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of a mart that is kept in buckets by series, which are not shuffled again."""
    name = f"mart_{uuid.uuid4().hex}"
    mart = warehouse(spark, sf_dir).pricing_mart
    path = f"{shared_dir(spark)}/shelfprice/{name}"
    return build_features(prepare(write_bucketed(mart, name, path, SERIES, ["sales_week"], 32)))


@query(_FEATURES, "SELECT * FROM latest")
def latest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir)


@query(
    "side n_rows:i first_week:d last_week:d quantity:i",
    """WITH c AS (SELECT max(sales_week) - 28 AS cutoff FROM training)
        SELECT CASE WHEN sales_week <= cutoff THEN 'train' ELSE 'test' END AS side, count(*) AS n_rows, min(sales_week) AS first_week,
               max(sales_week) AS last_week, sum(quantity_sold) AS quantity FROM training, c GROUP BY ALL""",
)
def training_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_frame(build_features(prepare(_mart(spark, sf_dir))))
    train_rows, test_rows, _ = time_split(rows)
    sides = train_rows.withColumn("side", F.lit("train")).unionByName(test_rows.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("sales_week").alias("first_week"),
        F.max("sales_week").alias("last_week"),
        F.sum("quantity_sold").alias("quantity"),
    )


@query("elasticity:6", "SELECT regr_slope(log_quantity, log_unit_retail) AS elasticity FROM training")
def price_elasticity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_elasticity(training_frame(_features(spark, sf_dir)))


@query(
    "mae:6 n_rows:i",
    """SELECT avg(CASE WHEN avg_unit_retail > 0 THEN abs(log_quantity - ln(1 + quantity_rolling_avg_4_weeks)) END) AS mae,
        count(*) AS n_rows FROM training""",
)
def demand_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_absolute_error(constant_elasticity(ELASTICITY)(training_frame(_features(spark, sf_dir))))


@query(
    "product_id store_key implied_elasticity:6",
    """SELECT product_id, store_key, CASE WHEN avg_unit_retail > 0 THEN CAST(-1 - store_id % 5 AS DOUBLE) END AS implied_elasticity
        FROM latest""",
)
def grid_elasticity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slope of the predictions on a price grid: it must give back each series' own elasticity."""
    own = (-1 - F.col("store_id") % 5).cast("double")
    return implied_elasticity(_latest(spark, sf_dir), constant_elasticity(own))


_BAND = """band AS (SELECT *, greatest(avg_unit_cost * CAST(1.1 AS DOUBLE), anchor * (1 - gap)) AS price_low, anchor * (1 + gap) AS top
        FROM (SELECT *, coalesce(nullif(avg_competitor_price, 0), avg_unit_retail) AS anchor,
              CASE WHEN nullif(avg_competitor_price, 0) IS NOT NULL THEN CAST(0.05 AS DOUBLE) ELSE CAST(0.15 AS DOUBLE) END AS gap FROM latest)),
    limits AS (SELECT *, greatest(price_low * CAST(1.01 AS DOUBLE), top) AS price_high FROM band)"""
_GRID = f"""{_BAND},
    price_grid AS (SELECT *, price_low + i * ((price_high - price_low) / {_N - 1}) AS candidate_price
        FROM limits CROSS JOIN (SELECT unnest(range({_N})) AS i)),
    scored AS (SELECT *, greatest(exp(ln(1 + quantity_rolling_avg_4_weeks)
        + {ELASTICITY} * (ln(nullif(candidate_price, 0)) - ln(nullif(avg_unit_retail, 0)))) - 1, 0) AS q
        FROM price_grid),
    monotone AS (SELECT *, min(q) OVER (PARTITION BY product_id, store_key ORDER BY candidate_price, i) AS predicted_quantity FROM scored),
    candidates AS (SELECT *, predicted_quantity * (candidate_price - avg_unit_cost) AS predicted_margin FROM monotone)"""
_BEST = f"""{_GRID},
    best AS (SELECT product_id, store_key, store_id, category, CAST(sales_week + INTERVAL 1 DAY AS DATE) AS target_sales_week,
        avg_unit_retail AS current_price, quantity_sold AS current_weekly_quantity, current_profit_margin_pct AS current_weekly_margin,
        CAST(round_even(candidate_price, 0) AS BIGINT) AS recommended_price, CAST(round_even(predicted_quantity, 0) AS BIGINT) AS predicted_weekly_quantity,
        CAST(round_even(predicted_margin, 0) AS BIGINT) AS predicted_weekly_margin, price_high > top AS band_violated
        FROM candidates QUALIFY row_number() OVER (PARTITION BY product_id, store_key ORDER BY predicted_margin DESC, candidate_price) = 1)"""


def _rollup(keys: str) -> str:
    return f"""SELECT {keys}, current_price, current_weekly_quantity,
        CAST(round_even(current_weekly_quantity * current_price * pct, 0) AS BIGINT) AS current_weekly_margin,
        recommended_price, predicted_weekly_quantity, predicted_weekly_margin
        FROM (SELECT {keys}, avg(current_price) AS current_price, sum(current_weekly_quantity) AS current_weekly_quantity,
              avg(current_weekly_margin) AS pct, avg(recommended_price) AS recommended_price,
              sum(predicted_weekly_quantity) AS predicted_weekly_quantity, sum(predicted_weekly_margin) AS predicted_weekly_margin
              FROM best GROUP BY {keys})"""


_ROLLED = f"{_BEST}, rolled AS ({_rollup('product_id')})"


@query(
    "product_id store_key price_low:4 price_high:4 band_violated",
    f"WITH {_BAND} SELECT *, price_high > top AS band_violated FROM limits",
)
def price_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.price_band(_latest(spark, sf_dir))


@query(
    "product_id store_key candidate_price:4 predicted_quantity:4 predicted_margin:2",
    f"WITH {_GRID} SELECT * FROM candidates",
)
def price_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _latest(spark, sf_dir)
    return pricing.candidates(rows, constant_elasticity(ELASTICITY), n_candidates=_N)


_RECOMMENDED = (
    "product_id store_key store_id:i category target_sales_week:d current_price:2 current_weekly_quantity:i "
    "current_weekly_margin:6 recommended_price:i predicted_weekly_quantity:i predicted_weekly_margin:i band_violated"
)


@query(_RECOMMENDED, f"WITH {_BEST} SELECT * FROM best")
def price_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _latest(spark, sf_dir)
    return pricing.rounded(pricing.recommend(rows, constant_elasticity(ELASTICITY), n_candidates=_N))


_ROLLED_UP = (
    "current_price:4 current_weekly_quantity:i current_weekly_margin:i recommended_price:4 predicted_weekly_quantity:i "
    "predicted_weekly_margin:i"
)


def _week_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _latest(spark, sf_dir)
    best = pricing.rounded(pricing.recommend(rows, constant_elasticity(ELASTICITY), n_candidates=_N))
    return pricing.roll_up(best, "product_id", "target_sales_week")


@query("product_id target_sales_week:d " + _ROLLED_UP, f"WITH {_BEST} {_rollup('product_id, target_sales_week')}")
def recommendations_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _week_rollup(spark, sf_dir)


@query(
    "product_id " + _ROLLED_UP,
    f"WITH {_ROLLED} SELECT * FROM rolled WHERE product_id IN ('101', '95')",
)
def recommendations_on_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The on-demand request names its products; lags come from their whole history."""
    mart = _mart(spark, sf_dir)
    best = pricing.score(mart, constant_elasticity(ELASTICITY), product_ids=["101", "95"], n_candidates=_N)
    return pricing.roll_up(best, "product_id")


@query("product_id target_sales_week:d " + _ROLLED_UP, f"WITH {_BEST} {_rollup('product_id, target_sales_week')}")
def recommendations_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as Parquet, served as JSON records, read back."""
    root = f"{shared_dir(spark)}/shelfprice/served-{uuid.uuid4().hex}"
    write_table(_week_rollup(spark, sf_dir), f"{root}/parquet")
    saved = read_table(spark, f"{root}/parquet")
    write_json(saved, f"{root}/json")
    return spark.read.schema(saved.schema).json(f"{root}/json")


@query(
    "product_id store_id:i sales_week:d avg_unit_retail:2 quantity_sold:i",
    "SELECT * FROM mart QUALIFY row_number() OVER (PARTITION BY product_id, store_id ORDER BY sales_week DESC) = 1",
)
def latest_store_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = warehouse(spark, sf_dir).pricing_mart
    columns = ["product_id", "store_id", "sales_week", "avg_unit_retail", "quantity_sold"]
    return latest_per_group(mart.select(*columns), ["product_id", "store_id"], "sales_week")


@query(
    "product_id store_key sales_week:d last_quantity:i last_price:2",
    """SELECT product_id, store_key, sales_week, last_value(CASE WHEN quantity_sold > 0 THEN quantity_sold END IGNORE NULLS) OVER w AS last_quantity,
        last_value(CASE WHEN quantity_sold > 0 THEN avg_unit_retail END IGNORE NULLS) OVER w AS last_price FROM mart
        WINDOW w AS (PARTITION BY product_id, store_key ORDER BY sales_week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def last_sale_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = warehouse(spark, sf_dir).pricing_mart.select(
        "product_id", "store_key", "sales_week", F.col("quantity_sold").alias("last_quantity"),
        F.col("avg_unit_retail").alias("last_price"),
    )
    sold = F.col("last_quantity") > 0
    return forward_fill(mart, ["product_id", "store_key"], "sales_week", sold, ["last_quantity", "last_price"])


@query(
    "product_id:i price_step:i step_price:2",
    """SELECT CAST(p.product_id AS INTEGER) AS product_id, i AS price_step, our_unit_retail * i AS step_price
        FROM own_prices p CROSS JOIN (SELECT unnest(range(1, 6)) AS i) WHERE p.product_id <> 'Non-Product Expense'""",
)
def price_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = warehouse(spark, sf_dir).own_prices.filter(F.col("product_id") != "Non-Product Expense")
    stepped = integer_series(own, 5, "price_step")
    return stepped.withColumn("step_price", F.col("our_unit_retail") * F.col("price_step"))


@query(
    "sales_week:d revenue:2 margin:2",
    """SELECT sales_week, sum(avg_unit_retail * quantity_sold) AS revenue, sum((avg_unit_retail - avg_unit_cost) * quantity_sold) AS margin
        FROM mart GROUP BY sales_week""",
)
def weekly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.weekly_totals(warehouse(spark, sf_dir).pricing_mart)


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _latest(spark, sf_dir)
    best = pricing.rounded(pricing.recommend(rows, constant_elasticity(ELASTICITY), n_candidates=_N))
    return pricing.roll_up(best, "product_id")


@query(
    "current_revenue:2 predicted_revenue:2 current_margin:i predicted_margin:i revenue_uplift:2 revenue_uplift_pct:6 "
    "margin_uplift:i margin_uplift_pct:6",
    f"""WITH {_ROLLED}, t AS (SELECT sum(current_price * current_weekly_quantity) AS cr, sum(recommended_price * predicted_weekly_quantity) AS pr,
        CAST(sum(current_weekly_margin) AS DOUBLE) AS cm, CAST(sum(predicted_weekly_margin) AS DOUBLE) AS pm FROM rolled)
        SELECT cr AS current_revenue, pr AS predicted_revenue, cm AS current_margin, pm AS predicted_margin, pr - cr AS revenue_uplift,
        pr / nullif(cr, 0) - 1 AS revenue_uplift_pct, pm - cm AS margin_uplift, pm / nullif(cm, 0) - 1 AS margin_uplift_pct FROM t""",
)
def expected_uplift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.expected_uplift(_products(spark, sf_dir))


@query(
    "products_above_market:i",
    """SELECT count(DISTINCT CASE WHEN avg_unit_retail > avg_competitor_price THEN product_id END) AS products_above_market
        FROM mart WHERE sales_week = (SELECT max(sales_week) FROM mart)""",
)
def products_above_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.priced_above_market(_mart(spark, sf_dir))


@query(
    "product_id our_price:4 competitor_price:4",
    "SELECT product_id, avg(avg_unit_retail) AS our_price, avg(avg_competitor_price) AS competitor_price FROM mart GROUP BY product_id",
)
def price_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.price_pairs(warehouse(spark, sf_dir).pricing_mart)


@query(
    "sales_week:d gap_pct:6",
    """SELECT sales_week, avg((avg_unit_retail - avg_competitor_price) / nullif(avg_competitor_price, 0)) AS gap_pct
        FROM mart GROUP BY sales_week""",
)
def competitive_gap_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.competitive_gap_trend(warehouse(spark, sf_dir).pricing_mart)


@query(
    "product_id recommended_price:4 margin_uplift:i margin_uplift_pct:6",
    f"""WITH {_ROLLED} SELECT product_id, recommended_price, predicted_weekly_margin - current_weekly_margin AS margin_uplift,
        (predicted_weekly_margin - current_weekly_margin) / nullif(CAST(current_weekly_margin AS DOUBLE), 0) AS margin_uplift_pct
        FROM rolled ORDER BY margin_uplift DESC, product_id LIMIT 10""",
)
def top_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.top_opportunities(_products(spark, sf_dir), 10)


def _fitted(spark: SparkSession, sf_dir: str, trees: int = TREES) -> tuple[str, TrainResult]:
    """A folder with the mart and a model, and the result of the training job."""
    root = f"{shared_dir(spark)}/shelfprice/model-{uuid.uuid4().hex}"
    with short_lived_layers(spark):
        pricing.write_mart(warehouse(spark, sf_dir).pricing_mart, f"{root}/mart")
    return root, pricing.train_and_save(spark, f"{root}/mart", f"{root}/model", max_iter=trees)


@query(
    "product_id store_key in_band demand_falls margin_adds_up",
    "SELECT product_id, store_key, true AS in_band, true AS demand_falls, true AS margin_adds_up FROM latest",
)
def boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for every series under a fitted model: trained, saved, loaded and applied to the candidates."""
    root, _ = _fitted(spark, sf_dir)
    rows = latest_rows(build_features(prepare(read_table(spark, f"{root}/mart"))))
    tried = pricing.candidates(rows, model_predictor(load_model(spark, f"{root}/model")))
    cheaper = Window.partitionBy("product_id", "store_key").orderBy("candidate_price")
    before = F.lag("predicted_quantity").over(cheaper)
    price, margin = F.col("candidate_price"), F.col("predicted_quantity") * (F.col("candidate_price") - F.col("avg_unit_cost"))
    inside = (price >= F.col("price_low") - 1e-9) & (price <= F.col("price_high") + 1e-9)
    return (
        tried.withColumn("_falls", before.isNull() | (F.col("predicted_quantity") <= before))
        .groupBy("product_id", "store_key")
        .agg(
            F.every(inside).alias("in_band"),
            F.every("_falls").alias("demand_falls"),
            F.every(F.abs(F.col("predicted_margin") - margin) < 1e-6).alias("margin_adds_up"),
        )
    )


def _latest_of(spark: SparkSession, root: str) -> DataFrame:
    return latest_rows(build_features(prepare(read_table(spark, f"{root}/mart"))))


@query(
    "product_id store_key n_points:i never_rises",
    f"SELECT product_id, store_key, {_N} AS n_points, true AS never_rises FROM latest",
)
def monotone_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw predictions of a fitted model on 50 prices of every series, in order: none lies above the one before."""
    root, _ = _fitted(spark, sf_dir)
    predict = model_predictor(load_model(spark, f"{root}/model"))
    rows = pricing.price_band(_latest_of(spark, root))
    grid = price_points(rows, F.col("price_low"), F.col("price_high"), _N, "candidate_price")
    scored = predict(grid.withColumns(price_features(F.col("candidate_price"))))
    cheaper = Window.partitionBy("product_id", "store_key").orderBy("candidate_price")
    before = F.lag(PREDICTION).over(cheaper)
    return (
        scored.withColumn("_falls", before.isNull() | (F.col(PREDICTION) <= before))
        .groupBy("product_id", "store_key")
        .agg(F.count(PREDICTION).alias("n_points"), F.every("_falls").alias("never_rises"))
    )


@query(
    "product_id store_key priced falls",
    "SELECT product_id, store_key, avg_unit_retail > 0 AS priced, CASE WHEN avg_unit_retail > 0 THEN true END AS falls FROM latest",
)
def fitted_elasticity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sign of the slope of a fitted model's predictions on a price grid around each series' price."""
    root, _ = _fitted(spark, sf_dir)
    rows = _latest_of(spark, root)
    slopes = implied_elasticity(rows, model_predictor(load_model(spark, f"{root}/model")))
    priced = F.coalesce(F.col("avg_unit_retail") > 0, F.lit(False))
    found = rows.select("product_id", "store_key", priced.alias("priced")).join(slopes, ["product_id", "store_key"])
    return found.withColumn("falls", F.when(F.col("priced"), F.col("implied_elasticity") <= 1e-9))


@query(
    "product_id target_sales_week:d current_price:4 current_weekly_quantity:i current_weekly_margin:i n_limits:i",
    f"""WITH {_BEST}, rolled AS ({_rollup('product_id, target_sales_week')})
        SELECT product_id, target_sales_week, current_price, current_weekly_quantity, current_weekly_margin, 0 AS n_limits FROM rolled""",
)
def batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job with a saved model over a mart laid out by week; ``n_limits`` counts results that cannot be."""
    root, _ = _fitted(spark, sf_dir)
    out = pricing.score_all(spark, f"{root}/mart", f"{root}/model", f"{root}/scores", n_candidates=5)
    wrong = (F.col("predicted_weekly_quantity") < 0) | (F.col("recommended_price") < 0)
    return out.withColumn("n_limits", wrong.cast("int"))


@query(
    "naive_elasticity:6 learns generalises",
    """WITH c AS (SELECT max(sales_week) - 28 AS cutoff FROM training)
        SELECT regr_slope(log_quantity, log_unit_retail) AS naive_elasticity, true AS learns, true AS generalises
        FROM training, c WHERE sales_week <= cutoff""",
)
def boosted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a fit: its elasticity, and whether it beats the mean of the training rows on both sides."""
    root, fit = _fitted(spark, sf_dir)
    train_rows, test_rows, _ = time_split(training_frame(build_features(prepare(read_table(spark, f"{root}/mart")))))
    mean = train_rows.agg(F.avg(TARGET)).first()[0]
    errors = [rows.agg(F.avg(F.abs(F.col(TARGET) - mean))).first()[0] for rows in (train_rows, test_rows)]
    return spark.range(1).select(
        F.lit(fit.naive_elasticity).alias("naive_elasticity"),
        F.lit(fit.train_mae < errors[0]).alias("learns"),
        F.lit(fit.test_mae < errors[1]).alias("generalises"),
    )
