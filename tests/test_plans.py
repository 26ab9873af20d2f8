import datetime as dt
import math

import pytest
from conftest import values
from pyspark.sql import functions as F

from shelfprice.plans import pricing
from shelfprice.plans.demand import (
    PREDICTION,
    constant_elasticity,
    implied_elasticity,
    load_model,
    model_predictor,
    save_model,
    train,
)
from shelfprice.plans.dims import dim_products
from shelfprice.plans.features import build_features, latest_rows, prepare, time_split
from shelfprice.plans.marts import pricing_mart, weekly_sales
from shelfprice.plans.measures import expected_uplift, top_opportunities
from shelfprice.plans.silver import COMPANY_COLUMNS, silver_company, silver_sales
from shelfprice.plans.warehouse import Warehouse
from shelfprice.sources import product_mapping, read_raw_csv, read_table, write_bucketed, write_json, write_table

MONDAY = dt.date(2024, 1, 1)


def company_row(**changes):
    row = {
        "Record_Type": "SALES", "Transaction_ID": "Tx-1", "Date": "2024-03-01", "Store_ID": "7", "Store_Name": "Branch_7",
        "Store_City": "cairo", "Store_Region": "x", "Product_ID": "107", "Product_Name": "PROD_107", "Category": "GROCERIES",
        "Sub_Category": "grains", "Quantity": "3", "Unit_Cost": "8", "Unit_Retail": "10.5", "Expense_Type": "Not_Applicable",
        "Expense_Amount": "0",
    }
    row.update(changes)
    return tuple(row[c] for c in COMPANY_COLUMNS)


def company(rows, *changes):
    return rows([company_row(**c) for c in changes], ", ".join(f"{c} string" for c in COMPANY_COLUMNS))


def test_silver_company_cleans_and_drops_null_rows(rows):
    raw = company(
        rows,
        {},
        {"Transaction_ID": "Tx-2", "Quantity": "-3", "Product_ID": "NOT_APPLICABLE", "Category": "", "Expense_Type": "RENT"},
        {"Transaction_ID": "Tx-3", "Store_Region": None},
    )
    got = {r.transaction_id: r for r in silver_company(raw, "2025-01-01").collect()}
    assert set(got) == {"Tx-1", "Tx-2"}
    assert (got["Tx-1"].record_type, got["Tx-1"].store_region, got["Tx-1"].expense_type) == ("Sales", "Greater Cairo", "Direct Sale")
    second = got["Tx-2"]
    assert (second.quantity, second.product_id, second.category, second.expense_type) == (3, "Non-Product Expense", "Non-Product Expense", "Rent")


def test_sales_take_the_master_attributes(spark, rows):
    raw = company(rows, {}, {"Transaction_ID": "Tx-2", "Product_ID": "5"}, {"Transaction_ID": "Tx-3", "Quantity": "0"})
    sales = silver_sales(silver_company(raw, "2025-01-01"), product_mapping(spark))
    assert values(sales, "transaction_id", "category", "sub_category") == [
        ("Tx-1", "Groceries", "Grains "),
        ("Tx-2", "Groceries", "Grains"),
    ]


@pytest.fixture(scope="module")
def small(spark):
    """Two stores, one product known to the mapping, sales in weeks 1 and 3, scrapes in week 2."""
    sale = [
        company_row(Transaction_ID="Tx-1", Date="2024-01-02", Quantity="2"),
        company_row(Transaction_ID="Tx-2", Date="2024-01-16", Quantity="4", Unit_Retail="12"),
        company_row(Transaction_ID="Tx-3", Date="2024-01-03", Store_ID="8", Store_Name="Branch_8", Unit_Retail="9"),
        company_row(Transaction_ID="Tx-4", Date="2024-01-09", Record_Type="STORE_EXPENSE", Expense_Type="RENT", Expense_Amount="50"),
    ]
    scrape = [("2024-01-10 08:00:00", "LULU", "107", "Prod_107", "11"), ("2024-01-10 09:00:00", "lulu", "107", "Prod_107", "900")]
    return Warehouse(
        spark.createDataFrame(sale, ", ".join(f"{c} string" for c in COMPANY_COLUMNS)),
        spark.createDataFrame(scrape, "Scraped_At string, Competitor_Name string, Product_ID string, Product_Name string, Competitor_Price string"),
        as_of="2024-02-01",
    )


def test_facts(small):
    sales = {r.transaction_id: r for r in small.sales_fact.collect()}
    assert sales["Tx-2"].gross_revenue == 48.0 and sales["Tx-2"].gross_margin_amount == 16.0
    assert sales["Tx-1"].date_key == 20240102 and "-1" not in {sales["Tx-1"].product_key, sales["Tx-1"].store_key}
    assert values(small.expenses_fact, "month_date_key", "expense_amount") == [(202401, 50.0)]
    # 900 is more than five times the own average, (10.5 + 12 + 9 + 10.5) / 4, and becomes it
    prices = sorted(r.competitor_price for r in small.competitor_fact.collect())
    assert prices == [10.5, 11.0]


def test_pricing_mart_carries_prices(small):
    rows_ = values(small.pricing_mart.filter("store_id = 7"), "sales_week", "avg_unit_retail", "avg_competitor_price", "quantity_sold")
    assert [(str(w), float(r), float(c), q) for w, r, c, q in rows_] == [
        ("2024-01-01", 10.5, 10.5, 2),
        ("2024-01-08", 10.5, 10.75, 0),
        ("2024-01-15", 12.0, 10.75, 4),
    ]
    other = values(small.pricing_mart.filter("store_id = 8"), "sales_week", "avg_unit_retail", "quantity_sold")
    assert [(float(r), q) for _, r, q in other] == [(9.0, 3), (9.0, 0), (9.0, 0)]
    product = values(small.product_week_mart, "sales_week", "quantity_sold")
    assert [q for _, q in product] == [5, 0, 4]


def test_unknown_product_member(small):
    assert small.products.filter("product_key = '-1'").count() == 1
    assert dim_products(small.products.filter("product_key <> '-1'")).count() == small.products.count()


def test_weekly_sales_ignores_unmatched_keys(rows):
    fact = rows(
        [("a", "s", 20240102, MONDAY, "t1", 1, 2.0, 1.0), ("-1", "s", 20240102, MONDAY, "t2", 1, 2.0, 1.0), ("a", "s", -1, None, "t3", 1, 2.0, 1.0)],
        "product_key string, store_key string, date_key int, full_date date, transaction_id string, quantity int, unit_retail double, unit_cost double",
    )
    assert values(weekly_sales(fact, "product_key"), "total_transactions") == [(1,)]


def series(rows, weeks=12, price=10.0, competitor=10.0, cost=8.0, product="1", store="s"):
    data = [
        (product, store, 1, MONDAY + dt.timedelta(7 * i), "Cat", "Sub", "Delta", price + i % 3, cost, competitor, competitor - 1, competitor + 1, 5 + i % 4)
        for i in range(weeks)
    ]
    return rows(
        data,
        "product_id string, store_key string, store_id int, sales_week date, category string, sub_category string, store_region string, "
        "avg_unit_retail double, avg_unit_cost double, avg_competitor_price double, min_competitor_price double, max_competitor_price double, "
        "quantity_sold bigint",
    )


def test_features(rows):
    got = {r.sales_week: r for r in build_features(prepare(series(rows))).collect()}
    first, fifth = got[MONDAY], got[MONDAY + dt.timedelta(28)]
    assert first.quantity_lag_1_week is None and first.quantity_rolling_avg_4_weeks is None
    assert fifth.quantity_lag_4_weeks == 5 and fifth.quantity_rolling_avg_4_weeks == (5 + 6 + 7 + 8) / 4
    assert fifth.log_unit_retail == math.log(11.0) and fifth.week_of_year == 5
    assert fifth.is_higher_than_competitor == 1.0 and first.is_higher_than_competitor == 0.0 and first.is_undercut == 1.0
    assert math.isclose(fifth.price_change_pct_weekly, 11 / 10 - 1)


def test_zero_prices_give_null_features(rows):
    row = build_features(prepare(series(rows, weeks=2, price=0.0, competitor=0.0))).orderBy("sales_week").first()
    assert row.log_unit_retail is None and row.competitor_price_ratio is None and row.current_profit_margin_pct is None


def test_latest_row_per_series(rows):
    both = series(rows).unionByName(series(rows, weeks=6, store="t"))
    latest = latest_rows(build_features(prepare(both)))
    assert [str(r[1]) for r in values(latest, "store_key", "sales_week")] == ["2024-03-18", "2024-02-05"]


def test_time_split_needs_both_sides(rows):
    train_rows, test_rows, cutoff = time_split(series(rows))
    assert (train_rows.count(), test_rows.count(), str(cutoff)) == (8, 4, "2024-02-19")
    for days in (0, 1000):
        with pytest.raises(ValueError):
            time_split(series(rows), days)


def latest(rows, **kw):
    return latest_rows(build_features(prepare(series(rows, **kw))))


def test_price_band(rows):
    inside = pricing.price_band(latest(rows, competitor=10.0, cost=5.0)).first()
    assert (inside.price_low, inside.price_high, inside.band_violated) == (9.5, 10.5, False)
    costly = pricing.price_band(latest(rows, competitor=10.0, cost=20.0)).first()
    assert costly.price_low == 20.0 * 1.1 and costly.price_high == costly.price_low * 1.01 and costly.band_violated
    unknown = pricing.price_band(latest(rows, competitor=0.0, cost=1.0)).first()
    assert math.isclose(unknown.price_high, 12.0 * 1.15) and math.isclose(unknown.price_low, 12.0 * 0.85)


def test_recommendation_against_brute_force(rows):
    frame = latest(rows, competitor=10.0, cost=8.0)
    base = frame.first()
    best = None
    for i in range(50):
        price = 9.5 + i * (1.0 / 49)
        quantity = max(math.expm1(math.log1p(base.quantity_rolling_avg_4_weeks) - 4 * (math.log(price) - math.log(base.avg_unit_retail))), 0)
        margin = quantity * (price - 8.0)
        if best is None or margin > best[0] + 1e-12:
            best = (margin, price, quantity)
    got = pricing.recommend(frame, constant_elasticity(-4.0)).first()
    assert math.isclose(got.recommended_price, best[1]) and math.isclose(got.predicted_weekly_margin, best[0])
    assert got.target_sales_week == base.sales_week + dt.timedelta(1)


def test_demand_is_made_non_increasing_in_price(rows):
    def rising(df):
        return df.withColumn(PREDICTION, F.col("log_unit_retail"))

    got = pricing.candidates(latest(rows), rising, n_candidates=7).orderBy("candidate_price").collect()
    quantities = [r.predicted_quantity for r in got]
    assert all(a >= b for a, b in zip(quantities, quantities[1:]))
    assert all(got[0].price_low <= r.candidate_price <= got[0].price_high + 1e-9 for r in got)


def test_equal_margins_take_the_lowest_price(rows):
    def none_sold(df):
        return df.withColumn(PREDICTION, F.lit(0.0))

    row = pricing.recommend(latest(rows, cost=5.0), none_sold, n_candidates=5).first()
    assert row.recommended_price == 9.5 and row.predicted_weekly_margin == 0.0


def test_halves_round_to_even(rows):
    df = rows([(0.5, 1.5, 2.5)], "recommended_price double, predicted_weekly_quantity double, predicted_weekly_margin double")
    assert tuple(pricing.rounded(df).first()) == (0, 2, 2)


def test_implied_elasticity_returns_the_models_own(rows):
    got = implied_elasticity(latest(rows), constant_elasticity(-2.5)).first().implied_elasticity
    assert math.isclose(got, -2.5, rel_tol=1e-9)


def test_roll_up_and_measures(rows):
    recs = rows(
        [("1", "s", 10.0, 5, 0.2, 12, 6, 20), ("1", "t", 20.0, 5, 0.4, 14, 4, 30), ("2", "s", 10.0, 1, 0.5, 9, 2, 1)],
        "product_id string, store_key string, current_price double, current_weekly_quantity bigint, current_weekly_margin double, "
        "recommended_price bigint, predicted_weekly_quantity bigint, predicted_weekly_margin bigint",
    )
    rolled = pricing.roll_up(recs, "product_id")
    assert values(rolled)[0] == ("1", 15.0, 10, 45, 13.0, 10, 50)
    uplift = expected_uplift(rolled).first()
    assert uplift.current_revenue == 160.0 and uplift.margin_uplift == 51 - 50
    assert [r.product_id for r in top_opportunities(rolled, 1).collect()] == ["1"]


def test_boosted_model_round_trip(spark, rows, tmp_path):
    frame = series(rows, weeks=20)
    for i in range(1, 6):
        frame = frame.unionByName(series(rows, weeks=20, price=10.0 + i, store=f"s{i}"))
    mart_path, model_path, out = (str(tmp_path / n) for n in ("mart", "model", "out"))
    write_table(frame, mart_path)
    result = pricing.train_and_save(spark, mart_path, model_path, max_iter=2, max_depth=2)
    assert result.train_mae >= 0 and result.test_mae >= 0
    # an unseen category level is scored, not rejected
    unseen = latest(rows, store="new").withColumn("category", F.lit("Other"))
    assert model_predictor(load_model(spark, model_path))(unseen).first()[PREDICTION] is not None
    scored = pricing.score_all(spark, mart_path, model_path, out, n_candidates=4)
    assert scored.count() == 1 and read_table(spark, out).count() == 1
    assert pricing.predict_products(spark, mart_path, model_path, ["1"], n_candidates=4).count() == 1
    with pytest.raises(Exception):
        load_model(spark, str(tmp_path / "missing"))
    save_model(result.model, model_path)


def test_marts_join_nothing_to_dense_rows(spark, rows):
    w = Warehouse(company(rows, {}, {"Transaction_ID": "Tx-2", "Date": "2024-05-01"}), rows([], "Scraped_At string, Competitor_Name string, Product_ID string, Product_Name string, Competitor_Price string"), as_of="2025-01-01")
    for mart in (w.pricing_mart, w.product_week_mart):
        plan = mart._jdf.queryExecution().optimizedPlan().toString().splitlines()
        explode = next(i for i, line in enumerate(plan) if "Generate" in line)
        assert not any("Join" in line or "Window" in line or "Aggregate" in line for line in plan[:explode])
        assert any("Join" in line for line in plan[explode:])


def test_batch_scoring_reads_the_last_weeks_only(spark, rows, tmp_path):
    frame = series(rows, weeks=20)
    pricing.write_mart(prepare(frame), str(tmp_path / "mart"))
    recent = pricing.recent_weeks(read_table(spark, str(tmp_path / "mart")))
    folders = {f.split("sales_week=")[1].split("/")[0] for f in recent._jdf.queryExecution().optimizedPlan().toString().split() if "sales_week=" in f}
    assert not folders or len(folders) <= 5
    assert recent.select("sales_week").distinct().count() == 5
    filters = recent._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "sales_week" in filters


def test_bucketed_layers_are_not_shuffled(spark, rows, tmp_path):
    frame = series(rows, weeks=20).unionByName(series(rows, weeks=20, price=11.0, store="s1"))
    saved = write_bucketed(prepare(frame), "mart_in_buckets", str(tmp_path / "mart"), ["product_id", "store_key"], ["sales_week"], 4)
    features = latest_rows(build_features(saved))
    assert "Exchange" not in features._jdf.queryExecution().executedPlan().toString()
    assert values(features) == values(latest_rows(build_features(prepare(frame))).select(features.columns))


def test_csv_and_json(spark, rows, tmp_path):
    (tmp_path / "raw.csv").write_text("a,b\n1,x\n02,\n")
    df = read_raw_csv(spark, str(tmp_path / "raw.csv"), ["a", "b"])
    assert values(df) == [("02", None), ("1", "x")]
    write_json(rows([(float("nan"), 1)], "x double, y int"), str(tmp_path / "json"))
    text = "".join(p.read_text() for p in (tmp_path / "json").glob("part-*"))
    assert text.strip() == '{"x":null,"y":1}'


def test_schema_merging_read(spark, rows, tmp_path):
    write_table(rows([(1,)], "k int"), str(tmp_path / "t"), "append")
    write_table(rows([(2, "x")], "k int, s string"), str(tmp_path / "t"), "append")
    assert values(read_table(spark, str(tmp_path / "t"), merge_schema=True), "k", "s") == [(1, None), (2, "x")]


def test_layers_are_released(spark, tmp_path):
    from pathlib import Path

    from shelfprice.sources.staging import release, short_lived_layers, write_through

    def folder(df):
        return Path(df.inputFiles()[0].removeprefix("file://")).parent

    kept = folder(write_through(spark.range(3), "kept"))
    with short_lived_layers(spark):
        gone = folder(write_through(spark.range(3), "gone"))
        assert gone.exists()
    assert kept.exists() and not gone.exists()
    release(spark)
    assert not kept.exists()
