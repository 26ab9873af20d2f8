import datetime as dt
import random
import string

import pytest
from pyspark.sql import functions as F

from shelfprice import functions as fn
from shelfprice.functions.keys import NULL_PLACEHOLDER

AS_OF = "2025-01-01"


def one(rows, value, build, schema="s string"):
    return rows([(value,)], schema).select(build(F.col("s")).alias("v")).first().v


@pytest.mark.parametrize(
    "text, expected",
    [
        ("STORE_EXPENSE", "Store_Expense"),
        ("  home care ", "Home Care"),
        ("tx-12", "Tx-12"),
        ("Branch_ab1", "Branch_Ab1"),
        ("1st of MAY", "1st Of May"),
        (None, None),
    ],
)
def test_title(rows, text, expected):
    assert one(rows, text, fn.title) == expected


def test_title_matches_word_recipe_on_random_ascii(rows):
    rng = random.Random(7)
    alphabet = string.ascii_letters + string.digits + "_-./' "
    texts = [("".join(rng.choices(alphabet, k=rng.randint(0, 14))),) for _ in range(300)]
    recipe = (
        "array_join(transform(regexp_extract_all(lower(trim(s)), '[a-z0-9]+|[^a-z0-9]+', 0),"
        " x -> concat(upper(substr(x, 1, 1)), substr(x, 2))), '')"
    )
    df = rows(texts, "s string").select("s", fn.title(F.col("s")).alias("a"), F.expr(recipe).alias("b"))
    assert df.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def test_blank_texts_become_null(rows):
    assert one(rows, "   ", fn.clean_title_case) is None
    titled = rows([("a b", " ")], "x string, y string").select(fn.clean_title_cases("x", "y").alias("v")).first().v
    assert titled == ["A B", None]


def test_pattern_and_allowed_values(rows):
    assert one(rows, " Branch_7 ", fn.clean_with_pattern) == "Branch_7"
    assert one(rows, "Shop 7", fn.clean_with_pattern) is None
    allowed = lambda c: fn.validate_allowed_values(c, ["SALES", "STORE_EXPENSE"])
    assert one(rows, " sales ", allowed) == "Sales"
    assert one(rows, "store_EXPENSE", allowed) == "Store_Expense"
    assert one(rows, "refund", allowed) is None


def test_region_mapping(rows):
    data = [(" cairo ", None), ("GIZA", "x"), ("Tanta", ""), ("ASWAN", "upper egypt"), ("ASWAN", " "), (None, "delta x")]
    got = rows(data, "c string, r string").select(fn.map_store_region(F.col("c"), F.col("r")).alias("v"))
    assert [r.v for r in got.collect()] == ["Greater Cairo", "Greater Cairo", "Delta", "Upper Egypt", None, "Delta X"]


def test_not_applicable(rows):
    for marker in ("NOT_APPLICABLE", " N/A ", "NONE", "", "Not_Applicable", None):
        assert one(rows, marker, fn.handle_not_applicable) == "Non-Product Expense"
    assert one(rows, "None", fn.handle_not_applicable) == "None"
    assert one(rows, 12, fn.handle_not_applicable, "s int") == "12"


@pytest.mark.parametrize(
    "text, whole, number",
    [
        ("12.7", 12, 12.7),
        ("-3", 3, 3.0),
        ("12.", None, 12.0),
        (" 5 ", 5, 5.0),
        ("abc", None, None),
        ("", None, None),
        ("99999999999", None, 99999999999.0),
    ],
)
def test_guarded_numbers(rows, text, whole, number):
    assert one(rows, text, fn.guarded_int) == whole
    assert one(rows, text, fn.guarded_double) == number


@pytest.mark.parametrize(
    "text, date_format, expected",
    [
        (" 2024-03-01 ", "YYYY-MM-DD", dt.date(2024, 3, 1)),
        ("2024-02-30", "YYYY-MM-DD", None),
        ("2999-01-01", "YYYY-MM-DD", dt.date(2025, 1, 1)),
        ("3/1/2024", "YYYY-MM-DD", None),
        ("31/12/2023", "DD/MM/YYYY", dt.date(2023, 12, 31)),
        ("31/12/2023", "MM/DD/YYYY", None),
        ("12/31/2023", "MM/DD/YYYY", dt.date(2023, 12, 31)),
        ("31-12-2023", "DD-MM-YYYY", dt.date(2023, 12, 31)),
        ("2023-12-31 23:59:59", "YYYY-MM-DD HH24:MI:SS", dt.date(2023, 12, 31)),
        ("2023-12-31T23:59:59.123", "YYYY-MM-DD HH24:MI:SS", dt.date(2023, 12, 31)),
        ("2023-12-31", "YYYY-MM-DD HH24:MI:SS", None),
        ("2023-12-31 25:00:00", "YYYY-MM-DD HH24:MI:SS", None),
        ("3/1/2024", "M/d/yyyy", dt.date(2024, 3, 1)),
        (None, "YYYY-MM-DD", None),
    ],
)
def test_guarded_dates(rows, text, date_format, expected):
    assert one(rows, text, lambda c: fn.guarded_date(c, date_format, AS_OF)) == expected


def test_calendar_keys(rows):
    day = dt.date(2024, 1, 3)
    df = rows([(day,)], "s date")
    got = df.select(fn.date_key(F.col("s")), fn.month_key(F.col("s")), fn.week_start(F.col("s"))).first()
    assert tuple(got) == (20240103, 202401, dt.date(2024, 1, 1))


def test_surrogate_key_of_null(rows):
    import hashlib

    got = rows([("a", None)], "x string, y int").select(fn.surrogate_key(F.col("x"), F.col("y")).alias("v")).first().v
    assert got == hashlib.md5(f"a-{NULL_PLACEHOLDER}".encode()).hexdigest()


def test_outliers(rows):
    data = [("50.01", 10.0), ("50", 10.0), ("0.9", 10.0), ("1.0", 10.0), ("7.126", None), ("n/a", 10.0)]
    got = rows(data, "p string, a double").select(fn.fill_outlier_with_avg(F.col("p"), F.col("a")).alias("v"))
    assert [r.v for r in got.collect()] == [10.0, 50.0, 10.0, 1.0, 7.13, None]


def test_money_ties_do_not_depend_on_the_last_bits(rows):
    noisy = rows([(10.015,), (10.014999999999999,)], "p double").select(fn.money(F.col("p")).alias("v"))
    assert [str(r.v) for r in noisy.collect()] == ["10.02", "10.02"]


def test_nan_becomes_null(rows):
    df = fn.nan_to_null(rows([(float("nan"), 1)], "x double, y int"))
    assert tuple(df.first()) == (None, 1)
