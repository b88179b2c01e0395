"""Scalar expressions (X1-X18, I1) on literal fixtures; expected values written from the reference."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.functions import exprs


def test_discount_price_sample_call(spark):
    df = spark.createDataFrame([(Decimal("482.20"), Decimal("0.50"))], "p decimal(10,2), d decimal(4,2)")
    assert df.select(exprs.discount_price("p", "d").alias("x")).first()["x"] == Decimal("241.10")


def test_discount_price_rounds_half_away_from_zero(spark):
    # 10.05 - 10.05*0.5 = 5.025 -> 5.03
    df = spark.createDataFrame([(Decimal("10.05"), Decimal("0.50"))], "p decimal(10,2), d decimal(4,2)")
    assert df.select(exprs.discount_price("p", "d").alias("x")).first()["x"] == Decimal("5.03")


def test_sql_function(spark):
    exprs.register_sql_functions(spark)
    got = spark.sql("SELECT fn_calc_discount_price(482.20, 0.5) AS x").first()["x"]
    assert got == Decimal("241.10")


def test_calendar_names_padded_and_iso_weekday(spark):
    # 2024-02-29 Thursday; 2023-09-06 Wednesday; 2023-05-07 Sunday; 2023-01-02 Monday
    days = [dt.date(2024, 2, 29), dt.date(2023, 9, 6), dt.date(2023, 5, 7), dt.date(2023, 1, 2)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {
        r["d"]: (r["m"], r["n"], r["w"], r["q"])
        for r in df.select(
            "d",
            exprs.month_name("d").alias("m"),
            exprs.day_name("d").alias("n"),
            exprs.iso_day_of_week("d").alias("w"),
            exprs.quarter_name("d").alias("q"),
        ).collect()
    }
    assert got[dt.date(2024, 2, 29)] == ("February ", "Thursday ", 4, "First")
    assert got[dt.date(2023, 9, 6)] == ("September", "Wednesday", 3, "Third")
    assert got[dt.date(2023, 5, 7)] == ("May      ", "Sunday   ", 7, "Second")
    assert got[dt.date(2023, 1, 2)] == ("January  ", "Monday   ", 1, "First")


def test_quarter_four_is_fourth(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 25),)], "d date")
    assert df.select(exprs.quarter_name("d").alias("q")).first()["q"] == "Fourth"


def test_gender_codes(spark):
    df = spark.createDataFrame([("Male",), ("Female",), ("Other",), ("unknown",), (None,)], "g string")
    got = dict((r["g"], r["c"]) for r in df.select("g", exprs.gender_code("g").alias("c")).collect())
    assert got == {"Male": "M", "Female": "F", "Other": "F", "unknown": None, None: None}


def test_customer_no_null_rules(spark):
    df = spark.createDataFrame([(7,), (None,)], "i int")
    got = {r["i"]: (r["a"], r["b"]) for r in df.select("i", exprs.customer_no("i").alias("a"), exprs.customer_no_for_join("i").alias("b")).collect()}
    assert got[7] == ("C-7", "C-7")
    assert got[None] == (None, "C-")


def test_parse_address_cases(spark):
    bs = "\\n"  # backslash followed by n, as the address text holds it
    cases = {
        "normal": (f"['12 Main St{bs}Springfield, 01234']", ("12 Main St", "Springfield", " 01234")),
        "no comma": (f"['12 Main St{bs}Springfield']", ("12 Main St", "Springfield", None)),
        "no line mark": ("['12 Main St, Springfield']", ("12 Main St, Springfield", None, None)),
        "empty": ("", (None, None, None)),
        "null": (None, (None, None, None)),
        "extra brackets": (f"[['12 Main St{bs}Spring'field, 1']]", ("12 Main St", "Springfield", " 1")),
        "several marks": (f"['a{bs}b, 1{bs}c, 2']", ("a", "b", " 1")),
        "trailing mark": (f"['a{bs}']", ("a", None, None)),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "k string, raw string")
    street, city, zip_code = exprs.parse_address(F.col("raw"))
    got = {r["k"]: (r["s"], r["c"], r["z"]) for r in df.select("k", street.alias("s"), city.alias("c"), zip_code.alias("z")).collect()}
    for k, (_, want) in cases.items():
        assert got[k] == want, k


def test_exact_ratio_rounding(spark):
    df = spark.createDataFrame(
        [(Decimal("0.25"), 2), (Decimal("0.05"), 2), (Decimal("-0.25"), 2), (Decimal("2.00"), 3), (Decimal("1.00"), 8)],
        "s decimal(18,2), n int",
    )
    got = [r["r"] for r in df.select(exprs.exact_ratio("s", "n", 2).alias("r")).collect()]
    # 0.125 -> 0.13, 0.025 -> 0.03, -0.125 -> -0.13, 0.666.. -> 0.67, 0.125 -> 0.13
    assert got == [Decimal("0.13"), Decimal("0.03"), Decimal("-0.13"), Decimal("0.67"), Decimal("0.13")]


def test_year_range_matches_year(spark):
    days = [dt.date(2022, 12, 31), dt.date(2023, 1, 1), dt.date(2023, 12, 31), dt.date(2024, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r["d"] for r in df.where(exprs.year_range("d", 2023)).orderBy("d").collect()] == days[1:3]


def test_christmas_filter(spark):
    days = [dt.date(2023, 12, 25), dt.date(2023, 12, 24), dt.date(2024, 12, 25), dt.date(2023, 11, 25)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert sorted(r["d"] for r in df.where(exprs.is_christmas("d")).collect()) == [dt.date(2023, 12, 25), dt.date(2024, 12, 25)]
