"""W1-W6, B1-B3, V1 on hand fixtures and invariants on the driver data."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import star
from tallyhouse.plans import questions
from tallyhouse.schemas import SALES_DETAILS

from conftest import rows


def sd_row(sales_id, day, amount, region=1, category=1, method=1, customer=1):
    return (sales_id, customer, category, Decimal("1.00"), 1, Decimal("0.00"), Decimal(amount), method, day, region)


@pytest.fixture(scope="module")
def lookups(spark):
    return {
        "customer": spark.createDataFrame([(1, "C-1", "F")], "customer_id int, customer_no string, gender string"),
        "product_category": spark.createDataFrame([(1, "Books")], "category_id int, category string"),
        "region": spark.createDataFrame([(1, "Europe"), (2, "Asia")], "region_id int, region_name string"),
        "payment_method": spark.createDataFrame(
            [(1, "Credit Card"), (2, "Debit Card"), (3, "Gift Card"), (4, "PayPal"), (5, "Voucher")],
            "method_id int, payment_method string",
        ),
    }


def build_star(sd, lk):
    dd = star.build_dim_date(sd)
    dims = dict(
        dim_date=dd,
        dim_customer=star.build_dim_customer(sd, lk["customer"]),
        dim_product_category=star.build_dim_product_category(sd, lk["product_category"]),
        dim_region=star.build_dim_region(sd, lk["region"]),
        dim_payment_method=star.build_dim_payment_method(sd, lk["payment_method"]),
    )
    return dims, star.build_fact_sales(sd, **dims)


def test_b1_averages_rows_b2_averages_quarter_totals(spark, lookups):
    d = dt.date
    sd = spark.createDataFrame(
        [sd_row(1, d(2023, 1, 10), "10.00"), sd_row(2, d(2023, 2, 10), "20.00"), sd_row(3, d(2023, 4, 10), "100.00"),
         sd_row(4, d(2023, 10, 1), "1.00"), sd_row(5, d(2023, 7, 1), "3.00")],
        SALES_DETAILS,
    )
    dims, fact = build_star(sd, lookups)
    b1 = questions.avg_quarterly_revenue(fact, dims["dim_region"], dims["dim_product_category"], dims["dim_date"])
    # ordered by the quarter *name*: First, Fourth, Second, Third
    assert [tuple(r) for r in b1.collect()] == [
        (2023, "First", "Europe", "Books", Decimal("15.00")),
        (2023, "Fourth", "Europe", "Books", Decimal("1.00")),
        (2023, "Second", "Europe", "Books", Decimal("100.00")),
        (2023, "Third", "Europe", "Books", Decimal("3.00")),
    ]
    b2 = questions.avg_of_quarter_totals(fact, dims["dim_region"], dims["dim_product_category"], dims["dim_date"])
    # (30 + 100 + 1 + 3) / 4 quarters = 33.50
    assert [tuple(r) for r in b2.collect()] == [("Europe", "Books", 4, Decimal("33.50"))]


def test_dim_date_columns(spark, lookups):
    d = dt.date
    sd = spark.createDataFrame([sd_row(1, d(2024, 2, 29), "1.00"), sd_row(2, d(2023, 12, 25), "1.00")], SALES_DETAILS)
    dd = {r["full_date"]: r for r in star.build_dim_date(sd).collect()}
    leap = dd[d(2024, 2, 29)]
    assert (leap["date_key"], leap["year"], leap["quarter"], leap["quarter_name"], leap["month"]) == (2, 2024, 1, "First", 2)
    assert (leap["month_name"], leap["day_of_month"], leap["day_of_week"], leap["day_name"], leap["is_holiday"]) == (
        "February ", 29, 4, "Thursday ", False)
    xmas = dd[d(2023, 12, 25)]
    assert (xmas["date_key"], xmas["quarter_name"], xmas["day_of_week"], xmas["day_name"]) == (1, "Fourth", 1, "Monday   ")


def test_christmas_view_fifth_method(spark, lookups):
    d = dt.date
    sd = spark.createDataFrame(
        [
            sd_row(1, d(2023, 12, 25), "10.00", region=1, method=1),
            sd_row(2, d(2023, 12, 25), "5.00", region=1, method=4),
            sd_row(3, d(2023, 12, 25), "7.00", region=2, method=5),  # only a fifth method: a row of zeros
            sd_row(4, d(2023, 12, 24), "99.00", region=1, method=1),
        ],
        SALES_DETAILS,
    )
    got = [tuple(r) for r in questions.christmas_sales_by_payment_method(sd, lookups["region"]).collect()]
    z = Decimal("0.00")
    assert got == [
        ("Asia", d(2023, 12, 25), z, z, z, z),
        ("Europe", d(2023, 12, 25), Decimal("10.00"), z, z, Decimal("5.00")),
    ]


def test_payment_mix_shares(spark, lookups):
    d = dt.date
    sd = spark.createDataFrame(
        [sd_row(1, d(2023, 1, 1), "1.00", method=1), sd_row(2, d(2023, 1, 1), "2.00", method=2), sd_row(3, d(2023, 1, 2), "0.00", method=2)],
        SALES_DETAILS,
    )
    dims, fact = build_star(sd, lookups)
    got = [tuple(r) for r in questions.payment_mix_by_region(fact, dims["dim_region"], dims["dim_payment_method"]).collect()]
    assert got == [("Europe", "Credit Card", 1, Decimal("1.00"), Decimal("0.3333")), ("Europe", "Debit Card", 2, Decimal("2.00"), Decimal("0.6667"))]


def test_fact_invariants_on_driver_data(wh):
    fact, sd = wh.table("fact_sales"), wh.table("sales_details")
    assert fact.count() == sd.count()
    assert fact.agg(F.sum("sale_amount")).first()[0] == sd.agg(F.sum("amount")).first()[0]
    assert fact.select("sale_key").distinct().count() == fact.count()
    dd = wh.table("dim_date")
    assert sorted(r[0] for r in dd.select("date_key").collect()) == list(range(1, dd.count() + 1))


def test_b1_plan_is_one_scan_and_one_shuffle(wh):
    b1 = questions.avg_quarterly_revenue(wh.table("fact_sales"), wh.table("dim_region"), wh.table("dim_product_category"), wh.table("dim_date"))
    plan = b1._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert rows(b1)  # runs


def test_cluster_settings_apply_and_keep_results(spark, wh):
    from tallyhouse.session import cluster_settings

    def b1():
        return rows(questions.avg_quarterly_revenue(
            wh.table("fact_sales"), wh.table("dim_region"), wh.table("dim_product_category"), wh.table("dim_date")))

    before = b1()
    # runtime SQL settings only (the cleaner flag is read when the context starts)
    settings = {k: v for k, v in cluster_settings(1 << 30, 4).items() if k.startswith("spark.sql.")}
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert b1() == before
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_used_ids_hold_every_dimension_value_from_one_scan(wh):
    sd = wh.table("sales_details")
    used = star.used_ids(sd)
    assert _plan(used).count("FileScan") == 1
    for col in ("invoice_date", "customer_id", "category_id", "region_id", "payment_method_id"):
        got = star.used_column(used, col)
        assert got.schema[col].dataType == sd.schema[col].dataType
        assert sorted(got.collect()) == sorted(sd.select(col).distinct().collect())
    assert star.used_ids(sd.limit(0)).count() == 0


def test_christmas_days_reach_the_scan(wh):
    sd, region = wh.table("sales_details"), wh.table("region")
    days = questions.christmas_days(wh.table("dim_date"))
    assert days and all((d.month, d.day) == (12, 25) for d in days)
    listed = questions.christmas_sales_by_payment_method(sd, region, days)
    assert rows(listed) == rows(questions.christmas_sales_by_payment_method(sd, region))
    assert "In(invoice_date" in _plan(listed)
    assert questions.christmas_sales_by_payment_method(sd, region, []).count() == 0


def test_stored_reads_prune_periods_without_a_window(wh):
    import __spark_entry__ as entry
    from tallyhouse.operators import cumulative as cum

    last = entry._years(wh)[-1]
    table = entry._stored(wh, "cum_customer_sales")
    for df in (cum.unnest_customer_sales(table, last), cum.flatten_customer_sales(table, last)):
        plan = _plan(df)
        assert "PartitionFilters: [isnotnull(current_year" in plan and "Window" not in plan
        assert df.count() > 0
