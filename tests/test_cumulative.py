"""Hand fixture for keys that skip periods, chain = closed form, idempotent reruns."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import cumulative as cum
from tallyhouse.schemas import SALES_DETAILS
from tallyhouse.session import scratch_path

from conftest import rows


def sd_row(sales_id, customer, day, amount, qty=1, category=1, region=1, discount="0.10"):
    return (sales_id, customer, category, Decimal("1.00"), qty, Decimal(discount), Decimal(amount), 1, day, region)


@pytest.fixture(scope="module")
def skip_sales(spark):
    """A: every year; B: first year only; C: first and third; D: last only (2023-2025)."""
    d = dt.date
    data = [
        sd_row(1, 1, d(2023, 3, 1), "10.00"),
        sd_row(2, 1, d(2024, 3, 1), "20.00"),
        sd_row(3, 1, d(2025, 3, 1), "30.00", qty=2),
        sd_row(4, 2, d(2023, 5, 1), "5.00"),
        sd_row(5, 3, d(2023, 6, 1), "7.00"),
        sd_row(6, 3, d(2025, 6, 1), "8.00"),
        sd_row(7, 4, d(2025, 7, 1), "9.00"),
    ]
    return spark.createDataFrame(data, SALES_DETAILS)


EXPECTED_REVENUE = [
    (1, Decimal("10.00"), 2023), (1, Decimal("30.00"), 2024), (1, Decimal("60.00"), 2025),
    (2, Decimal("5.00"), 2023), (2, Decimal("5.00"), 2024), (2, Decimal("5.00"), 2025),
    (3, Decimal("7.00"), 2023), (3, Decimal("7.00"), 2024), (3, Decimal("15.00"), 2025),
    (4, Decimal("9.00"), 2025),
]


def test_backfill_carries_skipped_keys_forward(skip_sales):
    assert rows(cum.backfill(skip_sales, cum.CUSTOMER_REVENUE)) == sorted(EXPECTED_REVENUE, key=lambda t: tuple(map(str, t)))


def test_chain_equals_backfill_and_rerun_is_idempotent(spark, skip_sales):
    path = scratch_path(spark, "chain_revenue")
    chained = rows(cum.run_chain(spark, skip_sales, cum.CUSTOMER_REVENUE, [2023, 2024, 2025], path))
    assert chained == rows(cum.backfill(skip_sales, cum.CUSTOMER_REVENUE))
    # rerunning a period replaces its partition instead of adding rows
    again = cum.run_chain(spark, skip_sales, cum.CUSTOMER_REVENUE, [2024], path)
    assert rows(again) == chained


def test_daily_step_carries_category_forward(spark):
    d = dt.date
    sales = spark.createDataFrame(
        [sd_row(1, 1, d(2023, 1, 1), "1.00", category=1), sd_row(2, 1, d(2023, 1, 3), "2.00", category=1, qty=3),
         sd_row(3, 1, d(2023, 1, 2), "4.00", category=2)],
        SALES_DETAILS,
    )
    got = rows(cum.backfill(sales, cum.PRODUCT_SALES), "category_id", "cumulative_quantity", "cumulative_sales", "present_date")
    assert got == sorted(
        [
            (1, 1, Decimal("1.00"), d(2023, 1, 1)),
            (1, 1, Decimal("1.00"), d(2023, 1, 2)),
            (1, 4, Decimal("3.00"), d(2023, 1, 3)),
            (2, 1, Decimal("4.00"), d(2023, 1, 2)),
            (2, 1, Decimal("4.00"), d(2023, 1, 3)),
        ],
        key=lambda t: tuple(map(str, t)),
    )
    path = scratch_path(spark, "chain_daily")
    chained = cum.run_chain(spark, sales, cum.PRODUCT_SALES, [d(2023, 1, 1), d(2023, 1, 2), d(2023, 1, 3)], path)
    assert rows(chained) == rows(cum.backfill(sales, cum.PRODUCT_SALES))


def test_two_key_table_and_names(spark, skip_sales):
    pc = spark.createDataFrame([(1, "Books")], "category_id int, category string")
    rg = spark.createDataFrame([(1, "Europe")], "region_id int, region_name string")
    table = cum.backfill(skip_sales, cum.REGION_PRODUCT_SALES, cum.name_joiner(pc, rg))
    assert rows(table) == [
        (1, "Europe", 1, "Books", Decimal("22.00"), 2023),
        (1, "Europe", 1, "Books", Decimal("42.00"), 2024),
        (1, "Europe", 1, "Books", Decimal("89.00"), 2025),
    ]
    assert cum.lookup(table, product_category="Books", current_year=2024).count() == 1


def test_customer_sales_arrays_and_transitions(spark, skip_sales):
    customer = spark.createDataFrame([(i, f"C-{i}") for i in range(1, 5)], "customer_id int, customer_no string")
    table = cum.backfill_customer_sales(skip_sales, customer)
    last = {r["customer_id"]: [s["sales_year"] for s in r["sales_stats"]] for r in table.where("current_year = 2025").collect()}
    assert last == {1: [2023, 2024, 2025], 2: [2023], 3: [2023, 2025], 4: [2025]}
    stats_2025 = [s for s in table.where("customer_id = 1 AND current_year = 2025").first()["sales_stats"]][-1]
    assert (stats_2025["total_amount_spent"], stats_2025["total_qty_purchased"]) == (30.0, 2)
    assert abs(stats_2025["total_discount"] - 0.1) < 1e-6
    states = {(r["customer_id"], r["current_year"]): r["transition_state"] for r in cum.transition_analysis(table).collect()}
    assert states == {
        (1, 2023): "New", (1, 2024): "Retained", (1, 2025): "Retained",
        (2, 2023): "New", (2, 2024): "Churned", (2, 2025): "Stale",
        (3, 2023): "New", (3, 2024): "Churned", (3, 2025): "Resurrected",
        (4, 2025): "New",
    }
    path = scratch_path(spark, "chain_customer_sales")
    chained = cum.run_customer_sales_chain(spark, skip_sales, customer, [2023, 2024, 2025], path)
    assert rows(chained) == rows(table)
    flat = rows(cum.flatten_customer_sales(table, 2025), "customer_no", "sales_year")
    assert flat == sorted([("C-1", 2023), ("C-1", 2024), ("C-1", 2025), ("C-2", 2023), ("C-3", 2023), ("C-3", 2025), ("C-4", 2025)])
    assert cum.unnest_customer_sales(table, 2025).count() == 7


def test_chain_equals_backfill_on_driver_data(spark, wh):
    sd = wh.table("sales_details")
    years = [r[0] for r in sd.select(F.year("invoice_date")).distinct().orderBy(1).collect()]
    names = cum.name_joiner(wh.table("product_category"), wh.table("region"))
    for spec in (cum.CUSTOMER_PRODUCT_ENGAGE, cum.REGION_PRODUCT_SALES):
        path = scratch_path(spark, f"chain_{spec.name}")
        chained = cum.run_chain(spark, sd, spec, years, path, names)
        closed = cum.backfill(sd, spec, names)
        assert chained.exceptAll(closed).count() == 0 and closed.exceptAll(chained).count() == 0
    # daily table: the first five days chained equal the closed form on those days
    days = [r[0] for r in sd.select("invoice_date").distinct().orderBy("invoice_date").limit(5).collect()]
    span = [days[0] + dt.timedelta(days=i) for i in range((days[-1] - days[0]).days + 1)]
    path = scratch_path(spark, "chain_daily_driver")
    chained = cum.run_chain(spark, sd, cum.PRODUCT_SALES, span, path, names)
    closed = cum.backfill(sd, cum.PRODUCT_SALES, names).where(F.col("present_date") <= span[-1])
    assert rows(chained) == rows(closed)


def test_last_period_totals_equal_grand_totals(wh):
    sd = wh.table("sales_details")
    table = cum.backfill(sd, cum.CUSTOMER_REVENUE)
    last = table.agg(F.max("current_year")).first()[0]
    assert table.where(F.col("current_year") == last).agg(F.sum("cum_amount_spent")).first()[0] == sd.agg(F.sum("amount")).first()[0]


def test_bucketed_chain_has_no_shuffle_and_equals_closed_form(spark, wh):
    sales_table = wh.build_bucketed_sales(4)
    sd = wh.table("sales_details")
    years = [r[0] for r in sd.select(F.year("invoice_date")).distinct().orderBy(1).collect()]
    for spec in (cum.CUSTOMER_REVENUE, cum.CUSTOMER_PRODUCT_ENGAGE):
        table = f"{wh.database}.{spec.name}_chain"
        path = scratch_path(spark, f"bucketed_{spec.name}")
        names = cum.name_joiner(wh.table("product_category"))
        chained = cum.run_bucketed_chain(spark, sales_table, spec, years, table, path, 4, names)
        closed = cum.backfill(sd, spec, names)
        assert chained.exceptAll(closed).count() == 0 and closed.exceptAll(chained).count() == 0
        # one more step planned on the bucketed layout: no Exchange in the join / aggregation
        prior = spark.table(table).where(F.col("current_year") == years[-1])
        step = cum.cumulate_step(cum.period_totals(spark.table(sales_table), spec, years[-1] + 1), prior, spec, years[-1] + 1)
        plan = step._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
        assert "PartitionFilters: [isnotnull(current_year" in plan
        assert "PartitionFilters: [isnotnull(sale_year" in plan  # one year of the sales is read


def test_bucket_skew_guard(spark):
    from tallyhouse.plans.warehouse import bucket_skew

    even = spark.range(0, 8000).select(F.col("id").cast("int").alias("customer_id"))
    assert bucket_skew(even, "customer_id", 8) < 1.5
    hot = even.unionByName(spark.range(0, 4000).select(F.lit(7).alias("customer_id")))  # one id: a third of the rows
    assert bucket_skew(hot, "customer_id", 8) > 2.5


def test_late_sale_refresh_equals_full_backfill(spark, skip_sales):
    path = scratch_path(spark, "late_refresh")
    cum.run_chain(spark, skip_sales, cum.CUSTOMER_REVENUE, [2023, 2024, 2025], path)
    late = spark.createDataFrame(
        [sd_row(8, 2, dt.date(2024, 8, 1), "100.00"), sd_row(9, 5, dt.date(2024, 9, 1), "1.00")], SALES_DETAILS
    )
    sales = skip_sales.unionByName(late)
    refreshed = rows(cum.refresh_from(spark, sales, cum.CUSTOMER_REVENUE, path, 2024))
    assert refreshed == rows(cum.backfill(sales, cum.CUSTOMER_REVENUE))
    # the untouched earlier period is as it was; a rerun changes nothing
    assert rows(cum.refresh_from(spark, sales, cum.CUSTOMER_REVENUE, path, 2024)) == refreshed
    days = spark.createDataFrame(
        [sd_row(1, 1, dt.date(2023, 1, 1), "1.00"), sd_row(2, 1, dt.date(2023, 1, 4), "2.00")], SALES_DETAILS
    )
    dpath = scratch_path(spark, "late_refresh_daily")
    cum.run_chain(spark, days, cum.PRODUCT_SALES, [dt.date(2023, 1, i) for i in range(1, 5)], dpath)
    late_days = days.unionByName(spark.createDataFrame([sd_row(3, 1, dt.date(2023, 1, 2), "5.00", category=2)], SALES_DETAILS))
    got = rows(cum.refresh_from(spark, late_days, cum.PRODUCT_SALES, dpath, dt.date(2023, 1, 2)))
    assert got == rows(cum.backfill(late_days, cum.PRODUCT_SALES))


def test_sparse_form_reads_like_dense(spark, wh, skip_sales):
    for sales, spec in ((skip_sales, cum.CUSTOMER_REVENUE), (wh.table("sales_details"), cum.CUSTOMER_PRODUCT_ENGAGE)):
        dense = cum.backfill(sales, spec)
        sparse = cum.backfill_sparse(sales, spec)
        assert sparse.count() <= dense.count()
        for period in [r[0] for r in dense.select(spec.period_col).distinct().collect()]:
            assert rows(cum.as_of(sparse, spec, period)) == rows(dense.where(F.col(spec.period_col) == period))
    days = spark.createDataFrame(
        [sd_row(1, 1, dt.date(2023, 1, 1), "1.00"), sd_row(2, 1, dt.date(2023, 1, 9), "2.00"), sd_row(3, 1, dt.date(2023, 1, 3), "4.00", category=2)],
        SALES_DETAILS,
    )
    dense = cum.backfill(days, cum.PRODUCT_SALES)
    sparse = cum.backfill_sparse(days, cum.PRODUCT_SALES)
    assert sparse.count() == 3 and dense.count() == 16
    assert rows(cum.as_of(sparse, cum.PRODUCT_SALES, dt.date(2023, 1, 5))) == rows(dense.where(F.col("present_date") == dt.date(2023, 1, 5)))


def test_bucketed_customer_sales_chain(spark, wh):
    sales_table = wh.build_bucketed_sales(4)
    sd, customer = wh.table("sales_details"), wh.table("customer")
    years = [r[0] for r in sd.select(F.year("invoice_date")).distinct().orderBy(1).collect()]
    table = f"{wh.database}.cum_customer_sales_chain"
    chained = cum.run_bucketed_customer_sales_chain(spark, sales_table, customer, years, table, scratch_path(spark, "b_c5"), 4)
    assert rows(chained) == rows(cum.backfill_customer_sales(sd, customer))
    prior = spark.table(table).where(F.col("current_year") == years[-1])
    step = cum.customer_sales_step(spark.table(sales_table), prior, customer, years[-1] + 1)
    plan = step._jdf.queryExecution().executedPlan().toString()
    # the customer numbers are a checked broadcast here; the full join itself needs no shuffle
    assert "Exchange hashpartitioning" not in plan, plan


def test_stored_cumulative_tables_then_one_more_step(spark, wh):
    from tallyhouse.sources import tables as store

    wh.build_cumulative()
    sd = wh.table("sales_details")
    names = cum.name_joiner(wh.table("product_category"), wh.table("region"))
    for spec in (cum.REGION_PRODUCT_SALES, cum.CUSTOMER_PRODUCT_ENGAGE, cum.CUSTOMER_REVENUE):
        assert rows(store.read_table(spark, wh.path(spec.name), spec.schema)) == rows(cum.backfill(sd, spec, names))
    stored_c5 = store.read_table(spark, wh.path("cum_customer_sales"), cum.CUM_CUSTOMER_SALES)
    assert rows(stored_c5) == rows(cum.backfill_customer_sales(sd, wh.table("customer")))
    # the next year (no sales yet) appended by a C0 step: every customer carried forward
    last = cum.last_period(sd, "year")
    after = cum.run_chain(spark, sd, cum.CUSTOMER_REVENUE, [last + 1], wh.path("cum_customer_revenue"))
    nxt = after.where(F.col("current_year") == last + 1)
    prev = after.where(F.col("current_year") == last)
    assert rows(nxt, "customer_id", "cum_amount_spent") == rows(prev, "customer_id", "cum_amount_spent")
