"""Transitions, trends and segments from stored totals; feeds with faults; batches that commit as one; nested text."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, StructField, StructType, StringType, ArrayType, IntegerType

from tallyhouse.functions.exprs import with_canonical_text
from tallyhouse.operators import cumulative as cum
from tallyhouse.operators import segments
from tallyhouse.plans import atomic_ingest, faults
from tallyhouse.schemas import FAKE_CUSTOMER_NAMES, RETAIL_SALES, SALE_SUBMISSION, SALES_DETAILS
from tallyhouse.session import scratch_path
from tallyhouse.sources import csv as csv_source
from tallyhouse.sources import tables as store

from conftest import rows
from test_late_data import sale

D = dt.date


@pytest.fixture(scope="module")
def skip_sales(spark):
    """1: every year; 2: first only; 3: first and last two; 4: last only; 5: second, then never."""
    days = {1: (2021, 2022, 2023, 2024), 2: (2021,), 3: (2021, 2023, 2024), 4: (2024,), 5: (2022,)}
    data = [sale(10 * c + i, c, D(y, 3, 1), f"{5 * c + i}.00", qty=i + 1) for c, years in days.items() for i, y in enumerate(years)]
    return spark.createDataFrame(data, SALES_DETAILS)


# -- transitions -------------------------------------------------------------------------------------
def test_states_from_totals_equal_states_from_arrays(spark, skip_sales):
    customer = spark.createDataFrame([(i, f"C-{i}") for i in range(1, 6)], "customer_id int, customer_no string")
    want = rows(cum.transition_analysis(cum.backfill_customer_sales(skip_sales, customer)))
    assert {r[2] for r in want} == set(cum.TRANSITION_STATES)
    revenue = cum.backfill(skip_sales, cum.CUSTOMER_REVENUE)
    assert rows(cum.transition_states(revenue, cum.CUSTOMER_REVENUE)) == want
    for year in (2021, 2022, 2023, 2024):
        assert rows(cum.transition_states_of(revenue, cum.CUSTOMER_REVENUE, year)) == [r for r in want if r[1] == year]


def test_states_by_two_keys_and_by_day(spark):
    data = [sale(1, 1, D(2024, 1, 1), "1.00"), sale(2, 1, D(2024, 1, 2), "1.00"), sale(3, 1, D(2024, 1, 5), "1.00"), sale(4, 1, D(2024, 1, 5), "1.00", category=2)]
    daily = cum.transition_states(cum.backfill(spark.createDataFrame(data, SALES_DETAILS), cum.PRODUCT_SALES), cum.PRODUCT_SALES)
    got = {(r["category_id"], r["present_date"].day): r["transition_state"] for r in daily.collect()}
    assert got == {(1, 1): "New", (1, 2): "Retained", (1, 3): "Churned", (1, 4): "Stale", (1, 5): "Resurrected", (2, 5): "New"}


def test_states_of_bucketed_tables_need_no_shuffle(spark, wh):
    db = store.ensure_database(spark, "th_states", scratch_path(spark, "states_db"))
    table = f"{db}.engage"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    engage = cum.backfill(wh.table("sales_details"), cum.CUSTOMER_PRODUCT_ENGAGE)
    store.save_bucketed(engage, table, scratch_path(spark, "engage"), ("customer_id",), 4, ("current_year",))
    spec, stored = cum.CUSTOMER_PRODUCT_ENGAGE, spark.table(table)
    last = stored.agg(F.max("current_year").alias("y")).first()["y"]
    one = cum.transition_states_of(stored, spec, last)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("PartitionFilters: [isnotnull(current_year") == 3
    assert rows(one) == [r for r in rows(cum.transition_states(engage, spec)) if r[2] == last]


# -- trends and segments -------------------------------------------------------------------------------
def test_trend_reads_gains_from_totals(spark, skip_sales):
    got = cum.trend(cum.backfill(skip_sales, cum.CUSTOMER_REVENUE), cum.CUSTOMER_REVENUE)
    by = {(r["customer_id"], r["current_year"]): (r["cum_amount_spent_gain"], r["cum_amount_spent_growth"]) for r in got.collect()}
    d = Decimal
    assert [by[(1, y)] for y in range(2021, 2025)] == [(d("5.00"), None), (d("6.00"), d("20.00")), (d("7.00"), d("16.67")), (d("8.00"), d("14.29"))]
    assert [by[(3, y)] for y in range(2021, 2025)] == [(d("15.00"), None), (d("0.00"), d("-100.00")), (d("16.00"), None), (d("17.00"), d("6.25"))]


@pytest.mark.parametrize("n_customers", [1, 7, 23])
def test_segments_follow_ntile(spark, n_customers):
    data, k = [], 0
    for c in range(1, n_customers + 1):
        for y in range(2020, 2020 + c % 5 + 1):
            k += 1
            data.append(sale(k, c, D(y, 1, 1), f"{(c * 37) % 11 + 1}.00", qty=(c * 5) % 7 + 1))
    sd = spark.createDataFrame(data, SALES_DETAILS)
    customer = spark.createDataFrame([(i, f"C-{i}") for i in range(1, n_customers + 1)], "customer_id int, customer_no string")
    last = max(r[8].year for r in data)
    got = segments.customer_segments(cum.backfill_customer_sales(sd, customer), cum.backfill(sd, cum.CUSTOMER_REVENUE), last)
    got.createOrReplaceTempView("segments_got")
    want = spark.sql(
        "SELECT customer_id, ntile(5) OVER (ORDER BY last_year, customer_id) r, ntile(5) OVER (ORDER BY quantity, customer_id) f, "
        "ntile(5) OVER (ORDER BY cum_amount_spent, customer_id) v FROM segments_got"
    )
    assert rows(got, "customer_id", "recency_band", "frequency_band", "value_band") == rows(want)
    for r in got.collect():
        mean = (r["frequency_band"] + r["value_band"]) / 2
        if r["recency_band"] == 5 and mean >= 4:
            assert r["segment"] == "Champions"
        elif r["recency_band"] <= 2 and mean < 3:
            assert r["segment"] == "Lost"


# -- feeds with faults ---------------------------------------------------------------------------------
def test_checked_load_splits_a_file(spark, tmp_path):
    lines = ["name", "plain", '"quoted, comma"', 'two, columns', '"open', 'half"', "", '"with ""inner"" quotes"', "  kept blanks  ", "é"]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "a" / "two.csv").write_text("name\nother\nx,y,z\n")
    good, bad = csv_source.load_checked(spark, str(tmp_path / "a"), FAKE_CUSTOMER_NAMES)
    assert rows(good) == sorted([("plain",), ("quoted, comma",), ('with "inner" quotes',), ("  kept blanks  ",), ("é",), ("other",)])
    got = {(os.path.basename(r["source_file"]), r["raw_line"], r["reject_reason"]) for r in bad.collect()}
    assert got == {
        ("one.csv", "two, columns", "columns:2"), ("one.csv", '"open', "open_quote"), ("one.csv", 'half"', "open_quote"), ("two.csv", "x,y,z", "columns:3"),
    }


def test_checked_load_of_a_sales_feed_keeps_the_good_rows(spark, wh):
    staged = wh.table("retail_sales")
    path = scratch_path(spark, "feed")
    csv_source.write_lines(faults.faulty_sales_feed(staged), path, "sale", "feed")
    good, bad = csv_source.load_checked(spark, path, RETAIL_SALES)
    case = F.col("transaction_id") % faults.FAULT_CYCLE
    assert good.dtypes == staged.dtypes
    assert rows(good.where(case != 6)) == rows(staged.where(case > 6))
    quoted = good.where(case == 6).select("product_category").collect()
    assert quoted and all(r[0].endswith(", quoted") for r in quoted)
    reasons = {r[0] for r in bad.select("reject_reason").distinct().collect()}
    assert reasons == {"columns:12", "columns:14", "bad_value:quantity", "bad_value:price", "bad_value:total_amount", "open_quote"}
    assert good.count() + bad.count() == staged.count() + staged.where(case == 4).count()


# -- one commit for sales and dates -----------------------------------------------------------------------
@pytest.fixture(scope="module")
def refs(spark):
    return {
        "customer": spark.createDataFrame([(1,), (2,)], "customer_id int"),
        "product_category": spark.createDataFrame([(1,)], "category_id int"),
        "payment_method": spark.createDataFrame([(1,)], "method_id int"),
        "region": spark.createDataFrame([(1,)], "region_id int"),
    }


def submission(customer, amount="9.00"):
    return (customer, 1, 1, Decimal("0.10"), Decimal(amount), 1, 1, Decimal("10.00"))


def test_a_crash_between_the_writes_shows_nothing(spark, refs, wh, monkeypatch):
    target, dim_date = atomic_ingest.Target(scratch_path(spark, "atomic")), wh.table("dim_date")
    batch = spark.createDataFrame([submission(1), submission(2)], SALE_SUBMISSION)
    write = atomic_ingest.Target._write

    def crash(self, name, rows_, batch_id):
        if name == "dates":
            raise RuntimeError("crash")
        write(self, name, rows_, batch_id)

    monkeypatch.setattr(atomic_ingest.Target, "_write", crash)
    with pytest.raises(RuntimeError):
        target.ingest(batch, refs, dim_date, 0, D(2030, 1, 1))
    assert target.sales(spark).count() == 0 and target.dates(spark).count() == 0
    monkeypatch.undo()
    monkeypatch.setattr(atomic_ingest.Target, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        target.ingest(batch, refs, dim_date, 0, D(2030, 1, 1))
    assert target.sales(spark).count() == 0 and target.dates(spark).count() == 0
    monkeypatch.undo()
    for _ in range(2):  # run again, and once more after it was committed
        assert target.ingest(batch, refs, dim_date, 0, D(2030, 1, 1)).count() == 0
        assert target.sales(spark).count() == 2
        assert [r["full_date"] for r in target.dates(spark).collect()] == [D(2030, 1, 1)]
    top = dim_date.agg(F.max("date_key").alias("k")).first()["k"]
    target.ingest(batch, refs, dim_date, 1, D(2030, 1, 2))
    assert sorted(r["date_key"] for r in target.dates(spark).collect()) == [top + 1, top + 2]
    ids = [r["sales_id"] for r in target.sales(spark).collect()]
    assert len(set(ids)) == 4


def test_a_batch_with_a_bad_row_commits_nothing(spark, refs, wh):
    target = atomic_ingest.Target(scratch_path(spark, "atomic"))
    mixed = spark.createDataFrame([submission(1), submission(1, "8.00"), submission(99)], SALE_SUBMISSION)
    rejected = target.ingest(mixed, refs, wh.table("dim_date"), 0, D(2030, 1, 1))
    assert sorted(r["reject_reason"] for r in rejected.collect()) == ["amount_mismatch", "batch_rolled_back", "fk:customer_id"]
    assert target.sales(spark).count() == 0 and target.commits(spark).count() == 0


# -- nested values as text ------------------------------------------------------------------------------
def test_canonical_text(spark):
    inner = StructType([StructField("x", IntegerType()), StructField("f", FloatType()), StructField("s", StringType())])
    schema = StructType([StructField("a", ArrayType(inner))])
    df = spark.createDataFrame([([(1, 0.1, 'q"b\\'), None, (None, -2.5, None)],), ([],), (None,)], schema)
    got = [r["a"] for r in with_canonical_text(df, "a").collect()]
    assert got == ['[0:{x=1,f=100000u,s="q\\"b\\\\"},1:null,2:{x=null,f=-2500000u,s=null}]', "[]", "null"]
