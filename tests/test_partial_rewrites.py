"""Tables that are rewritten or read in part: keyed upsert, bucketed address history, the fact by year, NOT IN."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import scd2, upsert
from tallyhouse.plans import joins, questions
from tallyhouse.schemas import CUSTOMER_ADDRESS, FACT_SALES, SALE_KEYED, SALE_YEAR
from tallyhouse.session import scratch_path
from tallyhouse.sources import tables as store

from conftest import rows
from test_late_data import part_files


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# -- keyed upsert -----------------------------------------------------------------------------------
def keyed(t, year, quantity, customer=1):
    return (t, f"{year}-01-01", customer, quantity, Decimal("1.00"), year)


def batch_of(spark, data, *flags):
    df = spark.createDataFrame(data, SALE_KEYED)
    return df.withColumn("deleted", F.col("transaction_id").isin(*flags)) if flags else df


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "upsert")
    upsert.upsert(spark, path, batch_of(spark, [keyed(t, 2020 + t % 4, 1) for t in range(1, 13)]), ["transaction_id"], SALE_YEAR, SALE_KEYED)
    return path


def apply(spark, path, batch, **kw):
    return upsert.upsert(spark, path, batch, ["transaction_id"], SALE_YEAR, SALE_KEYED, **kw)


def test_upsert_replaces_inserts_moves_and_deletes(spark, table):
    old = part_files(spark, table)
    # 1 changes, 5 moves from 2021 to 2022, 99 is new there, 9 goes
    batch = batch_of(spark, [keyed(1, 2021, 7), keyed(5, 2022, 7), keyed(99, 2022, 7), keyed(9, 2021, 7)], 9)
    want = {r[0]: r for r in [keyed(t, 2020 + t % 4, 1) for t in range(1, 13)] + [keyed(1, 2021, 7), keyed(5, 2022, 7), keyed(99, 2022, 7)]}
    del want[9]
    for _ in range(2):
        apply(spark, table, batch)
        got = store.read_table(spark, table, SALE_KEYED)
        assert rows(got) == sorted(want.values(), key=lambda t: tuple(map(str, t)))
    new = part_files(spark, table)
    assert {y: new[y] == old[y] for y in old} == {"sale_year=2020": True, "sale_year=2021": False, "sale_year=2022": False, "sale_year=2023": True}


def test_upsert_drops_a_partition_that_runs_empty(spark, table):
    year = [t for t in range(1, 13) if t % 4 == 3]
    apply(spark, table, batch_of(spark, [keyed(t, 2020, 2) for t in year]))
    got = store.read_table(spark, table, SALE_KEYED)
    assert got.count() == 12 and "sale_year=2023" not in part_files(spark, table)
    apply(spark, table, batch_of(spark, [keyed(t, 2020, 2) for t in range(1, 13)], *range(1, 13)))
    assert store.read_table(spark, table, SALE_KEYED).count() == 0


def test_upsert_keeps_the_last_row_of_a_key_and_rejects_null_keys(spark, table):
    batch = batch_of(spark, [keyed(1, 2021, 3), keyed(1, 2021, 9), keyed(1, 2021, 5), (None, "x", 1, 1, None, 2021)])
    rejected = apply(spark, table, batch, order=["quantity"])
    assert [r["reject_reason"] for r in rejected.collect()] == ["null_key"]
    got = store.read_table(spark, table, SALE_KEYED).where("transaction_id = 1").collect()
    assert [r["quantity"] for r in got] == [9]
    apply(spark, table, batch.limit(0))  # an empty batch
    assert store.read_table(spark, table, SALE_KEYED).count() == 12


def test_upsert_of_a_null_partition(spark, table):
    apply(spark, table, batch_of(spark, [(77, None, 1, 1, None, None)]))
    apply(spark, table, batch_of(spark, [keyed(77, 2022, 4)]))
    got = store.read_table(spark, table, SALE_KEYED).where("transaction_id = 77").collect()
    assert [(r["quantity"], r[SALE_YEAR]) for r in got] == [(4, 2022)]


def test_upsert_reads_only_touched_partitions_and_key_columns(spark, table):
    stored = store.read_table(spark, table, SALE_KEYED)
    plan = plan_of(upsert.in_partitions(stored, SALE_YEAR, {2021, 2022}))
    assert "PartitionFilters: [sale_year" in plan and "2021,2022" in plan.replace(" ", "")
    keys = stored.join(F.broadcast(stored.select("transaction_id").limit(3)), "transaction_id", "left_semi").select(SALE_YEAR)
    assert "ReadSchema: struct<transaction_id:bigint>" in plan_of(keys)


# -- address history by bucket -----------------------------------------------------------------------
def test_a_batch_rewrites_only_its_buckets(spark):
    day = dt.date(2024, 1, 1)
    history = spark.createDataFrame([(c, 10 + c, day, None, True) for c in range(1, 200)], CUSTOMER_ADDRESS)
    stored = scd2.StoredHistory(scratch_path(spark, "history"), 16)
    stored.create(history)
    old = part_files(spark, stored.path)
    batch = spark.createDataFrame([(3, 500, dt.date(2024, 3, 1)), (3, 501, dt.date(2024, 2, 1)), (4, 14, dt.date(2024, 2, 1))], "customer_id int, address_id int, change_date date")
    touched = {f"{scd2.BUCKET}={r[0]}" for r in batch.select(stored.bucket()).collect()}
    want = rows(scd2.apply_scd2(history, batch)[0])
    for _ in range(2):
        stored.apply(batch)
        assert rows(stored.read(spark)) == want
        new = part_files(spark, stored.path)
        assert {b for b in old if new[b] != old[b]} == touched and len(touched) < 3
    assert scd2.scd2_violations(stored.read(spark)).count() == 0
    known = spark.createDataFrame([(5,)], "customer_id int")
    late_rows = spark.createDataFrame([(5, 1, None), (999, 1, day)], batch.schema)
    reasons = sorted(r["reject_reason"] for r in stored.apply(late_rows, known).collect())
    assert reasons == ["fk:customer_id", "not_null:change_date"] and rows(stored.read(spark)) == want
    assert stored.apply(batch.limit(0)).count() == 0


def test_a_batch_reads_only_its_buckets(spark):
    stored = scd2.StoredHistory(scratch_path(spark, "history"), 4)
    stored.create(spark.createDataFrame([(c, c, dt.date(2024, 1, 1), None, True) for c in range(1, 20)], CUSTOMER_ADDRESS))
    plan = plan_of(store.read_table(spark, stored.path, scd2._STORED).where(F.col(scd2.BUCKET).isin([2])))
    assert "PartitionFilters: [isnotnull(customer_bucket" in plan


# -- the fact by year ----------------------------------------------------------------------------------
def star_of(wh):
    return wh.table("fact_sales"), wh.table("dim_region"), wh.table("dim_product_category"), wh.table("dim_date")


def test_a_question_for_one_year_reads_one_partition(spark, wh):
    fact, region, category, date = star_of(wh)
    assert fact.columns == [*FACT_SALES.names, SALE_YEAR]
    got = questions.avg_quarterly_revenue(fact, region, category, date.where("year = 1997"))
    plan = plan_of(got)
    assert "sale_year" in plan.split("PartitionFilters: [", 1)[1].split("]")[0] and "= 1997)" in plan
    whole = questions.avg_quarterly_revenue(fact, region, category, date)
    assert rows(got) == rows(whole.where("year = 1997"))


def test_a_question_for_some_days_prunes_the_fact_at_run_time(spark, wh):
    fact, region, category, date = star_of(wh)
    days = questions.of_dates(date, dt.date(1996, 11, 5), dt.date(1997, 2, 10))
    got = questions.avg_quarterly_revenue(fact, region, category, days)
    assert "dynamicpruning" in plan_of(got)
    got.collect()
    scans = [s for s in executed_nodes(got) if "sale_year" in s.output().mkString(",") and "FileSourceScan" in s.getClass().getName()]
    assert [s.metrics().get("numPartitions").get().value() for s in scans] == [2]


def executed_nodes(df):
    """The physical operators of an executed query, inside adaptive stages as well."""
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        out.append(node)
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


# -- NOT IN -------------------------------------------------------------------------------------------
@pytest.mark.parametrize("known", [[1, 2], [1, None], [None], []])
@pytest.mark.parametrize("bound", [100, 0])
def test_not_in_follows_sql(spark, known, bound):
    left = spark.createDataFrame([(1,), (3,), (3,), (None,)], "x int")
    right = spark.createDataFrame([(k,) for k in known], "y int")
    left.createOrReplaceTempView("not_in_left")
    right.createOrReplaceTempView("not_in_right")
    want = rows(spark.sql("SELECT x FROM not_in_left WHERE x NOT IN (SELECT y FROM not_in_right)"))
    assert rows(joins.not_in(left, "x", right, "y", bound)) == want
    assert want == {(1, 2): [(3,), (3,)], (1, None): [], (None,): [], (): [(1,), (3,), (3,), (None,)]}[tuple(known)]


def test_not_in_plans(spark, wh):
    dates, known = wh.table("sales_details").select("invoice_date").distinct(), wh.table("dim_date")
    small = plan_of(joins.not_in(dates, "invoice_date", known, "full_date", 10**6))
    line = next(x for x in small.splitlines() if "LeftAnti" in x)
    assert "BroadcastHashJoin" in line and line.rstrip().rstrip(")").endswith("true")  # null-aware
    large = plan_of(joins.not_in(dates, "invoice_date", known, "full_date", 0))
    assert "NestedLoop" not in large and "Cartesian" not in large and "SortMergeJoin" in large
