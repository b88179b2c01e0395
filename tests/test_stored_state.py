"""Stored tables keep what a step doesn't touch, and missing or replaced input is noticed."""

from __future__ import annotations

import datetime as dt
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tallyhouse.operators import cumulative as cum
from tallyhouse.operators import scd2
from tallyhouse.plans import joins, runs
from tallyhouse.session import scratch_path
from tallyhouse.sources import tables as store
from tallyhouse.streaming import sales_stream
from test_scd2_ingest import refs, sub  # noqa: F401

MODE = "spark.sql.sources.partitionOverwriteMode"


@pytest.fixture
def static(spark):
    before = spark.conf.get(MODE)
    spark.conf.set(MODE, "STATIC")
    yield
    assert spark.conf.get(MODE) == "STATIC"
    spark.conf.set(MODE, before)


def test_insert_period_keeps_other_periods_in_a_static_session(spark, static):
    db = store.ensure_database(spark, "th_static", scratch_path(spark, "static"))
    table = f"{db}.t"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    df = spark.createDataFrame([(1, 10, 2020), (1, 11, 2021)], "k int, v int, y int")
    store.save_bucketed(df, table, scratch_path(spark, "static_t"), ("k",), 2, partition_by=("y",))
    store.insert_period(spark.createDataFrame([(2, 12, 2022)], "k int, v int, y int"), table)
    # and from a plan that reads the table itself
    again = spark.table(table).where("y = 2022").withColumn("y", F.lit(2023)).select("k", "v", "y")
    store.insert_period(again, table)
    assert rows(spark.table(table).select("k", "v", "y")) == [(1, 10, 2020), (1, 11, 2021), (2, 12, 2022), (2, 12, 2023)]


def test_bucketed_chain_in_a_static_session(spark, wh, static):
    sales = wh.build_bucketed_sales(4)
    db = store.ensure_database(spark, wh.database, f"{wh.root}/catalog")
    table = f"{db}.static_chain"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    sd = wh.table("sales_details")
    years = range(cum.first_period(sd, "year"), cum.last_period(sd, "year") + 1)
    got = cum.run_bucketed_chain(spark, sales, cum.CUSTOMER_REVENUE, list(years), table, scratch_path(spark, "static_chain"), 4)
    assert rows(got) == rows(cum.backfill(sd, cum.CUSTOMER_REVENUE))


def test_a_skipped_period_is_an_error(spark, wh):
    sd = wh.table("sales_details")
    first = cum.first_period(sd, "year")
    path = scratch_path(spark, "gap")
    with pytest.raises(ValueError, match="without gaps"):
        cum.run_chain(spark, sd, cum.CUSTOMER_REVENUE, [first, first + 2], path)
    with pytest.raises(ValueError, match="isn't stored"):
        cum.refresh_from(spark, sd, cum.CUSTOMER_REVENUE, scratch_path(spark, "no_base"), first + 2)


def test_only_a_missing_path_reads_as_empty(spark):
    schema = cum.CUSTOMER_REVENUE.schema
    assert store.read_table(spark, scratch_path(spark, "nothing"), schema).count() == 0
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        store.read_table(spark, "nosuchscheme://x/y", schema).count()


def test_replaced_input_is_built_again(spark):
    data = tempfile.mkdtemp(prefix="tallyhouse-in-", dir="/tmp")
    for name in ("region", "nation", "customer", "part", "orders"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", f"{data}/{name}.parquet")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")

    def put(df):
        df.coalesce(1).write.mode("overwrite").parquet(f"{data}/lineitem.parquet")

    put(lines)
    assert runs.warehouse(spark, data).table("retail_sales").count() == lines.count()
    half = lines.where("l_orderkey % 2 = 0")
    put(half)
    assert runs.warehouse(spark, data).table("retail_sales").count() == half.count()
    assert os.path.isdir(data)


def test_size_check_sends_no_rows_to_one_task(spark):
    df = spark.range(0, 1000, 1, 8)
    assert joins.within_rows(df, 1000) and not joins.within_rows(df, 999)


HISTORY = "customer_id int, address_id int, start_date date, end_date date, is_current boolean"
CHANGES = "customer_id int, address_id int, change_date date"


def test_scd2_several_late_and_replayed_moves(spark):
    d = lambda m, day=1: dt.date(2025, m, day)
    history = spark.createDataFrame([(1, 10, d(1), None, True), (2, 10, d(1), None, True), (3, 5, d(1), None, True)], HISTORY)
    both = spark.createDataFrame([(1, 20, d(2)), (1, 30, d(3)), (2, 30, d(3)), (9, 1, None)], CHANGES)
    h, rejected = scd2.apply_scd2(history, both)
    assert [(r["customer_id"], r["reject_reason"]) for r in rejected.collect()] == [(9, "not_null:change_date")]
    late = spark.createDataFrame([(2, 20, d(2)), (1, 20, d(2, 15))], CHANGES)
    for batch in (late, both.where("change_date is not null"), late):  # replays change nothing
        h, _ = scd2.apply_scd2(h.checkpoint(), batch)
    expected = [
        (1, 10, d(1), d(1, 31), False), (1, 20, d(2), d(2, 28), False), (1, 30, d(3), None, True),
        (2, 10, d(1), d(1, 31), False), (2, 20, d(2), d(2, 28), False), (2, 30, d(3), None, True),
        (3, 5, d(1), None, True),
    ]
    assert rows(h) == rows(spark.createDataFrame(expected, HISTORY))
    assert scd2.scd2_violations(h).count() == 0


def test_stream_quarantines_malformed_lines_and_ids_stay_unique(spark, refs):  # noqa: F811
    from tallyhouse.schemas import DIM_DATE, SALE_SUBMISSION, empty

    root = scratch_path(spark, "malformed")
    good = spark.createDataFrame([sub(), sub(qty=2)], SALE_SUBMISSION)
    src = tempfile.mkdtemp(prefix="tallyhouse-csv-", dir="/tmp")
    cells = [[("" if v is None else str(v)) for v in r] for r in good.collect()]
    bad = list(cells[0])
    bad[good.columns.index("discount")] = "abc"
    for k, lines in enumerate(([cells[0], bad], [cells[1]])):
        with open(f"{src}/{k}.csv", "w") as f:
            f.write("\n".join(",".join(x) for x in [good.columns, *lines]) + "\n")
    targets = sales_stream.SalesStreamTargets(f"{root}/sales", f"{root}/rej", f"{root}/dim_date", f"{root}/_ckpt")
    store.write_table(empty(spark, DIM_DATE), targets.dim_date_path)
    sales_stream.start_sales_stream(spark, src, refs, targets, dt.date(2025, 3, 3)).awaitTermination()
    sales = sales_stream.streamed_sales(spark, targets)
    assert sales.count() == sales.select("sales_id").distinct().count() == 2
    assert [r["reject_reason"] for r in store.read_table(spark, targets.rejected_path).collect()] == [sales_stream.MALFORMED]
