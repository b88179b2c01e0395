"""What one task reads, holds or sorts stays at the same size for larger tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import cumulative as cum
from tallyhouse.plans import ingest, runs
from tallyhouse.schemas import SALES_DETAILS, conform
from tallyhouse.session import ROWS_PER_TASK, TASK_BYTES, bounded_tasks, scratch_path
from tallyhouse.sources import csv as csv_source
from tallyhouse.sources import tables as store
from tallyhouse.streaming import sales_stream

from conftest import SF_SMALL, rows

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def test_feed_is_dealt_over_files_of_bounded_size(spark, wh):
    root = scratch_path(spark, "dealt")
    subs = runs.sales_submissions(spark, SF_SMALL, wh)
    n = subs.count()
    files = sales_stream.deal_files(subs, f"{root}/incoming", 3, rows_per_file=500)
    assert files == -(-n // 1500) > 1
    lines = spark.read.option("header", True).csv(f"{root}/incoming")
    sizes = [r["count"] for r in lines.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * 500
    targets = sales_stream.SalesStreamTargets(f"{root}/sales", f"{root}/rejected", f"{root}/dim_date", f"{root}/_checkpoint")
    store.write_table(wh.table("dim_date"), targets.dim_date_path)
    refs = runs.reference_tables(wh)
    sales_stream.start_sales_stream(spark, f"{root}/incoming", refs, targets, dt.date(2025, 1, 1), files_per_batch=files).awaitTermination()
    sales, rejected = (spark.read.parquet(p) for p in (targets.sales_path, targets.rejected_path))
    assert sales.count() + rejected.count() == n
    assert {r[0] for r in sales.select(sales_stream.BATCH_COL).distinct().collect()} == {0, 1, 2}


def last_write_plan(spark) -> str:
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs_ = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [runs_.apply(i).physicalPlanDescription() for i in range(runs_.size())]
    return [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p][-1]


def test_writes_to_few_partitions_are_not_sorted(spark):
    before = spark.conf.get(WRITERS)
    path = scratch_path(spark, "feed")
    lines = spark.range(0, 2000, 1, 4).select(F.concat(F.lit("l,"), F.col("id").cast("string")).alias("line"), (F.col("id") % 3).alias("feed"))
    csv_source.write_lines(lines, path, "a,b", "feed")
    assert "Sort" not in last_write_plan(spark)
    _good, bad = csv_source.load_checked(spark, path, sales_stream.DIM_DATE)
    assert "Sort" not in last_write_plan(spark)
    assert bad.count() == 2000
    assert spark.conf.get(WRITERS) == before
    target = scratch_path(spark, "many")  # more partitions than are kept open: the rest is sorted, all rows are there
    with store.few_partitions(spark), store.few_partitions(spark):
        store.write_table(spark.range(0, 5000, 1, 2).withColumn("p", F.col("id") % (3 * store.OPEN_PARTITIONS)), target, ("p",))
        assert spark.conf.get(WRITERS) == str(store.OPEN_PARTITIONS)
    assert spark.conf.get(WRITERS) == before
    assert rows(spark.read.parquet(target).select("id")) == rows(spark.range(5000))


@pytest.mark.parametrize("hot", [False, True])
def test_fine_table_is_shuffled_once_unless_a_key_is_hot(spark, hot):
    i = F.col("id")
    customer = F.when(i % 3 == 0, F.lit(1)).otherwise(i % 1999) if hot else i % 1999
    sales = conform(spark.range(0, 20_000, 1, 4).select(
        i.alias("sales_id"), customer.alias("customer_id"), (i % 4 + 1).alias("category_id"), F.lit(1).alias("payment_method_id"), F.lit(1).alias("region_id"),
        F.lit("2.00").alias("unit_price"), (i % 5 + 1).alias("quantity"), F.lit("0.10").alias("discount"), (i % 97 / 4).alias("amount"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (i % 1500).cast("int")).alias("invoice_date"),
    ), SALES_DETAILS)
    spec = cum.CUSTOMER_PRODUCT_ENGAGE
    category = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "category_id int, category string")  # 4 has no name
    names = cum.name_joiner(category)
    table = cum.backfill(sales, spec, names)
    assert table._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == (2 if hot else 1)
    assert rows(table) == rows(cum.backfill(sales, replace(spec, fine=False), names))


def test_by_key_gives_more_tasks_for_more_rows(spark):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(100).withColumnRenamed("id", "k")
    assert cum.by_key(df, ["k"], (width + 3) * ROWS_PER_TASK).rdd.getNumPartitions() == width + 3


def test_bounded_tasks_follow_the_rows(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(k) for k in keys]
    with pytest.raises(RuntimeError), bounded_tasks(spark, 100 * ROWS_PER_TASK):
        assert int(spark.conf.get(keys[0])) == 100
        assert all(int(spark.conf.get(k)) <= TASK_BYTES for k in keys[1:])
        raise RuntimeError
    assert [spark.conf.get(k) for k in keys] == before
    with bounded_tasks(spark, 1):
        assert spark.conf.get(keys[0]) == before[0]


def test_large_batches_are_checked_without_a_sort_of_the_batch(spark, wh, monkeypatch):
    subs = runs.sales_submissions(spark, SF_SMALL, wh)
    refs, day = runs.reference_tables(wh), dt.date(2025, 1, 1)
    batch = subs.withColumn("customer_id", F.when(F.col("quantity") % 7 == 0, None).when(F.col("quantity") % 7 == 1, -F.col("customer_id")).otherwise(F.col("customer_id")))
    want = rows(ingest.ingest_sales(batch, refs, day)[1])
    monkeypatch.setattr(ingest, "LOOKUP_BROADCAST_ROWS", 0)
    monkeypatch.setattr(ingest, "BATCH_KEYS_BROADCAST_ROWS", 0)
    rejected = ingest.ingest_sales(batch, refs, day)[1]
    assert rejected._jdf.queryExecution().executedPlan().toString().count("ShuffledHashJoin") >= len(ingest.FOREIGN_KEYS)
    assert rows(rejected) == want and want
