"""The broadcast guards: size checks, their memo, and semi-join reduction."""

from __future__ import annotations

from tallyhouse.plans.joins import bounded_broadcast, present_keys, within_rows
from tallyhouse.session import scratch_path
from tallyhouse.sources import tables as store


def test_within_rows_and_memo_follow_rewrites(spark):
    path = scratch_path(spark, "joins_memo")
    store.write_table(spark.range(0, 5).toDF("k"), path)
    small = spark.read.parquet(path)
    assert within_rows(small, 5) and not within_rows(small, 4)
    store.write_table(spark.range(0, 50).toDF("k"), path)  # rewritten: new part files, new memo key
    assert not within_rows(spark.read.parquet(path), 5)


def test_bounded_broadcast_hint_only_under_the_bound(spark):
    df = spark.range(0, 10).toDF("k")
    hinted = bounded_broadcast(df, 100)._jdf.queryExecution().analyzed().toString()
    plain = bounded_broadcast(df, 5)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in plain.lower()


def test_present_keys_both_paths(spark):
    ref = spark.range(0, 1000).toDF("customer_id")
    keys = spark.createDataFrame([(3,), (999,), (5000,)], "customer_id long")
    for bound in (10, 0):
        got = sorted(r[0] for r in present_keys(keys, ref, "customer_id", bound).collect())
        assert got == [3, 999]


def test_full_rewrite_drops_partitions_missing_from_the_new_data(spark):
    from pyspark.sql import functions as F

    path = scratch_path(spark, "full_rewrite")
    store.write_table(spark.range(0, 4).withColumn("p", F.col("id") % 2), path, partition_by=("p",))
    store.write_table(spark.range(0, 4).withColumn("p", F.lit(0)), path, partition_by=("p",))
    assert sorted(r["p"] for r in spark.read.parquet(path).select("p").distinct().collect()) == [0]
