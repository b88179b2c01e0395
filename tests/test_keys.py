"""K1-K3: dense keys are 1..n in sorted order, NULL last, independent of the partitioning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.operators.keys import dense_key, row_key


def test_dense_key_sorted_and_dense(spark):
    vals = [f"v{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(v,) for v in reversed(vals)], "v string").repartition(7)
    got = {r["v"]: r["k"] for r in dense_key(df, ["v"], "k").collect()}
    assert got == {v: i + 1 for i, v in enumerate(vals)}


def test_dense_key_stable_across_partition_counts(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2000).alias("v"))
    a = {r["v"]: r["k"] for r in dense_key(df.repartition(3), ["v"], "k", num_partitions=5).collect()}
    b = {r["v"]: r["k"] for r in dense_key(df.repartition(11), ["v"], "k", num_partitions=2).collect()}
    assert a == b
    assert sorted(a.values()) == list(range(1, 2001))


def test_dense_key_null_last_and_groups(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", None), ("a", "b"), ("b", "z"), ("b", "c")], "g string, v string"
    )
    got = {(r["g"], r["v"]): r["k"] for r in dense_key(df, ["v"], "k", group_cols=["g"], num_partitions=3).collect()}
    assert got == {("a", "b"): 1, ("a", "x"): 2, ("a", None): 3, ("b", "c"): 1, ("b", "z"): 2}


def test_row_key_unique(spark):
    df = row_key(spark.range(0, 1000).repartition(4), "k")
    assert df.select("k").distinct().count() == 1000


def test_cluster_settings_scale_with_input():
    from tallyhouse.session import bucket_count, cluster_settings

    small = cluster_settings(10 << 30, 64)
    big = cluster_settings(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128  # two waves of 64 cores
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)  # follows the input; AQE merges after shuffles
    assert big["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert bucket_count(1 << 30) == 8 and bucket_count(10 << 40) == 16384 and bucket_count(100 << 30) == 128
