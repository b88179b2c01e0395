"""Session helpers: building a session for tests/bench and locating the shared scratch folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tallyhouse") -> SparkSession:
    """Session used by tests and the bench. Library code never creates a session itself."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # No broadcast from *estimated* sizes: small sides are broadcast either explicitly after a
        # row-count check (plans.joins.bounded_broadcast) or by AQE from *measured* shuffle sizes.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        # a join on (customer_id, category_id) between tables bucketed by customer_id alone is
        # already co-partitioned; without this Spark would shuffle both sides again
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", os.environ.get("TALLYHOUSE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # delete reliable checkpoints (dense keys, SCD2 versions) once their data is unreachable
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


MB = 1 << 20


def cluster_settings(input_bytes: int, executor_cores: int) -> dict[str, str]:
    """Settings for a cluster run reading ``input_bytes`` with ``executor_cores`` cores in total.

    * scan splits of 256 MB; the initial shuffle width follows the input (one partition per
      256 MB, at least two waves of tasks) and AQE merges partitions down to
      128 MB after each shuffle, so the post-aggregation shuffles stay narrow;
    * skewed sort-merge-join partitions (over 512 MB and 5x the median) are split by AQE;
    * broadcast only from measured sizes (AQE, 32 MB) or explicit row-count checks, never
      from static estimates;
    * co-partitioned joins on a prefix of the bucket keys, dynamic partition overwrite;
    * checkpoint files removed once unreachable (this one must be set when the session starts).
    """
    width = max(2 * executor_cores, math.ceil(input_bytes / (256 * MB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


# rows of one task of a build that joins and sorts whole sales (sorted, some 300 bytes each), and its files and shuffle blocks
ROWS_PER_TASK, TASK_BYTES = 500_000, 16 * MB


@contextmanager
def bounded_tasks(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs in this block, over tables of about ``rows`` rows, get more tasks for more rows instead of larger ones.

    The shuffle width follows the rows (never under the session's), AQE merges only up to ``TASK_BYTES`` and splits of
    files are kept as small, so a task's sorts stay at the same size for any input. A join whose smaller side was measured
    to stay under that in every task is a hash join, without a sort. The session's settings are put back.
    """
    width, hash_join = "spark.sql.shuffle.partitions", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    sizes = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = {k: spark.conf.get(k) for k in (width, hash_join, *sizes)}
    spark.conf.set(width, max(int(before[width]), math.ceil(rows / ROWS_PER_TASK)))
    for k in sizes:
        spark.conf.set(k, min(_bytes(spark, before[k]), TASK_BYTES))
    spark.conf.set(hash_join, max(_bytes(spark, before[hash_join]), TASK_BYTES))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _bytes(spark: SparkSession, size: str) -> int:
    """A size setting (``16m``, ``64MB``, ``1048576b``) in bytes, as Spark reads it."""
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size))


def bucket_count(table_bytes: int, target_bytes: int = 1024 * MB) -> int:
    """Buckets for a customer-bucketed table: about ``target_bytes`` per bucket, a power of two
    from 8 up (both sides of a bucketed join must use the same count)."""
    want = max(1, math.ceil(table_bytes / target_bytes))
    return int(max(8, 2 ** math.ceil(math.log2(want))))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the SparkContext.

    The folder comes from ``spark.checkpoint.dir`` as the cluster configures it. Only a
    local-mode session without that setting (tests, the bench) gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a folder shared by all executors"
            )
        configured = tempfile.mkdtemp(prefix="tallyhouse-ckpt-", dir="/tmp")
        spark.conf.set(CHECKPOINT_CONF, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession) -> str:
    """The configured shared folder itself (``setCheckpointDir`` adds a per-application subfolder)."""
    ensure_checkpoint_dir(spark)
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    return (configured or ensure_checkpoint_dir(spark)).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
