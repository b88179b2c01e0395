"""I4: the after-insert trigger as a Structured Streaming job.

New sales submissions arrive as files. Each micro-batch is validated (I2); accepted rows are
written to the sales table, rejects and malformed lines to the quarantine, each under the micro-batch id, by
dynamic partition overwrite, so a replayed batch replaces its own output (exactly once). Then the
trigger's work runs (I3): invoice dates missing from ``dim_date`` are appended.

There is no cross-table transaction: ``dim_date`` is written *after* the sales. A crash before
the stream commits a batch makes Spark run that batch again under the same id: its sales
partition is overwritten, and dates already appended are no longer missing, so ``dim_date``
never gets a duplicate. Each batch therefore reads back only its own partition, and the work
per batch does not grow with the stream's history.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.quality import REASON
from tallyhouse.plans.ingest import ingest_sales, load_missing_dates
from tallyhouse.schemas import DIM_DATE, SALE_SUBMISSION, SALES_DETAILS
from tallyhouse.sources import csv as csv_source
from tallyhouse.sources import tables as store

BATCH_COL = "batch_id"
MALFORMED = "malformed_line"
# K3: ids of streamed sales. The top bit keeps them apart from the base table's; then 20 bits of
# batch and 42 bits within the batch (512 partitions x 2^33 rows)
STREAM_IDS, BATCH_BITS, PART_LIMIT = 1 << 62, 42, 512

# rows of one incoming file (about 40 MB of CSV): what a task writes or reads doesn't grow with the feed
ROWS_PER_FILE = 1_000_000


@dataclass
class SalesStreamTargets:
    sales_path: str  # streamed sales_details rows, partitioned by batch_id
    rejected_path: str  # quarantine, partitioned by batch_id
    dim_date_path: str  # dim_date (appended to)
    checkpoint_path: str  # streaming checkpoint


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    store.write_period(df.withColumn(BATCH_COL, F.lit(batch_id).cast("long")), path, BATCH_COL)


def process_batch(
    batch: DataFrame, batch_id: int, refs: dict[str, DataFrame], targets: SalesStreamTargets, as_of: _dt.date
) -> None:
    spark = batch.sparkSession
    if csv_source.CORRUPT not in batch.columns:
        batch = batch.withColumn(csv_source.CORRUPT, F.lit(None).cast("string"))
    if batch.rdd.getNumPartitions() > PART_LIMIT:
        batch = batch.coalesce(PART_LIMIT)
    batch = batch.persist()  # parsed once for both writes
    try:
        corrupt = F.col(csv_source.CORRUPT)
        accepted, rejected = ingest_sales(batch.where(corrupt.isNull()), refs, as_of)
        in_batch = F.monotonically_increasing_id()
        accepted = accepted.withColumn("sales_id", F.lit(STREAM_IDS + (batch_id << BATCH_BITS)) + in_batch)
        malformed = batch.where(corrupt.isNotNull()).withColumn(REASON, F.lit(MALFORMED))
        rejected = rejected.withColumn(csv_source.CORRUPT, F.lit(None).cast("string"))
        _write_batch(accepted, targets.sales_path, batch_id)
        _write_batch(rejected.unionByName(malformed), targets.rejected_path, batch_id)
    finally:
        batch.unpersist()
    this_batch = store.read_table(spark, targets.sales_path).where(F.col(BATCH_COL) == F.lit(batch_id))
    dim_date = store.read_table(spark, targets.dim_date_path, DIM_DATE)
    new_dates = load_missing_dates(this_batch, dim_date)
    store.append_table(new_dates, targets.dim_date_path)


def deal_files(submissions: DataFrame, path: str, batches: int, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write a feed that the stream takes in ``batches`` equal batches; returns the files of a batch.

    The feed is dealt over as many files as keep each at about ``rows_per_file`` rows (the count reads no column).
    """
    files = max(1, math.ceil(submissions.count() / (batches * rows_per_file)))
    # by the row's place: even, and without the sort of all rows that a repartition by number alone does
    dealt = submissions.withColumn("_place", F.monotonically_increasing_id()).repartition(batches * files, "_place")
    csv_source.write_csv(dealt.drop("_place"), path)
    return files


def start_sales_stream(
    spark: SparkSession,
    source_dir: str,
    refs: dict[str, DataFrame],
    targets: SalesStreamTargets,
    as_of: _dt.date,
    files_per_batch: int = 1,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream over header CSV files of submissions in ``source_dir``."""
    return start_batches(spark, source_dir, targets, lambda df, bid: process_batch(df, bid, refs, targets, as_of), files_per_batch, available_now)


def start_batches(
    spark: SparkSession,
    source_dir: str,
    targets: SalesStreamTargets,
    work: Callable[[DataFrame, int], None],
    files_per_batch: int = 1,
    available_now: bool = True,
) -> StreamingQuery:
    """The file stream of submissions, with ``work`` done on every micro-batch."""
    reader = csv_source.with_options(spark.readStream, SALE_SUBMISSION)
    source = reader.option("maxFilesPerTrigger", files_per_batch).csv(source_dir)
    writer = source.writeStream.foreachBatch(work).option("checkpointLocation", targets.checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def streamed_sales(spark: SparkSession, targets: SalesStreamTargets) -> DataFrame:
    return store.read_table(spark, targets.sales_path, SALES_DETAILS)
