"""I2 and I3 as one transaction: a batch's sales and its new dates appear together or not at all.

Sales and dates are written under the batch's own partition, then one row is written to the commits table. Readers
take only the partitions of committed batches, so a crash anywhere before that row leaves nothing to
see, and running the batch again replaces its own partitions. A committed batch isn't applied twice. As the
reference's procedure raises on the first bad row, a batch with a rejected row commits nothing.

One writer at a time, as the batches number the date keys one after the other.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyhouse.plans.ingest import ingest_sales, load_missing_dates
from tallyhouse.schemas import DIM_DATE, SALES_DETAILS, conform
from tallyhouse.session import ensure_checkpoint_dir
from tallyhouse.sources import tables as store

BATCH = "batch_id"
_COMMITS = StructType([StructField("n_sales", LongType()), StructField(BATCH, LongType())])
_PART = [StructField(BATCH, LongType())]
# sales ids of a batch: 20 bits of batch, then 42 bits of partition and row within it, under the streamed ones
BATCH_BITS = 42


@dataclass(frozen=True)
class Target:
    """Sales and date rows that batches add under ``root`` to a loaded ``dim_date``."""

    root: str

    def commits(self, spark: SparkSession) -> DataFrame:
        return store.read_table(spark, f"{self.root}/commits", _COMMITS)

    def _committed(self, spark: SparkSession, name: str, schema: StructType) -> DataFrame:
        rows = store.read_table(spark, f"{self.root}/{name}", StructType([*schema.fields, *_PART]))
        # one row a batch: a join (the planner prunes partitions by it), not a list on the driver
        return rows.join(self.commits(spark).select(BATCH), BATCH, "left_semi")

    def sales(self, spark: SparkSession) -> DataFrame:
        return self._committed(spark, "sales", SALES_DETAILS).select(*SALES_DETAILS.names, BATCH)

    def dates(self, spark: SparkSession) -> DataFrame:
        return conform(self._committed(spark, "dates", DIM_DATE), DIM_DATE)

    def _write(self, name: str, rows: DataFrame, batch_id: int) -> None:
        store.drop_partitions(rows.sparkSession, f"{self.root}/{name}", [((BATCH, batch_id),)])  # of a crashed run
        store.write_period(rows.withColumn(BATCH, F.lit(batch_id).cast("long")), f"{self.root}/{name}", BATCH)

    def ingest(self, submissions: DataFrame, refs: dict[str, DataFrame], dim_date: DataFrame, batch_id: int, as_of: _dt.date) -> DataFrame:
        """Apply one batch; returns its rejected rows (all of its rows, when any is bad)."""
        spark = submissions.sparkSession
        ensure_checkpoint_dir(spark)
        accepted, rejected = ingest_sales(submissions, refs, as_of, all_or_nothing=True)
        if self.commits(spark).where(F.col(BATCH) == batch_id).take(1):
            return rejected
        ids = F.lit(batch_id << BATCH_BITS).cast("long") + F.monotonically_increasing_id()
        sales = conform(accepted.withColumn("sales_id", ids), SALES_DETAILS).checkpoint(eager=True)
        n = sales.count()
        if n:
            known = conform(dim_date, DIM_DATE).unionByName(self.dates(spark))
            dates = load_missing_dates(sales, known).checkpoint(eager=True)
            self._write("sales", sales, batch_id)
            self._write("dates", dates, batch_id)
            self._commit(spark, n, batch_id)
        return rejected

    def _commit(self, spark: SparkSession, n: int, batch_id: int) -> None:
        store.write_period(spark.createDataFrame([(n, batch_id)], _COMMITS).coalesce(1), f"{self.root}/commits", BATCH)
