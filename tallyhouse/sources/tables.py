"""Table storage: full overwrite (S5/S9), period partitions (S7) and views.

Period tables are Parquet partitioned by the period column. A step reads the prior period's
partition (partition pruning) and overwrites only the target partition (dynamic overwrite), so a
rerun of a period replaces it instead of duplicating it.
"""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from tallyhouse.schemas import empty


# Partition folders that a writing task keeps open at once; the rows of any further ones are sorted, as without this
OPEN_PARTITIONS = 32
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_open_writes: dict[str, tuple[int, str]] = {}  # session -> (writes running, the value before them)
_open_lock = threading.Lock()


@contextmanager
def few_partitions(spark: SparkSession) -> Iterator[None]:
    """Writes in this block, to at most a few dozen partition folders, take rows in the order they come.

    A partitioned write otherwise sorts each task's rows by partition first: whole rows, arrays included, which spill.
    Writes of several threads may overlap; the session's own setting is back after the last of them.
    """
    session = spark._jsparkSession.sessionUUID()
    with _open_lock:
        running, before = _open_writes.get(session) or (0, spark.conf.get(_WRITERS))
        _open_writes[session] = (running + 1, before)
        spark.conf.set(_WRITERS, OPEN_PARTITIONS)
    try:
        yield
    finally:
        with _open_lock:
            running, before = _open_writes.pop(session)
            if running > 1:
                _open_writes[session] = (running - 1, before)
            else:
                spark.conf.set(_WRITERS, before)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace the whole table. Static overwrite is forced: under a session set to dynamic
    partition overwrite, partitions missing from ``df`` would otherwise survive a rebuild."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a written table; a table that does not exist yet reads as empty with ``schema``.

    Only a missing path counts as "not yet": any other problem is raised. With a schema the
    footers are not read to infer one (the tables are written conformed).
    """
    try:
        if schema is None:
            return spark.read.parquet(path)
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if schema is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def write_period(df: DataFrame, path: str, period_col: str) -> None:
    """Replace exactly the period partitions present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period_col)
        .parquet(path)
    )


def read_period(spark: SparkSession, path: str, period_col: str, period, schema: StructType) -> DataFrame:
    """Rows of one period (pruned to that partition); empty before the first run."""
    lit = F.lit(period) if not isinstance(period, _dt.date) else F.lit(period).cast("date")
    return read_table(spark, path, schema).where(F.col(period_col) == lit)


def prior_period(table: DataFrame, period_col: str, prior, target) -> DataFrame:
    """The rows of the period before ``target``, for a step that adds to them.

    They may only be missing on the first run: when older periods are stored, a gap would make every
    running total start again, so it is an error.
    """
    rows = table.where(F.col(period_col) == prior)
    if not rows.take(1) and table.where(F.col(period_col) < target).take(1):
        raise ValueError(f"older periods are stored, but not the one before the target: fill {period_col} without gaps")
    return rows


def drop_partitions(spark: SparkSession, path: str, partitions: list[tuple[tuple[str, object], ...]]) -> None:
    """Remove partition folders, each given by its (column, value) pairs from the outermost on.

    A partition that is to hold no rows can't be written as such: dynamic overwrite replaces only partitions
    that have rows.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for pairs in partitions:
        # dates, numbers and plain words only: nothing that a partition folder's name escapes
        folder = jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *[f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in pairs]]))
        folder.getFileSystem(conf).delete(folder, True)


def ensure_database(spark: SparkSession, name: str, location: str) -> str:
    """A catalog database whose tables live under ``location`` (qualified names ``db.table``)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


def save_bucketed(
    df: DataFrame, table: str, path: str, bucket_cols: tuple[str, ...], buckets: int, partition_by: tuple[str, ...] = ()
) -> None:
    """K9 re-aimed: instead of an index, store ``df`` hash-bucketed and sorted by ``bucket_cols``.

    Joins and aggregations on those columns between tables with the same bucketing then need no
    shuffle at all. Rows are brought together by bucket first, so a bucket is one file a partition.
    """
    df = df.repartition(buckets, *bucket_cols)
    w = df.write.mode("overwrite").bucketBy(buckets, *bucket_cols).sortBy(*bucket_cols).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def insert_period(df: DataFrame, table: str) -> None:
    """S7 on a catalog table: replace the period partitions present in ``df`` (bucketing kept).

    ``insertInto`` follows the session's overwrite mode and ignores the writer's option, so the
    mode is set for the insert and put back after it: other periods stay in any session.
    """
    conf, key = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, "dynamic")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        conf.set(key, before)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """A named view; its query is re-planned at every read, as a SQL view is."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
