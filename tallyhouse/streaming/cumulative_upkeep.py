"""Cumulative tables kept up by the sales stream: each micro-batch adds its deltas, exactly once.

A batch's accepted sales are summed to (key, period) deltas. A delta belongs to its period and, as the tables
are running totals, to every later stored one; so the stored partitions from the oldest delta's period on are
read, the deltas' own running totals are added by a full outer join on the keys, and the partitions are
written anew. Older partitions and the base sales are not read.

Adding isn't idempotent by itself, so nothing is changed in place. The table is partitioned by period and by the batch
that wrote the partition; a small table beside it lists, per batch, the live (period, batch) partitions, and is
written last. A reader takes the last list. A batch that is run again after a crash starts from the list before
it and replaces its own partitions; a batch that is listed already is left alone. Both give the table that running
it once gives.

:func:`vacuum` removes the partitions that no list in use names.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tallyhouse.operators import cumulative as cum
from tallyhouse.schemas import conform
from tallyhouse.sources import tables as store
from tallyhouse.streaming import sales_stream

VERSION = "written_by"  # batch that wrote a partition; the initial fill is BASE
BASE = -1
BATCH = sales_stream.BATCH_COL

Names = Callable[[DataFrame], DataFrame] | None


@dataclass(frozen=True)
class UpkeptTable:
    """A C0 table (see :class:`cumulative.CumulativeSpec`) under ``path`` that batches add to."""

    spec: cum.CumulativeSpec
    path: str

    @property
    def rows_path(self) -> str:
        return f"{self.path}/rows"

    @property
    def live_path(self) -> str:
        return f"{self.path}/live"

    @property
    def rows_schema(self) -> StructType:
        return StructType([*self.spec.schema.fields, StructField(VERSION, LongType())])

    @property
    def live_schema(self) -> StructType:
        period = self.spec.schema[self.spec.period_col]
        return StructType([StructField(period.name, period.dataType), StructField(VERSION, LongType()), StructField(BATCH, LongType())])

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        marked = rows.withColumn(VERSION, F.lit(batch_id).cast("long"))
        with store.few_partitions(rows.sparkSession):
            marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.spec.period_col, VERSION).parquet(self.rows_path)

    def _list(self, spark: SparkSession, live: dict, batch_id: int) -> None:
        rows = spark.createDataFrame([(p, v, batch_id) for p, v in live.items()], self.live_schema)
        store.write_period(rows.coalesce(1), self.live_path, BATCH)

    def create(self, table: DataFrame) -> None:
        """Store ``table`` (from C9, say) as the state that the first batch adds to."""
        self._write(conform(table, self.spec.schema), BASE)
        spark = table.sparkSession
        rows = store.read_table(spark, self.rows_path, self.rows_schema).where(F.col(VERSION) == BASE)
        periods = [r[0] for r in rows.select(self.spec.period_col).distinct().collect()]  # the calendar bounds them
        self._list(spark, dict.fromkeys(periods, BASE), BASE)

    def lists(self, spark: SparkSession) -> DataFrame:
        return store.read_table(spark, self.live_path, self.live_schema)

    def live(self, spark: SparkSession, before: int | None = None) -> tuple[int | None, dict]:
        """(last batch, or the last one under ``before``; its live partitions as {period: batch})."""
        known = self.lists(spark) if before is None else self.lists(spark).where(F.col(BATCH) < before)
        last = known.agg(F.max(BATCH).alias("b")).first()["b"]
        if last is None:
            return None, {}
        return last, {r[0]: r[1] for r in known.where(F.col(BATCH) == last).collect()}

    def _at(self, spark: SparkSession, live: dict) -> DataFrame:
        """The rows of the given partitions (partition filters: nothing else is read)."""
        wanted = F.lit(False)
        by_version: dict[int, list] = {}
        for p, v in live.items():
            by_version.setdefault(v, []).append(p)
        for v, periods in by_version.items():
            wanted = wanted | ((F.col(VERSION) == v) & F.col(self.spec.period_col).isin(periods))
        return conform(store.read_table(spark, self.rows_path, self.rows_schema).where(wanted), self.spec.schema)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._at(spark, self.live(spark)[1])

    def add(self, sales: DataFrame, batch_id: int, names: Names = None) -> None:
        """Add the sales of one batch to their periods and all later stored ones."""
        spark, spec = sales.sparkSession, self.spec
        last, _ = self.live(spark)
        if last is not None and last >= batch_id:
            return
        _, live = self.live(spark, before=batch_id)
        deltas = sales.groupBy(*spec.keys, cum.period_expr(spec.grain).alias("_p")).agg(*[F.sum(src).alias(out) for out, src in spec.measures])
        bounds = deltas.agg(F.min("_p").alias("a"), F.max("_p").alias("b")).first()
        if bounds["a"] is None:  # nothing accepted: the state stays, under this batch
            return self._list(spark, live, batch_id)
        end = max([bounds["b"], *live])
        touched = {p: v for p, v in live.items() if p >= bounds["a"]}
        before = self._at(spark, touched)
        newest = max(live, default=None)
        if newest is not None and newest < end:  # periods after the last stored one start from its totals
            base = self._at(spark, {newest: live[newest]})
            ahead = base.drop(spec.period_col).withColumn(spec.period_col, F.explode(_periods_after(spec.grain, newest, end)))
            before = before.unionByName(conform(ahead, spec.schema))
        added = running_deltas(deltas, spec, end)
        rows = add_rows(before, added, spec, names)
        self._write(rows, batch_id)
        # the periods that were written, told by their partitions: one listing of this batch's folders
        written = store.read_table(spark, self.rows_path, self.rows_schema).where(F.col(VERSION) == batch_id)
        periods = [r[0] for r in written.select(spec.period_col).distinct().collect()]
        self._list(spark, live | dict.fromkeys(periods, batch_id), batch_id)


def _periods_after(grain: str, newest, end):
    """All periods after ``newest`` up to ``end``, wherever the deltas start."""
    if grain == "day":
        return F.sequence(F.lit(newest + _dt.timedelta(days=1)).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    return F.sequence(F.lit(int(newest) + 1), F.lit(int(end)))


def running_deltas(deltas: DataFrame, spec: cum.CumulativeSpec, end) -> DataFrame:
    """What each key's deltas add to every period from its first one to ``end``."""
    w = Window.partitionBy(*spec.keys).orderBy("_p")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = deltas.select(
        *spec.keys, "_p", F.lead("_p").over(w).alias("_next"), *[F.sum(out).over(running).alias(out) for out, _ in spec.measures]
    )
    expand = cum.expand_periods(spec.grain, F.col("_p"), F.col("_next"), end)
    return run.select(*spec.keys, F.explode(expand).alias(spec.period_col), *[out for out, _ in spec.measures])


def add_rows(before: DataFrame, added: DataFrame, spec: cum.CumulativeSpec, names: Names) -> DataFrame:
    """Stored rows plus the running deltas: one full outer join, both sides one row per key and period."""
    on = [*spec.keys, spec.period_col]
    b = before.select(*on, *[F.col(out).alias(f"_b_{out}") for out, _ in spec.measures])
    a = added.select(*on, *[F.col(out).alias(f"_a_{out}") for out, _ in spec.measures])
    sums = [(F.coalesce(f"_b_{out}", F.lit(0)) + F.coalesce(f"_a_{out}", F.lit(0))).alias(out) for out, _ in spec.measures]
    rows = b.join(a, on, "full").select(*on, *sums)
    return conform(names(rows) if names is not None else rows, spec.schema)


def vacuum(spark: SparkSession, table: UpkeptTable, keep: int = 2) -> int:
    """Drop the partitions that none of the last ``keep`` lists names, and the older lists. Returns how many partitions went."""
    batches = sorted(r[0] for r in table.lists(spark).select(BATCH).distinct().collect())
    kept, old = batches[-keep:], batches[:-keep]
    live = {(r[0], r[1]) for r in table.lists(spark).where(F.col(BATCH).isin(kept)).select(table.spec.period_col, VERSION).collect()}
    have = store.read_table(spark, table.rows_path, table.rows_schema).select(table.spec.period_col, VERSION).distinct().collect()
    gone = [(r[0], r[1]) for r in have if (r[0], r[1]) not in live]
    store.drop_partitions(spark, table.live_path, [((BATCH, b),) for b in old])
    store.drop_partitions(spark, table.rows_path, [((table.spec.period_col, p), (VERSION, v)) for p, v in gone])
    return len(gone)


def process_batch(
    batch: DataFrame,
    batch_id: int,
    refs: dict[str, DataFrame],
    targets: sales_stream.SalesStreamTargets,
    as_of: _dt.date,
    upkept: Sequence[UpkeptTable],
    names: Names = None,
) -> None:
    """I4's work on a batch, then the accepted sales, read back from their own partition, added to each table."""
    sales_stream.process_batch(batch, batch_id, refs, targets, as_of)
    accepted = store.read_table(batch.sparkSession, targets.sales_path).where(F.col(BATCH) == F.lit(batch_id))
    for table in upkept:
        table.add(accepted, batch_id, names)


def start_upkeep_stream(
    spark: SparkSession,
    source_dir: str,
    refs: dict[str, DataFrame],
    targets: sales_stream.SalesStreamTargets,
    as_of: _dt.date,
    upkept: Sequence[UpkeptTable],
    names: Names = None,
    files_per_batch: int = 1,
    available_now: bool = True,
) -> StreamingQuery:
    """The sales stream with the cumulative tables kept up. ``as_of`` may lie in the past: a late feed."""
    return sales_stream.start_batches(
        spark, source_dir, targets, lambda df, bid: process_batch(df, bid, refs, targets, as_of, upkept, names), files_per_batch, available_now
    )
