"""Customer addresses as a type-2 slowly changing dimension.

History rows are ``(customer_id, address_id, start_date, end_date, is_current)``; date ranges are
inclusive, the open row has ``end_date`` NULL, and a new version starts the day after the old one
ends, so versions of a customer never overlap or leave gaps.

Applying a batch of changes rebuilds the versions of the customers in the batch only; all other
history passes through untouched. :class:`StoredHistory` keeps it partitioned by customer bucket, and reads and
rewrites only the buckets of a batch.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyhouse.operators.quality import REASON
from tallyhouse.plans.joins import present_keys, within_rows
from tallyhouse.schemas import CUSTOMER_ADDRESS, conform
from tallyhouse.session import ensure_checkpoint_dir
from tallyhouse.sources import tables as store

BUCKET = "customer_bucket"
_STORED = StructType([*CUSTOMER_ADDRESS.fields, StructField(BUCKET, IntegerType())])

# A batch of up to this many (de-duplicated) changes is broadcast: the dimension is not shuffled.
CHANGE_BROADCAST_ROWS = 1_000_000


def assign_address(customer_id, address_count: int, multiplier: int):
    """Deterministic stand-in for the reference's random assignment: (id * multiplier) mod n + 1."""
    return (F.pmod(F.col(customer_id).cast("long") * F.lit(multiplier), F.lit(address_count)) + 1).cast("int")


def seed_customer_address(customer: DataFrame, address_count: int, as_of: _dt.date, multiplier: int = 7919) -> DataFrame:
    """One open row per customer, starting ``as_of``."""
    seeded = customer.select(
        "customer_id",
        assign_address("customer_id", address_count, multiplier).alias("address_id"),
        F.lit(as_of).cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
    )
    return conform(seeded, CUSTOMER_ADDRESS)


def dated_changes(changes: DataFrame) -> DataFrame:
    """One change per customer and day: the last by ``seq``. Changes are
    ``(customer_id, address_id, change_date[, seq])``; ``seq`` orders moves made on the same day.

    ``max`` over a struct picks the last with map-side combine, so a customer with a huge
    number of changes is left with at most one row a day.
    """
    seq = F.col("seq").cast("long") if "seq" in changes.columns else F.lit(0).cast("long")
    last = changes.groupBy("customer_id", "change_date").agg(F.max(F.struct(seq.alias("seq"), F.col("address_id"))).alias("_m"))
    return last.select("customer_id", F.col("_m.address_id").alias("address_id"), "change_date")


def apply_scd2(history: DataFrame, changes: DataFrame, customer: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new full history, rejected changes).

    Every dated change of the batch becomes a version, so several moves of a customer are all
    kept. A late change (dated before the current version) splits the version that covers its day;
    one dated on the first day of a version replaces that version's address; a move to the
    address already held is no version. Changes for a customer unknown to ``customer`` (when given)
    or without a date are rejected.

    Only the history of the customers in the batch is rebuilt: starts of versions and changes
    are one event list per customer (at most one event a day), and ``lead`` gives the end dates.
    When the batch is within ``CHANGE_BROADCAST_ROWS`` (checked), its customers are broadcast and all
    other history passes through without a shuffle.
    """
    ch = dated_changes(changes)
    small = within_rows(ch, CHANGE_BROADCAST_ROWS)
    undated = ch.where(F.col("change_date").isNull()).withColumn(REASON, F.lit("not_null:change_date"))
    ch, rejected = ch.where(F.col("change_date").isNotNull()), undated
    if customer is not None:
        known = present_keys(ch.select("customer_id").distinct(), customer, "customer_id", CHANGE_BROADCAST_ROWS, small=small)
        known = F.broadcast(known) if small else known
        unknown = ch.join(known, "customer_id", "left_anti").withColumn(REASON, F.lit("fk:customer_id"))
        rejected = rejected.unionByName(unknown)
        ch = ch.join(known, "customer_id", "left_semi")
    changed = ch.select("customer_id").distinct()
    changed = F.broadcast(changed) if small else changed
    untouched = history.join(changed, "customer_id", "left_anti")
    held = history.join(changed, "customer_id", "left_semi")
    event = lambda rank: F.struct(F.lit(rank).alias("rank"), F.col("address_id")).alias("e")
    events = held.select("customer_id", F.col("start_date").alias("day"), event(0)).unionByName(
        ch.select("customer_id", F.col("change_date").alias("day"), event(1))
    )
    daily = events.groupBy("customer_id", "day").agg(F.max("e").alias("e")).select("customer_id", "day", "e.address_id")
    w = Window.partitionBy("customer_id").orderBy("day")
    moves = daily.select("*", F.lag("day").over(w).alias("_pd"), F.lag("address_id").over(w).alias("_pa"))
    moves = moves.where(F.col("_pd").isNull() | ~F.col("address_id").eqNullSafe(F.col("_pa")))
    following = F.lead("day").over(w)
    rebuilt = moves.select(
        "customer_id",
        "address_id",
        F.col("day").alias("start_date"),
        F.date_sub(following, 1).alias("end_date"),
        following.isNull().alias("is_current"),
    )
    return conform(untouched, CUSTOMER_ADDRESS).unionByName(conform(rebuilt, CUSTOMER_ADDRESS)), rejected


@dataclass(frozen=True)
class StoredHistory:
    """N8's history as a table partitioned by customer bucket; a batch rewrites only the buckets of its customers.

    All versions of a customer are in one bucket, so late moves need no other partition. With
    buckets of about a scan split each, the cost of a batch follows the buckets it touches, at most its number
    of customers, not the history.
    """

    path: str
    buckets: int

    def bucket(self, customer_id: str = "customer_id") -> Column:
        return F.pmod(F.xxhash64(F.col(customer_id)), F.lit(self.buckets)).cast("int")

    def create(self, history: DataFrame) -> None:
        """Store a seeded history (N7): brought together by bucket first, so a bucket is one file."""
        rows = conform(history, CUSTOMER_ADDRESS).withColumn(BUCKET, self.bucket())
        store.write_table(rows.repartition(BUCKET), self.path, (BUCKET,))

    def read(self, spark: SparkSession) -> DataFrame:
        return conform(store.read_table(spark, self.path, _STORED), CUSTOMER_ADDRESS)

    def apply(self, changes: DataFrame, customer: DataFrame | None = None) -> DataFrame:
        """N8 on the stored table; returns the rejected changes. Applying a batch again changes nothing.

        The rebuilt buckets are settled before the partitions that they were read from are replaced.
        """
        spark = changes.sparkSession
        ensure_checkpoint_dir(spark)
        touched = [r[0] for r in changes.select(self.bucket().alias(BUCKET)).distinct().collect()]  # ``buckets`` at most
        if not touched:
            return changes.limit(0).withColumn(REASON, F.lit(None).cast("string"))
        held = store.read_table(spark, self.path, _STORED).where(F.col(BUCKET).isin(touched))
        history, rejected = apply_scd2(conform(held, CUSTOMER_ADDRESS), changes, customer)
        rows = history.withColumn(BUCKET, self.bucket()).repartition(BUCKET).checkpoint(eager=True)
        store.write_period(rows, self.path, BUCKET)
        return rejected


def scd2_violations(history: DataFrame) -> DataFrame:
    """Customers with other than exactly one current row, or with overlapping / gapped versions."""
    w = Window.partitionBy("customer_id").orderBy("start_date")
    steps = history.select(
        "customer_id",
        "start_date",
        "end_date",
        F.lag("end_date").over(w).alias("_prev_end"),
        F.lag("start_date").over(w).alias("_prev_start"),
    )
    bad_seq = steps.where(
        F.col("_prev_start").isNotNull()
        & (F.col("_prev_end").isNull() | (F.date_add(F.col("_prev_end"), 1) != F.col("start_date")))
    ).select("customer_id", F.lit("gap_or_overlap").alias("violation"))
    currents = history.groupBy("customer_id").agg(F.sum(F.col("is_current").cast("int")).alias("_n"))
    bad_cur = currents.where(F.col("_n") != 1).select("customer_id", F.lit("current_rows").alias("violation"))
    return bad_seq.unionByName(bad_cur)
