"""Keyed upsert into a stored partitioned table (what MERGE does, on plain Parquet).

1. Find the partitions to touch: those that hold a key of the batch now (the key columns of the table, semi-joined
   with the batch's keys), and those that its rows go to. When the partition column is part of the key, the
   batch alone tells.
2. In these, and only there, matched rows are replaced or deleted and new ones inserted. All other
   partitions keep their files.
3. The touched partitions are replaced by one dynamic overwrite; one that is left without rows is dropped after it.

The result depends only on the table and the batch's last row per key, so a batch can be applied again after a
crash, or by mistake, and changes nothing more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.operators.quality import REASON
from tallyhouse.plans.joins import within_rows
from tallyhouse.schemas import conform
from tallyhouse.session import ensure_checkpoint_dir
from tallyhouse.sources import tables as store

# a batch with up to this many keys is broadcast into the scans of the table
KEY_BROADCAST_ROWS = 1_000_000
DELETED = "deleted"


def last_per_key(updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``, then by the other columns (so that ties have one outcome).

    ``max`` over a struct combines on the map side: a key repeated without bound leaves one row a task.
    """
    rest = [*order, *[c for c in updates.columns if c not in keys and c not in order]]
    best = updates.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def upsert(
    spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], partition_col: str, schema: StructType, order: Sequence[str] = ()
) -> DataFrame:
    """Apply ``updates`` to the table at ``path`` (which need not exist yet); returns the rejected rows.

    ``updates`` has the table's columns and may have ``deleted`` (true: the key's row goes). Rows with a NULL in a key
    are rejected: a key that equals nothing can't be applied twice with one outcome.
    """
    ensure_checkpoint_dir(spark)
    keys = list(keys)
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    rejected = updates.where(keyless).withColumn(REASON, F.lit("null_key"))
    flagged = updates.where(~keyless)
    if DELETED not in updates.columns:
        flagged = flagged.withColumn(DELETED, F.lit(False))
    cols = [*schema.names, DELETED]
    batch = last_per_key(flagged.select(*cols), keys, order).select(*cols).checkpoint(eager=True)
    small = within_rows(batch, KEY_BROADCAST_ROWS)
    batch_keys = F.broadcast(batch.select(*keys)) if small else batch.select(*keys)
    table = store.read_table(spark, path, schema)
    new = batch.where(~F.coalesce(F.col(DELETED), F.lit(False)))
    to = new.select(partition_col)
    at = batch.select(partition_col) if partition_col in keys else table.select(*keys, partition_col).join(batch_keys, keys, "left_semi").select(partition_col)
    held = [r[0] for r in at.distinct().collect()]  # partitions are few: a folder each
    touched = set(held) | {r[0] for r in to.distinct().collect()}
    if not touched:
        return rejected
    kept = in_partitions(table, partition_col, touched).join(batch_keys, keys, "left_anti")
    rows = conform(kept.unionByName(new.drop(DELETED)), schema).checkpoint(eager=True)
    store.write_period(rows, path, partition_col)
    filled = {r[0] for r in rows.select(partition_col).distinct().collect()}
    gone = [p for p in held if p not in filled]
    store.drop_partitions(spark, path, [((partition_col, p),) for p in gone])
    return rejected


def in_partitions(table: DataFrame, partition_col: str, values) -> DataFrame:
    """Rows of the given partitions (a partition filter), the one of NULL included when it is among them."""
    some = [v for v in values if v is not None]
    wanted = F.col(partition_col).isin(some)
    return table.where(wanted | F.col(partition_col).isNull() if None in values else wanted)
