"""K1-K3: surrogate keys.

``dense_key`` numbers the distinct rows of a DataFrame 1..n in sorted order, in parallel:

1. range-partition by the sort columns and sort each partition (one shuffle; AQE may merge
   adjacent small ranges, which keeps the order);
2. tag each row with ``monotonically_increasing_id`` (partition index in the high bits, position in
   the partition in the low bits) and checkpoint, so the layout is fixed for the passes below;
3. count rows per partition (n rows out), turn the counts into starting offsets;
4. key = offset of the row's partition + its position in the partition + 1.

No task ever holds more than one range partition, and only the per-partition counts (one row per
partition) are broadcast. ``group_cols`` restarts the numbering per group (several small lookups
keyed in one pass).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import ensure_checkpoint_dir

_ROW = "_th_row"
_PART = "_th_part"
_POS = "_th_pos"
_OFFSET = "_th_offset"


def _order(cols: Sequence[str]) -> list[Column]:
    # ascending with NULLs last, as an SQL ORDER BY does in the reference's database
    return [F.col(c).asc_nulls_last() for c in cols]


def dense_key(
    df: DataFrame,
    order_cols: Sequence[str],
    key_col: str,
    group_cols: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``key_col`` = 1..n following the order of ``order_cols`` (within ``group_cols``).

    Rows should be distinct on ``group_cols + order_cols`` for the key to be deterministic.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ordering = _order([*group_cols, *order_cols])
    ranged = df.repartitionByRange(num_partitions, *ordering) if num_partitions else df.repartitionByRange(*ordering)
    laid_out = (
        ranged
        .sortWithinPartitions(*ordering)
        .withColumn(_ROW, F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    tagged = laid_out.withColumn(_PART, F.shiftright(F.col(_ROW), 33)).withColumn(
        _POS, F.col(_ROW) - F.shiftleft(F.col(_PART), 33)
    )
    # one row per (partition, group): its size and where the group starts inside the partition
    counts = tagged.groupBy(_PART, *group_cols).agg(F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_first"))
    # at most (#partitions x #groups) rows: a proven bound for the window and the broadcast
    before = Window.partitionBy(*group_cols).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        _PART, *group_cols, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFFSET)
    )
    # position inside the partition counts rows of earlier groups too; subtract them
    pos = F.col(_POS) - F.col("_first")
    keyed = tagged.join(F.broadcast(offsets), [_PART, *group_cols]).withColumn(
        key_col, (F.col(_OFFSET) + pos + 1).cast("int")
    )
    return keyed.drop(_ROW, _PART, _POS, _OFFSET, "_first")


def row_key(df: DataFrame, key_col: str) -> DataFrame:
    """K3: a unique (not dense) key for fact rows; never compared across runs."""
    return df.withColumn(key_col, (F.monotonically_increasing_id() + 1).cast("long"))
