"""K4-K7: keys and constraints as batch checks, and the accepted / rejected split.

A database enforces these row by row at insert time; here each is a DataFrame returning the
violating rows, and :func:`split_by_rules` tags every row with the first rule it breaks so one
pass yields both the accepted rows and the quarantine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.plans.joins import within_rows

REASON = "reject_reason"


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K4: key values that are NULL or occur more than once, with their row count.

    One aggregation with map-side combine; a hot key costs one counter, not its rows.
    """
    any_null = None
    for k in keys:
        any_null = F.col(k).isNull() if any_null is None else (any_null | F.col(k).isNull())
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where((F.col("row_count") > 1) | any_null).withColumn(
        "violation", F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate_key"))
    )


# referenced key sets up to this size are broadcast (2M int keys are ~16 MB)
FK_BROADCAST_ROWS = 2_000_000


def foreign_key_orphans(
    df: DataFrame, cols: Sequence[str], ref: DataFrame, ref_cols: Sequence[str], broadcast_rows: int = FK_BROADCAST_ROWS
) -> DataFrame:
    """K5: rows whose non-NULL foreign key has no match in ``ref`` (an SQL FK ignores NULL keys).

    The referenced keys are de-duplicated first, so the anti join's build side is one row per
    key; it is broadcast after a size check, else the anti join shuffles both sides.
    """
    keys = ref.select(*[F.col(r).alias(f"_ref_{i}") for i, r in enumerate(ref_cols)]).distinct()
    # bound on raw rows: an upper bound of the distinct keys, and the count stops early
    keys = F.broadcast(keys) if within_rows(ref.select(*ref_cols), broadcast_rows) else keys
    cond = None
    for i, c in enumerate(cols):
        e = F.col(c) == F.col(f"_ref_{i}")
        cond = e if cond is None else cond & e
    present = None
    for c in cols:
        e = F.col(c).isNotNull()
        present = e if present is None else present & e
    return df.where(present).join(keys, cond, "left_anti")


def constraint_report(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    checks: Sequence[tuple[str, Column]] = (),
    foreign_keys: Sequence[tuple[str, str, DataFrame, str]] = (),
    broadcast_rows: int = FK_BROADCAST_ROWS,
) -> DataFrame:
    """K5-K7 for one table in a single scan: rows ``(check_name, violations)``.

    NOT NULL (rows with any NULL in ``not_null``) and CHECK predicates are conditional counts.
    A foreign key ``(label, col, ref, ref_col)`` whose referenced key set fits ``broadcast_rows``
    is a broadcast flag join on the same pass. A larger one is checked on per-key row counts
    (partial aggregation), anti-joined with the referenced keys, so only distinct keys move.
    """
    counted: list[tuple[str, Column]] = []  # (check name, condition of a violating row)
    if not_null:
        any_null = None
        for c in not_null:
            e = F.col(c).isNull()
            any_null = e if any_null is None else any_null | e
        counted.append((f"not_null:{table}", any_null))
    for name, pred in checks:
        counted.append((name, ~F.coalesce(pred, F.lit(True))))
    flagged = df
    large: list[tuple[str, str, DataFrame, str]] = []
    for i, (label, col, ref, ref_col) in enumerate(foreign_keys):
        keys = ref.select(F.col(ref_col).alias(f"_fk{i}")).distinct()
        if within_rows(ref.select(ref_col), broadcast_rows):  # raw rows bound the distinct keys
            flagged = flagged.join(F.broadcast(keys.withColumn(f"_has{i}", F.lit(True))), F.col(col) == F.col(f"_fk{i}"), "left")
            counted.append((label, F.col(col).isNotNull() & F.col(f"_has{i}").isNull()))
        else:
            large.append((label, col, ref, ref_col))
    parts = []
    if counted:
        names = [f"_c{i}" for i in range(len(counted))]
        wide = flagged.agg(*[F.sum(F.when(cond, 1).otherwise(0)).alias(n) for n, (_, cond) in zip(names, counted)])
        wide = wide.select(*[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(label) for n, (label, _) in zip(names, counted)])
        parts.append(wide.unpivot([], [label for label, _ in counted], "check_name", "violations"))
    for label, col, ref, ref_col in large:
        per_key = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        orphans = per_key.join(ref.select(F.col(ref_col).alias("_k")).distinct(), "_k", "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violations")).select(
            F.lit(label).alias("check_name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_violations(df: DataFrame, predicate: Column) -> DataFrame:
    """K6: rows where a CHECK predicate is *false*; NULL passes a CHECK constraint."""
    return df.where(~F.coalesce(predicate, F.lit(True)))


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K7: rows with a NULL in any of ``cols``."""
    cond = None
    for c in cols:
        e = F.col(c).isNull()
        cond = e if cond is None else cond | e
    return df.where(cond)


def first_failure(rules: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first rule whose failure condition is true, else NULL.

    Each rule is ``(name, fails)`` where ``fails`` is a boolean column; a NULL ``fails`` counts as
    passing.
    """
    out = None
    for name, fails in rules:
        cond = F.coalesce(fails, F.lit(False))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out if out is not None else F.lit(None).cast("string")


def not_null_rules(cols: Sequence[str]) -> list[tuple[str, Column]]:
    return [(f"not_null:{c}", F.col(c).isNull()) for c in cols]


def tag_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    return df.withColumn(REASON, first_failure(rules))


def split_by_rules(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``reject_reason``). Both derive from one tagged plan."""
    tagged = tag_rejects(df, rules)
    return tagged.where(F.col(REASON).isNull()).drop(REASON), tagged.where(F.col(REASON).isNotNull())
