"""Join helpers: broadcast only behind a size check, with a shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (plan hash, input files, bound) -> within bound. Only plans over files are remembered: a
# rewritten table has new part files, so its key changes and it is counted again.
_CHECKED: dict[tuple[int, tuple[str, ...], int], bool] = {}


def within_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    A plain count: every task sends one partial number. (A limit would send up to ``max_rows + 1``
    rows of every partition to one task.) On written tables it reads no column.
    """
    files = tuple(sorted(df.inputFiles()))
    key = (df.semanticHash(), files, max_rows) if files else None
    if key is not None and key in _CHECKED:
        return _CHECKED[key]
    ok = df.count() <= max_rows
    if key is not None:
        _CHECKED[key] = ok
    return ok


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Return ``broadcast(df)`` when ``df`` provably has at most ``max_rows`` rows, else ``df``.

    Above the bound the join is left to the planner: a sort-merge join, or AQE's runtime
    broadcast when the *measured* shuffle size of a side turns out small.
    """
    return F.broadcast(df) if within_rows(df, max_rows) else df


def present_keys(keys: DataFrame, ref: DataFrame, key_col: str, max_rows: int, small: bool | None = None) -> DataFrame:
    """Semi-join reduction: the rows of ``keys`` (one column ``key_col``, distinct) found in ``ref``.

    When ``keys`` is small (checked), it is broadcast into a scan of ``ref``: the large side is
    read once and never shuffled, and the result has at most as many rows as ``keys``.
    Otherwise both sides are joined by shuffle. ``small`` passes a size check already made.
    """
    ref_keys = ref.select(key_col)
    if small if small is not None else within_rows(keys, max_rows):
        return ref_keys.join(F.broadcast(keys), key_col, "left_semi").distinct()
    return keys.join(ref_keys.distinct(), key_col, "left_semi")


def not_in(left: DataFrame, col: str, known: DataFrame, known_col: str, max_rows: int) -> DataFrame:
    """Rows of ``left`` with ``col NOT IN (SELECT known_col FROM known)``, with SQL's NULL rules.

    A NULL among the known values excludes every row; a NULL in ``col`` is excluded unless nothing is known.
    Up to ``max_rows`` known values (checked) this is Spark's null-aware anti join, a broadcast hash join.
    That join always broadcasts the known side; beyond the bound the rule is spelled out instead: the
    NULL and emptiness facts are two scalar aggregates, and the equality is a shuffled anti join.
    """
    values = known.select(F.col(known_col).alias("_known"))
    if within_rows(values, max_rows):
        return left.where(~F.col(col).isin(values))
    facts = values.agg(F.count_if(F.col("_known").isNull()).alias("nulls"), F.count(F.lit(1)).alias("n"))
    nulls, n = facts.select("nulls").scalar(), facts.select("n").scalar()
    open_ = left.where((nulls == 0) & (F.col(col).isNotNull() | (n == 0)))
    return open_.join(values.where(F.col("_known").isNotNull()).distinct(), F.col(col) == F.col("_known"), "left_anti")
