"""Late and corrected sales in stored cumulative tables: find the periods they touched, refresh from there.

A fingerprint per period (rows, sum and xor of row hashes) is stored beside each cumulative table when it is
filled. Later one aggregate over the sales gives today's fingerprints; the periods whose
fingerprints differ, appeared or vanished are the ones that late, corrected or deleted sales touched. A C0 table is
then recomputed from the oldest of them on (:func:`cumulative.refresh_from`, seeded by the stored period before it);
the yearly arrays of C5 are spliced: one year's struct is replaced, inserted or removed in the middle of the stored
arrays, from the sales of the touched years alone.

Order of writes: the fingerprints are taken before the sales are read for the refresh, and stored after the
refreshed partitions. A crash in between, or a sale that arrives meanwhile, only means that the same
periods are found again, and a refresh replaces whole partitions, so it can be repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.operators import cumulative as cum
from tallyhouse.schemas import CUM_CUSTOMER_SALES, SALE_YEAR, conform
from tallyhouse.session import ensure_checkpoint_dir
from tallyhouse.sources import tables as store

#: what the cumulative tables read of a sale; a change of any other column isn't late data to them
HASHED = ("customer_id", "category_id", "region_id", "quantity", "amount", "discount", "invoice_date")
MARKS = ("n_rows", "hash_sum", "hash_xor")


# -- change detection -------------------------------------------------------------------------------
def period_fingerprints(sales_details: DataFrame, grain: str) -> DataFrame:
    """(period, n_rows, hash_sum, hash_xor), one aggregate with map-side combine over the sales.

    Sum and xor of the row hashes depend on no order; together with the count they tell a moved, changed,
    added, removed or repeated row (an xor alone misses a row that comes in twice).
    """
    h = F.xxhash64(*[F.col(c) for c in HASHED])
    rows = sales_details.select(cum.period_expr(grain).alias("period"), h.alias("_h"))
    return rows.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("_h").cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("_h").alias("hash_xor"),
    )


def changed_periods(before: DataFrame, now: DataFrame) -> DataFrame:
    """Periods whose fingerprints differ, are new, or are gone (one row a period on both sides)."""
    b = before.select("period", F.struct(*MARKS).alias("_b"))
    n = now.select("period", F.struct(*MARKS).alias("_n"))
    return b.join(n, "period", "full").where(~F.col("_b").eqNullSafe(F.col("_n"))).select("period")


def fingerprint_path(path: str) -> str:
    return f"{path.rstrip('/')}_periods"


def settled(df: DataFrame) -> DataFrame:
    """``df`` as computed now, in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_fingerprints(fingerprints: DataFrame, path: str) -> None:
    """Remember what the table at ``path`` was filled from."""
    store.write_table(fingerprints.coalesce(1), fingerprint_path(path))


@dataclass(frozen=True)
class Refreshed:
    """What a refresh found and did: the touched periods, oldest first, and the table."""

    periods: list
    table: DataFrame

    @property
    def start(self):
        return self.periods[0] if self.periods else None


def _touched(spark: SparkSession, sales_details: DataFrame, grain: str, path: str) -> tuple[DataFrame, list]:
    """(today's fingerprints, settled before the sales are read again; touched periods in order)."""
    now = settled(period_fingerprints(sales_details, grain))
    before = store.read_table(spark, fingerprint_path(path), now.schema)
    # at most one row a period of the calendar
    return now, sorted(r["period"] for r in changed_periods(before, now).collect())


def _last_stored(spark: SparkSession, path: str, period_col: str, schema: StructType):
    return store.read_table(spark, path, schema).agg(F.max(period_col).alias("p")).first()["p"]


def fill(
    spark: SparkSession,
    sales_details: DataFrame,
    spec: cum.CumulativeSpec,
    path: str,
    names: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The whole table by C9, with the fingerprints it was filled from."""
    marks = settled(period_fingerprints(sales_details, spec.grain))
    store.write_table(cum.backfill(sales_details, spec, names), path, (spec.period_col,))
    store_fingerprints(marks, path)
    return store.read_table(spark, path, spec.schema)


def refresh_late(
    spark: SparkSession,
    sales_details: DataFrame,
    spec: cum.CumulativeSpec,
    path: str,
    names: Callable[[DataFrame], DataFrame] | None = None,
) -> Refreshed:
    """C9 for late data: recompute a stored table from the oldest touched period on, found by fingerprints.

    Periods before it keep their files. Nothing is written when no period differs.
    """
    now, periods = _touched(spark, sales_details, spec.grain, path)
    if periods:
        last = [p for p in (_last_stored(spark, path, spec.period_col, spec.schema), cum.last_period(sales_details, spec.grain)) if p is not None]
        cum.refresh_from(spark, sales_details, spec, path, periods[0], names, max(last))
        store_fingerprints(now, path)
    return Refreshed(periods, store.read_table(spark, path, spec.schema))


# -- C5: splice into the stored arrays --------------------------------------------------------------
def fill_customer_sales(spark: SparkSession, sales_details: DataFrame, customer: DataFrame, path: str) -> DataFrame:
    """C5 by C9, with the fingerprints it was filled from."""
    marks = settled(period_fingerprints(sales_details, "year"))
    store.write_table(cum.backfill_customer_sales(sales_details, customer), path, ("current_year",))
    store_fingerprints(marks, path)
    return store.read_table(spark, path, CUM_CUSTOMER_SALES)


def _of_years(sales_details: DataFrame, years: Iterable[int]) -> DataFrame:
    """The sales of the given years: date ranges for the scan, and the year partitions where there are any."""
    wanted: Column = F.lit(False)
    for y in years:
        wanted = wanted | cum.period_filter("year", y)
    rows = sales_details.where(wanted)
    return rows.where(F.col(SALE_YEAR).isin(*years)) if SALE_YEAR in sales_details.columns else rows


def year_stats(sales_details: DataFrame, years: list[int]) -> DataFrame:
    """(customer_id, fresh): the structs of the given years, in order; at most one a year."""
    per = _of_years(sales_details, years).groupBy("customer_id", F.year("invoice_date").alias("_y")).agg(
        cum.stats_struct(F.col("_y")).alias("_s")
    )
    return per.groupBy("customer_id").agg(F.array_sort(F.collect_list("_s")).alias("fresh"))


def splice(stored: DataFrame, fresh: DataFrame, years: list[int], end: int) -> DataFrame:
    """Stored C5 rows with the structs of ``years`` replaced by ``fresh`` ones, up to the year ``end``.

    ``stored`` holds the partitions from the oldest of ``years`` on (or the last one, if it is older), ``fresh``
    the customer's number as well. Years after the last stored one carry its rows forward. Customers whose first sale is a late one get their rows from
    that year on; a customer whose last struct goes loses the row. Arrays stay ordered by year.
    """
    start = min(years)
    last = stored.agg(F.max("current_year").alias("y")).first()["y"]
    held = stored.where(F.col("current_year") >= start)
    if last is not None and last < end:
        ahead = F.explode(F.sequence(F.lit(max(last + 1, start)), F.lit(end))).alias("current_year")
        held = held.unionByName(stored.where(F.col("current_year") == last).select("customer_id", "customer_no", "sales_stats", ahead))
    first = F.greatest(F.col("fresh")[0]["sales_year"], F.lit(start))
    new = fresh.select("customer_id", F.col("customer_no").alias("_no"), "fresh", F.explode(F.sequence(first, F.lit(end))).alias("current_year"))
    new = new.withColumn("fresh", F.filter("fresh", lambda s: s["sales_year"] <= F.col("current_year")))
    both = held.join(new, ["customer_id", "current_year"], "full")
    kept = F.filter("sales_stats", lambda s: ~s["sales_year"].isin(*years))
    none = F.array().cast(CUM_CUSTOMER_SALES["sales_stats"].dataType)
    stats = F.array_sort(F.concat(F.coalesce(kept, none), F.coalesce(F.col("fresh"), none)))
    return both.select("customer_id", F.coalesce("customer_no", "_no").alias("customer_no"), stats.alias("sales_stats"), "current_year").where(F.size("sales_stats") > 0)


def refresh_customer_sales(spark: SparkSession, sales_details: DataFrame, customer: DataFrame, path: str) -> Refreshed:
    """C5 for late data: touched years found by fingerprints, their structs spliced into every later stored array.

    Reads the sales of the touched years and the stored partitions from the oldest of them on. The
    result is settled before the partitions it was read from are replaced.
    """
    now, years = _touched(spark, sales_details, "year", path)
    if years:
        table = store.read_table(spark, path, CUM_CUSTOMER_SALES)
        last = _last_stored(spark, path, "current_year", CUM_CUSTOMER_SALES)
        end = max(y for y in (last, years[-1]) if y is not None)
        base = table.where(F.col("current_year") >= min(years[0], last if last is not None else years[0]))
        fresh = cum.with_customer_numbers(year_stats(sales_details, years), customer)
        spliced = conform(splice(base, fresh, years, end), CUM_CUSTOMER_SALES)
        store.write_period(settled(spliced), path, "current_year")
        store_fingerprints(now, path)
    return Refreshed(years, store.read_table(spark, path, CUM_CUSTOMER_SALES))
