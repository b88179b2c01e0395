"""Cumulative tables ("yesterday FULL OUTER JOIN today").

Rule for keys that skip a period: a key with no sale in the target period is carried forward
*under the target period* with its totals unchanged. Wherever the reference's statements succeed
this gives the same rows; where they would write a NULL or duplicate key it gives a defined row.

Two ways to fill a table, which must agree:

* :func:`cumulate_step` (C0) computes one period from the prior period's rows, as the reference
  does, and :func:`run_chain` repeats it period by period, writing each period partition;
* :func:`backfill` (C9) computes all periods in one job: aggregate per (key, period), running
  totals over a window partitioned by key, then each active period is expanded over the periods
  until the key's next activity. A window partition holds one row per *active period* of one key,
  so a key with a third of all sales still has at most #periods rows.

Descriptive names (category, region, customer_no) are joined after aggregation, on ids.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from tallyhouse.functions.exprs import exact_ratio, year_range
from tallyhouse.plans.joins import bounded_broadcast
from tallyhouse.schemas import (
    CUM_CUSTOMER_PRODUCT_ENGAGE,
    CUM_CUSTOMER_REVENUE,
    CUM_CUSTOMER_SALES,
    CUM_PRODUCT_SALES,
    CUM_REGION_PRODUCT_SALES,
    SALE_YEAR,
    SALES_STATS,
    conform,
)
from tallyhouse.session import ROWS_PER_TASK
from tallyhouse.sources import tables as store

LOOKUP_BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class CumulativeSpec:
    name: str
    keys: tuple[str, ...]
    grain: str  # "day" or "year"
    period_col: str
    measures: tuple[tuple[str, str], ...]  # (output column, sales_details column summed)
    schema: StructType
    fine: bool = False  # a cell (keys, period) has a few sales only: combining them before a shuffle saves little


PRODUCT_SALES = CumulativeSpec(
    "cum_product_sales",
    ("category_id",),
    "day",
    "present_date",
    (("cumulative_quantity", "quantity"), ("cumulative_sales", "amount")),
    CUM_PRODUCT_SALES,
)
REGION_PRODUCT_SALES = CumulativeSpec(
    "cum_region_product_sales",
    ("region_id", "category_id"),
    "year",
    "current_year",
    (("cumulative_sales", "amount"),),
    CUM_REGION_PRODUCT_SALES,
)
CUSTOMER_PRODUCT_ENGAGE = CumulativeSpec(
    "cum_customer_product_engage",
    ("customer_id", "category_id"),
    "year",
    "current_year",
    (("cum_purchase_count", "quantity"), ("cumulative_sales", "amount")),
    CUM_CUSTOMER_PRODUCT_ENGAGE,
    fine=True,
)
CUSTOMER_REVENUE = CumulativeSpec(
    "cum_customer_revenue",
    ("customer_id",),
    "year",
    "current_year",
    (("cum_amount_spent", "amount"),),
    CUM_CUSTOMER_REVENUE,
)
SPECS = {s.name: s for s in (PRODUCT_SALES, REGION_PRODUCT_SALES, CUSTOMER_PRODUCT_ENGAGE, CUSTOMER_REVENUE)}


# -- periods -----------------------------------------------------------------------------------
def period_expr(grain: str, date_col: str = "invoice_date") -> Column:
    d = F.col(date_col)
    return d if grain == "day" else F.year(d).cast("int")


def period_filter(grain: str, period, date_col: str = "invoice_date") -> Column:
    """Rows of one period, written so that Parquet can skip row groups."""
    if grain == "day":
        return F.col(date_col) == F.lit(period)
    return year_range(date_col, int(period))


def sales_of_period(sales_details: DataFrame, grain: str, period) -> DataFrame:
    """The sales of one period; a layout partitioned by ``SALE_YEAR`` is pruned to the period's year."""
    rows = sales_details.where(period_filter(grain, period))
    if SALE_YEAR in sales_details.columns:
        rows = rows.where(F.col(SALE_YEAR) == F.lit(period.year if grain == "day" else int(period)))
    return rows


def up_to(grain: str, end, date_col: str = "invoice_date") -> Column:
    """Rows in periods up to and including ``end`` (a range on the date, pushed to the scan)."""
    if grain == "day":
        return F.col(date_col) <= F.lit(end)
    return F.col(date_col) < F.lit(_dt.date(int(end) + 1, 1, 1))


def previous_period(grain: str, period):
    return period - _dt.timedelta(days=1) if grain == "day" else int(period) - 1


def _period_lit(grain: str, period) -> Column:
    return F.lit(period).cast("date") if grain == "day" else F.lit(int(period)).cast("int")


# -- names ---------------------------------------------------------------------------------------
def name_joiner(product_category: DataFrame | None = None, region: DataFrame | None = None) -> Callable[[DataFrame], DataFrame]:
    """Attach category / region names to a frame keyed by ids (lookups broadcast after a size check)."""

    def attach(df: DataFrame) -> DataFrame:
        out = df
        if product_category is not None and "category_id" in df.columns:
            pc = product_category.select("category_id", F.col("category").alias("product_category"))
            out = out.join(bounded_broadcast(pc, LOOKUP_BROADCAST_ROWS), "category_id", "left")
        if region is not None and "region_id" in df.columns:
            rg = region.select("region_id", F.col("region_name").alias("region"))
            out = out.join(bounded_broadcast(rg, LOOKUP_BROADCAST_ROWS), "region_id", "left")
        return out

    return attach


# -- C0: one step -----------------------------------------------------------------------------
def period_totals(sales_details: DataFrame, spec: CumulativeSpec, period) -> DataFrame:
    """``today``: one row per key with the period's sums (the key is unique on this side)."""
    today = sales_of_period(sales_details, spec.grain, period)
    return today.groupBy(*spec.keys).agg(*[F.sum(src).alias(out) for out, src in spec.measures])


def cumulate_step(
    today: DataFrame,
    yesterday: DataFrame,
    spec: CumulativeSpec,
    period,
    names: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``yesterday FULL OUTER JOIN today`` on the keys; totals add up, the period is the target's.

    Both sides have one row per key, so the full join cannot fan out; it shuffles both sides on
    the keys (or neither, when both are stored bucketed by the keys).
    """
    t = today.select(*spec.keys, *[F.col(out).alias(f"_t_{out}") for out, _ in spec.measures])
    y = yesterday.select(*spec.keys, *[F.col(out).alias(f"_y_{out}") for out, _ in spec.measures])
    joined = t.join(y, list(spec.keys), "full")
    out = joined.select(
        *spec.keys,
        *[
            (F.coalesce(F.col(f"_y_{out}"), F.lit(0)) + F.coalesce(F.col(f"_t_{out}"), F.lit(0))).alias(out)
            for out, _ in spec.measures
        ],
        _period_lit(spec.grain, period).alias(spec.period_col),
    )
    if names is not None:
        out = names(out)
    return conform(out, spec.schema)


def run_chain(
    spark: SparkSession,
    sales_details: DataFrame,
    spec: CumulativeSpec,
    periods: Sequence,
    path: str,
    names: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Fill ``path`` period by period with C0 steps; each step reads the prior partition back.

    Writing every period keeps the plan of the next step short (lineage stops at the file) and
    makes a rerun of any period an idempotent partition overwrite.
    """
    for period in periods:
        prior = store.prior_period(
            store.read_table(spark, path, spec.schema), spec.period_col,
            _period_lit(spec.grain, previous_period(spec.grain, period)), _period_lit(spec.grain, period),
        )
        step = cumulate_step(period_totals(sales_details, spec, period), prior, spec, period, names)
        store.write_period(step, path, spec.period_col)
    return store.read_table(spark, path, spec.schema)


def run_bucketed_chain(
    spark: SparkSession,
    sales_table: str,
    spec: CumulativeSpec,
    periods: Sequence,
    table: str,
    path: str,
    buckets: int,
    names: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """C0 repeated on a catalog table partitioned by period and bucketed by the first key.

    With ``sales_table`` bucketed the same way, each step reads one sales period and one prior
    partition, aggregates and full-joins them without any shuffle (the reference's "historical
    analysis without shuffle"); for a two-key table this needs
    ``spark.sql.requireAllClusterKeysForCoPartition=false``.
    """
    sales = spark.table(sales_table)
    for period in periods:
        if store.table_exists(spark, table):
            prior = store.prior_period(
                spark.table(table), spec.period_col,
                _period_lit(spec.grain, previous_period(spec.grain, period)), _period_lit(spec.grain, period),
            )
        else:
            prior = spark.createDataFrame([], spec.schema)
        step = cumulate_step(period_totals(sales, spec, period), prior, spec, period, names)
        if store.table_exists(spark, table):
            store.insert_period(step, table)
        else:
            store.save_bucketed(step, table, path, spec.keys[:1], buckets, partition_by=(spec.period_col,))
    return spark.table(table)


# -- C9: all periods in one job ---------------------------------------------------------------
def last_period(sales_details: DataFrame, grain: str):
    """The last period with sales (one scalar)."""
    return sales_details.agg(F.max(period_expr(grain)).alias("p")).first()["p"]


def first_period(sales_details: DataFrame, grain: str):
    """The first period with sales (one scalar)."""
    return sales_details.agg(F.min(period_expr(grain)).alias("p")).first()["p"]


def expand_periods(grain: str, start: Column, next_active: Column, end) -> Column:
    """Periods from ``start`` until the period before ``next_active`` (or ``end``)."""
    if grain == "day":
        stop = F.coalesce(F.date_sub(next_active, 1), F.lit(end).cast("date"))
        return F.sequence(start, stop, F.expr("INTERVAL 1 DAY"))
    stop = F.coalesce(next_active - 1, F.lit(int(end)))
    return F.sequence(start, stop)


KEY_BUCKETS, MAX_KEY_SKEW = 64, 2.0


def key_spread(sales_details: DataFrame, spec: CumulativeSpec) -> tuple[object, int, float]:
    """(last period, rows, largest bucket of the keys over the mean one), by one scan that sends a row per bucket and task."""
    bucket = F.pmod(F.hash(*spec.keys), F.lit(KEY_BUCKETS))
    found = sales_details.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), F.max(period_expr(spec.grain)).alias("p")).collect()
    total = sum(r["n"] for r in found)
    skew = max((r["n"] for r in found), default=0) * KEY_BUCKETS / total if total else 0.0
    return max((r["p"] for r in found if r["p"] is not None), default=None), total, skew


def by_key(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df`` shuffled by its keys, to more tasks than the session's shuffle width if ``rows`` need them."""
    tasks = math.ceil(rows / ROWS_PER_TASK)
    return df.repartition(tasks, *keys) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(*keys)


def backfill(
    sales_details: DataFrame,
    spec: CumulativeSpec,
    names: Callable[[DataFrame], DataFrame] | None = None,
    end=None,
) -> DataFrame:
    """The whole cumulative table, every key from its first period to ``end``.

    Sums per (key, period) are combined before the shuffle, then brought together by key: two shuffles. The sales of
    a ``fine`` table go to their key at once instead, in one; unless some keys hold far more of them than others.
    Names depend on the keys only and are attached before the periods are filled in.

    Equals :func:`run_chain` over all periods (tested).
    """
    together = False
    if spec.fine:
        last, rows, skew = key_spread(sales_details, spec)
        end, together = end if end is not None else last, skew <= MAX_KEY_SKEW
    end = end if end is not None else last_period(sales_details, spec.grain)
    sales = sales_details.where(up_to(spec.grain, end))
    if together:
        sales = by_key(sales.select(*spec.keys, "invoice_date", *dict.fromkeys(src for _, src in spec.measures)), spec.keys, rows)
    per = sales.groupBy(*spec.keys, period_expr(spec.grain).alias("_p")).agg(
        *[F.sum(src).alias(out) for out, src in spec.measures]
    )
    w = Window.partitionBy(*spec.keys).orderBy("_p")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = per.select(
        *spec.keys,
        "_p",
        F.lead("_p").over(w).alias("_next"),
        *[F.sum(out).over(running).alias(out) for out, _ in spec.measures],
    )
    if names is not None:
        run = names(run)
    periods = F.explode(expand_periods(spec.grain, F.col("_p"), F.col("_next"), end)).alias(spec.period_col)
    return conform(run.select(*[c for c in run.columns if c not in ("_p", "_next")], periods), spec.schema)


def backfill_sparse(sales_details: DataFrame, spec: CumulativeSpec) -> DataFrame:
    """C9, sparse: running totals only at each key's *active* periods.

    The dense table has a row per key for every period after its first sale (keys x periods);
    for fine periods (days) over many keys (customers) that explodes. This form keeps one row per
    key and active period, the same running totals, and :func:`as_of` reads any period from it.
    """
    per = sales_details.groupBy(*spec.keys, period_expr(spec.grain).alias(spec.period_col)).agg(
        *[F.sum(src).alias(out) for out, src in spec.measures]
    )
    running = Window.partitionBy(*spec.keys).orderBy(spec.period_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = per.select(*spec.keys, spec.period_col, *[F.sum(out).over(running).alias(out) for out, _ in spec.measures])
    return conform(out, spec.schema)


def as_of(sparse: DataFrame, spec: CumulativeSpec, period, names: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The dense table's rows for ``period``, read from the sparse form: per key, the latest
    active row at or before ``period`` (``max_by``, one aggregation with map-side combine)."""
    lit = _period_lit(spec.grain, period)
    latest = (
        sparse.where(F.col(spec.period_col) <= lit)
        .groupBy(*spec.keys)
        .agg(F.max_by(F.struct(*[out for out, _ in spec.measures]), F.col(spec.period_col)).alias("_m"))
    )
    out = latest.select(*spec.keys, *[F.col(f"_m.{out}").alias(out) for out, _ in spec.measures], lit.alias(spec.period_col))
    if names is not None:
        out = names(out)
    return conform(out, spec.schema)


def refresh_from(
    spark: SparkSession,
    sales_details: DataFrame,
    spec: CumulativeSpec,
    path: str,
    start,
    names: Callable[[DataFrame], DataFrame] | None = None,
    end=None,
) -> DataFrame:
    """Late data: recompute periods ``start..end`` of a stored cumulative table and replace them.

    ``start`` is the oldest period touched by late sales. The stored partition before it holds
    every key's totals so far; they seed running sums over the sales of ``start..end`` only, so the
    cost follows the refreshed periods, not all of history. Dynamic overwrite replaces exactly
    the refreshed partitions, so a refresh can be rerun. Raises when the seeding partition is
    missing although there are older sales.
    """
    end = end if end is not None else last_period(sales_details, spec.grain)
    prev = previous_period(spec.grain, start)
    base = store.read_period(spark, path, spec.period_col, prev, spec.schema)
    if not base.take(1) and sales_details.where(up_to(spec.grain, prev)).take(1):
        raise ValueError(f"the period before {start} isn't stored, but there are sales up to it")
    base = base.select(
        *spec.keys, _period_lit(spec.grain, prev).alias("_p"), *[out for out, _ in spec.measures]
    )
    recent = (
        sales_details.where(up_to(spec.grain, end) & ~up_to(spec.grain, prev))
        .groupBy(*spec.keys, period_expr(spec.grain).alias("_p"))
        .agg(*[F.sum(src).alias(out) for out, src in spec.measures])
    )
    w = Window.partitionBy(*spec.keys).orderBy("_p")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = base.unionByName(recent, allowMissingColumns=False).select(
        *spec.keys,
        "_p",
        F.lead("_p").over(w).alias("_next"),
        *[F.sum(out).over(running).alias(out) for out, _ in spec.measures],
    )
    first = F.greatest(F.col("_p"), _period_lit(spec.grain, start))
    if spec.grain == "day":
        stop = F.coalesce(F.date_sub(F.col("_next"), 1), F.lit(end).cast("date"))
        periods = F.when(first <= stop, F.sequence(first, stop, F.expr("INTERVAL 1 DAY")))
    else:
        stop = F.coalesce(F.col("_next") - 1, F.lit(int(end)))
        periods = F.when(first <= stop, F.sequence(first, stop))
    expanded = run.select(
        *spec.keys, F.explode(periods).alias(spec.period_col), *[out for out, _ in spec.measures]
    )
    if names is not None:
        expanded = names(expanded)
    refreshed = conform(expanded, spec.schema)
    store.write_period(refreshed, path, spec.period_col)
    return store.read_table(spark, path, spec.schema)


# -- C5: yearly statistics as an array of structs ----------------------------------------------
def stats_struct(year: Column) -> Column:
    return F.struct(
        year.cast("int").alias("sales_year"),
        F.sum("discount").cast("float").alias("total_discount"),
        F.sum("amount").cast("float").alias("total_amount_spent"),
        F.sum("quantity").cast("long").alias("total_qty_purchased"),
    ).cast(SALES_STATS)


# customer numbers are broadcast for up to 1M customers (~30 MB); beyond, the join shuffles
CUSTOMER_BROADCAST_ROWS = 1_000_000


def with_customer_numbers(df: DataFrame, customer: DataFrame) -> DataFrame:
    # customer_id is the customer table's unique key, so the join cannot fan out
    numbers = bounded_broadcast(customer.select("customer_id", "customer_no"), CUSTOMER_BROADCAST_ROWS)
    return df.join(numbers, "customer_id", "left")


def customer_sales_step(sales_details: DataFrame, yesterday: DataFrame, customer: DataFrame, year: int) -> DataFrame:
    """C5 step: append this year's statistics to each customer's array.

    New customers start a one-element array; customers without sales this year keep their array
    unchanged (nothing NULL is appended); every row is labelled with the target year. The number
    of a customer depends only on its id, so it is attached after the full join; the join itself
    stays co-partitioned when both sides are bucketed by customer_id.
    """
    today = (
        sales_of_period(sales_details, "year", year)
        .groupBy("customer_id")
        .agg(stats_struct(F.lit(year)).alias("_stats"))
    )
    y = yesterday.select("customer_id", F.col("customer_no").alias("_y_no"), F.col("sales_stats").alias("_y_stats"))
    j = with_customer_numbers(today.join(y, "customer_id", "full"), customer)
    stats = (
        F.when(F.col("_y_stats").isNull(), F.array(F.col("_stats")))
        .when(F.col("_stats").isNotNull(), F.concat(F.col("_y_stats"), F.array(F.col("_stats"))))
        .otherwise(F.col("_y_stats"))
    )
    out = j.select(
        "customer_id",
        F.coalesce("customer_no", "_y_no").alias("customer_no"),
        stats.alias("sales_stats"),
        F.lit(year).cast("int").alias("current_year"),
    )
    return conform(out, CUM_CUSTOMER_SALES)


def run_customer_sales_chain(
    spark: SparkSession, sales_details: DataFrame, customer: DataFrame, years: Sequence[int], path: str
) -> DataFrame:
    for year in years:
        prior = store.prior_period(store.read_table(spark, path, CUM_CUSTOMER_SALES), "current_year", F.lit(year - 1), F.lit(year))
        store.write_period(customer_sales_step(sales_details, prior, customer, year), path, "current_year")
    return store.read_table(spark, path, CUM_CUSTOMER_SALES)


def run_bucketed_customer_sales_chain(
    spark: SparkSession, sales_table: str, customer: DataFrame, years: Sequence[int], table: str, path: str, buckets: int
) -> DataFrame:
    """C5 steps on a catalog table partitioned by year and bucketed by customer_id (see
    :func:`run_bucketed_chain`)."""
    sales = spark.table(sales_table)
    for year in years:
        if store.table_exists(spark, table):
            prior = store.prior_period(spark.table(table), "current_year", F.lit(year - 1), F.lit(year))
        else:
            prior = spark.createDataFrame([], CUM_CUSTOMER_SALES)
        step = customer_sales_step(sales, prior, customer, year)
        if store.table_exists(spark, table):
            store.insert_period(step, table)
        else:
            store.save_bucketed(step, table, path, ("customer_id",), buckets, partition_by=("current_year",))
    return spark.table(table)


def backfill_customer_sales(sales_details: DataFrame, customer: DataFrame, end: int | None = None) -> DataFrame:
    """C9 for C5: per (customer, year) statistics, the running array over a window by customer."""
    end = end if end is not None else last_period(sales_details, "year")
    per = sales_details.where(up_to("year", end)).groupBy("customer_id", F.year("invoice_date").alias("_p")).agg(
        stats_struct(F.col("_p")).alias("_stats")
    )
    w = Window.partitionBy("customer_id").orderBy("_p")
    run = per.select(
        "customer_id",
        "_p",
        F.lead("_p").over(w).alias("_next"),
        F.collect_list("_stats").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("sales_stats"),
    )
    expanded = run.select(
        "customer_id",
        "sales_stats",
        F.explode(expand_periods("year", F.col("_p").cast("int"), F.col("_next").cast("int"), end)).alias("current_year"),
    )
    return conform(with_customer_numbers(expanded, customer), CUM_CUSTOMER_SALES)


def unnest_customer_sales(cum_customer_sales: DataFrame, year: int) -> DataFrame:
    """One row per element of the statistics array (struct column kept)."""
    return cum_customer_sales.where(F.col("current_year") == year).select(
        "customer_id", "customer_no", F.explode("sales_stats").alias("sales_stats")
    )


def flatten_customer_sales(cum_customer_sales: DataFrame, year: int) -> DataFrame:
    """The array exploded and the struct expanded into columns (``inline``)."""
    return cum_customer_sales.where(F.col("current_year") == year).select(
        "customer_no", F.inline("sales_stats")
    )


def lookup(cum_table: DataFrame, **equals) -> DataFrame:
    """Rows matching column = value for each keyword (pushed to the scan / partition filter)."""
    out = cum_table
    for c, v in equals.items():
        out = out.where(F.col(c) == F.lit(v))
    return out


# -- C10: transitions --------------------------------------------------------------------------
TRANSITION_STATES = ("New", "Retained", "Resurrected", "Churned", "Stale")


def transition_analysis(cum_customer_sales: DataFrame) -> DataFrame:
    """Each customer-year labelled New / Retained / Resurrected / Churned / Stale.

    Read from the history array of the row itself (no join to the prior year, no window).
    """
    year = F.col("current_year")
    stats = F.col("sales_stats")
    first_year = F.get(stats, 0)["sales_year"]
    active = F.exists(stats, lambda s: s["sales_year"] == year)
    was_active = F.exists(stats, lambda s: s["sales_year"] == year - 1)
    state = _labels(first_year == year, active, was_active)
    return cum_customer_sales.select("customer_id", "current_year", state.alias("transition_state"))


def _labels(is_new: Column, active: Column, was_active: Column) -> Column:
    return (
        F.when(is_new, F.lit("New"))
        .when(active & was_active, F.lit("Retained"))
        .when(active, F.lit("Resurrected"))
        .when(was_active, F.lit("Churned"))
        .otherwise(F.lit("Stale"))
    )


def transition_states(table: DataFrame, spec: CumulativeSpec) -> DataFrame:
    """C10 for a table without arrays: every key and period labelled from the running totals alone.

    A key is active in a period when its totals differ from the period before, or it has no row there. One window per key
    over its periods; a table bucketed by its first key isn't shuffled for it.
    """
    totals = F.struct(*[F.col(out) for out, _ in spec.measures])
    w = Window.partitionBy(*spec.keys).orderBy(spec.period_col)
    t = table.select(*spec.keys, spec.period_col, totals.alias("_m"), F.lag(totals, 1).over(w).alias("_m1"), F.lag(totals, 2).over(w).alias("_m2"))
    is_new, was_new = F.col("_m1").isNull(), F.col("_m2").isNull()
    state = _labels(is_new, F.col("_m") != F.col("_m1"), was_new | (F.col("_m1") != F.col("_m2")))
    return t.select(*spec.keys, spec.period_col, state.alias("transition_state"))


def transition_states_of(table: DataFrame, spec: CumulativeSpec, period) -> DataFrame:
    """C10 for one period: its stored partition set against the two before it, all other partitions unread.

    Rows never leave a running total, so the period's partition holds every key: two left joins on the
    keys, unique on all sides, without a shuffle where the table is bucketed by its first key.
    """
    before = previous_period(spec.grain, period)

    def totals(p, name):
        m = F.struct(*[F.col(out) for out, _ in spec.measures])
        return table.where(F.col(spec.period_col) == _period_lit(spec.grain, p)).select(*spec.keys, m.alias(name))

    j = totals(period, "_m").join(totals(before, "_m1"), list(spec.keys), "left")
    j = j.join(totals(previous_period(spec.grain, before), "_m2"), list(spec.keys), "left")
    state = _labels(F.col("_m1").isNull(), F.col("_m") != F.col("_m1"), F.col("_m2").isNull() | (F.col("_m1") != F.col("_m2")))
    return j.select(*spec.keys, _period_lit(spec.grain, period).alias(spec.period_col), state.alias("transition_state"))


# -- trends ------------------------------------------------------------------------------------
def trend(table: DataFrame, spec: CumulativeSpec, names: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Market trend: what each key's measures gained in every period, and the change against the period before.

    Read from the running totals of the stored periods, without the sales: a period's gain is the difference of two
    neighbours. ``<measure>_growth`` is the change of the gain in percent of the gain before it (2 places, half away from
    zero); NULL for a key's first period and after a period without gain.
    """
    w = Window.partitionBy(*spec.keys).orderBy(spec.period_col)
    outs = [out for out, _ in spec.measures]
    gains = table.select(
        *spec.keys, spec.period_col, *[(F.col(o) - F.coalesce(F.lag(o).over(w), F.lit(0))).alias(o) for o in outs]
    )
    growth = []
    for o in outs:
        prior = F.lag(o).over(w)
        scale = 2 if isinstance(spec.schema[o].dataType, DecimalType) else 0
        share = exact_ratio((F.col(o) - prior) * 100, prior, 2, num_scale=scale, den_scale=scale, precision=20)
        growth.append(F.when(prior > 0, share).alias(f"{o}_growth"))
    types = {o: spec.schema[o].dataType for o in outs}
    out = gains.select(*spec.keys, spec.period_col, *[F.col(o).cast(types[o]).alias(f"{o}_gain") for o in outs], *growth)
    return names(out) if names is not None else out
