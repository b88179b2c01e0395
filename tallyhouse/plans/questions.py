"""The business questions over the star schema and the Christmas view.

All dimensions joined here are small; each is broadcast after a size check, so a question is one
scan of the fact with its joins pipelined into the partial aggregation, and a single shuffle of
partial aggregates.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.exprs import exact_avg, exact_ratio, is_christmas
from tallyhouse.operators.star import DATE_DIM_BROADCAST_ROWS, SMALL_DIM_BROADCAST_ROWS
from tallyhouse.plans.joins import bounded_broadcast
from tallyhouse.schemas import SALE_YEAR, TOTAL

# Fixed values ------------------------------------------------------------------------------
# payment method ids tested literally by the Christmas view, in column order (the ids follow
# the sorted method names: Credit Card, Debit Card, Gift Card, PayPal)
CHRISTMAS_COLUMNS = (("credit_card", 1), ("debit_card", 2), ("gift_card", 3), ("paypal", 4))
# ------------------------------------------------------------------------------------------


def _asc(*cols: str):
    """ORDER BY as the reference's database sorts: ascending, NULLs last."""
    return [F.col(c).asc_nulls_last() for c in cols]


def _fact_with(fact: DataFrame, dim_region=None, dim_product_category=None, dim_date=None, dim_payment_method=None):
    out = fact
    if dim_region is not None:
        out = out.join(bounded_broadcast(dim_region, SMALL_DIM_BROADCAST_ROWS), "region_key")
    if dim_product_category is not None:
        pc = dim_product_category.withColumnRenamed("category_key", "product_category_key")
        out = out.join(bounded_broadcast(pc, SMALL_DIM_BROADCAST_ROWS), "product_category_key")
    if dim_payment_method is not None:
        out = out.join(bounded_broadcast(dim_payment_method, SMALL_DIM_BROADCAST_ROWS), "payment_method_key")
    if dim_date is not None:
        dd, on = dim_date.select("date_key", "year", "quarter", "quarter_name"), ["date_key"]
        if SALE_YEAR in fact.columns:  # a fact partitioned by year: dates known to be few leave its other years unread
            dd, on = dd.withColumn(SALE_YEAR, F.col("year")), [*on, SALE_YEAR]
        out = out.join(bounded_broadcast(dd, DATE_DIM_BROADCAST_ROWS), on)
    return out


def avg_quarterly_revenue(
    fact_sales: DataFrame, dim_region: DataFrame, dim_product_category: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """B1 (the reference's question 1, literal): ROUND(AVG(sale_amount), 2) per year, quarter name,
    region and category. It averages *sale rows* within the quarter, and orders by the quarter
    name as text (First, Fourth, Second, Third)."""
    f = _fact_with(fact_sales, dim_region=dim_region, dim_product_category=dim_product_category, dim_date=dim_date)
    return (
        f.groupBy("year", "quarter_name", "region", "product_category")
        .agg(exact_avg("sale_amount", 2).alias("avg_sales"))
        .orderBy(*_asc("year", "quarter_name", "region", "product_category"))
    )


def of_dates(dim_date: DataFrame, first: _dt.date, last: _dt.date) -> DataFrame:
    """The days of a question asked for ``first`` to ``last``: the filter reaches the fact through its year partitions."""
    return dim_date.where(F.col("full_date").between(F.lit(first), F.lit(last)))


def avg_of_quarter_totals(
    fact_sales: DataFrame, dim_region: DataFrame, dim_product_category: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """B2: the question's wording read as "the average of quarterly totals" per region and category."""
    f = _fact_with(fact_sales, dim_region=dim_region, dim_product_category=dim_product_category, dim_date=dim_date)
    quarterly = f.groupBy("region", "product_category", "year", "quarter").agg(F.sum("sale_amount").alias("_q_total"))
    return (
        quarterly.groupBy("region", "product_category")
        .agg(
            F.count(F.lit(1)).alias("quarters"),
            exact_ratio(F.sum("_q_total"), F.count(F.lit(1)), 2).alias("avg_quarterly_revenue"),
        )
        .orderBy(*_asc("region", "product_category"))
    )


def payment_mix_by_region(fact_sales: DataFrame, dim_region: DataFrame, dim_payment_method: DataFrame) -> DataFrame:
    """B3 (question 2, left open by the reference): how customers pay, per region.

    Sales count, revenue, and the method's share of the region's revenue (exact, 4 places).
    The share's window runs over the aggregated (region, method) rows only.
    """
    f = _fact_with(fact_sales, dim_region=dim_region, dim_payment_method=dim_payment_method)
    per = f.groupBy("region", "payment_method").agg(
        F.count(F.lit(1)).alias("n_sales"), F.sum("sale_amount").cast(TOTAL).alias("revenue")
    )
    region_total = F.sum("revenue").over(Window.partitionBy("region"))
    return per.withColumn(
        "revenue_share", exact_ratio(F.col("revenue"), region_total, 4, num_scale=2, den_scale=2, precision=9)
    ).orderBy(*_asc("region", "payment_method"))


def christmas_days(dim_date: DataFrame) -> list[_dt.date]:
    """The Christmas days of the date dimension, one a year."""
    return [r["full_date"] for r in dim_date.where(is_christmas("full_date")).select("full_date").collect()]


def christmas_sales_by_payment_method(
    sales_details: DataFrame, region: DataFrame, days: list[_dt.date] | None = None
) -> DataFrame:
    """V1: Christmas-day revenue per region and day, pivoted into one column per payment method.

    Only method ids 1-4 are counted (a fifth method's amounts vanish, and a region-day with only
    such rows still gives a row of zeros). The join to ``payment_method`` in the reference reads
    no column and cannot change the row count (its key is unique), so it is left out.

    ``days``: the Christmas days that sales can have (:func:`christmas_days`). As a list of dates the
    filter reaches the scan, which then skips the row groups of other days.
    """
    xmas = sales_details.where(is_christmas("invoice_date"))
    if days is not None:
        xmas = xmas.where(F.col("invoice_date").isin(days))
    sums = [
        F.sum(F.when(F.col("payment_method_id") == k, F.col("amount")).otherwise(F.lit(0))).alias(f"_{name}")
        for name, k in CHRISTMAS_COLUMNS
    ]
    per_id = xmas.groupBy("region_id", "invoice_date").agg(*sums)
    named = per_id.join(bounded_broadcast(region.select("region_id", "region_name"), SMALL_DIM_BROADCAST_ROWS), "region_id", "left")
    return (
        named.groupBy("region_name", F.col("invoice_date").alias("christmas_day"))
        .agg(*[F.sum(f"_{name}").cast(TOTAL).alias(name) for name, _ in CHRISTMAS_COLUMNS])
        .orderBy(*_asc("region_name", "christmas_day"))
    )
