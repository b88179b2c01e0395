"""Exploration and sanity queries over staging and 3NF tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.exprs import exact_avg
from tallyhouse.plans.joins import bounded_broadcast
from tallyhouse.schemas import GRAND_TOTAL

LOOKUP_BROADCAST_ROWS = 100_000
# staging columns profiled by E2, with their number of decimals
NUMERIC_PROFILE = {"quantity": 0, "price": 2, "total_amount": 2}


def preview(df: DataFrame, order_cols: list[str], n: int = 100) -> DataFrame:
    """The sanity-check ``SELECT * ... LIMIT n``, made deterministic by ordering on the key
    (a top-n: each task keeps its n smallest rows, the driver merges them)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols]).limit(n)


def profile_distinct(retail_sales: DataFrame, column: str) -> DataFrame:
    """SELECT DISTINCT column ORDER BY column (NULL last)."""
    return retail_sales.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def profile_numeric(retail_sales: DataFrame, columns: dict[str, int] = NUMERIC_PROFILE) -> DataFrame:
    """MIN, MAX and ROUND(AVG, 4) of several columns in a single pass.

    The average is exact (the database averages integers and decimals exactly), not a double.
    """
    aggs = []
    for c, scale in columns.items():
        aggs += [
            F.min(c).alias(f"min_{c}"),
            F.max(c).alias(f"max_{c}"),
            exact_avg(c, 4, value_scale=scale, precision=22).alias(f"avg_{c}"),
        ]
    return retail_sales.agg(*aggs)


def sales_count_by_customer(sales_details: DataFrame) -> DataFrame:
    """Rows per customer, most first."""
    return (
        sales_details.groupBy("customer_id")
        .agg(F.count("customer_id").alias("num_recs"))
        .orderBy(F.col("num_recs").desc(), F.col("customer_id"))
    )


def sales_by_region(sales_details: DataFrame, region: DataFrame) -> DataFrame:
    """Total amount per region name.

    Aggregated on region_id first and joined to the lookup afterwards: the id determines the
    name, so the join sees one row per region instead of one per sale; the lookup is broadcast
    after a size check.
    """
    per_id = sales_details.groupBy("region_id").agg(F.sum("amount").alias("_total"))
    names = bounded_broadcast(region.select("region_id", "region_name"), LOOKUP_BROADCAST_ROWS)
    joined = per_id.join(names, "region_id", "left")
    return (
        joined.groupBy("region_name")
        .agg(F.round(F.sum("_total"), 2).cast(GRAND_TOTAL).alias("total_amount"))
        .orderBy(F.col("region_name").asc_nulls_last())
    )


def invoice_date_range(sales_details: DataFrame) -> DataFrame:
    """E5: first and last invoice date."""
    return sales_details.agg(
        F.min("invoice_date").alias("first_invoice_date"), F.max("invoice_date").alias("last_invoice_date")
    )


def sales_on_date(sales_details: DataFrame, day: _dt.date) -> DataFrame:
    """Sales of one invoice date (an equality that reaches the Parquet scan)."""
    return sales_details.where(F.col("invoice_date") == F.lit(day))


def address_count(address: DataFrame) -> DataFrame:
    """COUNT(*) of the address table."""
    return address.agg(F.count(F.lit(1)).alias("address_count"))
