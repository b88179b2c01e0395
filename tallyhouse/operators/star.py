"""The star schema (five dimensions and the sales fact) built from the 3NF tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.exprs import day_name, iso_day_of_week, month_name, quarter_name
from tallyhouse.operators.keys import dense_key, row_key
from tallyhouse.plans.joins import bounded_broadcast
from tallyhouse.schemas import (
    DIM_CUSTOMER,
    DIM_DATE,
    DIM_PAYMENT_METHOD,
    DIM_PRODUCT_CATEGORY,
    DIM_REGION,
    FACT_SALES,
    SALE_YEAR,
    SALES_DETAILS,
    TOTAL,
    conform,
)

# A day dimension grows by 366 rows a year; a million rows is over 2,700 years of days.
DATE_DIM_BROADCAST_ROWS = 1_000_000
# Category, region and payment-method dimensions are tiny lookups.
SMALL_DIM_BROADCAST_ROWS = 100_000
# The fact needs only the customer dimension's int key set; 2M keys are ~16 MB to broadcast.
CUSTOMER_KEYS_BROADCAST_ROWS = 2_000_000


def date_attributes(dates: DataFrame, date_col: str = "full_date") -> DataFrame:
    """The calendar columns of ``dim_date`` for a column of dates."""
    d = F.col(date_col)
    return dates.select(
        "*",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        quarter_name(d).alias("quarter_name"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_day_of_week(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        F.lit(False).alias("is_holiday"),
    )


def build_dim_date(sales_details: DataFrame) -> DataFrame:
    """One row per distinct invoice date, keyed 1..n in date order."""
    dates = sales_details.select(F.col("invoice_date").alias("full_date")).distinct()
    return conform(date_attributes(dense_key(dates, ["full_date"], "date_key")), DIM_DATE)


# sales_details columns that hold the ids of W2-W5
_ID_COLUMNS = ("customer_id", "category_id", "region_id", "payment_method_id")


def used_ids(sales_details: DataFrame) -> DataFrame:
    """(dim, id): the dates and ids that sales hold, from one scan of the sales. A date is its day number."""
    ids = {"invoice_date": F.unix_date("invoice_date"), **{c: F.col(c) for c in _ID_COLUMNS}}
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("dim"), c.cast("long").alias("id")) for n, c in ids.items()]))
    return sales_details.select(pairs.alias("e")).select("e.dim", "e.id").distinct()


def used_column(used: DataFrame, col: str) -> DataFrame:
    """The values of one ``sales_details`` column, back from :func:`used_ids`."""
    value = F.date_from_unix_date(F.col("id").cast("int")) if col == "invoice_date" else F.col("id").cast(SALES_DETAILS[col].dataType)
    return used.where(F.col("dim") == col).select(value.alias(col))


def _used_ids(sales_details: DataFrame, col: str, alias: str) -> DataFrame:
    # de-duplicated before any join (partial aggregation on the map side)
    return sales_details.select(F.col(col).alias(alias)).distinct()


def build_dim_customer(sales_details: DataFrame, customer: DataFrame) -> DataFrame:
    """Customers that have sales; the key is the 3NF customer_id."""
    used = _used_ids(sales_details, "customer_id", "customer_id")
    return conform(
        customer.join(used, "customer_id", "left_semi").withColumnRenamed("customer_id", "customer_key"), DIM_CUSTOMER
    )


def build_dim_product_category(sales_details: DataFrame, product_category: DataFrame) -> DataFrame:
    """W3."""
    used = _used_ids(sales_details, "category_id", "category_id")
    dim = product_category.join(used, "category_id", "left_semi").select(
        F.col("category_id").alias("category_key"), F.col("category").alias("product_category")
    )
    return conform(dim, DIM_PRODUCT_CATEGORY)


def build_dim_region(sales_details: DataFrame, region: DataFrame) -> DataFrame:
    """W4."""
    used = _used_ids(sales_details, "region_id", "region_id")
    dim = region.join(used, "region_id", "left_semi").select(
        F.col("region_id").alias("region_key"), F.col("region_name").alias("region")
    )
    return conform(dim, DIM_REGION)


def build_dim_payment_method(sales_details: DataFrame, payment_method: DataFrame) -> DataFrame:
    """W5."""
    used = _used_ids(sales_details, "payment_method_id", "method_id")
    dim = payment_method.join(used, "method_id", "left_semi").select(
        F.col("method_id").alias("payment_method_key"), F.col("payment_method")
    )
    return conform(dim, DIM_PAYMENT_METHOD)


def build_fact_sales(
    sales_details: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    dim_product_category: DataFrame,
    dim_region: DataFrame,
    dim_payment_method: DataFrame,
    customer_dim_covers_sales: bool = False,
    by_year: bool = False,
) -> DataFrame:
    """Sales joined (inner) to the five dimensions; one fact row per sales_details row.

    The small dimensions are broadcast after a size check. The customer dimension contributes
    only its key, which equals the 3NF id, so it is a semi join against the key set: broadcast
    up to 2M customers, a sort-merge join (shuffling the sales by customer) beyond that.

    ``customer_dim_covers_sales``: the caller asserts ``dim_customer`` was built (W2) from this
    very ``sales_details``, whose customer_id is NOT NULL. The inner join then cannot drop a row,
    so it is left out, and the fact build never shuffles the sales.

    ``by_year`` adds ``sale_year``, the year of the sale's date, to partition the stored fact by: questions that
    also join it with the date dimension's year then read only the years that their dates are in.
    """
    dd = bounded_broadcast(dim_date.select("date_key", "full_date"), DATE_DIM_BROADCAST_ROWS)
    dc = bounded_broadcast(dim_product_category.select("category_key"), SMALL_DIM_BROADCAST_ROWS)
    dr = bounded_broadcast(dim_region.select("region_key"), SMALL_DIM_BROADCAST_ROWS)
    dp = bounded_broadcast(dim_payment_method.select("payment_method_key"), SMALL_DIM_BROADCAST_ROWS)
    s = sales_details
    joined = (
        s.join(dc, s["category_id"] == dc["category_key"])
        .join(dr, s["region_id"] == dr["region_key"])
        .join(dp, s["payment_method_id"] == dp["payment_method_key"])
        .join(dd, s["invoice_date"] == dd["full_date"])
    )
    if not customer_dim_covers_sales:
        cust_keys = bounded_broadcast(dim_customer.select("customer_key"), CUSTOMER_KEYS_BROADCAST_ROWS)
        joined = joined.join(cust_keys, s["customer_id"] == cust_keys["customer_key"], "left_semi")
    fact = joined.select(
        F.col("date_key"),
        s["customer_id"].alias("customer_key"),
        F.col("category_key").alias("product_category_key"),
        s["quantity"].alias("product_quantity"),
        s["amount"].cast(TOTAL).alias("sale_amount"),
        s["discount"].alias("sale_discount"),
        F.col("region_key"),
        F.col("payment_method_key"),
        F.year(s["invoice_date"]).cast("int").alias(SALE_YEAR),
    )
    keyed = row_key(fact, "sale_key")
    return keyed.select(*FACT_SALES.names, SALE_YEAR) if by_year else conform(keyed, FACT_SALES)
