"""Adapter from the driver's TPC-H-style parquet tables to the warehouse's staging inputs.

``retail_sales`` plays the role of the sales CSV. The join order keeps the largest table
(lineitem) to two shuffles: orders are first enriched with the customer's segment and region
(customer x nation x region), then joined to lineitem on the order key, then to part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans.joins import bounded_broadcast
from tallyhouse.schemas import MONEY, RATE, RETAIL_SALES, conform

# Fixed values of the fixture mapping -------------------------------------------------------
# order priority -> payment method
PAYMENT_BY_PRIORITY = {
    "1-URGENT": "Credit Card",
    "2-HIGH": "Debit Card",
    "3-MEDIUM": "Gift Card",
    "4-NOT SPECIFIED": "PayPal",
    "5-LOW": "Credit Card",
}
# market segment -> customer gender text
GENDER_BY_SEGMENT = {
    "AUTOMOBILE": "Male",
    "BUILDING": "Male",
    "FURNITURE": "Female",
    "HOUSEHOLD": "Female",
    "MACHINERY": "Other",
}
# customer age = AGE_BASE + custkey mod AGE_SPAN
AGE_BASE, AGE_SPAN = 18, 60
# ------------------------------------------------------------------------------------------

# nation and region are fixed-size reference tables; anything above this is not broadcast
_TINY_ROWS = 10_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mapped(col: str, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(col) == k, F.lit(v)) if out is None else out.when(F.col(col) == k, F.lit(v))
    return out.otherwise(F.lit(None).cast("string"))


def customer_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> (c_custkey, c_mktsegment, n_name, r_name); nation/region broadcast after a size check."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = bounded_broadcast(nation, _TINY_ROWS).join(
        bounded_broadcast(region, _TINY_ROWS), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return customer.join(bounded_broadcast(geo, _TINY_ROWS), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_mktsegment", "n_name", "r_name"
    )


def sales_rows(spark: SparkSession, sf_dir: str) -> int:
    """Lines of the largest table (a count that reads no column)."""
    return read_table(spark, sf_dir, "lineitem").count()


def retail_sales(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """The staging table ``retail_sales`` (13 columns) derived from lineitem/orders/customer/part.

    ``extra`` carries additional lineitem columns through (used to derive ingestion batches).
    """
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = customer_locations(spark, sf_dir)
    orders_cust = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    line = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", *extra
    )
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    rows = line.join(orders_cust, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    staged = rows.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("transaction_id"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("o_custkey").cast("long").alias("customer_id"),
        F.col("l_partkey").cast("long").alias("product_id"),
        F.col("p_type").alias("product_category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
        F.col("l_discount").cast(RATE).alias("discount"),
        _mapped("o_orderpriority", PAYMENT_BY_PRIORITY).alias("payment_method"),
        (F.lit(AGE_BASE) + F.col("c_custkey") % AGE_SPAN).cast("int").alias("customer_age"),
        _mapped("c_mktsegment", GENDER_BY_SEGMENT).alias("customer_gender"),
        F.col("r_name").alias("customer_location"),
        F.col("l_extendedprice").cast(MONEY).alias("total_amount"),
        *[F.col(c) for c in extra],
    )
    if extra:
        return staged
    return conform(staged, RETAIL_SALES)


def customer_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fake_customer_address``: one raw address per customer, in the bracketed text form.

    ``['<custkey> Main St\\n<nation>, <custkey zero-padded to 5>']`` with a literal backslash-n.
    """
    cust = customer_locations(spark, sf_dir)
    text = F.concat(
        F.lit("['"),
        F.col("c_custkey").cast("string"),
        F.lit(" Main St\\n"),
        F.col("n_name"),
        F.lit(", "),
        F.format_string("%05d", F.col("c_custkey")),
        F.lit("']"),
    )
    return cust.select(text.alias("customer_address"))


def customer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fake_customer_names`` stand-in: the customer table's names."""
    return read_table(spark, sf_dir, "customer").select(F.col("c_name").alias("customer_name"))
