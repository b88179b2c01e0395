"""Explicit schemas for every table of the warehouse (no schema inference anywhere).

Money is exact: ``DecimalType(10,2)`` per row, ``DecimalType(18,2)`` for totals,
``DecimalType(4,2)`` for discount rates. ``REAL`` columns of the nested customer statistics are
``FloatType``. Row keys of the two sales tables are ``LongType`` (a 4-byte serial runs out
long before 100 TB of sales), and so are the three *summed* quantities of the cumulative tables
(declared INT by the reference): a category's lifetime quantity at 100 TB is ~10^12, and with
ANSI arithmetic an INT target would fail the load, as the reference's INSERT would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(10, 2)
TOTAL = DecimalType(18, 2)
GRAND_TOTAL = DecimalType(28, 2)  # totals over all sales, for which no table declares a type
RATE = DecimalType(4, 2)


def _s(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# --- staging -------------------------------------------------------------------------------
# The three source ids are BIGINT (INT in the reference): source keys of 100 TB of sales exceed
# 2^31, and they only feed keys and customer numbers.
RETAIL_SALES = _s(
    ("transaction_id", LongType(), True),
    ("timestamp", StringType(), True),
    ("customer_id", LongType(), True),
    ("product_id", LongType(), True),
    ("product_category", StringType(), True),
    ("quantity", IntegerType(), True),
    ("price", MONEY, True),
    ("discount", RATE, True),
    ("payment_method", StringType(), True),
    ("customer_age", IntegerType(), True),
    ("customer_gender", StringType(), True),
    ("customer_location", StringType(), True),
    ("total_amount", MONEY, True),
)
FAKE_CUSTOMER_NAMES = _s(("customer_name", StringType(), True))
FAKE_CUSTOMER_ADDRESS = _s(("customer_address", StringType(), True))

# --- 3NF ------------------------------------------------------------------------------------
PAYMENT_METHOD = _s(
    ("method_id", IntegerType(), False),
    ("payment_method", StringType(), False),
    ("is_active", BooleanType(), False),
)
PRODUCT_CATEGORY = _s(("category_id", IntegerType(), False), ("category", StringType(), True))
REGION = _s(("region_id", IntegerType(), False), ("region_name", StringType(), True))
ADDRESS = _s(
    ("address_id", IntegerType(), False),
    ("street_number", StringType(), True),
    ("city", StringType(), True),
    ("zip_code", StringType(), True),
)
CUSTOMER = _s(
    ("customer_id", IntegerType(), False),
    ("customer_no", StringType(), True),
    ("first_name", StringType(), True),
    ("last_name", StringType(), True),
    ("gender", StringType(), True),
    ("email", StringType(), True),
    ("date_of_birth", DateType(), True),
    ("phone_number", StringType(), True),
)
CUSTOMER_ADDRESS = _s(
    ("customer_id", IntegerType(), True),
    ("address_id", IntegerType(), True),
    ("start_date", DateType(), True),
    ("end_date", DateType(), True),
    ("is_current", BooleanType(), True),
)
SALES_DETAILS = _s(
    ("sales_id", LongType(), False),
    ("customer_id", IntegerType(), False),
    ("category_id", IntegerType(), False),
    ("unit_price", MONEY, True),
    ("quantity", IntegerType(), False),
    ("discount", RATE, True),
    ("amount", MONEY, False),
    ("payment_method_id", IntegerType(), False),
    ("invoice_date", DateType(), False),
    ("region_id", IntegerType(), False),
)

# --- cumulative -----------------------------------------------------------------------------
CUM_PRODUCT_SALES = _s(
    ("category_id", IntegerType(), True),
    ("product_category", StringType(), True),
    ("cumulative_quantity", LongType(), True),
    ("cumulative_sales", TOTAL, True),
    ("present_date", DateType(), True),
)
CUM_REGION_PRODUCT_SALES = _s(
    ("region_id", IntegerType(), True),
    ("region", StringType(), True),
    ("category_id", IntegerType(), True),
    ("product_category", StringType(), True),
    ("cumulative_sales", TOTAL, True),
    ("current_year", IntegerType(), True),
)
CUM_CUSTOMER_PRODUCT_ENGAGE = _s(
    ("customer_id", IntegerType(), True),
    ("category_id", IntegerType(), True),
    ("product_category", StringType(), True),
    ("cum_purchase_count", LongType(), True),
    ("cumulative_sales", TOTAL, True),
    ("current_year", IntegerType(), True),
)
CUM_CUSTOMER_REVENUE = _s(
    ("customer_id", IntegerType(), True),
    ("cum_amount_spent", TOTAL, True),
    ("current_year", IntegerType(), True),
)
SALES_STATS = _s(
    ("sales_year", IntegerType(), True),
    ("total_discount", FloatType(), True),
    ("total_amount_spent", FloatType(), True),
    ("total_qty_purchased", LongType(), True),
)
CUM_CUSTOMER_SALES = _s(
    ("customer_id", IntegerType(), True),
    ("customer_no", StringType(), True),
    ("sales_stats", ArrayType(SALES_STATS, True), True),
    ("current_year", IntegerType(), True),
)

# --- star -----------------------------------------------------------------------------------
DIM_DATE = _s(
    ("date_key", IntegerType(), False),
    ("full_date", DateType(), True),
    ("year", IntegerType(), True),
    ("quarter", IntegerType(), True),
    ("quarter_name", StringType(), True),
    ("month", IntegerType(), True),
    ("month_name", StringType(), True),
    ("day_of_month", IntegerType(), True),
    ("day_of_week", IntegerType(), True),
    ("day_name", StringType(), True),
    ("is_holiday", BooleanType(), False),
)
DIM_PRODUCT_CATEGORY = _s(("category_key", IntegerType(), False), ("product_category", StringType(), True))
DIM_REGION = _s(("region_key", IntegerType(), False), ("region", StringType(), True))
DIM_PAYMENT_METHOD = _s(("payment_method_key", IntegerType(), False), ("payment_method", StringType(), True))
DIM_CUSTOMER = _s(
    ("customer_key", IntegerType(), False),
    ("customer_no", StringType(), True),
    ("first_name", StringType(), True),
    ("last_name", StringType(), True),
    ("gender", StringType(), True),
    ("email", StringType(), True),
)
FACT_SALES = _s(
    ("sale_key", LongType(), False),
    ("date_key", IntegerType(), True),
    ("customer_key", IntegerType(), True),
    ("product_category_key", IntegerType(), True),
    ("product_quantity", IntegerType(), True),
    ("sale_amount", TOTAL, True),
    ("sale_discount", RATE, True),
    ("region_key", IntegerType(), True),
    ("payment_method_key", IntegerType(), True),
)

# --- ingestion ------------------------------------------------------------------------------
# Arguments of the validated insert, in the procedure's parameter order.
SALE_YEAR = "sale_year"  # partition column of the bucketed sales layout

# staged sales kept one row per transaction, partitioned by the year of their timestamp
SALE_KEYED = _s(
    ("transaction_id", LongType(), True),
    ("timestamp", StringType(), True),
    ("customer_id", LongType(), True),
    ("quantity", IntegerType(), True),
    ("total_amount", MONEY, True),
    (SALE_YEAR, IntegerType(), True),
)

SALE_SUBMISSION = _s(
    ("customer_id", IntegerType(), True),
    ("category_id", IntegerType(), True),
    ("quantity", IntegerType(), True),
    ("discount", RATE, True),
    ("amount", MONEY, True),
    ("payment_method_id", IntegerType(), True),
    ("region_id", IntegerType(), True),
    ("unit_price", MONEY, True),
)

TABLES: dict[str, StructType] = {
    "retail_sales": RETAIL_SALES,
    "fake_customer_names": FAKE_CUSTOMER_NAMES,
    "fake_customer_address": FAKE_CUSTOMER_ADDRESS,
    "payment_method": PAYMENT_METHOD,
    "product_category": PRODUCT_CATEGORY,
    "region": REGION,
    "address": ADDRESS,
    "customer": CUSTOMER,
    "customer_address": CUSTOMER_ADDRESS,
    "sales_details": SALES_DETAILS,
    "cum_product_sales": CUM_PRODUCT_SALES,
    "cum_region_product_sales": CUM_REGION_PRODUCT_SALES,
    "cum_customer_product_engage": CUM_CUSTOMER_PRODUCT_ENGAGE,
    "cum_customer_revenue": CUM_CUSTOMER_REVENUE,
    "cum_customer_sales": CUM_CUSTOMER_SALES,
    "dim_date": DIM_DATE,
    "dim_product_category": DIM_PRODUCT_CATEGORY,
    "dim_region": DIM_REGION,
    "dim_payment_method": DIM_PAYMENT_METHOD,
    "dim_customer": DIM_CUSTOMER,
    "fact_sales": FACT_SALES,
    "sales_submissions": SALE_SUBMISSION,
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select ``schema``'s columns in order, cast to its types; columns the input lacks are NULL.

    This is what an INSERT with a column list does.
    """
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def empty(spark, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
