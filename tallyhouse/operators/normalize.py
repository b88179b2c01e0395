"""Staging ``retail_sales`` -> 3NF tables (lookups, address, customer, sales_details)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.exprs import as_date, customer_no, customer_no_for_join, gender_code, parse_address
from tallyhouse.operators.keys import dense_key, row_key
from tallyhouse.operators.quality import REASON, first_failure, not_null_rules
from tallyhouse.plans.joins import bounded_broadcast
from tallyhouse.schemas import ADDRESS, CUSTOMER, PAYMENT_METHOD, PRODUCT_CATEGORY, REGION, SALES_DETAILS, conform

# lookup name -> (staging column, key column, value column)
LOOKUPS = {
    "payment_method": ("payment_method", "method_id", "payment_method"),
    "region": ("customer_location", "region_id", "region_name"),
    "product_category": ("product_category", "category_id", "category"),
}
_SCHEMAS = {"payment_method": PAYMENT_METHOD, "region": REGION, "product_category": PRODUCT_CATEGORY}

# Lookups hold a handful of values (methods, regions, categories); above this they are joined by shuffle.
LOOKUP_BROADCAST_ROWS = 100_000


def _shape_lookup(name: str, keyed: DataFrame) -> DataFrame:
    _, key_col, value_col = LOOKUPS[name]
    out = keyed.select(F.col("key").alias(key_col), F.col("value").alias(value_col))
    if name == "payment_method":
        # NOT NULL column with a default of true
        out = out.where(F.col(value_col).isNotNull()).withColumn("is_active", F.lit(True))
    return conform(out, _SCHEMAS[name])


def load_lookup(retail_sales: DataFrame, name: str) -> DataFrame:
    """DISTINCT values of one staging column, keyed 1..n in sorted order (NULL last)."""
    src, _, _ = LOOKUPS[name]
    values = retail_sales.select(F.col(src).alias("value")).distinct()
    return _shape_lookup(name, dense_key(values, ["value"], "key"))


def load_lookups(retail_sales: DataFrame) -> dict[str, DataFrame]:
    """N1-N3 in one scan: the three columns are unpivoted and de-duplicated together."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(n).alias("lookup"), F.col(src).alias("value")) for n, (src, _, _) in LOOKUPS.items()])
    )
    values = retail_sales.select(pairs.alias("e")).select("e.lookup", "e.value").distinct()
    keyed = dense_key(values, ["value"], "key", group_cols=["lookup"])
    return {n: _shape_lookup(n, keyed.where(F.col("lookup") == n)) for n in LOOKUPS}


def parse_addresses(fake_customer_address: DataFrame) -> DataFrame:
    """Raw address text -> (street_number, city, zip_code); rows without a street are dropped."""
    street, city, zip_code = parse_address(F.col("customer_address"))
    parsed = fake_customer_address.select(
        street.alias("street_number"), city.alias("city"), zip_code.alias("zip_code")
    )
    return parsed.where(F.col("street_number").isNotNull())


def load_address(fake_customer_address: DataFrame) -> DataFrame:
    """N4 + K2: the ``address`` table with a dense key in (street, city, zip) order."""
    keyed = dense_key(parse_addresses(fake_customer_address), ["street_number", "city", "zip_code"], "address_id")
    return conform(keyed, ADDRESS)


def customer_pairs(retail_sales: DataFrame) -> DataFrame:
    """DISTINCT (customer_no, gender code): an id seen with two gender codes yields two rows."""
    return retail_sales.select(
        customer_no("customer_id").alias("customer_no"), gender_code("customer_gender").alias("gender")
    ).distinct()


def load_customer(retail_sales: DataFrame) -> DataFrame:
    """N5 + K2: the ``customer`` table; descriptive columns other than gender stay NULL."""
    keyed = dense_key(customer_pairs(retail_sales), ["customer_no", "gender"], "customer_id")
    return conform(keyed, CUSTOMER)


SALES_NOT_NULL = ("customer_id", "category_id", "quantity", "amount", "payment_method_id", "invoice_date", "region_id")


def sales_rules():
    """Constraint order of an insert: NOT NULL first, then CHECK (quantity > 0)."""
    return [*not_null_rules(SALES_NOT_NULL), ("check:quantity>0", F.col("quantity") <= 0)]


def stage_sales_details(
    retail_sales: DataFrame, customer: DataFrame, lookups: dict[str, DataFrame], extra: tuple[str, ...] = ()
) -> DataFrame:
    """Staging rows mapped to 3NF ids, tagged with ``reject_reason`` (NULL when accepted).

    The customer join is on ``CONCAT('C-', id)`` = customer_no. A customer_no held with two
    gender codes matches twice, so that id's rows are doubled, as in the reference. Lookup misses
    leave NULL ids which the NOT NULL rules then reject (quarantine instead of a failed load).
    """
    cust = customer.select(F.col("customer_id").alias("_cust_id"), F.col("customer_no").alias("_cust_no"))
    pay = bounded_broadcast(lookups["payment_method"].select("method_id", "payment_method"), LOOKUP_BROADCAST_ROWS)
    cat = bounded_broadcast(lookups["product_category"].select("category_id", "category"), LOOKUP_BROADCAST_ROWS)
    reg = bounded_broadcast(lookups["region"].select("region_id", "region_name"), LOOKUP_BROADCAST_ROWS)
    # CONCAT('C-', NULL) = 'C-' matches no customer. Used as a join key, every such row would hash
    # to the same reducer; they are given distinct keys instead (NUL-prefixed, so they cannot
    # match a customer number either), which spreads them over all partitions.
    unmatched = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in retail_sales.columns]).cast("string"))
    rs = retail_sales.withColumn(
        "_join_no", F.when(F.col("customer_id").isNull(), unmatched).otherwise(customer_no_for_join("customer_id"))
    )
    joined = (
        rs.join(cat, rs["product_category"] == cat["category"], "left")
        .join(pay, rs["payment_method"] == pay["payment_method"], "left")
        .join(reg, rs["customer_location"] == reg["region_name"], "left")
        .join(cust, F.col("_join_no") == F.col("_cust_no"), "left")
    )
    mapped = joined.select(
        F.col("_cust_id").alias("customer_id"),
        F.col("category_id"),
        rs["price"].alias("unit_price"),
        rs["quantity"],
        rs["discount"],
        rs["total_amount"].alias("amount"),
        F.col("method_id").alias("payment_method_id"),
        as_date(rs["timestamp"]).alias("invoice_date"),
        F.col("region_id"),
        *[rs[c] for c in extra],
    )
    return mapped.withColumn(REASON, first_failure(sales_rules()))


def finish_sales_details(staged: DataFrame) -> DataFrame:
    """Accepted staged rows in the ``sales_details`` layout, with a row key."""
    accepted = staged.where(F.col(REASON).isNull())
    return conform(row_key(accepted, "sales_id"), SALES_DETAILS)


def load_sales_details(
    retail_sales: DataFrame, customer: DataFrame, lookups: dict[str, DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """(sales_details, rejected rows with ``reject_reason``)."""
    staged = stage_sales_details(retail_sales, customer, lookups)
    return finish_sales_details(staged), staged.where(F.col(REASON).isNotNull())
