"""Validated insertion of new sales and the follow-up load of new dates into ``dim_date``.

The reference inserts one sale per procedure call and raises on the first problem; here a whole
batch is validated at once and split into accepted rows and rejected rows with the first reason,
in the order the database would report them: the amount check of the procedure, then NOT NULL,
then CHECK, then the foreign keys.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.exprs import discount_price
from tallyhouse.operators.keys import dense_key, row_key
from tallyhouse.operators.quality import REASON, first_failure, not_null_rules
from tallyhouse.operators.star import date_attributes
from tallyhouse.plans.joins import not_in, present_keys, within_rows
from tallyhouse.schemas import DIM_DATE, SALE_SUBMISSION, SALES_DETAILS, conform

SUBMISSION_NOT_NULL = ("customer_id", "category_id", "quantity", "amount", "payment_method_id", "region_id")
# reference key sets up to this size are broadcast whole (the lookups; small customer tables)
LOOKUP_BROADCAST_ROWS = 100_000

# foreign key column -> (referenced table name, referenced column)
FOREIGN_KEYS = {
    "customer_id": ("customer", "customer_id"),
    "category_id": ("product_category", "category_id"),
    "payment_method_id": ("payment_method", "method_id"),
    "region_id": ("region", "region_id"),
}


# a batch with up to this many distinct values of a key is checked by semi-join reduction
BATCH_KEYS_BROADCAST_ROWS = 1_000_000


def _with_fk_flags(batch: DataFrame, refs: dict[str, DataFrame]) -> DataFrame:
    """Add a boolean ``_has_<col>`` per foreign key.

    Small reference tables (the lookups) are broadcast whole after a size check. For a large one
    (customers) the batch's distinct keys are broadcast into a scan of it instead (semi-join
    reduction): the reference table is read once and never shuffled, and the keys found, at
    most as many as the batch has, are joined back by broadcast.
    """
    out = batch
    for col, (table, ref_col) in FOREIGN_KEYS.items():
        ref = refs[table]
        whole = ref.select(F.col(ref_col).alias(f"_fk_{col}")).distinct()
        # bound on raw rows (an upper bound of the distinct keys; the count reads no column)
        if within_rows(ref.select(ref_col), LOOKUP_BROADCAST_ROWS):
            found = F.broadcast(whole)
        else:
            batch_keys = batch.select(F.col(col).alias(ref_col)).where(F.col(ref_col).isNotNull()).distinct()
            found = present_keys(batch_keys, ref, ref_col, BATCH_KEYS_BROADCAST_ROWS).withColumnRenamed(ref_col, f"_fk_{col}")
            if within_rows(batch_keys, BATCH_KEYS_BROADCAST_ROWS):
                found = F.broadcast(found)  # no more rows than the batch's distinct keys
            else:
                # a map of the task's share of the keys; a merge join would sort the whole batch
                found = found.hint("shuffle_hash")
        flags = found.withColumn(f"_has_{col}", F.lit(True))
        out = out.join(flags, F.col(col) == F.col(f"_fk_{col}"), "left").drop(f"_fk_{col}")
    return out


def ingest_rules() -> list:
    mismatch = F.col("amount") != discount_price("unit_price", "discount")
    fk = [(f"fk:{c}", F.col(c).isNotNull() & F.col(f"_has_{c}").isNull()) for c in FOREIGN_KEYS]
    return [("amount_mismatch", mismatch), *not_null_rules(SUBMISSION_NOT_NULL), ("check:quantity>0", F.col("quantity") <= 0), *fk]


def validate_sales(batch: DataFrame, refs: dict[str, DataFrame]) -> DataFrame:
    """I2 core: submissions tagged with ``reject_reason`` (NULL = accepted).

    A NULL amount or price does not fail the amount comparison (the procedure's IF is not true),
    but the NOT NULL rule catches a NULL amount.
    """
    flagged = _with_fk_flags(conform(batch, SALE_SUBMISSION), refs)
    tagged = flagged.withColumn(REASON, first_failure(ingest_rules()))
    return tagged.select(*[f.name for f in SALE_SUBMISSION.fields], REASON)


def ingest_sales(
    batch: DataFrame, refs: dict[str, DataFrame], as_of: _dt.date, all_or_nothing: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows in the ``sales_details`` layout stamped with ``as_of``, rejected rows).

    With ``all_or_nothing`` the batch behaves like one transaction: if any row is rejected, no
    row is accepted and the valid rows are rejected as ``batch_rolled_back``.
    """
    tagged = validate_sales(batch, refs)
    if all_or_nothing and tagged.where(F.col(REASON).isNotNull()).limit(1).count() > 0:
        rolled = tagged.withColumn(REASON, F.coalesce(F.col(REASON), F.lit("batch_rolled_back")))
        return conform(rolled.limit(0).withColumn("sales_id", F.lit(0).cast("long")), SALES_DETAILS), rolled
    accepted = tagged.where(F.col(REASON).isNull()).withColumn("invoice_date", F.lit(as_of).cast("date"))
    return conform(row_key(accepted, "sales_id"), SALES_DETAILS), tagged.where(F.col(REASON).isNotNull())


# days in dim_date; a calendar of a thousand years has fewer
DATE_BROADCAST_ROWS = 1_000_000


def missing_dates(sales_details: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Invoice dates ``NOT IN`` dim_date's dates, with SQL's NULL rule: if dim_date holds a NULL
    date nothing is missing. Both sides are de-duplicated dates, so the anti join is small."""
    dates = sales_details.select(F.col("invoice_date").alias("full_date")).where(F.col("full_date").isNotNull()).distinct()
    return not_in(dates, "full_date", dim_date, "full_date", DATE_BROADCAST_ROWS)


def load_missing_dates(sales_details: DataFrame, dim_date: DataFrame) -> DataFrame:
    """``dim_date`` rows for every missing invoice date, keys continuing after the current maximum.

    The reference's trigger function keeps a single arbitrary missing date; all are loaded here,
    numbered in date order by the same parallel dense key as the initial load.
    """
    start = dim_date.agg(F.coalesce(F.max("date_key"), F.lit(0)).alias("k")).first()["k"]
    keyed = dense_key(missing_dates(sales_details, dim_date), ["full_date"], "_n")
    keyed = keyed.withColumn("date_key", (F.lit(start) + F.col("_n")).cast("int"))
    return conform(date_attributes(keyed), DIM_DATE)
