"""Customer segmentation from the stored cumulative tables: recency, frequency and value bands.

The last year's partitions of C5 and C4 hold all that is needed: the years with sales of each customer, the quantity
bought and the amount spent so far. The sales aren't read. Bands are equal shares of the customers in the order of a
measure (as NTILE gives them). The order is made in parallel: range partitions are numbered by their
own rows and the row counts before them (:func:`keys.dense_key`), so no single task sees all customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.keys import dense_key

BANDS = 5
#: segments by (recency band, mean of the frequency and value bands), first match
RULES = (
    ("Champions", lambda r, m, top: (r == top) & (m >= top - 1)),
    ("Loyal", lambda r, m, top: (r >= top - 1) & (m >= top - 2)),
    ("At Risk", lambda r, m, top: (r <= 2) & (m >= top - 2)),
    ("Recent", lambda r, m, top: r >= top - 1),
    ("Lost", lambda r, m, top: (r <= 2) & (m < top - 2)),
)
OTHER = "Regular"


def bands(customers: DataFrame, measure: str, out: str, n: int, total: int) -> DataFrame:
    """(customer_id, out): 1 for the lowest ``n``-th of the customers to ``n`` for the highest; ties by customer id.

    The first ``total % n`` bands have one customer more, as NTILE deals them.
    """
    ranked = dense_key(customers.select(measure, "customer_id"), [measure, "customer_id"], "_rank")
    size, extra = total // n, total % n
    r = F.col("_rank").cast("long") - 1
    large = (size + 1) * extra
    band = F.when(r < large, F.floor(r / F.lit(size + 1))) .otherwise(F.floor((r - large) / F.lit(max(size, 1))) + extra) + 1
    return ranked.select("customer_id", band.cast("int").alias(out))


def profile(cum_customer_sales: DataFrame, cum_customer_revenue: DataFrame, year: int) -> DataFrame:
    """One row per customer: last_year, active_years, quantity and amount so far, from the partitions of ``year``."""
    history = cum_customer_sales.where(F.col("current_year") == year).select(
        "customer_id",
        F.element_at("sales_stats", -1)["sales_year"].alias("last_year"),  # arrays are ordered by year
        F.size("sales_stats").alias("active_years"),
        F.aggregate("sales_stats", F.lit(0).cast("long"), lambda a, s: a + s["total_qty_purchased"]).alias("quantity"),
    )
    spent = cum_customer_revenue.where(F.col("current_year") == year).select("customer_id", "cum_amount_spent")
    return history.join(spent, "customer_id")


def customer_segments(cum_customer_sales: DataFrame, cum_customer_revenue: DataFrame, year: int, n: int = BANDS) -> DataFrame:
    """Every customer with its recency, frequency (quantity) and value bands, 1 lowest, and a segment's name."""
    customers = profile(cum_customer_sales, cum_customer_revenue, year).checkpoint(eager=True)
    total = customers.count()
    out = customers
    for measure, name in (("last_year", "recency_band"), ("quantity", "frequency_band"), ("cum_amount_spent", "value_band")):
        out = out.join(bands(customers, measure, name, n, total), "customer_id")
    mean = (F.col("frequency_band") + F.col("value_band")) / 2
    segment: Column = F.lit(OTHER)
    for name, rule in reversed(RULES):
        segment = F.when(rule(F.col("recency_band"), mean, n), F.lit(name)).otherwise(segment)
    return out.withColumn("segment", segment)
