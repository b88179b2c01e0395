"""N1-N6, E1-E7 and S1-S3 on hand fixtures (expected values written from the reference's SQL)."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.operators import explore, normalize, quality
from tallyhouse.operators.quality import REASON
from tallyhouse.schemas import RETAIL_SALES
from tallyhouse.sources import csv as csv_source

from conftest import rows


def sale(cid, gender="Male", category="Books", method="Credit Card", location="Europe", qty=1, ts="2023-01-05 10:11:12", amount="10.00"):
    return (1, ts, cid, 1, category, qty, Decimal("10.00"), Decimal("0.00"), method, 30, gender, location, Decimal(amount))


def staging(spark, data):
    return spark.createDataFrame(data, RETAIL_SALES)


def test_gender_codes_and_doubled_customers(spark):
    rs = staging(
        spark,
        [
            sale(1, "Male"),
            sale(1, "Female"),  # one id with two gender codes -> two customers (D8)
            sale(2, "Female"),
            sale(2, "Other"),  # Other is coded F -> still one customer (D7)
            sale(3, "unknown"),  # -> NULL gender
            sale(None, "Male"),  # 'C-' || NULL is NULL
        ],
    )
    cust = normalize.load_customer(rs)
    assert rows(cust, "customer_id", "customer_no", "gender") == sorted(
        [(1, "C-1", "F"), (2, "C-1", "M"), (3, "C-2", "F"), (4, "C-3", None), (5, None, "M")],
        key=lambda t: tuple((x is None, str(x)) for x in t),
    )
    lookups = normalize.load_lookups(rs)
    sd, rejected = normalize.load_sales_details(rs, cust, lookups)
    per_customer = {r["customer_id"]: r["n"] for r in sd.groupBy("customer_id").agg(F.count("*").alias("n")).collect()}
    # both staging rows of id 1 match both customers C-1 -> 4 rows; id 2 -> 2 rows; id 3 -> 1 row
    assert per_customer == {1: 2, 2: 2, 3: 2, 4: 1}
    # the NULL id becomes 'C-' for the join, matches nothing, and is quarantined
    assert [r[REASON] for r in rejected.collect()] == ["not_null:customer_id"]


def test_lookups_sorted_null_last_and_misses_quarantined(spark):
    rs = staging(
        spark,
        [
            sale(1, category="Electronics", method="PayPal", location="Asia"),
            sale(2, category="Books", method="Credit Card", location="Europe"),
            sale(3, category=None, method="Debit Card", location="Asia"),
            sale(4, category="Books", method="Gift Card", location="Africa", qty=0),
            sale(5, category="Books", method="Gift Card", location="Africa", ts="not a date"),
        ],
    )
    lookups = normalize.load_lookups(rs)
    assert rows(lookups["product_category"]) == [(1, "Books"), (2, "Electronics"), (3, None)]
    assert rows(lookups["payment_method"]) == [
        (1, "Credit Card", True), (2, "Debit Card", True), (3, "Gift Card", True), (4, "PayPal", True)
    ]
    assert rows(lookups["region"]) == [(1, "Africa"), (2, "Asia"), (3, "Europe")]
    sd, rejected = normalize.load_sales_details(rs, normalize.load_customer(rs), lookups)
    assert sd.count() == 2
    reasons = sorted(r[REASON] for r in rejected.collect())
    # NULL category never equals its own lookup row (D31), CHECK quantity > 0, unparsable date
    assert reasons == ["check:quantity>0", "not_null:category_id", "not_null:invoice_date"]


def test_single_lookup_equals_combined(spark):
    rs = staging(spark, [sale(i, location=loc) for i, loc in enumerate(["b", "a", "c", "a"])])
    assert rows(normalize.load_lookup(rs, "region")) == rows(normalize.load_lookups(rs)["region"])


def test_exploration(spark):
    rs = staging(spark, [sale(1, qty=1, amount="1.00"), sale(2, qty=2, amount="2.00"), sale(3, qty=2, amount="2.01")])
    prof = explore.profile_numeric(rs).first()
    assert (prof["min_quantity"], prof["max_quantity"], prof["avg_quantity"]) == (1, 2, Decimal("1.6667"))
    assert prof["avg_total_amount"] == Decimal("1.6700")
    assert [r[0] for r in explore.profile_distinct(rs, "customer_gender").collect()] == ["Male"]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 5), (1, 0), (None, None), (2, -1)], "k int, q int")
    pk = {(r["k"], r["violation"]) for r in quality.primary_key_violations(df, ["k"]).collect()}
    assert pk == {(1, "duplicate_key"), (None, "null_key")}
    # NULL passes a CHECK constraint
    assert sorted(r["q"] for r in quality.check_violations(df, F.col("q") > 0).collect()) == [-1, 0]
    ref = spark.createDataFrame([(1,)], "id int")
    orphans = quality.foreign_key_orphans(df, ["k"], ref, ["id"])
    assert [r["k"] for r in orphans.collect()] == [2]  # NULL keys are not orphans
    assert quality.not_null_violations(df, ["k", "q"]).count() == 1


def _write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def test_names_csv_reader(spark):
    d = tempfile.mkdtemp(prefix="th-csv-", dir="/tmp")
    # quoted comma, non-ASCII, outer blanks kept, blank line, no newline at the end
    _write(os.path.join(d, "names.csv"), 'name\n"Doe, Jane"\nJosé Álvarez\n  padded  \n\nplain')
    good, bad = csv_source.load_customer_names(spark, d)
    assert sorted(r["customer_name"] for r in good.collect()) == sorted(["Doe, Jane", "José Álvarez", "  padded  ", "plain"])
    assert bad.count() == 0


def test_sales_csv_reader_quarantines_bad_rows(spark):
    d = tempfile.mkdtemp(prefix="th-csv-", dir="/tmp")
    header = "transaction_id,timestamp,customer_id,product_id,product_category,quantity,price,discount,payment_method,customer_age,customer_gender,customer_location,total_amount"
    good_line = "1,2023-01-05 10:11:12,7,3,Books,2,10.00,0.10,PayPal,30,Male,Europe,18.00"
    bad_type = "2,2023-01-05 10:11:12,7,3,Books,two,10.00,0.10,PayPal,30,Male,Europe,18.00"
    _write(os.path.join(d, "sales.csv"), "\n".join([header, good_line, bad_type]))
    good, bad = csv_source.load_retail_sales(spark, d)
    got = good.collect()
    assert len(got) == 1 and got[0]["quantity"] == 2 and got[0]["total_amount"] == Decimal("18.00")
    assert [r["raw_line"] for r in bad.collect()] == [bad_type]
    assert good.count() == 1 and bad.count() == 1


def test_address_table(spark):
    raw = spark.createDataFrame([("['2 B St\\nX, 1']",), ("['1 A St\\nY, 2']",), ("",)], "customer_address string")
    addr = normalize.load_address(raw)
    assert rows(addr) == [(1, "1 A St", "Y", " 2"), (2, "2 B St", "X", " 1")]
    assert explore.address_count(addr).first()[0] == 2


def test_sales_on_date_pushes_filter(spark, wh):
    sd = wh.table("sales_details")
    day = sd.agg(F.min("invoice_date")).first()[0]
    q = explore.sales_on_date(sd, day)
    assert q.count() == sd.where(F.col("invoice_date") == day).count() > 0
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(invoice_date" in plan


def test_fixture_invariants(spark, wh):
    rs, sd = wh.table("retail_sales"), wh.table("sales_details")
    # every staging row is accepted once (no gender conflicts in the driver data)
    assert sd.count() == rs.count()
    assert sd.agg(F.sum("amount")).first()[0] == rs.agg(F.sum("total_amount")).first()[0]
    first, last = explore.invoice_date_range(sd).first()
    assert first <= last and first >= dt.date(1990, 1, 1)


def test_constraint_report_one_pass_both_fk_paths(spark):
    df = spark.createDataFrame([(1, 5), (1, 0), (None, None), (2, -1), (9, 3)], "k int, q int")
    ref = spark.createDataFrame([(1,), (2,)], "id int")
    for bound in (10, 0):  # broadcast flags / per-key counts anti-joined
        got = dict(
            (r["check_name"], r["violations"])
            for r in quality.constraint_report(
                df, "t", ["k", "q"], [("check:q>0", F.col("q") > 0)], [("fk:k", "k", ref, "id")], broadcast_rows=bound
            ).collect()
        )
        assert got == {"not_null:t": 1, "check:q>0": 2, "fk:k": 1}
    plan = quality.constraint_report(df, "t", ["k"], [], [("fk:k", "k", ref, "id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 3  # the table is read once
