"""N7-N8 (SCD2), I1-I4 (validated insert, missing dates, stream) on hand fixtures."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import scd2
from tallyhouse.operators.quality import REASON
from tallyhouse.plans import ingest
from tallyhouse.schemas import DIM_DATE, SALE_SUBMISSION, SALES_DETAILS
from tallyhouse.session import scratch_path
from tallyhouse.sources import tables as store
from tallyhouse.streaming import sales_stream

from conftest import rows

D0 = dt.date(2025, 1, 1)


def test_scd2_changes(spark):
    customer = spark.createDataFrame([(1,), (2,), (3,), (4,)], "customer_id int")
    history = scd2.seed_customer_address(customer.where("customer_id < 4"), 10, D0, multiplier=1)
    # seed: address = id mod 10 + 1 -> 1:2, 2:3, 3:4
    d1, d2 = dt.date(2025, 2, 1), dt.date(2025, 3, 1)
    batch1 = spark.createDataFrame(
        [(1, 2, d1, 0), (2, 7, d1, 0), (3, 5, d1, 1), (3, 6, d1, 2), (4, 9, d1, 0), (99, 1, d1, 0)],
        "customer_id int, address_id int, change_date date, seq int",
    )
    h1, rej1 = scd2.apply_scd2(history, batch1, customer)
    assert [r["customer_id"] for r in rej1.collect()] == [99]
    batch2 = spark.createDataFrame([(2, 3, d2)], "customer_id int, address_id int, change_date date")
    h2, _ = scd2.apply_scd2(h1.checkpoint(), batch2, customer)
    expected = [
        (1, 2, D0, None, True),  # no change
        (2, 3, D0, dt.date(2025, 1, 31), False),  # moved ...
        (2, 7, d1, dt.date(2025, 2, 28), False),
        (2, 3, d2, None, True),  # ... and back
        (3, 4, D0, dt.date(2025, 1, 31), False),
        (3, 6, d1, None, True),  # two moves on one day: the later (seq 2) wins
        (4, 9, d1, None, True),  # no current row before: opened
    ]
    assert rows(h2) == rows(spark.createDataFrame(expected, "customer_id int, address_id int, start_date date, end_date date, is_current boolean"))
    assert scd2.scd2_violations(h2).count() == 0


def test_scd2_move_on_start_day_replaces_in_place(spark):
    history = spark.createDataFrame([(1, 2, D0, None, True)], "customer_id int, address_id int, start_date date, end_date date, is_current boolean")
    h, _ = scd2.apply_scd2(history, spark.createDataFrame([(1, 5, D0)], "customer_id int, address_id int, change_date date"))
    assert rows(h) == [(1, 5, D0, None, True)]


@pytest.fixture(scope="module")
def refs(spark):
    return {
        "customer": spark.createDataFrame([(1928,)], "customer_id int"),
        "product_category": spark.createDataFrame([(2, "Books")], "category_id int, category string"),
        "payment_method": spark.createDataFrame([(1, "Credit Card", True)], "method_id int, payment_method string, is_active boolean"),
        "region": spark.createDataFrame([(4, "Europe")], "region_id int, region_name string"),
    }


def sub(customer=1928, category=2, qty=1, discount="0.5", amount="241.10", method=1, region=4, price="482.20"):
    return (customer, category, qty, Decimal(discount), None if amount is None else Decimal(amount), method, region, Decimal(price))


def test_validated_insert(spark, refs):
    batch = spark.createDataFrame(
        [
            sub(amount="482.20"),  # the reference's sample call: rejected (D23)
            sub(),  # 241.10 accepted
            sub(qty=0),
            sub(customer=99999),
            sub(amount=None),  # NULL passes the comparison, fails NOT NULL
            sub(qty=3),  # the one-unit amount is accepted for any quantity (D22)
            sub(region=7),
        ],
        SALE_SUBMISSION,
    )
    accepted, rejected = ingest.ingest_sales(batch, refs, dt.date(2025, 2, 8))
    assert rows(accepted, "quantity", "amount", "invoice_date") == [(1, Decimal("241.10"), dt.date(2025, 2, 8)), (3, Decimal("241.10"), dt.date(2025, 2, 8))]
    assert sorted(r[REASON] for r in rejected.collect()) == sorted(
        ["amount_mismatch", "check:quantity>0", "fk:customer_id", "not_null:amount", "fk:region_id"]
    )
    assert accepted.count() + rejected.count() == batch.count()


def test_all_or_nothing_batch(spark, refs):
    good = spark.createDataFrame([sub(), sub(qty=2)], SALE_SUBMISSION)
    acc, rej = ingest.ingest_sales(good, refs, dt.date(2025, 2, 8), all_or_nothing=True)
    assert acc.count() == 2 and rej.count() == 0
    mixed = spark.createDataFrame([sub(), sub(amount="482.20")], SALE_SUBMISSION)
    acc, rej = ingest.ingest_sales(mixed, refs, dt.date(2025, 2, 8), all_or_nothing=True)
    assert acc.count() == 0
    assert sorted(r[REASON] for r in rej.collect()) == ["amount_mismatch", "batch_rolled_back"]


def test_missing_dates(spark):
    d = dt.date
    old = spark.createDataFrame([(1, d(2025, 1, 1)), (2, d(2025, 1, 2))], "date_key int, full_date date")
    old = old.select(*[(F.col(f.name) if f.name in ("date_key", "full_date") else F.lit(None)).cast(f.dataType).alias(f.name) for f in DIM_DATE.fields])
    sales = spark.createDataFrame(
        [(i, 1, 1, Decimal("1"), 1, Decimal("0"), Decimal("1"), 1, day, 1) for i, day in enumerate([d(2025, 1, 2), d(2025, 3, 1), d(2025, 2, 1), d(2025, 2, 1), d(2025, 1, 5)])],
        SALES_DETAILS,
    )
    new = ingest.load_missing_dates(sales, old)
    assert rows(new, "date_key", "full_date") == [(3, d(2025, 1, 5)), (4, d(2025, 2, 1)), (5, d(2025, 3, 1))]
    with_null = old.unionByName(old.limit(1).withColumn("full_date", F.lit(None).cast("date")))
    assert ingest.load_missing_dates(sales, with_null).count() == 0  # NOT IN over a NULL: nothing


def test_stream_equals_batch(spark, refs):
    batches = [[sub(), sub(amount="482.20")], [sub(qty=2)], [sub(customer=5)]]
    src = tempfile.mkdtemp(prefix="th-stream-src-", dir="/tmp")
    header = ",".join(f.name for f in SALE_SUBMISSION.fields)
    for i, b in enumerate(batches):
        with open(os.path.join(src, f"batch{i}.csv"), "w") as fh:
            fh.write("\n".join([header, *[",".join("" if v is None else str(v) for v in row) for row in b]]) + "\n")
    root = scratch_path(spark, "stream_out")
    targets = sales_stream.SalesStreamTargets(f"{root}/sales", f"{root}/rej", f"{root}/dim_date", f"{root}/_ckpt")
    dim = spark.createDataFrame([(1, dt.date(2025, 1, 1))], "date_key int, full_date date")
    store.write_table(dim.select(*[(F.col(f.name) if f.name in dim.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in DIM_DATE.fields]), targets.dim_date_path)
    as_of = dt.date(2025, 2, 8)
    q = sales_stream.start_sales_stream(spark, src, refs, targets, as_of)
    q.awaitTermination()
    streamed = sales_stream.streamed_sales(spark, targets)
    everything = spark.createDataFrame([s for b in batches for s in b], SALE_SUBMISSION)
    batch_accepted, batch_rejected = ingest.ingest_sales(everything, refs, as_of)
    cols = [f.name for f in SALES_DETAILS.fields if f.name != "sales_id"]
    assert rows(streamed, *cols) == rows(batch_accepted, *cols)
    assert store.read_table(spark, targets.rejected_path).count() == batch_rejected.count() == 2
    dates = rows(store.read_table(spark, targets.dim_date_path, DIM_DATE), "date_key", "full_date")
    assert dates == [(1, dt.date(2025, 1, 1)), (2, as_of)]  # the new day loaded once


def test_both_join_strategies_agree(spark, refs, monkeypatch):
    """The broadcast and the shuffle paths of SCD2 and of the FK checks give the same rows."""
    customer = spark.createDataFrame([(i,) for i in range(1, 6)], "customer_id int")
    history = scd2.seed_customer_address(customer.where("customer_id < 5"), 10, D0, multiplier=1)
    changes = spark.createDataFrame(
        [(1, 2, dt.date(2025, 2, 1)), (2, 8, dt.date(2025, 2, 1)), (5, 3, dt.date(2025, 2, 1)), (77, 1, dt.date(2025, 2, 1))],
        "customer_id int, address_id int, change_date date",
    )
    batch = spark.createDataFrame([sub(), sub(customer=4), sub(qty=0), sub(amount="1.00")], SALE_SUBMISSION)
    h_small, r_small = scd2.apply_scd2(history, changes, customer)
    a_small, j_small = ingest.ingest_sales(batch, refs, D0)
    small = (rows(h_small), rows(r_small), rows(a_small.drop("sales_id")), rows(j_small))
    monkeypatch.setattr(scd2, "CHANGE_BROADCAST_ROWS", 0)
    monkeypatch.setattr(ingest, "LOOKUP_BROADCAST_ROWS", 0)
    h_big, r_big = scd2.apply_scd2(history, changes, customer)
    a_big, j_big = ingest.ingest_sales(batch, refs, D0)
    assert (rows(h_big), rows(r_big), rows(a_big.drop("sales_id")), rows(j_big)) == small
    monkeypatch.setattr(ingest, "BATCH_KEYS_BROADCAST_ROWS", 0)
    a_sh, j_sh = ingest.ingest_sales(batch, refs, D0)
    assert (rows(a_sh.drop("sales_id")), rows(j_sh)) == small[2:]


def test_replayed_batch_is_exactly_once(spark, refs):
    root = scratch_path(spark, "replay")
    targets = sales_stream.SalesStreamTargets(f"{root}/sales", f"{root}/rej", f"{root}/dim_date", f"{root}/_ckpt")
    dim = spark.createDataFrame([(1, dt.date(2025, 1, 1))], "date_key int, full_date date")
    store.write_table(dim.select(*[(F.col(f.name) if f.name in dim.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in DIM_DATE.fields]), targets.dim_date_path)
    batch = spark.createDataFrame([sub(), sub(qty=2), sub(amount="1.00")], SALE_SUBMISSION)
    as_of = dt.date(2025, 3, 3)
    for _ in range(2):  # the same micro-batch id delivered twice
        sales_stream.process_batch(batch, 7, refs, targets, as_of)
    assert sales_stream.streamed_sales(spark, targets).count() == 2
    assert store.read_table(spark, targets.rejected_path).count() == 1
    dates = rows(store.read_table(spark, targets.dim_date_path, DIM_DATE), "date_key", "full_date")
    assert dates == [(1, dt.date(2025, 1, 1)), (2, as_of)]
