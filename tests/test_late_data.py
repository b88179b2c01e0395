"""Late sales: touched periods found by fingerprints, refreshed or spliced tables, and upkeep by the stream."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import cumulative as cum
from tallyhouse.operators import late
from tallyhouse.plans import ingest, runs
from tallyhouse.schemas import SALES_DETAILS
from tallyhouse.session import scratch_path
from tallyhouse.sources import csv as csv_source
from tallyhouse.sources import tables as store
from tallyhouse.streaming import cumulative_upkeep as upkeep
from tallyhouse.streaming import sales_stream

from conftest import rows

D = dt.date


def sale(sales_id, customer, day, amount, qty=1, category=1, region=1, discount="0.10"):
    return (sales_id, customer, category, Decimal("1.00"), qty, Decimal(discount), Decimal(amount), 1, day, region)


BEFORE = [
    sale(1, 1, D(2022, 3, 1), "10.00"), sale(2, 1, D(2023, 3, 1), "20.00"), sale(3, 1, D(2025, 3, 1), "30.00", qty=2),
    sale(4, 2, D(2022, 5, 1), "5.00"), sale(5, 3, D(2022, 6, 1), "7.00"), sale(6, 3, D(2024, 6, 1), "8.00"), sale(7, 4, D(2025, 7, 1), "9.00"),
]
# into the middle of an array, before the first sale of a customer, a new customer, and a second row of a year
LATE = [sale(8, 1, D(2024, 1, 1), "1.00"), sale(9, 4, D(2023, 1, 1), "2.00"), sale(10, 5, D(2023, 2, 2), "3.00"), sale(11, 3, D(2024, 2, 2), "4.00")]


def sales(spark, data):
    return spark.createDataFrame(data, SALES_DETAILS)


def part_files(spark, path, *parts):
    """{partition folder: its data files}, from a written table."""
    found = {}
    for f in store.read_table(spark, path).inputFiles():
        folder, name = os.path.split(urlparse(f).path)
        found.setdefault(os.path.basename(folder), set()).add(name)
    return {k: v for k, v in found.items() if not parts or k in parts}


@pytest.fixture(scope="module")
def customer(spark):
    return spark.createDataFrame([(i, f"C-{i}") for i in range(1, 7)], "customer_id int, customer_no string")


# -- change detection ---------------------------------------------------------------------------------
def test_fingerprints_tell_every_kind_of_change(spark):
    base = BEFORE + LATE
    marks = late.period_fingerprints(sales(spark, base), "year")

    def changed(data):
        return sorted(r[0] for r in late.changed_periods(marks, late.period_fingerprints(sales(spark, data), "year")).collect())

    assert changed(list(reversed(base))) == []  # order doesn't count
    assert changed([*base, base[1], base[1]]) == [2023]  # a row repeated twice: xor alone stays
    assert changed(base[:3] + base[4:]) == [2022]  # removed
    assert changed([*base, sale(12, 9, D(2030, 1, 1), "1.00")]) == [2030]  # a new period
    assert changed([r for r in base if r[8].year != 2023]) == [2023]  # a vanished period
    moved = [sale(6, 3, D(2023, 6, 1), "8.00") if r[0] == 6 else r for r in base]
    assert changed(moved) == [2023, 2024]
    corrected = [sale(2, 1, D(2023, 3, 1), "20.01") if r[0] == 2 else r for r in base]
    assert changed(corrected) == [2023]
    renumbered = [(r[0] + 100, *r[1:]) for r in base]
    assert changed(renumbered) == []  # the tables don't read the row key
    assert late.changed_periods(marks.limit(0), marks).count() == 4


def test_refresh_late_finds_the_start_and_keeps_older_files(spark):
    path = scratch_path(spark, "late_revenue")
    late.fill(spark, sales(spark, BEFORE), cum.CUSTOMER_REVENUE, path)
    old = part_files(spark, path)
    everything = sales(spark, BEFORE + LATE)
    got = late.refresh_late(spark, everything, cum.CUSTOMER_REVENUE, path)
    assert got.periods == [2023, 2024] and got.start == 2023
    assert rows(got.table) == rows(cum.backfill(everything, cum.CUSTOMER_REVENUE))
    new = part_files(spark, path)
    assert new["current_year=2022"] == old["current_year=2022"]
    assert all(new[f"current_year={y}"].isdisjoint(old[f"current_year={y}"]) for y in (2023, 2024, 2025))
    again = late.refresh_late(spark, everything, cum.CUSTOMER_REVENUE, path)
    assert again.periods == [] and again.start is None and part_files(spark, path) == new


def test_refresh_late_by_day_before_the_first_and_after_the_last_period(spark):
    path = scratch_path(spark, "late_daily")
    late.fill(spark, sales(spark, [sale(1, 1, D(2024, 1, 3), "1.00"), sale(2, 1, D(2024, 1, 5), "2.00", category=2)]), cum.PRODUCT_SALES, path)
    more = sales(spark, [
        sale(1, 1, D(2024, 1, 3), "1.00"), sale(2, 1, D(2024, 1, 5), "2.00", category=2),
        sale(3, 1, D(2024, 1, 1), "4.00"), sale(4, 1, D(2024, 1, 7), "8.00"),
    ])
    got = late.refresh_late(spark, more, cum.PRODUCT_SALES, path)
    assert got.periods == [D(2024, 1, 1), D(2024, 1, 7)]
    assert rows(got.table) == rows(cum.backfill(more, cum.PRODUCT_SALES))


def test_refresh_late_on_a_table_without_fingerprints_fills_it(spark):
    path = scratch_path(spark, "late_empty")
    got = late.refresh_late(spark, sales(spark, BEFORE), cum.CUSTOMER_REVENUE, path)
    assert rows(got.table) == rows(cum.backfill(sales(spark, BEFORE), cum.CUSTOMER_REVENUE))


# -- C5 -------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "after",
    [
        BEFORE + LATE,
        [*BEFORE, sale(12, 2, D(2027, 1, 1), "6.00"), sale(13, 6, D(2020, 1, 1), "6.00")],  # new years at both ends
        [r for r in BEFORE if r[0] not in (2, 6)],  # structs go from the middle and the end
        [sale(2, 1, D(2023, 3, 1), "21.00") if r[0] == 2 else r for r in BEFORE],
        BEFORE[:3] + BEFORE[4:],  # a customer without any sale left
    ],
)
def test_spliced_arrays_equal_a_backfill(spark, customer, after):
    path = scratch_path(spark, "late_arrays")
    late.fill_customer_sales(spark, sales(spark, BEFORE), customer, path)
    old = part_files(spark, path)
    now = sales(spark, after)
    got = late.refresh_customer_sales(spark, now, customer, path)
    assert rows(got.table) == rows(cum.backfill_customer_sales(now, customer))
    new = part_files(spark, path)
    assert all(new[f] == old[f] for f in old if int(f[-4:]) < got.start)
    assert late.refresh_customer_sales(spark, now, customer, path).periods == []


def test_splice_reads_the_touched_years_alone(spark, wh):
    """The scan of the sales is limited to the touched years by pushed date ranges."""
    plan = late.year_stats(wh.table("sales_details"), [1994, 1996])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(invoice_date,1994-01-01),LessThan(invoice_date,1995-01-01))" in plan
    read = plan[plan.index("ReadSchema") :]
    assert "region_id" not in read and "unit_price" not in read


# -- upkeep by the stream ----------------------------------------------------------------------------------
BATCHES = [LATE[:2], [], LATE[2:], [sale(12, 2, D(2028, 1, 1), "6.00"), sale(13, 6, D(2020, 1, 1), "6.00")]]


@pytest.mark.parametrize("spec", [cum.CUSTOMER_REVENUE, cum.CUSTOMER_PRODUCT_ENGAGE], ids=lambda s: s.name)
def test_batches_add_up_to_a_backfill_and_replays_change_nothing(spark, spec):
    table = upkeep.UpkeptTable(spec, scratch_path(spark, "upkept"))
    table.create(cum.backfill(sales(spark, BEFORE), spec))
    seen = list(BEFORE)
    for n, batch in enumerate(BATCHES):
        seen += batch
        table.add(sales(spark, batch), n)
        want = rows(cum.backfill(sales(spark, seen), spec))
        assert rows(table.read(spark)) == want
        table.add(sales(spark, batch), n)  # replayed after its list was written
        assert rows(table.read(spark)) == want
    for keep in (2, 1):
        upkeep.vacuum(spark, table, keep)
        assert rows(table.read(spark)) == want
    assert table.lists(spark).select(upkeep.BATCH).distinct().count() == 1


def test_a_crash_before_the_list_is_written_is_repeated(spark, monkeypatch):
    spec = cum.CUSTOMER_REVENUE
    table = upkeep.UpkeptTable(spec, scratch_path(spark, "upkept_crash"))
    table.create(cum.backfill(sales(spark, BEFORE), spec))
    before = rows(table.read(spark))
    files = part_files(spark, table.rows_path)
    monkeypatch.setattr(upkeep.UpkeptTable, "_list", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        table.add(sales(spark, LATE), 0)
    monkeypatch.undo()
    assert rows(table.read(spark)) == before  # the half-done batch isn't seen
    table.add(sales(spark, LATE), 0)
    assert rows(table.read(spark)) == rows(cum.backfill(sales(spark, BEFORE + LATE), spec))
    assert table.live(spark)[1][2022] == upkeep.BASE  # the oldest period is still the first fill's
    assert files["written_by=-1"] <= part_files(spark, table.rows_path)["written_by=-1"]


def test_upkeep_starts_from_an_empty_table(spark):
    table = upkeep.UpkeptTable(cum.CUSTOMER_REVENUE, scratch_path(spark, "upkept_empty"))
    assert table.read(spark).count() == 0
    table.add(sales(spark, BEFORE), 0)
    assert rows(table.read(spark)) == rows(cum.backfill(sales(spark, BEFORE), cum.CUSTOMER_REVENUE))


def test_stream_with_upkeep_equals_backfill_and_replay(spark, wh):
    """The stream's batches against one backfill over base and streamed sales; every batch run once more."""
    from conftest import SF_SMALL

    root = scratch_path(spark, "upkeep_stream")
    subs = runs.sales_submissions(spark, SF_SMALL, wh)
    csv_source.write_csv(subs.repartition(2), f"{root}/incoming")
    day, sd = D(1996, 5, 5), wh.table("sales_details")
    targets = sales_stream.SalesStreamTargets(f"{root}/sales", f"{root}/rejected", f"{root}/dim_date", f"{root}/_checkpoint")
    store.write_table(wh.table("dim_date"), targets.dim_date_path)
    names = cum.name_joiner(wh.table("product_category"), wh.table("region"))
    kept = [upkeep.UpkeptTable(s, f"{root}/{s.name}") for s in (cum.CUSTOMER_REVENUE, cum.REGION_PRODUCT_SALES)]
    for t in kept:
        t.create(cum.backfill(sd, t.spec, names))
    refs = runs.reference_tables(wh)
    upkeep.start_upkeep_stream(spark, f"{root}/incoming", refs, targets, day, kept, names).awaitTermination()
    accepted = ingest.ingest_sales(subs, refs, day)[0]
    both = sd.unionByName(accepted)
    for t in kept:
        assert rows(t.read(spark)) == rows(cum.backfill(both, t.spec, names))
        assert {p: v == upkeep.BASE for p, v in t.live(spark)[1].items()} == {p: p < 1996 for p in t.live(spark)[1]}
    streamed = store.read_table(spark, targets.sales_path)
    for b in (0, 1):
        for t in kept:
            t.add(streamed.where(F.col(sales_stream.BATCH_COL) == b), b, names)
    assert rows(kept[0].read(spark)) == rows(cum.backfill(both, cum.CUSTOMER_REVENUE))
