"""

Each query takes ``(spark, sf_dir)``. The warehouse (staging -> 3NF -> star) is built once per
data directory and written under the session's ``spark.checkpoint.dir`` (a complete build by the
same code is reused); queries then read the written tables. Names follow the operators of
"""

from __future__ import annotations

import datetime as _dt
import os
import sys
import uuid
from collections.abc import Callable

# the package and the oracle live next to this file; make them importable however it is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_sql as _oracle
from tallyhouse.functions.exprs import discount_price, with_canonical_text
from tallyhouse.operators import cumulative as cum
from tallyhouse.operators import explore, late, normalize, quality, scd2, segments, upsert
from tallyhouse.plans import atomic_ingest, faults, ingest, questions, runs
from tallyhouse.plans.warehouse import REJECTED
from tallyhouse.plans.joins import not_in
from tallyhouse.schemas import CUSTOMER_ADDRESS, FAKE_CUSTOMER_ADDRESS, FAKE_CUSTOMER_NAMES, RETAIL_SALES, SALE_KEYED, SALE_YEAR, SALES_DETAILS, conform
from tallyhouse.session import ensure_checkpoint_dir, scratch_path
from tallyhouse.sources import csv as csv_source
from tallyhouse.sources import tables as store
from tallyhouse.sources import tpch
from tallyhouse.streaming import cumulative_upkeep, sales_stream

AS_OF = _dt.date.fromisoformat(_oracle.AS_OF)
SALES_DAY = _dt.date.fromisoformat(_oracle.SALES_DAY)
FEED_DAY = _dt.date.fromisoformat(_oracle.FEED_DAY)
DIM_DATE_CUTOFF = _dt.date.fromisoformat(_oracle.DIM_DATE_CUTOFF)
SALES_DETAIL_COLS = [f.name for f in SALES_DETAILS.fields if f.name != "sales_id"]
BUCKETS = 8
STREAM_BATCHES = 3

Query = Callable[[SparkSession, str], DataFrame]


def _wh(spark: SparkSession, sf_dir: str):
    ensure_checkpoint_dir(spark)
    return runs.warehouse(spark, sf_dir)


# -- staging and 3NF -------------------------------------------------------------------------
def q_retail_sales(spark, sf):
    return _wh(spark, sf).table("retail_sales")


def q_staging_csv_roundtrip(spark, sf):
    """The staging table exported as CSV and loaded back through the CSV reader."""
    path = scratch_path(spark, "retail_sales_csv")
    csv_source.write_csv(_wh(spark, sf).table("retail_sales"), path)
    good, _bad = csv_source.load_retail_sales(spark, path)
    return good


def q_customer_names_csv(spark, sf):
    """A names file (header ``name``) written from the customer table and loaded back."""
    path = scratch_path(spark, "customer_names_csv")
    csv_source.write_csv(tpch.customer_names(spark, sf).withColumnRenamed("customer_name", "name"), path)
    good, _bad = csv_source.load_customer_names(spark, path)
    return good


def q_customer_address_csv(spark, sf):
    """S3 + N4: an address file written from the customer table, loaded back and parsed."""
    path = scratch_path(spark, "customer_address_csv")
    csv_source.write_csv(tpch.customer_addresses(spark, sf), path)
    good, _bad = csv_source.load_customer_addresses(spark, path)
    return normalize.parse_addresses(good)


def _quarantine(spark, feed, schema, header):
    """The rejected lines of a feed, with the file set they came from and the reason."""
    path = scratch_path(spark, "faulty_feed")
    csv_source.write_lines(feed, path, header, "feed")
    bad = csv_source.load_checked(spark, path, schema)[1]
    folder = F.regexp_extract(csv_source.SOURCE_FILE, "feed=([0-9]+)", 1).cast("int")
    return bad.select(folder.alias("feed"), csv_source.RAW_LINE, quality.REASON)


def q_sales_csv_quarantine(spark, sf):
    """Lines of a sales feed with faults."""
    return _quarantine(spark, faults.faulty_sales_feed(_wh(spark, sf).table("retail_sales")), RETAIL_SALES, "sale")


def q_customer_names_csv_quarantine(spark, sf):
    """Lines of a names feed with faults."""
    return _quarantine(spark, faults.faulty_names_feed(tpch.customer_names(spark, sf)), FAKE_CUSTOMER_NAMES, "name")


def q_customer_address_csv_quarantine(spark, sf):
    """S3: lines of an address feed with faults."""
    return _quarantine(spark, faults.faulty_addresses_feed(tpch.customer_addresses(spark, sf)), FAKE_CUSTOMER_ADDRESS, "customer_address")


def _lookup(name):
    return lambda spark, sf: _wh(spark, sf).table(name)


def q_parsed_addresses(spark, sf):
    return normalize.parse_addresses(tpch.customer_addresses(spark, sf))


def q_address_table(spark, sf):
    return runs.with_addresses(spark, sf).table("address")


def q_address_count(spark, sf):
    return explore.address_count(runs.with_addresses(spark, sf).table("address"))


def q_customer_table(spark, sf):
    return _wh(spark, sf).table("customer")


def q_sales_details(spark, sf):
    return _wh(spark, sf).table("sales_details").select(*SALES_DETAIL_COLS)


def q_rejected_sales(spark, sf):
    """N6 quarantine: staged rows that broke a NOT NULL or CHECK rule."""
    wh = _wh(spark, sf)
    return store.read_table(spark, wh.path(REJECTED), SALES_DETAILS).select(*SALES_DETAIL_COLS)


def q_quarantined_sales(spark, sf):
    """N6 quarantine on staged sales with faults: every rule rejects some, with its reason."""
    wh = _wh(spark, sf)
    lookups = {n: wh.table(n) for n in normalize.LOOKUPS}
    staged = normalize.stage_sales_details(faults.faulty_sales(wh.table("retail_sales")), wh.table("customer"), lookups)
    return staged.where(F.col(quality.REASON).isNotNull()).select(*SALES_DETAIL_COLS, quality.REASON)


def q_seed_customer_address(spark, sf):
    wh = runs.with_addresses(spark, sf)
    return scd2.seed_customer_address(wh.table("customer"), runs.address_count(wh), AS_OF, _oracle.ADDRESS_MULTIPLIERS[0])


def q_customer_address_history(spark, sf):
    """Seed, then three change batches applied in order (the last moves customers back)."""
    wh = runs.with_addresses(spark, sf)
    customer = wh.table("customer")
    n = runs.address_count(wh)
    history = scd2.seed_customer_address(customer, n, AS_OF, _oracle.ADDRESS_MULTIPLIERS[0])
    for k, mult in enumerate(_oracle.ADDRESS_MULTIPLIERS[1:], start=1):
        day = AS_OF + _dt.timedelta(days=k * _oracle.SCD2_STEP_DAYS)
        history, _rej = scd2.apply_scd2(history, runs.address_changes(customer, n, mult, day), customer)
        history = history.checkpoint(eager=True)  # each batch is a committed version
    return conform(history, CUSTOMER_ADDRESS)


def q_customer_address_moves(spark, sf):
    """Two moves of every customer in one batch, a late move between them, and a replay."""
    wh = runs.with_addresses(spark, sf)
    customer = wh.table("customer")
    n = runs.address_count(wh)
    seed, first, second, late = _oracle.MOVE_MULTIPLIERS
    day = [AS_OF + _dt.timedelta(days=k * _oracle.SCD2_STEP_DAYS) for k in range(4)]
    history = scd2.seed_customer_address(customer, n, AS_OF, seed)
    two = runs.address_changes(customer, n, first, day[1]).unionByName(runs.address_changes(customer, n, second, day[3]))
    between = runs.address_changes(customer.where(F.col("customer_id") % 2 == 0), n, late, day[2])
    for batch in (two, between, two):
        history = scd2.apply_scd2(history, batch, customer)[0].checkpoint(eager=True)
    return conform(history, CUSTOMER_ADDRESS)


def q_customer_address_moves_stored(spark, sf):
    """N8 on the bucketed table: the batches of ``customer_address_moves``, each rewriting its own buckets."""
    wh = runs.with_addresses(spark, sf)
    customer = wh.table("customer")
    n = runs.address_count(wh)
    seed, first, second, late_move = _oracle.MOVE_MULTIPLIERS
    day = [AS_OF + _dt.timedelta(days=k * _oracle.SCD2_STEP_DAYS) for k in range(4)]
    stored = scd2.StoredHistory(scratch_path(spark, "customer_address"), BUCKETS)
    stored.create(scd2.seed_customer_address(customer, n, AS_OF, seed))
    two = runs.address_changes(customer, n, first, day[1]).unionByName(runs.address_changes(customer, n, second, day[3]))
    between = runs.address_changes(customer.where(F.col("customer_id") % 2 == 0), n, late_move, day[2])
    for batch in (two, between, two):
        stored.apply(batch, customer)
    return stored.read(spark)


def q_sales_upsert(spark, sf):
    """Staged sales as a table keyed by transaction id; then a batch of changes, applied twice."""
    rs = _wh(spark, sf).table("retail_sales")
    year = F.substring("timestamp", 1, 4).cast("int").alias(SALE_YEAR)
    staged = rs.select(*SALE_KEYED.names[:-1], year)
    path, t = scratch_path(spark, "sales_keyed"), F.col("transaction_id")
    upsert.upsert(spark, path, staged, ["transaction_id"], SALE_YEAR, SALE_KEYED, SALE_KEYED.names[1:-1])
    table = store.read_table(spark, path, SALE_KEYED)
    later = F.concat((F.col(SALE_YEAR) + 1).cast("string"), F.substring("timestamp", 5, 100))
    changed = table.where((t % 11 == 0) | (t % 55 == 5)).select(
        "transaction_id", F.when(t % 22 == 0, later).otherwise(F.col("timestamp")).alias("timestamp"), "customer_id",
        F.when(t % 11 == 0, F.col("quantity") + 1).otherwise(F.col("quantity")).alias("quantity"), "total_amount",
        F.when(t % 22 == 0, F.col(SALE_YEAR) + 1).otherwise(F.col(SALE_YEAR)).alias(SALE_YEAR), (t % 55 == 5).alias("deleted"),
    )
    added = table.where(t % 33 == 0).withColumns({"transaction_id": -t, "deleted": F.lit(False)})
    batch = late.settled(changed.unionByName(added))
    for _ in range(2):
        upsert.upsert(spark, path, batch, ["transaction_id"], SALE_YEAR, SALE_KEYED)
    return store.read_table(spark, path, SALE_KEYED)


# -- exploration -------------------------------------------------------------------------------
def _distinct(col):
    return lambda spark, sf: explore.profile_distinct(_wh(spark, sf).table("retail_sales"), col)


def q_customer_preview(spark, sf):
    return explore.preview(_wh(spark, sf).table("customer"), ["customer_id"])


def q_retail_sales_preview(spark, sf):
    rs = _wh(spark, sf).table("retail_sales")
    return explore.preview(rs, ["transaction_id", *[c for c in rs.columns if c != "transaction_id"]])


def q_numeric_profile(spark, sf):
    return explore.profile_numeric(_wh(spark, sf).table("retail_sales"))


def q_sales_count_by_customer(spark, sf):
    return explore.sales_count_by_customer(_wh(spark, sf).table("sales_details"))


def q_sales_by_region(spark, sf):
    wh = _wh(spark, sf)
    return explore.sales_by_region(wh.table("sales_details"), wh.table("region"))


def q_invoice_date_range(spark, sf):
    return explore.invoice_date_range(_wh(spark, sf).table("sales_details"))


def q_sales_on_date(spark, sf):
    return explore.sales_on_date(_wh(spark, sf).table("sales_details"), SALES_DAY).select(*SALES_DETAIL_COLS)


# -- quality -----------------------------------------------------------------------------------
def q_duplicate_transaction_ids(spark, sf):
    return quality.primary_key_violations(_wh(spark, sf).table("retail_sales"), ["transaction_id"])


def q_quality_report(spark, sf):
    """K4-K7 over the 3NF tables: one scan per table for its NOT NULL / CHECK / FK counts."""
    wh = _wh(spark, sf)
    sd, cust = wh.table("sales_details"), wh.table("customer")

    def count(name, violations):
        return violations.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")

    sales_checks = quality.constraint_report(
        sd,
        "sales_details",
        not_null=normalize.SALES_NOT_NULL,
        checks=[("check:sales_details(quantity>0)", F.col("quantity") > 0)],
        foreign_keys=[
            ("fk:sales_details(customer_id)->customer", "customer_id", cust, "customer_id"),
            ("fk:sales_details(category_id)->product_category", "category_id", wh.table("product_category"), "category_id"),
            ("fk:sales_details(payment_method_id)->payment_method", "payment_method_id", wh.table("payment_method"), "method_id"),
            ("fk:sales_details(region_id)->region", "region_id", wh.table("region"), "region_id"),
        ],
    )
    parts = [
        count("pk:customer(customer_id)", quality.primary_key_violations(cust, ["customer_id"])),
        count("pk:retail_sales(transaction_id)", quality.primary_key_violations(wh.table("retail_sales"), ["transaction_id"])),
        sales_checks,
        quality.constraint_report(wh.table("payment_method"), "payment_method", not_null=["payment_method"]),
        # A customer number held by two customer rows (two gender codes) doubles its sales
        count(
            "dup:customer(customer_no)",
            quality.primary_key_violations(cust.where(F.col("customer_no").isNotNull()), ["customer_no"]),
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _faulty_submissions(spark, sf, wh):
    return faults.faulty_submissions(runs.sales_submissions(spark, sf, wh))


def q_submission_quality_report(spark, sf):
    """K5-K7 on submissions with faults: each check finds violations."""
    wh = _wh(spark, sf)
    return quality.constraint_report(
        _faulty_submissions(spark, sf, wh),
        "submissions",
        not_null=ingest.SUBMISSION_NOT_NULL,
        checks=[("check:submissions(quantity>0)", F.col("quantity") > 0)],
        foreign_keys=[
            (f"fk:submissions({col})", col, wh.table(table), ref_col) for col, (table, ref_col) in ingest.FOREIGN_KEYS.items()
        ],
    )


# -- star and questions -------------------------------------------------------------------------
def _table(name, drop=()):
    def run(spark, sf):
        df = _wh(spark, sf).table(name)
        return df.drop(*drop) if drop else df

    return run


def q_avg_quarterly_revenue(spark, sf):
    wh = _wh(spark, sf)
    return questions.avg_quarterly_revenue(
        wh.table("fact_sales"), wh.table("dim_region"), wh.table("dim_product_category"), wh.table("dim_date")
    )


def q_avg_quarterly_revenue_of_year(spark, sf):
    """B1 for one year: one partition of the fact is read."""
    wh = _wh(spark, sf)
    days = wh.table("dim_date").where(F.col("year") == _oracle.QUESTION_YEAR)
    return questions.avg_quarterly_revenue(wh.table("fact_sales"), wh.table("dim_region"), wh.table("dim_product_category"), days)


def q_avg_quarterly_revenue_between(spark, sf):
    """B1 for a range of days: the years that hold them are found in dim_date at run time."""
    wh = _wh(spark, sf)
    days = questions.of_dates(wh.table("dim_date"), *[_dt.date.fromisoformat(d) for d in _oracle.QUESTION_DAYS])
    return questions.avg_quarterly_revenue(wh.table("fact_sales"), wh.table("dim_region"), wh.table("dim_product_category"), days)


def q_avg_of_quarter_totals(spark, sf):
    wh = _wh(spark, sf)
    return questions.avg_of_quarter_totals(
        wh.table("fact_sales"), wh.table("dim_region"), wh.table("dim_product_category"), wh.table("dim_date")
    )


def q_payment_mix_by_region(spark, sf):
    wh = _wh(spark, sf)
    return questions.payment_mix_by_region(wh.table("fact_sales"), wh.table("dim_region"), wh.table("dim_payment_method"))


def q_christmas_sales_by_payment_method(spark, sf):
    """V1 as a named view, read back through the catalog."""
    wh = _wh(spark, sf)
    days = questions.christmas_days(wh.table("dim_date"))
    view = questions.christmas_sales_by_payment_method(wh.table("sales_details"), wh.table("region"), days)
    return store.create_view(view, "v_christmas_day_sales_by_payment_methods")


def q_discount_prices(spark, sf):
    sd = _wh(spark, sf).table("sales_details")
    return sd.select("unit_price", "discount", discount_price("unit_price", "discount").alias("discount_price"))


# -- cumulative tables ----------------------------------------------------------------------------
def _names(wh):
    return cum.name_joiner(wh.table("product_category"), wh.table("region"))


def _backfill(spec_name):
    def run(spark, sf):
        wh = _wh(spark, sf)
        return cum.backfill(wh.table("sales_details"), cum.SPECS[spec_name], _names(wh))

    return run


def q_cum_customer_revenue_step(spark, sf):
    """The last year computed as one step from the prior year's rows."""
    wh = _wh(spark, sf)
    sd = wh.table("sales_details")
    spec = cum.CUSTOMER_REVENUE
    last = _years(wh)[-1]
    prior = cum.backfill(sd, spec, end=last - 1).where(F.col("current_year") == last - 1)
    return cum.cumulate_step(cum.period_totals(sd, spec, last), prior, spec, last)


def _years(wh) -> list[int]:
    """All sales years, gaps included, from the date dimension (one row a day) instead of the sales."""
    bounds = wh.table("dim_date").agg(F.min("year").alias("a"), F.max("year").alias("b")).first()
    return list(range(bounds["a"], bounds["b"] + 1))


def _stored(wh, name):
    """A cumulative table as stored by period; the tables are built at their first use."""
    if "cumulative" not in wh.built:
        wh.build_cumulative()
    return wh.table(name)


def _chain(spec_name):
    """The same table filled year by year with full outer steps over stored partitions."""

    def run(spark, sf):
        wh = _wh(spark, sf)
        return cum.run_chain(
            spark, wh.table("sales_details"), cum.SPECS[spec_name], _years(wh), scratch_path(spark, f"{spec_name}_chain"), _names(wh)
        )

    return run


def q_cum_customer_sales_chain(spark, sf):
    """C5 as yearly steps (arrays started and appended to), every element with its position."""
    wh = _wh(spark, sf)
    path = scratch_path(spark, "cum_customer_sales_chain")
    table = cum.run_customer_sales_chain(spark, wh.table("sales_details"), wh.table("customer"), _years(wh), path)
    return table.select(
        "customer_id", "customer_no", "current_year", F.posexplode("sales_stats").alias("pos", "s")
    ).select("customer_id", "customer_no", "current_year", "pos", "s.*")


def q_cum_customer_revenue_stored(spark, sf):
    """C8 on the stored table: the last year's partition, read without touching the sales."""
    wh = _wh(spark, sf)
    return cum.lookup(_stored(wh, "cum_customer_revenue"), current_year=_years(wh)[-1])


def q_cum_customer_revenue_chain(spark, sf):
    """C0 repeated year by year on the customer-bucketed, year-partitioned layout."""
    wh = _wh(spark, sf)
    sales_table = wh.build_bucketed_sales(BUCKETS)
    years = _years(wh)
    table = f"{wh.database}.cum_customer_revenue_chain_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, "cum_customer_revenue_chain")
    return cum.run_bucketed_chain(spark, sales_table, cum.CUSTOMER_REVENUE, years, table, path, BUCKETS)


def q_cum_customer_product_engage_as_of(spark, sf):
    """C9 sparse: running totals kept only at active years, read as of the last year."""
    wh = _wh(spark, sf)
    sd = wh.table("sales_details")
    spec = cum.CUSTOMER_PRODUCT_ENGAGE
    sparse = cum.backfill_sparse(sd, spec)
    return cum.as_of(sparse, spec, _years(wh)[-1], _names(wh))


def q_cum_region_sales_for_category(spark, sf):
    """C8 on the stored table, by category."""
    return cum.lookup(_stored(_wh(spark, sf), "cum_region_product_sales"), product_category=_oracle.LOOKUP_CATEGORY)


def _customer_sales(spark, sf):
    wh = _wh(spark, sf)
    return cum.backfill_customer_sales(wh.table("sales_details"), wh.table("customer"))


def q_cum_customer_sales(spark, sf):
    """C5, the arrays as canonical text (position, field, value)."""
    return with_canonical_text(_customer_sales(spark, sf), "sales_stats")


def q_cum_customer_sales_unnested(spark, sf):
    """C6 on the stored table: only the last year's partition is read; the structs as canonical text."""
    wh = _wh(spark, sf)
    return with_canonical_text(cum.unnest_customer_sales(_stored(wh, "cum_customer_sales"), _years(wh)[-1]), "sales_stats")


def q_cum_customer_sales_exploded(spark, sf):
    """C5 in full: every customer-year with each array element and its position."""
    return _customer_sales(spark, sf).select(
        "customer_id", "customer_no", "current_year", F.posexplode("sales_stats").alias("pos", "s")
    ).select("customer_id", "customer_no", "current_year", "pos", "s.*")


def q_cum_customer_sales_flat(spark, sf):
    """C7 on the stored table: only the last year's partition is read."""
    wh = _wh(spark, sf)
    return cum.flatten_customer_sales(_stored(wh, "cum_customer_sales"), _years(wh)[-1])


def q_customer_transitions(spark, sf):
    """C10 on the stored table."""
    return cum.transition_analysis(_stored(_wh(spark, sf), "cum_customer_sales"))


def _transitions(spec):
    """C10 on a stored table without arrays: every key and year."""
    return lambda spark, sf: cum.transition_states(_stored(_wh(spark, sf), spec.name), spec)


def q_customer_revenue_transitions(spark, sf):
    """C10 for the last year: its stored partition against the two before it."""
    wh = _wh(spark, sf)
    return cum.transition_states_of(_stored(wh, "cum_customer_revenue"), cum.CUSTOMER_REVENUE, _years(wh)[-1])


def q_region_category_trend(spark, sf):
    """Market trend by region and category, from the stored table."""
    wh = _wh(spark, sf)
    return cum.trend(_stored(wh, "cum_region_product_sales"), cum.REGION_PRODUCT_SALES, _names(wh))


def q_customer_category_trend(spark, sf):
    """Trend by customer and category, from the stored table."""
    return cum.trend(_stored(_wh(spark, sf), "cum_customer_product_engage"), cum.CUSTOMER_PRODUCT_ENGAGE)


def q_customer_segments(spark, sf):
    """Recency, frequency and value bands from the last stored year of C5 and C4."""
    wh = _wh(spark, sf)
    return segments.customer_segments(_stored(wh, "cum_customer_sales"), _stored(wh, "cum_customer_revenue"), _years(wh)[-1])


def q_cum_customer_revenue_late(spark, sf):
    """C9 for late data: the table filled without the late sales, then the touched years found and refreshed."""
    sd = _wh(spark, sf).table("sales_details")
    path = scratch_path(spark, "cum_customer_revenue_late")
    late.fill(spark, sd.where(~runs.is_late(_oracle.LATE_YEAR)), cum.CUSTOMER_REVENUE, path)
    found = late.refresh_late(spark, sd, cum.CUSTOMER_REVENUE, path)
    refreshed = F.col("current_year") >= found.start if found.periods else F.lit(False)
    return found.table.withColumn("refreshed", refreshed)


def q_cum_customer_sales_late(spark, sf):
    """C5 for late data: the late years' structs spliced into the stored arrays, every element with its position."""
    wh = _wh(spark, sf)
    sd, customer = wh.table("sales_details"), wh.table("customer")
    path = scratch_path(spark, "cum_customer_sales_late")
    late.fill_customer_sales(spark, sd.where(~runs.is_late(_oracle.LATE_YEAR)), customer, path)
    table = late.refresh_customer_sales(spark, sd, customer, path).table
    return table.select(
        "customer_id", "customer_no", "current_year", F.posexplode("sales_stats").alias("pos", "s")
    ).select("customer_id", "customer_no", "current_year", "pos", "s.*")


def q_cum_customer_revenue_streamed(spark, sf):
    """A late feed streamed in three batches, each added to its year and all later stored ones."""
    wh = _wh(spark, sf)
    root = scratch_path(spark, "upkeep_stream")
    files = sales_stream.deal_files(runs.sales_submissions(spark, sf, wh), f"{root}/incoming", STREAM_BATCHES)
    targets = sales_stream.SalesStreamTargets(
        sales_path=f"{root}/sales", rejected_path=f"{root}/rejected", dim_date_path=f"{root}/dim_date", checkpoint_path=f"{root}/_checkpoint"
    )
    store.write_table(wh.table("dim_date"), targets.dim_date_path)
    table = cumulative_upkeep.UpkeptTable(cum.CUSTOMER_REVENUE, f"{root}/cum_customer_revenue")
    table.create(cum.backfill(wh.table("sales_details"), cum.CUSTOMER_REVENUE))
    refs = runs.reference_tables(wh)
    stream = cumulative_upkeep.start_upkeep_stream(spark, f"{root}/incoming", refs, targets, FEED_DAY, [table], files_per_batch=files)
    stream.awaitTermination()
    return table.read(spark)


# -- ingestion ------------------------------------------------------------------------------------
def _ingest(spark, sf):
    wh = _wh(spark, sf)
    return ingest.ingest_sales(runs.sales_submissions(spark, sf, wh), runs.reference_tables(wh), AS_OF)


def q_ingest_accepted(spark, sf):
    return _ingest(spark, sf)[0].select(*SALES_DETAIL_COLS)


def q_ingest_rejected(spark, sf):
    return _ingest(spark, sf)[1]


def q_ingest_rejected_reasons(spark, sf):
    """I2 on submissions with faults: rows are rejected for every reason there is."""
    wh = _wh(spark, sf)
    return ingest.ingest_sales(_faulty_submissions(spark, sf, wh), runs.reference_tables(wh), AS_OF)[1]


def q_ingest_all_or_nothing(spark, sf):
    """I2 and I3 as one transaction: three batches, one of them with bad rows; the committed sales and their dates."""
    wh = _wh(spark, sf)
    subs, refs = runs.sales_submissions(spark, sf, wh), runs.reference_tables(wh)
    target, dim_date = atomic_ingest.Target(scratch_path(spark, "all_or_nothing")), wh.table("dim_date")
    for n in range(3):
        batch = subs.where(F.col("customer_id") % 3 == n)
        if n != 1:  # a feed that holds good rows only
            batch = batch.where(F.col("amount") == discount_price("unit_price", "discount"))
        target.ingest(batch, refs, dim_date, n, AS_OF + _dt.timedelta(days=n))
    dates = target.dates(spark).select(F.col("full_date").alias("invoice_date"), F.lit(True).alias("has_date"))
    found = target.sales(spark).join(F.broadcast(dates), "invoice_date", "left")  # a date a batch
    return found.select(*SALES_DETAIL_COLS, atomic_ingest.BATCH, F.coalesce("has_date", F.lit(False)).alias("has_date"))


def q_load_missing_dates(spark, sf):
    """dim_date as loaded before the cutoff date; the sales then bring the later dates."""
    wh = _wh(spark, sf)
    old = wh.table("dim_date").where(F.col("full_date") < F.lit(DIM_DATE_CUTOFF))
    return ingest.load_missing_dates(wh.table("sales_details"), old)


def q_dates_not_in(spark, sf):
    """Invoice dates (and a NULL) NOT IN a date dimension that is partly loaded, holds a NULL, or is empty."""
    wh = _wh(spark, sf)
    dates = wh.table("sales_details").select(F.col("invoice_date").alias("full_date")).distinct()
    dates = dates.unionByName(spark.createDataFrame([(None,)], "full_date date"))
    old = wh.table("dim_date").select("full_date").where(F.col("full_date") < F.lit(DIM_DATE_CUTOFF))
    known = {"part": old, "null": old.unionByName(spark.createDataFrame([(None,)], "full_date date")), "none": old.where(F.lit(False))}
    out = None
    for name, days in known.items():
        found = not_in(dates, "full_date", days, "full_date", ingest.DATE_BROADCAST_ROWS).select(F.lit(name).alias("known"), "full_date")
        out = found if out is None else out.unionByName(found)
    return out


def _streamed(spark, sf):
    """I4: submissions written as files and consumed by the stream in three batches."""
    wh = _wh(spark, sf)
    root = scratch_path(spark, "sales_stream")
    src = f"{root}/incoming"
    files = sales_stream.deal_files(runs.sales_submissions(spark, sf, wh), src, STREAM_BATCHES)
    targets = sales_stream.SalesStreamTargets(
        sales_path=f"{root}/sales", rejected_path=f"{root}/rejected", dim_date_path=f"{root}/dim_date",
        checkpoint_path=f"{root}/_checkpoint",
    )
    store.write_table(wh.table("dim_date"), targets.dim_date_path)
    q = sales_stream.start_sales_stream(spark, src, runs.reference_tables(wh), targets, AS_OF, files_per_batch=files)
    q.awaitTermination()
    return sales_stream.streamed_sales(spark, targets)


def q_stream_ingest(spark, sf):
    return _streamed(spark, sf).select(*SALES_DETAIL_COLS)


def q_stream_sales_ids(spark, sf):
    """K3 over the base table and the streamed sales together: as many ids as rows."""
    ids = _wh(spark, sf).table("sales_details").select("sales_id").unionByName(_streamed(spark, sf).select("sales_id"))
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("sales_id").alias("n_ids"))


# -------------------------------------------------------------------------------------------------
def _text_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the text operators and their pipeline, if that subpackage is there."""
    try:
        import corpus_pipeline
        from tallyhouse.llm import queries as text
    except ImportError as e:
        # only the parts themselves may be missing; a package that they need is a fault of the installation
        if not (e.name or "").startswith(("corpus_pipeline", "tallyhouse.llm")):
            raise
        return {}, {}
    sql = text.oracle_sql()
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**text.queries(), "pipeline": corpus_pipeline.run}, sql


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: question 1 (average quarterly revenue by region and category) on sf0.001."""
    return q_avg_quarterly_revenue(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "retail_sales": q_retail_sales,
        "staging_csv_roundtrip": q_staging_csv_roundtrip,
        "customer_names_csv": q_customer_names_csv,
        "customer_address_csv": q_customer_address_csv,
        "payment_method_lookup": _lookup("payment_method"),
        "region_lookup": _lookup("region"),
        "product_category_lookup": _lookup("product_category"),
        "parsed_addresses": q_parsed_addresses,
        "address_table": q_address_table,
        "address_count": q_address_count,
        "customer_table": q_customer_table,
        "sales_details": q_sales_details,
        "rejected_sales": q_rejected_sales,
        "quarantined_sales": q_quarantined_sales,
        "seed_customer_address": q_seed_customer_address,
        "customer_address_history": q_customer_address_history,
    }
    for col in ("customer_location", "product_category", "customer_gender", "payment_method"):
        q[f"distinct_{col}"] = _distinct(col)
    q.update(
        {
            "numeric_profile": q_numeric_profile,
            "customer_preview": q_customer_preview,
            "retail_sales_preview": q_retail_sales_preview,
            "sales_count_by_customer": q_sales_count_by_customer,
            "sales_by_region": q_sales_by_region,
            "invoice_date_range": q_invoice_date_range,
            "sales_on_date": q_sales_on_date,
            "duplicate_transaction_ids": q_duplicate_transaction_ids,
            "quality_report": q_quality_report,
            "submission_quality_report": q_submission_quality_report,
            "dim_date": _table("dim_date"),
            "dim_customer": _table("dim_customer"),
            "dim_product_category": _table("dim_product_category"),
            "dim_region": _table("dim_region"),
            "dim_payment_method": _table("dim_payment_method"),
            "fact_sales": _table("fact_sales", drop=("sale_key", SALE_YEAR)),
            "avg_quarterly_revenue": q_avg_quarterly_revenue,
            "avg_of_quarter_totals": q_avg_of_quarter_totals,
            "payment_mix_by_region": q_payment_mix_by_region,
            "christmas_sales_by_payment_method": q_christmas_sales_by_payment_method,
            "discount_prices": q_discount_prices,
            "cum_product_sales": _backfill("cum_product_sales"),
            "cum_region_product_sales": _backfill("cum_region_product_sales"),
            "cum_customer_product_engage": _backfill("cum_customer_product_engage"),
            "cum_customer_revenue": _backfill("cum_customer_revenue"),
            "cum_customer_revenue_step": q_cum_customer_revenue_step,
            "cum_customer_revenue_chain": q_cum_customer_revenue_chain,
            "cum_customer_product_engage_as_of": q_cum_customer_product_engage_as_of,
            "cum_region_sales_for_category": q_cum_region_sales_for_category,
            "cum_customer_sales": q_cum_customer_sales,
            "cum_customer_sales_unnested": q_cum_customer_sales_unnested,
            "cum_customer_sales_flat": q_cum_customer_sales_flat,
            "cum_customer_sales_exploded": q_cum_customer_sales_exploded,
            "customer_transitions": q_customer_transitions,
            "ingest_accepted": q_ingest_accepted,
            "ingest_rejected": q_ingest_rejected,
            "ingest_rejected_reasons": q_ingest_rejected_reasons,
            "load_missing_dates": q_load_missing_dates,
            "stream_ingest": q_stream_ingest,
            "stream_sales_ids": q_stream_sales_ids,
            "customer_address_moves": q_customer_address_moves,
            "customer_address_moves_stored": q_customer_address_moves_stored,
            "sales_upsert": q_sales_upsert,
            "dates_not_in": q_dates_not_in,
            "avg_quarterly_revenue_of_year": q_avg_quarterly_revenue_of_year,
            "avg_quarterly_revenue_between": q_avg_quarterly_revenue_between,
            "cum_region_product_sales_chain": _chain("cum_region_product_sales"),
            "cum_customer_product_engage_chain": _chain("cum_customer_product_engage"),
            "cum_customer_sales_chain": q_cum_customer_sales_chain,
            "cum_customer_revenue_stored": q_cum_customer_revenue_stored,
            "region_category_transitions": _transitions(cum.REGION_PRODUCT_SALES),
            "customer_category_transitions": _transitions(cum.CUSTOMER_PRODUCT_ENGAGE),
            "customer_revenue_transitions": q_customer_revenue_transitions,
            "region_category_trend": q_region_category_trend,
            "customer_category_trend": q_customer_category_trend,
            "customer_segments": q_customer_segments,
            "sales_csv_quarantine": q_sales_csv_quarantine,
            "customer_names_csv_quarantine": q_customer_names_csv_quarantine,
            "customer_address_csv_quarantine": q_customer_address_csv_quarantine,
            "ingest_all_or_nothing": q_ingest_all_or_nothing,
            "cum_customer_revenue_late": q_cum_customer_revenue_late,
            "cum_customer_sales_late": q_cum_customer_sales_late,
            "cum_customer_revenue_streamed": q_cum_customer_revenue_streamed,
        }
    )
    q.update(_text_queries()[0])
    return q


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query."""
    sql = {**_oracle.queries(), **_text_queries()[1]}
    return {k: v for k, v in sql.items() if k in queries()}
