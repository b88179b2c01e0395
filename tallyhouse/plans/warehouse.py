"""The warehouse build: staging -> 3NF -> star, each table written once and read back.

Writing each layer cuts the lineage (an executor lost later recomputes from the last written
table, not from the raw sources), gives the planner real file sizes for its broadcast decisions,
and lets every question scan only the columns it needs.

Layout choices:

* ``sales_details`` is written with the rejected rows beside it (partition ``load_status``), each
  file sorted by ``invoice_date`` so that date filters skip row groups.
* ``fact_sales`` is partitioned by ``sale_year``, and sorted by ``date_key`` within files for the same reason.
* lookups and dimensions are small single files.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import normalize, star
from tallyhouse.operators.keys import row_key
from tallyhouse.operators.quality import REASON
from tallyhouse.schemas import SALE_YEAR, SALES_DETAILS, TABLES, conform
from tallyhouse.session import scratch_path
from tallyhouse.sources import tables as store

SALES_STAGED = "sales_staged"


def bucket_skew(df: DataFrame, col: str, buckets: int) -> float:
    """Largest bucket's row count over the mean, for ``bucketBy(buckets, col)``.

    Uses Spark's bucket id (Murmur3 hash of the column, modulo the bucket count); the result has
    one row per bucket.
    """
    sizes = df.groupBy(F.pmod(F.hash(F.col(col)), F.lit(buckets)).alias("b")).count()
    row = sizes.agg(F.max("count").alias("mx"), F.sum("count").alias("total")).first()
    if not row or not row["total"]:
        return 0.0
    return float(row["mx"]) / (float(row["total"]) / buckets)
REJECTED = "sales_rejected"


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    timings: dict[str, float] = field(default_factory=dict)
    built: set[str] = field(default_factory=set)
    _frames: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    @classmethod
    def create(cls, spark: SparkSession, root: str | None = None) -> "Warehouse":
        return cls(spark, root or scratch_path(spark, "warehouse"))

    def path(self, name: str) -> str:
        if name == "sales_details":
            return f"{self.root}/{SALES_STAGED}/load_status=accepted"
        if name == REJECTED:
            return f"{self.root}/{SALES_STAGED}/load_status=rejected"
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """A written table. Tables do not change once written, so one DataFrame (and one file
        listing) serves every query; rewriting a table drops it."""
        if name not in self._frames:
            schema = TABLES.get(name)
            self._frames[name] = store.read_table(self.spark, self.path(name), schema if name != REJECTED else None)
        return self._frames[name]

    def write(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        store.write_table(df, self.path(name), partition_by)
        self._frames.pop(name, None)
        if name == SALES_STAGED:
            self._frames.pop("sales_details", None)
            self._frames.pop(REJECTED, None)

    def _timed(self, stage: str, fn: Callable[[], None]) -> None:
        t0 = time.perf_counter()
        fn()
        self.timings[stage] = round(time.perf_counter() - t0, 3)
        self.built.add(stage)

    def _write_timed(self, name: str, make: Callable[[], DataFrame], partition_by: tuple[str, ...] = ()) -> None:
        t0 = time.perf_counter()
        self.write(name, make(), partition_by)
        self.timings[f"table_{name}"] = round(time.perf_counter() - t0, 3)

    def _write_together(self, jobs: Sequence[tuple[str, Callable[[], None]]]) -> None:
        """Run independent table writes as concurrent Spark jobs (the scheduler shares the
        executors between them); each is timed on its own."""

        def run(job):
            name, fn = job
            t0 = time.perf_counter()
            fn()
            self.timings[f"table_{name}"] = round(time.perf_counter() - t0, 3)

        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            for f in [pool.submit(run, j) for j in jobs]:
                f.result()

    # -- stages --------------------------------------------------------------------------------
    def load_staging(self, retail_sales: DataFrame) -> "Warehouse":
        """Land the staging table."""
        self._timed("staging", lambda: self.write("retail_sales", retail_sales))
        return self

    def build_oltp(self) -> "Warehouse":
        """N1-N3, N5, N6."""

        def run():
            rs = self.table("retail_sales")

            def lookups():
                keyed = normalize.load_lookups(rs)  # one scan, one keying (checkpointed) for all three
                self._write_together([(n, (lambda n=n, df=df: self.write(n, df))) for n, df in keyed.items()])

            self._write_together(
                [("lookups", lookups), ("customer", lambda: self.write("customer", normalize.load_customer(rs)))]
            )
            lookups = {n: self.table(n) for n in normalize.LOOKUPS}
            staged = normalize.stage_sales_details(rs, self.table("customer"), lookups)
            staged = row_key(staged, "sales_id").withColumn(
                "load_status", F.when(F.col(REASON).isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
            )
            cols = [f.name for f in SALES_DETAILS.fields] + [REASON, "load_status"]
            staged = staged.select(*cols).sortWithinPartitions("load_status", "invoice_date")
            self._write_timed(SALES_STAGED, lambda: staged, partition_by=("load_status",))

        self._timed("oltp", run)
        return self

    def build_addresses(self, fake_customer_address: DataFrame) -> "Warehouse":
        """The address table."""
        self._timed("address", lambda: self.write("address", normalize.load_address(fake_customer_address)))
        return self

    def build_star(self) -> "Warehouse":
        """W1-W6."""

        def run():
            sd = self.table("sales_details")
            self._write_timed("used_ids", lambda: star.used_ids(sd))  # one scan of the sales for all five

            def used(col):
                return star.used_column(self.table("used_ids"), col)

            dims = {
                "dim_date": lambda: star.build_dim_date(used("invoice_date")),
                "dim_customer": lambda: star.build_dim_customer(used("customer_id"), self.table("customer")),
                "dim_product_category": lambda: star.build_dim_product_category(used("category_id"), self.table("product_category")),
                "dim_region": lambda: star.build_dim_region(used("region_id"), self.table("region")),
                "dim_payment_method": lambda: star.build_dim_payment_method(used("payment_method_id"), self.table("payment_method")),
            }
            self._write_together([(n, (lambda n=n, make=make: self.write(n, make()))) for n, make in dims.items()])
            t0 = time.perf_counter()
            fact = star.build_fact_sales(
                sd,
                self.table("dim_date"),
                self.table("dim_customer"),
                self.table("dim_product_category"),
                self.table("dim_region"),
                self.table("dim_payment_method"),
                customer_dim_covers_sales=True,  # dim_customer was just built from this sales_details
                by_year=True,
            )
            self.write("fact_sales", fact.sortWithinPartitions(SALE_YEAR, "date_key"), partition_by=(SALE_YEAR,))
            self.timings["table_fact_sales"] = round(time.perf_counter() - t0, 3)

        self._timed("star", run)
        return self

    def build_cumulative(self, include_daily: bool = False) -> "Warehouse":
        """C1-C5 as stored tables: each filled by the one-job backfill (C9) and partitioned by its
        period, so later periods are appended by C0 steps (``cumulative.run_chain`` on
        ``path(name)``) or refreshed after late sales (``cumulative.refresh_from``).

        The daily product table has one partition per day; it is only written when asked for.
        """
        from tallyhouse.operators import cumulative as cum

        def run():
            sd = self.table("sales_details")
            names = cum.name_joiner(self.table("product_category"), self.table("region"))
            specs = [s for s in cum.SPECS.values() if include_daily or s.grain != "day"]
            jobs = [
                (s.name, (lambda s=s: self.write(s.name, cum.backfill(sd, s, names), partition_by=(s.period_col,))))
                for s in specs
            ]
            jobs.append((
                "cum_customer_sales",
                lambda: self.write(
                    "cum_customer_sales", cum.backfill_customer_sales(sd, self.table("customer")), partition_by=("current_year",)
                ),
            ))
            with store.few_partitions(self.spark):  # a folder a year
                self._write_together(jobs)

        self._timed("cumulative", run)
        return self

    def build_bucketed_sales(self, buckets: int, max_skew: float = 2.0) -> str:
        """``sales_details`` as a catalog table partitioned by year and bucketed by customer_id, for
        shuffle-free customer-keyed cumulative steps that read one year. Returns the qualified table name.

        A bucket is read by a single task, so a customer holding a large share of all sales would
        make one task read that share. The bucket sizes are measured first (one aggregate, one
        row per bucket); if the largest is over ``max_skew`` times the mean, the plain layout is
        registered instead and steps fall back to partial aggregation + shuffle, which spreads a
        hot customer over every scan task.
        """
        db = store.ensure_database(self.spark, self.database, f"{self.root}/catalog")
        name = f"{db}.sales_details_by_customer_{buckets}"
        if store.table_exists(self.spark, name):
            return name
        sd = self.table("sales_details")
        by_year = sd.withColumn(SALE_YEAR, F.year("invoice_date"))
        skew = bucket_skew(sd, "customer_id", buckets)
        self.timings["bucket_skew"] = round(skew, 3)
        path = f"{self.root}/catalog/sales_details_by_customer_{buckets}"
        if skew <= max_skew:
            self._timed("bucketed_sales", lambda: store.save_bucketed(by_year, name, path, ("customer_id",), buckets, (SALE_YEAR,)))
        else:
            self._timed("bucketed_sales", lambda: by_year.write.mode("overwrite").partitionBy(SALE_YEAR).option("path", path).saveAsTable(name))
        return name

    @property
    def database(self) -> str:
        return "th_" + self.root.rstrip("/").rsplit("-", 1)[-1]

    def sales_details(self) -> DataFrame:
        return conform(self.table("sales_details"), SALES_DETAILS)
