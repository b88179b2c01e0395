"""Runs over the driver's tables: the warehouse built once per session and data set, plus the
derived inputs some operators need (addresses, address changes, sales submissions).

Every input here is derived by Spark from the given tables, so its size grows with them.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.exprs import discount_price
from tallyhouse.operators import normalize, scd2
from tallyhouse.operators.quality import REASON
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.schemas import SALE_SUBMISSION, conform
from tallyhouse.session import bounded_tasks, shared_dir
from tallyhouse.sources import tpch

_WAREHOUSES: dict[tuple[str, str, str], Warehouse] = {}
_INPUTS = ("region", "nation", "customer", "part", "orders", "lineitem")
_LISTED_FILES = 1000  # above, a table is known by its file count, size and folder time
_MANIFEST = "_manifest"


def _code_version() -> str:
    """Hash of the package source: a changed build gets a new warehouse folder."""
    h = hashlib.sha1()
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for base, _dirs, files in sorted(os.walk(pkg)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(base, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()[:12]


def _input_version(spark: SparkSession, sf_dir: str) -> str:
    """Hash of the input files' names, sizes and modification times: replaced data is new data."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    h = hashlib.sha1()
    for table in _INPUTS:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
        fs = path.getFileSystem(conf)
        total = fs.getContentSummary(path)
        h.update(f"{table}|{total.getFileCount()}|{total.getLength()}|{fs.getFileStatus(path).getModificationTime()}".encode())
        if total.getFileCount() <= _LISTED_FILES:
            for f in fs.listStatus(path):
                h.update(f"|{f.getPath().getName()}|{f.getLen()}|{f.getModificationTime()}".encode())
    return h.hexdigest()[:16]


def _is_complete(spark: SparkSession, root: str) -> bool:
    try:
        return spark.read.parquet(f"{root}/{_MANIFEST}").count() == 1
    except Exception:  # noqa: BLE001 - a missing or partial manifest means: build again
        return False


def warehouse(spark: SparkSession, sf_dir: str, reuse: bool = True) -> Warehouse:
    """Staging, 3NF and star tables for ``sf_dir``.

    Built once per Spark application and version of the input files. With ``reuse``, a complete
    build of the same files by the same code (found through its manifest in the shared checkpoint folder) is reused by later
    applications too; the manifest is written last, so a half-written build is never reused.
    """
    version = _input_version(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, version)
    wh = _WAREHOUSES.get(key)
    if wh is not None:
        return wh
    root = None
    if reuse:
        tag = hashlib.sha1(f"{sf_dir}|{version}|{_code_version()}".encode()).hexdigest()[:16]
        root = f"{shared_dir(spark)}/tallyhouse/warehouse-{tag}"
    wh = Warehouse.create(spark, root)
    if root is not None and _is_complete(spark, root):
        wh.built.update({"staging", "oltp", "star", "address"})
    else:
        # the address table needs only customer and nation: built alongside the sales layers
        with bounded_tasks(spark, tpch.sales_rows(spark, sf_dir)), ThreadPoolExecutor(max_workers=1) as pool:
            addresses = pool.submit(lambda: wh.build_addresses(tpch.customer_addresses(spark, sf_dir)))
            wh.load_staging(tpch.retail_sales(spark, sf_dir)).build_oltp().build_star()
            addresses.result()
        if root is not None:
            spark.createDataFrame([(sf_dir, version)], "sf_dir string, version string").write.mode("overwrite").parquet(
                f"{root}/{_MANIFEST}"
            )
    _WAREHOUSES[key] = wh
    return wh


def with_addresses(spark: SparkSession, sf_dir: str, reuse: bool = True) -> Warehouse:
    wh = warehouse(spark, sf_dir, reuse)
    if "address" not in wh.built:
        wh.build_addresses(tpch.customer_addresses(spark, sf_dir))
    return wh


def address_count(wh: Warehouse) -> int:
    return wh.table("address").count()


def address_changes(customer: DataFrame, address_count: int, multiplier: int, day: _dt.date) -> DataFrame:
    """A batch of address changes for every customer, dated ``day``."""
    return customer.select(
        "customer_id",
        scd2.assign_address("customer_id", address_count, multiplier).alias("address_id"),
        F.lit(day).cast("date").alias("change_date"),
    )


def sales_submissions(spark: SparkSession, sf_dir: str, wh: Warehouse) -> DataFrame:
    """Submissions for the validated insert, one per accepted sale: the amount is the discounted
    one-unit price, except for returned lines (flag ``R``), which submit the undiscounted price and
    are therefore rejected whenever their discount is above zero. Landed once per warehouse."""
    if "submissions" not in wh.built:
        with bounded_tasks(spark, tpch.sales_rows(spark, sf_dir)):
            wh._timed("submissions", lambda: wh.write("sales_submissions", _derive_submissions(spark, sf_dir, wh)))
    return wh.table("sales_submissions")


def _derive_submissions(spark: SparkSession, sf_dir: str, wh: Warehouse) -> DataFrame:
    rs = tpch.retail_sales(spark, sf_dir, extra=("l_returnflag",))
    lookups = {n: wh.table(n) for n in normalize.LOOKUPS}
    staged = normalize.stage_sales_details(rs, wh.table("customer"), lookups, extra=("l_returnflag",))
    ok = staged.where(F.col(REASON).isNull())
    amount = F.when(F.col("l_returnflag") == "R", F.col("unit_price")).otherwise(discount_price("unit_price", "discount"))
    return conform(ok.withColumn("amount", amount), SALE_SUBMISSION)


def reference_tables(wh: Warehouse) -> dict[str, DataFrame]:
    return {n: wh.table(n) for n in ("customer", "product_category", "payment_method", "region")}


def is_late(first_year: int):
    """Sales that a late feed brings: some of every year from ``first_year`` on, picked by the row's own values."""
    picked = F.pmod(F.col("customer_id").cast("long") * 7 + F.col("quantity"), F.lit(13)) == 0
    return picked & (F.year("invoice_date") >= first_year)
