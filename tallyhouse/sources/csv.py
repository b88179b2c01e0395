"""The staging CSV loads (header row, comma separated, explicit schema).

Malformed records are not silently dropped: the reader runs PERMISSIVE with a corrupt-record
column, the parsed rows are landed once as Parquet, and :func:`split_corrupt` separates the
malformed ones into a quarantine DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyhouse.operators.quality import REASON
from tallyhouse.schemas import FAKE_CUSTOMER_ADDRESS, FAKE_CUSTOMER_NAMES, RETAIL_SALES
from tallyhouse.session import scratch_path
from tallyhouse.sources.tables import few_partitions

CORRUPT = "_corrupt_record"


def with_options(reader, schema: StructType):
    """A batch or stream reader with the options of the loads and a corrupt-record column."""
    with_corrupt = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    return (
        reader.schema(with_corrupt)
        .option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", False)
        .option("encoding", "UTF-8")
        # the reference keeps values as written: no trimming of outer blanks
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("enforceSchema", True)
    )


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Columns are bound by position, as a COPY column list does; the header names are ignored."""
    return with_options(spark.read, schema).csv(path)


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows without the corrupt column, quarantined rows with their raw line).

    ``parsed`` must be a *saved* copy of the parsed file: Spark rejects queries on a raw CSV that
    read only the corrupt-record column (as a ``count`` does after column pruning).
    """
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = parsed.where(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "raw_line")
    return good, bad


def land_csv(spark: SparkSession, path: str, schema: StructType, staging_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse a CSV once, write the parsed rows (corrupt column included) and split them."""
    target = staging_path or scratch_path(spark, "landed_csv")
    read_csv(spark, path, schema).write.mode("overwrite").parquet(target)
    return split_corrupt(spark.read.parquet(target))


# -- loads with the reason of every rejected line --------------------------------------------------
SOURCE_FILE, RAW_LINE = "source_file", "raw_line"
_NO_CHARACTER = "\x01"  # a separator that no feed uses: a line stays one column


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(raw_line, source_file): every line behind each file's header, as it stands."""
    reader = spark.read.schema(f"{RAW_LINE} string").option("header", True).option("sep", _NO_CHARACTER).option("quote", "")
    reader = reader.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("encoding", "UTF-8")
    return reader.csv(path).select(RAW_LINE, F.col("_metadata.file_path").alias(SOURCE_FILE))


def _parsed(line: Column, schema: StructType) -> Column:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, StructField(CORRUPT, StringType())])
    options = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_csv(line, ddl, options)


def line_reason(schema: StructType) -> Column:
    """Why a line can't be loaded, or NULL, from ``raw_line``, its typed parse ``_row`` and its parse as text ``_text``.

    ``open_quote``: a quote isn't closed on its line, as on both halves of a value with a line break;
    ``columns:<n>``: as many columns as the line has, quoted separators aside; ``bad_value:<column>``: the first value
    that isn't of its column's type; ``malformed``: anything else that the parser refuses.
    """
    line = F.col(RAW_LINE)
    count = lambda text, c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    columns = count(F.regexp_replace(line, '"([^"]|"")*"', ""), ",") + 1
    reason = F.when(count(line, '"') % 2 == 1, F.lit("open_quote"))
    reason = reason.when(columns != len(schema.fields), F.concat(F.lit("columns:"), columns.cast("string")))
    for f in schema.fields:
        reason = reason.when(F.col("_text")[f.name].isNotNull() & F.col("_row")[f.name].isNull(), F.lit(f"bad_value:{f.name}"))
    return reason.when(F.col("_row")[CORRUPT].isNotNull(), F.lit("malformed"))


def load_checked(spark: SparkSession, path: str, schema: StructType, staging_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine), the quarantine with the file, the raw line and the reason.

    Each line is parsed by Spark's CSV parser on its own; files stay splittable. Lines are landed once, by the two halves.
    """
    target = staging_path or scratch_path(spark, "checked_csv")
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    lines = read_lines(spark, path).where(F.col(RAW_LINE).isNotNull())
    parsed = lines.withColumns({"_row": _parsed(F.col(RAW_LINE), schema), "_text": _parsed(F.col(RAW_LINE), text)})
    judged = parsed.withColumn(REASON, line_reason(schema)).withColumn("is_bad", F.col(REASON).isNotNull().cast("int"))
    kept = F.when(F.col("is_bad") == 0, F.struct(*[F.col(f"_row.{f.name}").alias(f.name) for f in schema.fields])).alias("row")
    rejected = [F.when(F.col("is_bad") == 1, F.col(c)).alias(c) for c in (SOURCE_FILE, RAW_LINE, REASON)]
    with few_partitions(spark):  # two halves
        judged.select(kept, *rejected, "is_bad").write.mode("overwrite").partitionBy("is_bad").parquet(target)
    landed = spark.read.parquet(target)
    good = landed.where("is_bad = 0").select("row.*")
    return good, landed.where("is_bad = 1").select(SOURCE_FILE, RAW_LINE, REASON)


def write_lines(lines: DataFrame, path: str, header: str, by: str) -> None:
    """Write the column ``line`` as it stands, one file set per value of ``by`` (a few), each file with a header line."""
    writer = lines.select(F.col("line").alias(header), by).write.mode("overwrite").option("header", True).option("sep", _NO_CHARACTER)
    writer = writer.option("quote", "").option("escapeQuotes", False).option("ignoreLeadingWhiteSpace", False)
    with few_partitions(lines.sparkSession):
        writer.option("ignoreTrailingWhiteSpace", False).partitionBy(by).csv(path)


def load_retail_sales(spark: SparkSession, path: str, staging_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Sales CSV -> (retail_sales, quarantined lines)."""
    return land_csv(spark, path, RETAIL_SALES, staging_path)


def load_customer_names(spark: SparkSession, path: str, staging_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Names CSV (header ``name``) -> ``fake_customer_names(customer_name)``."""
    return land_csv(spark, path, FAKE_CUSTOMER_NAMES, staging_path)


def load_customer_addresses(spark: SparkSession, path: str, staging_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S3: address CSV -> ``fake_customer_address(customer_address)``."""
    return land_csv(spark, path, FAKE_CUSTOMER_ADDRESS, staging_path)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a table as header CSV (the export side, used to produce feeds)."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
