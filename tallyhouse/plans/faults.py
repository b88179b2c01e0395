"""Faulty inputs derived from the given tables, one fault a row, so that every rule of the loads has rows to reject.

The fault of a row follows from its own values, so a rerun gives the same rows; most rows have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAULT_CYCLE = 97  # rows are dealt over this many cases; those without a rule below stay as they are

#: case -> (column of the staged sales, value put there)
SALES_FAULTS = {
    0: ("customer_id", None),
    1: ("product_category", "no such category"),
    2: ("quantity", None),
    3: ("total_amount", None),
    4: ("payment_method", "no such method"),
    5: ("timestamp", "no date"),
    6: ("customer_location", None),
    7: ("quantity", 0),
}
#: case -> (column of the submissions, value put there; "orphan" negates the key)
SUBMISSION_FAULTS = {
    0: ("customer_id", None),
    1: ("category_id", None),
    2: ("quantity", None),
    3: ("amount", None),
    4: ("payment_method_id", None),
    5: ("region_id", None),
    6: ("quantity", 0),
    7: ("customer_id", "orphan"),
    8: ("category_id", "orphan"),
    9: ("payment_method_id", "orphan"),
    10: ("region_id", "orphan"),
}


def _with_faults(df: DataFrame, case: Column, faults: dict) -> DataFrame:
    changed: dict[str, Column] = {}
    marked = df.withColumn("_case", case)
    for number, (col, value) in faults.items():
        bad = -F.col(col) if value == "orphan" else F.lit(value)
        bad = bad.cast(df.schema[col].dataType)
        changed[col] = F.when(F.col("_case") == number, bad).otherwise(changed.get(col, F.col(col)))
    return marked.withColumns(changed).drop("_case")


def faulty_sales(retail_sales: DataFrame) -> DataFrame:
    """Staged sales with missing, unknown and malformed values, by transaction id."""
    return _with_faults(retail_sales, F.pmod(F.col("transaction_id"), F.lit(FAULT_CYCLE)), SALES_FAULTS)


def faulty_submissions(submissions: DataFrame) -> DataFrame:
    """Submitted sales with missing values, quantity 0 and keys that no table has."""
    mixed = F.col("customer_id").cast("long") * 31 + F.col("category_id") * 7 + F.col("quantity")
    return _with_faults(submissions, F.pmod(mixed, F.lit(FAULT_CYCLE)), SUBMISSION_FAULTS)


# -- faulty feed files ------------------------------------------------------------------------------
FEEDS = 3  # file sets that a feed is dealt over


def _feed(lines: DataFrame, case: Column, faults: dict[int, Column], plain: Column) -> DataFrame:
    """(line, feed): a text with a line break becomes two lines, as a file has it."""
    text = plain
    for number, changed in faults.items():
        text = F.when(case % FAULT_CYCLE == number, changed).otherwise(text)
    return lines.select(F.explode(F.split(text, "\n")).alias("line"), (case % FEEDS).alias("feed"))


def _csv(cols: list[Column]) -> Column:
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def faulty_sales_feed(retail_sales: DataFrame) -> DataFrame:
    """Lines with a column missing or too many, values of the wrong type or size, and a quoted line break."""
    names = retail_sales.columns

    def line(**changed) -> Column:
        return _csv([changed.get(c, F.col(c)) for c in names])

    faults = {
        0: _csv([F.col(c) for c in names[:-1]]),
        1: F.concat(line(), F.lit(",one more")),
        2: line(quantity=F.lit("many")),
        3: line(price=F.lit("n/a")),
        4: line(product_category=F.concat(F.lit('"'), F.col("product_category"), F.lit('\nbroken"'))),
        5: line(total_amount=F.lit("99999999999.99")),
        6: line(product_category=F.concat(F.lit('"'), F.col("product_category"), F.lit(', quoted"'))),  # no fault
    }
    return _feed(retail_sales, F.col("transaction_id"), faults, line())


def faulty_names_feed(names: DataFrame) -> DataFrame:
    """Names with an unquoted comma, and with a quoted line break."""
    n = F.col("customer_name")
    case = F.regexp_extract(n, "([0-9]+)$", 1).cast("long")
    return _feed(names, case, {0: F.concat(n, F.lit(", Jr")), 1: F.concat(F.lit('"'), n, F.lit('\nJr"')), 2: F.concat(F.lit('"'), n, F.lit(', Jr"'))}, n)


def faulty_addresses_feed(addresses: DataFrame) -> DataFrame:
    """S3: addresses that aren't quoted although they hold a comma, and with a line break in place of backslash-n."""
    a = F.col("customer_address")
    case = F.regexp_extract(a, "([0-9]+)", 1).cast("long")
    quoted = F.concat(F.lit('"'), a, F.lit('"'))
    return _feed(addresses, case, {0: a, 1: F.replace(quoted, F.lit("\\n"), F.lit("\n"))}, quoted)
