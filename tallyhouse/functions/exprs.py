"""Column expressions shared by the operators. All built-in Spark functions: no Python UDFs.

Each helper returns a ``Column`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, StringType, StructType

from tallyhouse.schemas import MONEY

# Fixed values that must equal the reference's output -------------------------------------
# quarter names by quarter number 1..4
QUARTER_NAMES = ("First", "Second", "Third", "Fourth")
# staging gender text -> customer gender code ('Other' is coded 'F'; anything else NULL)
GENDER_CODES = {"Male": "M", "Female": "F", "Other": "F"}
# prefix that turns a staging customer id into a customer number
CUSTOMER_NO_PREFIX = "C-"
# month and day names are blank-padded to this width (the longest names, September / Wednesday)
NAME_WIDTH = 9
# ------------------------------------------------------------------------------------------

__all__ = [
    "QUARTER_NAMES",
    "GENDER_CODES",
    "discount_price",
    "register_sql_functions",
    "quarter_name",
    "month_name",
    "day_name",
    "iso_day_of_week",
    "year_range",
    "is_christmas",
    "customer_no",
    "customer_no_for_join",
    "gender_code",
    "parse_address",
    "exact_ratio",
    "exact_avg",
    "as_date",
    "canonical_text",
    "with_canonical_text",
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def discount_price(unit_price, discount) -> Column:
    """Price after a discount *rate*, rounded half away from zero to cents.

    Quantity is deliberately not involved: the validated insert compares the amount of the whole
    row with this one-unit price.
    """
    p = _col(unit_price)
    return F.round(p - p * _col(discount), 2).cast(MONEY)


def register_sql_functions(spark: SparkSession) -> None:
    """Expose I1 to SQL as a temporary SQL function (a native expression, not a Python UDF)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION fn_calc_discount_price("
        "unit_price DECIMAL(10,2), discount DECIMAL(4,2)) RETURNS DECIMAL(10,2) "
        "RETURN CAST(round(unit_price - unit_price * discount, 2) AS DECIMAL(10,2))"
    )


def quarter_name(d) -> Column:
    q = F.quarter(_col(d))
    return (
        F.when(q == 1, F.lit(QUARTER_NAMES[0]))
        .when(q == 2, F.lit(QUARTER_NAMES[1]))
        .when(q == 3, F.lit(QUARTER_NAMES[2]))
        .otherwise(F.lit(QUARTER_NAMES[3]))
    )


def month_name(d) -> Column:
    """Full English month name blank-padded to 9 characters."""
    return F.rpad(F.date_format(_col(d), "MMMM"), NAME_WIDTH, " ")


def day_name(d) -> Column:
    """Full English day name blank-padded to 9 characters."""
    return F.rpad(F.date_format(_col(d), "EEEE"), NAME_WIDTH, " ")


def iso_day_of_week(d) -> Column:
    """Monday 1 .. Sunday 7."""
    return (F.weekday(_col(d)) + 1).cast("int")


def year_range(d, year: int) -> Column:
    """``year(d) = year`` written as a date range, which Parquet can push down."""
    lo = _dt.date(year, 1, 1)
    hi = _dt.date(year + 1, 1, 1)
    c = _col(d)
    return (c >= F.lit(lo)) & (c < F.lit(hi))


def is_christmas(d) -> Column:
    c = _col(d)
    return (F.month(c) == 12) & (F.dayofmonth(c) == 25)


def customer_no(customer_id) -> Column:
    """'C-' || id, NULL when the id is NULL."""
    return F.concat(F.lit(CUSTOMER_NO_PREFIX), _col(customer_id).cast("string"))


def customer_no_for_join(customer_id) -> Column:
    """CONCAT('C-', id): a NULL id becomes 'C-', which never equals a stored customer number."""
    return F.concat(F.lit(CUSTOMER_NO_PREFIX), F.coalesce(_col(customer_id).cast("string"), F.lit("")))


def gender_code(g) -> Column:
    c = _col(g)
    out = None
    for text, code in GENDER_CODES.items():
        out = F.when(c == text, F.lit(code)) if out is None else out.when(c == text, F.lit(code))
    return out.otherwise(F.lit(None).cast("string"))


def parse_address(raw) -> tuple[Column, Column, Column]:
    """Split ``['<street>\\n<city>,<zip>']`` into (street_number, city, zip_code).

    Brackets and single quotes are dropped; the line mark is a literal backslash followed by
    ``n``. Empty pieces give NULL (an empty string has no elements), out-of-range parts give NULL,
    and the blank after the comma stays in the zip code.
    """
    cleaned = F.translate(_col(raw), "[]'", "")
    lines = F.split(F.nullif(cleaned, F.lit("")), r"\\n")
    street = F.get(lines, 0)
    city_zip = F.split(F.nullif(F.get(lines, 1), F.lit("")), ",")
    return street, F.get(city_zip, 0), F.get(city_zip, 1)


def _integer_units(c: Column, scale: int) -> Column:
    return (c * F.lit(10**scale)).cast("decimal(38,0)") if scale else c.cast("decimal(38,0)")


def exact_ratio(num, den, scale: int, num_scale: int = 2, den_scale: int = 0, precision: int = 18) -> Column:
    """``round(num / den, scale)`` computed exactly, rounding half away from zero.

    ``num`` and ``den`` are exact columns with ``num_scale`` / ``den_scale`` decimals and
    ``den > 0``. The quotient is formed in integers, so it never rounds twice (Spark's decimal
    division keeps only a limited number of places before ``round`` is applied).
    """
    a = _integer_units(_col(num), num_scale) * F.lit(10 ** (den_scale + scale)).cast("decimal(38,0)")
    b = _integer_units(_col(den), den_scale) * F.lit(10**num_scale).cast("decimal(38,0)")
    x = F.abs(a) * 2 + b
    y = b * 2
    q = ((x - x % y) / y).cast("decimal(38,0)")
    signed = F.when(a < 0, -q).otherwise(q)
    return (signed / F.lit(10**scale)).cast(f"decimal({precision},{scale})")


def exact_avg(c, scale: int, value_scale: int = 2, precision: int = 18) -> Column:
    """``ROUND(AVG(c), scale)`` with exact arithmetic, as an aggregate expression."""
    col = _col(c)
    return exact_ratio(F.sum(col), F.count(col), scale, num_scale=value_scale, den_scale=0, precision=precision)


def as_date(text) -> Column:
    """``text::DATE`` for feed data: a malformed value gives NULL (then quarantined) instead of failing."""
    return _col(text).try_cast("date")


# -- nested values as text --------------------------------------------------------------------------
MICRO = 1_000_000


def canonical_text(value: Column, dtype: DataType) -> Column:
    """A value of any type as text that two engines write alike, for comparing arrays and structs in full.

    ``[0:a,1:b]`` for arrays (position and element), ``{x=1,y=2}`` for structs, ``null``; strings are quoted, with
    quotes and backslashes escaped; REAL and DOUBLE are whole millionths (``120000u``), rounded half up, as engines
    print floating point numbers differently.
    """
    if isinstance(dtype, ArrayType):
        items = F.transform(value, lambda x, i: F.concat(i.cast("string"), F.lit(":"), canonical_text(x, dtype.elementType)))
        text = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    elif isinstance(dtype, StructType):
        fields = [F.concat(F.lit(f"{f.name}="), canonical_text(value[f.name], f.dataType)) for f in dtype.fields]
        text = F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")))
    elif isinstance(dtype, (FloatType, DoubleType)):
        text = F.concat(F.floor(value.cast("double") * MICRO + F.lit(0.5)).cast("string"), F.lit("u"))
    elif isinstance(dtype, StringType):
        text = F.concat(F.lit('"'), F.regexp_replace(value, r'(["\\])', r"\\$1"), F.lit('"'))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("null"))


def with_canonical_text(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` with the given columns as :func:`canonical_text`."""
    return df.withColumns({c: canonical_text(F.col(c), df.schema[c].dataType) for c in cols})
