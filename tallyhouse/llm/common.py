"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import ensure_checkpoint_dir

# two 64-bit hashes together name a row by its content; equal rows share them
KEY = ["_th_k1", "_th_k2"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: rows that may be broadcast; above this the planner joins by shuffle
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def add_key(df: DataFrame, *cols: str) -> DataFrame:
    """Add the two key columns computed from ``cols`` (nulls allowed)."""
    nulls = [F.col(f"`{c}`").isNull().cast("int") for c in cols]
    refs = [F.col(f"`{c}`") for c in cols]
    return df.withColumns({KEY[0]: F.xxhash64(*refs, *nulls), KEY[1]: F.xxhash64(F.lit(7919), *reversed(refs), *nulls)})


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that to pure ASCII, and much faster than ``translate``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def shield(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with neutral column names, and {own name: neutral name}: no column can clash with a working one."""
    names = {c: f"_th_in{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(v) for c, v in names.items()]), names


def own_columns(names: dict[str, str], out: str | None = None) -> list[Column]:
    """The shielded columns under their own names, without ``out``."""
    return [F.col(v).alias(c) for c, v in names.items() if c != out]


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: later reads survive lost executors and agree."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A settled table, marked for broadcast only when it is counted to have at most ``max_rows`` rows."""
    return F.broadcast(df) if df.count() <= max_rows else df


def with_result(df: DataFrame, columns: list, result: Column, out: str) -> DataFrame:
    """``columns`` and the struct ``result`` as ``out``, behind a one-element generator.

    The optimizer moves a filter on a projected column below the projection by repeating its
    expression there, into the lambdas as well, where it would run once per word. It doesn't move
    a filter past a generator.
    """
    return df.select(*columns, F.explode(F.array(result)).alias(out))
