"""Connected components by alternating large-star and small-star steps, as Spark jobs.

Every round is two grouped minima joined back to the edges. Groups are never collected: a hub is a
partial minimum before the shuffle and a skew-splittable join after it. Each round is written to
the shared checkpoint folder, so a lost executor only repeats its own part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import settled


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, component): every linked node with the smallest node of its component."""
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = settled(e.distinct())
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u != v")
            .distinct()
        )
        e = settled(small)
        now = _state(e)
        if now == before:
            break
        before = now
    centres = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
