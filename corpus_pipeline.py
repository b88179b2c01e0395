"""The corpus pipeline: documents -> packed training sequences, five stages, each one Spark job graph.

Each stage reads the Parquet that the one before it wrote. All but the last keep the columns of
``documents``; what a stage rejects is gone for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import table
from tallyhouse.llm.decontaminate import decontaminate
from tallyhouse.llm.language_id import identify
from tallyhouse.llm.packing import pack
from tallyhouse.llm.quality_rules import quality_rules
from tallyhouse.llm.queries import word_tokenizer
from tallyhouse.llm.simhash import drop_near_duplicates
from tallyhouse.session import scratch_path

#: a document whose best cosine is lower is in no known language
MIN_LANGUAGE_SCORE = 0.2


def _where(marked: DataFrame, condition, docs: DataFrame) -> DataFrame:
    return marked.where(condition).select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the rules reject go."""
    return _where(quality_rules(docs), F.col("_quality.kept"), docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents without a letter or far from every learned language go."""
    found = F.col("_language")
    return _where(identify(docs), (found["lang_pred"] != "und") & (found["score"] >= MIN_LANGUAGE_SCORE), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of every component the document with the smallest id stays."""
    return drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: contaminated documents go."""
    return _where(decontaminate(docs, table(spark, sf_dir, "benchmark")), ~F.col("_contamination.contaminated"), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one row per piece of a packed sequence."""
    return pack(docs, word_tokenizer())


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: learned prototypes and tokenizer ids aren't expressible in SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the results between them are written under the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
