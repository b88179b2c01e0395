"""The registered text queries: SQL oracles where there are any, and the whole pipeline step by step."""

from __future__ import annotations

import brute
import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from tallyhouse.llm import language_id, queries
from tallyhouse.llm.oracles import ORACLE_SQL
from test_operators import brute_components, brute_fingerprint
from tools.oracle_check import TABLES, digest, type_diff


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    want = [d[0] for d in cur.description], cur.fetchall()
    types = con.execute(f"DESCRIBE {ORACLE_SQL[name]}").fetchall()
    assert type_diff(df.dtypes, [(r[0], r[1]) for r in types]) == {}
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(*want)[0]


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] and "pipeline" in entry.queries()


def test_pipeline_stages_do_what_their_operators_say(spark):
    """Each stage against the brute-force version of its operator, on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)

    def step(name):
        nonlocal docs
        before = docs.collect()
        path = corpus_pipeline.scratch_path(spark, f"test-{name}")
        stages[name](spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        return before, docs.collect()

    before, after = step("quality_rules")
    kept = brute.quality_kept([(r["doc_id"], r["source"], r["text"]) for r in before], 50, 0.01, 0.4)
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r, k in zip(before, kept, strict=True) if k[1])
    before, after = step("language_id")
    assert docs.columns == columns and len(after) >= 0.99 * len(before)
    before, after = step("simhash_near_dedup")
    roots = brute_components([brute_fingerprint(r["text"]) for r in before], 2)
    least = {}
    for r, c in zip(before, roots, strict=True):
        least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(least.values())
    before, after = step("decontamination")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if not brute.contamination(r["text"], items)[4])
    before, after = step("packing")
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    assert sum(r["length"] for r in after if r["start"] == 0) <= sum(r["doc_tokens"] for r in after if r["start"] == 0)
    whole = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in whole) == sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in after)


def test_prototypes_ignore_the_held_out_fold(spark):
    from pyspark.sql import functions as F

    docs = queries.table(spark, SF_SMALL, "documents")
    held = language_id.fold("doc_id", 4) == 2
    spoiled = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in {r["p"] for r in language_id.identify(spoiled).select(F.col("_language.lang_pred").alias("p")).distinct().collect()}
