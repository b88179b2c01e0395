"""Decontamination of periodic texts, and of tables with clashing column names, against brute force."""

from __future__ import annotations

import random
import time

import brute

from tallyhouse.llm.decontaminate import decontaminate


def result(spark, docs, items, schema="doc_id long, text string, _th_k1 long, _th_w string, n_hit int, _th_in0 string"):
    df = spark.createDataFrame([(i, t, 7, "own", 3, "x") for i, t in docs], schema)
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate(df, bench)
    assert got.columns == [*df.columns, "_contamination"]
    rows = got.collect()
    assert all((r["_th_k1"], r["_th_w"], r["n_hit"], r["_th_in0"]) == (7, "own", 3, "x") for r in rows)
    return {r["doc_id"]: tuple(r["_contamination"]) for r in rows}


def test_periodic_documents_and_items(spark):
    rng = random.Random(4)
    docs = [(1, "a " * 400), (2, "a b " * 300), (3, "a " * 12 + "b"), (4, "a b c " * 9), (5, "x " * 50 + "a " * 13 + "y " * 50), (6, "b a " * 6 + "b")]
    docs += [(10 + k, " ".join(rng.choice("ab") for _ in range(60))) for k in range(20)]
    items = [("p", "a " * 300), ("q", "a b " * 40), ("q", "b a " * 40), ("short", "a b"), ("one", "c"), ("r", "a b c a b c a b c a b c a x"), ("empty", "")]
    items += [(f"i{k}", " ".join(rng.choice("ab") for _ in range(14))) for k in range(10)]
    got = result(spark, docs, items)
    for i, t in docs:
        assert got[i] == brute.contamination(t, items), i


def test_a_hundred_thousand_equal_words(spark):
    docs = [(1, "same " * 100_000), (2, "other words")]
    start = time.perf_counter()
    got = result(spark, docs, [("p", "same " * 300), ("q", "same " * 5)])
    assert time.perf_counter() - start < 60
    assert got[1][:3] == (100_000, 100_000, 2) and got[1][4] and got[2][:3] == (2, 0, 0)


def test_null_item_ids_are_hit_but_not_counted(spark):
    got = result(spark, [(1, "x " * 10 + "y " * 20)], [(None, "y " * 20), ("i", "x x")])
    assert got[1][:3] == (30, 30, 1)


def test_no_items_and_no_documents(spark):
    assert result(spark, [(1, "some words"), (2, None)], [("e", ""), ("n", None)])[1][:3] == (2, 0, 0)
    empty = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([("i", "a b c")], "item_id string, text string")
    assert decontaminate(empty, bench).collect() == []
