"""Spelling variants, exact top-k search and periodic runs against brute force, with their defined cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tallyhouse.llm import knn, periodicity, queries, spelling
from tallyhouse.llm.common import table


# -- spelling variants ------------------------------------------------------------------------------
def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        near = sorted((-m, v) for v, m in counts.items() if one_edit(w, v))
        form = near[0] if near and -near[0][0] >= ratio * n else None
        out[w] = (form and form[1], n, len(near), form and -form[0])
    got = []
    for w, (form, n, k, fn) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        got.append((w, form, root, n, k, fn))
    return sorted(got)


def vocabulary(seed, letters, n, lengths):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.choice(lengths))): 10 ** rng.randrange(6) for _ in range(n)}


@pytest.mark.parametrize(
    ("seed", "letters", "n", "lengths", "options"),
    [
        (1, "abé", 150, (0, 1, 2, 3, 7, 8, 9), {}),
        (2, "ab", 200, (1, 2, 5, 6, 7, 8), {"hot": 4, "shard_rows": 50}),  # keys refined several times, many shards
        (3, "a", 40, range(30), {"hot": 3}),  # periodic words
        (4, "ab\x00\U0001f600$", 120, (3, 4, 5), {"hot": 10, "shard_rows": 40}),
    ],
)
def test_spelling_equals_brute_force(spark, seed, letters, n, lengths, options):
    counts = vocabulary(seed, letters, n, lengths)
    if seed == 3:
        counts = {"a" * i: 3 ** (i % 9) for i in lengths}
    rows = spark.createDataFrame([(k, v, "x") for k, v in counts.items()], "word string, n long, form string")
    got = spelling.spelling_variants(rows, **options).collect()
    assert sorted(tuple(r) for r in got) == brute_variants(counts)


def test_spelling_nulls_repeats_ties_and_chains(spark):
    counts = {"abcdefg": 1, "abcdefgh": 10, "abcdefghi": 100, "xbcdefg": 10, "zzzzzzz": 5, "é" * 3000: 7, "é" * 3001: 70}
    rows = [(w, n // 2) for w, n in counts.items()] + [(w, n - n // 2) for w, n in counts.items()] + [(None, 3), ("gone", None)]
    got = spelling.spelling_variants(spark.createDataFrame(rows, "word string, n long"))
    assert sorted(tuple(r) for r in got.collect()) == brute_variants(counts)
    by = {r["word"]: r for r in got.collect()}
    assert (by["abcdefg"]["form"], by["abcdefg"]["root"]) == ("abcdefgh", "abcdefghi")  # tie with xbcdefg; chain of two
    empty = spelling.spelling_variants(spark.createDataFrame([], "word string, n long"))
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0


def test_bidirectional_interval_stays_in_step():
    v = spelling.Vocabulary(["banana", "bandana", "cabana", "ana"])
    codes = lambda s: np.searchsorted(v.alphabet, np.frombuffer(s.encode("utf-32-le"), dtype="<u4")) + 1
    for left in (True, False):
        for half in ("an", "ana", "b", "ban", "nd"):
            inner = codes(half)
            c = inner[::-1] if left else inner
            lo = v.starts[c[:1]]
            state = (lo, lo, v.starts[c[:1] + 1] - lo)
            for x in c[1:]:
                state = v.grow(*state, np.array([x]), left)
            text = "".join(chr(65 + t) for t in v.text)
            word = "".join(chr(65 + t) for t in inner)
            assert state[2][0] == len([1 for i in range(len(text)) if text.startswith(word, i)])
            other = (v.back if left else v.ahead).sa[state[1][0] : state[1][0] + state[2][0]]
            for at in other:
                at = len(text) - at - len(word) if left else at
                assert text.startswith(word, at)


def test_spelling_words_follow_the_contract(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    extra = spark.createDataFrame([(7, "ÀÉÎÕÜàé Straßenbahn×÷ ABCDEFG_hijklmn"), (None, "standing outstanding"), (8, None), (9, "")], "doc_id long, text string")
    docs = docs.unionByName(extra)
    want = {}
    for d, t in docs.collect():
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{d}:{w}".encode()) if d is not None else 1
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                want[w] = want.get(w, 0) + 1
    assert {r["word"]: r["n"] for r in queries.misspelled(docs).collect()} == want


# -- exact top-k -----------------------------------------------------------------------------------
VECTORS = "vec_id long, embedding array<float>, score string, _th_k1 int"


def brute_top_k(rows, asked, k, scale=64):
    fine = {(i, tuple(math.floor(scale * float(x)) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, qv in fine:
        if (q, qv) in asked(fine):
            best = sorted((-sum(a * b for a, b in zip(qv, v, strict=False)), i) for i, v in fine if (i, v) != (q, qv))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def clustered(n, width, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    return [(i, [float(np.float32(x)) for x in centres[i % 6] * (1 + 0.1 * (i % 3)) + spread * rng.normal(size=width)]) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"pivots": 12, "group_queries": 4, "block_values": 60}, {"pivots": 1}])
def test_top_k_equals_brute_force(spark, monkeypatch, options):
    monkeypatch.setattr(knn, "LEAST_BLOCK", 10)
    rows = clustered(180, 6, 1) + [(200 + i, [0.5, -0.5, 0.25, 0.0, 0.0, 1.0]) for i in range(70)]  # a hot vector, ties
    rows += [(300, None), (301, [None] * 6), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (305, [0.125]), (None, [1.0] * 6)]
    rows += rows[:3] + [(0, [9.0] * 6)]  # rows repeated in full, and an id with two vectors
    df = spark.createDataFrame([(i, v, "own", 7) for i, v in rows], VECTORS).repartition(3)
    asked = df.where("vec_id % 5 = 0")
    got = knn.top_k(df, asked, 7, **options).collect()
    assert sorted(tuple(r) for r in got) == brute_top_k(rows, lambda fine: {x for x in fine if x[0] % 5 == 0}, 7)


def test_top_k_sends_only_what_bounds_allow(spark):
    rows = clustered(600, 8, 3, spread=0.01)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    sent = []
    make = knn.make_plan

    def spy(between, margin, q, data, k, *rest):
        plan = make(between, margin, q, data, k, *rest)
        sent.append((len(plan.rings), len(data) * len(plan.query_blocks)))
        return plan

    knn.make_plan = spy
    try:
        got = knn.top_k(df, df.where("vec_id % 20 = 0"), 3, pivots=24, group_queries=8).collect()
    finally:
        knn.make_plan = make
    assert sorted(tuple(r) for r in got) == brute_top_k(rows, lambda fine: {x for x in fine if x[0] % 20 == 0}, 3)
    assert sent[0][0] < sent[0][1] / 2  # most pairs of group and cell aren't visited


def test_top_k_large_values_and_empty_tables(spark):
    rows = [(i, [3e6 * (i + 1), 1e6 * i]) for i in range(12)]  # scores beyond 2^53
    df = spark.createDataFrame([(i, [float(np.float32(x)) for x in v]) for i, v in rows], "vec_id long, embedding array<float>")
    got = knn.top_k(df, df, 4).collect()
    exact = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(tuple(r) for r in got) == brute_top_k(exact, lambda fine: fine, 4)
    none = df.limit(0)
    assert knn.top_k(none, none, 4).collect() == [] and knn.top_k(df, none, 4).collect() == [] and knn.top_k(none, df, 4).collect() == []


# -- periodic runs ---------------------------------------------------------------------------------
def brute_runs(w, least=12):
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def brute_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def word_texts():
    rng = random.Random(5)
    out = [None, "", " \t\n", "a", "a " * 11, "a " * 12, " a\x0bb\x0c\rc\td " * 4, "x\x85y\x1cz " * 13, "é ü " * 9]
    for _ in range(60):
        n, letters = rng.choice([13, 40, 90]), rng.choice(["a", "ab", "abc", "abcdefgh"])
        w = [rng.choice(letters) for _ in range(n)]
        p = rng.randint(1, n // 3)
        if rng.random() < 0.6:
            w = [w[i % p] for i in range(n)]
        if rng.random() < 0.4:
            w[rng.randrange(n)] = "odd"
        out.append(" ".join(w))
    fib = ["a", "b"]
    while len(fib[-1]) < 200:
        fib.append(fib[-1] + fib[-2])
    return [*out, " ".join(fib[-1]), " ".join("abaababaabaab" * 9)]


@pytest.mark.parametrize("slice_chars", [periodicity.SLICE_CHARS, 150])
def test_periodic_runs_equal_brute_force(spark, slice_chars):
    texts = word_texts() + word_texts()[:5]
    df = spark.createDataFrame([(i, t, "own", 3) for i, t in enumerate(texts)], "doc_id long, text string, _periodic string, _th_in0 int")
    got = periodicity.periodic_runs(df, slice_chars=slice_chars)
    assert got.columns == ["doc_id", "text", "_th_in0", "_periodic"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
        assert [tuple(r) for r in rows[i]["_periodic"]["runs"]] == runs, t
        assert rows[i]["_periodic"]["collapsed"] == brute_collapsed(w, runs)
    assert periodicity.periodic_runs(df.limit(0)).collect() == []


def test_long_texts_take_seconds():
    equal = periodicity.runs_of(np.zeros(60_000, dtype=np.int64), np.array([60_000]))
    assert equal.tolist() == [[0, 0, 60_000, 1]]
    unit = np.random.default_rng(0).permutation(700)
    long = periodicity.runs_of(np.concatenate([np.tile(unit, 90), unit[:9], np.arange(5)]), np.array([63_014]))
    assert [0, 0, 63_009, 700] in long.tolist()


def test_extensions_equal_comparison():
    rng = np.random.default_rng(2)
    for k in (1, 2, 4):
        s = rng.integers(0, k, 400)
        s[200:300] = s[50:150]
        s = np.concatenate([[k], s, [k + 1]])
        g = periodicity.Grammar(s, 2)
        i, j = rng.integers(1, 401, 500), rng.integers(1, 401, 500)
        i, j = i[i != j], j[i != j]
        for step in (1, -1):
            got = g.extend(i, j, step)
            for a, b, n in zip(i.tolist(), j.tolist(), got.tolist(), strict=True):
                m = 0
                while s[a + step * m] == s[b + step * m]:
                    m += 1
                assert n == m


def test_periodic_query_on_the_whole_table(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    want = {}
    for d, t in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n, h = len(w), zlib.crc32(str(d).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2])) if n < 4000 or h % 10 == 0 else None
        if runs is None:
            continue
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[d] = (
            d, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(brute_collapsed(w, runs)),
        )
    got = queries.op13_periodic_runs(spark, SF_SMALL)
    assert dict(got.dtypes) | {c: "bigint" for c in ("n_runs", "start", "length", "period", "exponent_milli")} == dict(got.dtypes)
    rows = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert len(rows) == docs.count() and {d: rows[d] for d in want} == want
    assert sum(r[1] > 0 for r in want.values()) > 5


def test_repeated_tail_keeps_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c"), (5, None)], "doc_id long, text string")
    assert [tuple(r) for r in queries.with_repeated_tail(df).collect()] == [(None, "a b c"), (5, None)]
    assert queries.with_repeated_tail(df.where(F.lit(False))).collect() == []
