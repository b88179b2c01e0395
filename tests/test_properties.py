"""Property tests: exact rounding against Python's Decimal, dense keys against a plain sort."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.functions.exprs import exact_ratio
from tallyhouse.operators.keys import dense_key

cents = st.integers(min_value=-10**12, max_value=10**12)
counts = st.integers(min_value=1, max_value=10**6)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(cents, counts), min_size=1, max_size=40))
def test_exact_ratio_matches_decimal_half_up(spark, pairs):
    df = spark.createDataFrame([(Decimal(c) / 100, n) for c, n in pairs], "s decimal(18,2), n int")
    got = [r[0] for r in df.select(exact_ratio("s", "n", 2)).collect()]
    want = [(Decimal(c) / 100 / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) for c, n in pairs]
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abcXYZ-0", max_size=4)), min_size=1, max_size=60, unique=True))
def test_dense_key_is_rank_in_sorted_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    got = {r["v"]: r["k"] for r in dense_key(df, ["v"], "k").collect()}
    # byte order of UTF-8 (Spark's string order), NULL last
    ordered = sorted([v for v in values if v is not None], key=lambda v: v.encode()) + [v for v in values if v is None]
    assert got == {v: i + 1 for i, v in enumerate(ordered)}
