from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyhouse.session import build_session

    s = build_session(4, shuffle_partitions=4, app="tallyhouse-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wh(spark):
    """The warehouse built from the smallest driver tables."""
    from tallyhouse.plans import runs

    return runs.warehouse(spark, SF_SMALL)


def rows(df, *cols):
    """Sorted list of tuples (of the given columns, or all)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
