"""The derived faulty inputs give every rule something to reject."""

from __future__ import annotations

import __spark_entry__ as entry
from conftest import SF_SMALL
from tallyhouse.operators.normalize import sales_rules
from tallyhouse.plans.ingest import ingest_rules


def reasons(spark, name):
    return {r[0] for r in entry.queries()[name](spark, SF_SMALL).select("reject_reason").distinct().collect()}


def test_every_rule_of_the_sales_load_rejects(spark):
    assert reasons(spark, "quarantined_sales") == {name for name, _ in sales_rules()}


def test_every_rule_of_the_ingest_rejects(spark):
    assert reasons(spark, "ingest_rejected_reasons") == {name for name, _ in ingest_rules()}


def test_every_check_finds_violations(spark):
    got = entry.queries()["submission_quality_report"](spark, SF_SMALL).collect()
    assert len(got) == 6 and all(r["violations"] > 0 for r in got)
