"""Licence notices as people write them, by hand."""

from __future__ import annotations

from tallyhouse.llm.license_scan import scan_licenses

NOTICES = {
    "distributed under the GNU GPL v3": "gpl", "Released under MPL 2.0": "mpl", "Licensed under GPLv2 or later": "gpl", "Licensed under the terms of the GPL": "gpl",
    "Licensed under Apache 2.0": "apache", "Licensed under BSD 3-Clause": "bsd", "Apache-2.0 licensed": "apache", "This library is LGPL-2.1.": "lgpl", "MIT-licensed code": "mit",
    "published under the AGPLv3": "agpl", "available under the EPL v2.0": "epl", "It is BSD licensed": "bsd", "Released under the MIT/X11": "mit", "licensed under PostgreSQL": "postgresql",
    "Released under the ISC": "isc", "Apache v2.0": "apache", "EPL version 2.0": "epl", "GPL-3.0-or-later": "gpl", "MPL 2.0": "mpl", "Distributed under CDDL version 1.0": "cddl",
}
NONE = ["apache 2.4.1 serves the pages", "available under ruby", "php 3.0 came out", "released under a new name", "an example 2.0 of simple things", "submit it under the door", "unlicensed", "gpl"]
NONE += ["arsenal won in the EPL 2-0 on sunday", "the Apache 2.0 web server on port 80", "apache 2 server", "an ISC 3.0 conference", "artistic 2.0 dreams"]


def test_short_notices_get_their_label(spark):
    rows = [(t,) for t in [*NOTICES, *NONE]]
    got = {r["text"]: r["_license"] for r in scan_licenses(spark.createDataFrame(rows, "text string")).collect()}
    assert {t: got[t]["labels"] for t in NOTICES} == NOTICES
    assert all(got[t]["score"] >= 0.6 and got[t]["n_base"] == 0 for t in NOTICES)
    assert {t: got[t]["labels"] for t in NONE} == dict.fromkeys(NONE, "")


def test_a_hundred_thousand_detections_take_seconds(spark):
    import time

    n = 100_000
    df = spark.createDataFrame([("mit license " * n,), ("x mit license " * 600 + "gpl v2 " * 300,)], "text string").repartition(1)
    start = time.perf_counter()
    rows = {len(r["text"]): r["_license"] for r in scan_licenses(df).collect()}
    assert time.perf_counter() - start < 90
    long, short = rows[12 * n], rows[14 * 600 + 7 * 300]
    assert (long["n_base"], long["last_word"], long["labels"], len(long["detections"])) == (n, 2 * n - 2, "mit", 2 * n - 1)  # "license mit" as well
    assert (short["n_base"], short["labels"], len(short["detections"])) == (600, "gpl,mit", 900)
