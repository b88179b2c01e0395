"""Lengths come from the payloads, not from what the metadata says."""

from __future__ import annotations

import gzip
import os

from conftest import SF_SMALL
from tallyhouse.llm import queries, warc


def test_payload_bytes_are_those_read_back(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 25), (2, "http://b/", "x" * 25), (3, "http://c/", "é" * 20)], "page_id long, url string, html string")
    whole, changed = str(tmp_path / "whole"), tmp_path / "changed"
    warc.write_warc(pages, whole)
    changed.mkdir()
    for name in os.listdir(whole):
        if name.startswith("part-"):
            with gzip.open(os.path.join(whole, name)) as f:
                (changed / name.removesuffix(".gz")).write_bytes(f.read().replace(b"payload-length: 25", b"payload-length: 99").replace(b"payload-length: 40", b"payload-length: 99"))
    monkeypatch.setattr(queries, "round_trip", lambda pages: warc.captures(spark, str(changed)))
    got = queries.op6_warc(spark, SF_SMALL).select("page_id", "payload_bytes", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == [(1, 25, "revisit", 2), (2, 25, "response", None), (3, 40, "response", None)]
