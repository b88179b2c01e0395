"""WARC archives: writing, reading and transaction assembly.

Writing: every page becomes a request, a response (or revisit) and a metadata record; request
and metadata name the response by ``WARC-Concurrent-To``. Of records with equal payloads the one
with the largest id is the response, the others are revisits of it (identical payload digest).
The digests are a narrow table: the winners come from a grouped maximum (combined before the
shuffle) joined back on the digest, where a hot digest can be split. Records are laid out by
page id over enough files for ``FILE_BYTES`` each and written by Spark's text writer (a record ends
in two line breaks, which is the writer's line separator) as gzip files, so any store that Spark writes works and lost
tasks are simply written again.

Reading: files are read whole by Spark's binary reader (one file at a time is in memory, its size
is bounded by ``FILE_BYTES`` plus one record) and cut by Content-Length, so a payload may hold
anything, record headers included. A file is one gzip stream, so it is read from its start, not sought into.
The archive is parsed once: its records are written as a table (without the bodies unless asked for), and
assembly joins the records of a capture from there through
WARC-Concurrent-To and emits one nested row; revisits find their response by payload digest.

Defined cases: null html is an empty payload; a null id has no page-id field and never wins over
another id; records that tie on id and payload are all responses; repeated rows are separate
captures; a null URL has no target URI, line breaks in one are percent-encoded; an empty table
writes an empty archive and gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import scratch_path

CRLF = "\r\n"
FILE_BYTES = 32 << 20
GZIP = b"\x1f\x8b"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uuid(kind: str) -> Column:
    h = F.md5(F.concat_ws(":", F.lit(kind), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("seq").cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: Column | str, headers: list[tuple[str, Column]], body: Column) -> Column:
    """One record without the two line breaks that end it; null header values are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = F.concat_ws(
        CRLF, F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), kind), F.lit(f"WARC-Date: {DATE}"),
        *[F.concat(F.lit(f"{k}: "), v) for k, v in headers],
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    return F.concat(head, F.lit(CRLF * 2), body)


def base32_of_hex(digest: str) -> Column:
    @F.pandas_udf("string")
    def f(digests: pd.Series) -> pd.Series:
        return digests.map(lambda x: base64.b32encode(bytes.fromhex(x)).decode())

    return f(digest)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES) -> None:
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.replace(F.replace(F.col(f"`{url}`"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"),
    ).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    total = rows.agg(F.sum(F.octet_length("html") + 2048)).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    winners = rows.groupBy("sha1").agg(F.max("id").alias("winner"))
    # the pages are spread by content and id, so one hot digest or id fills no single file
    narrow = rows.select("id", "sha1").distinct().join(winners, "sha1").select("id", "sha1", "winner")
    narrow = narrow.withColumnsRenamed({"id": "nid", "sha1": "nsha"}).repartition(files, F.coalesce("nid", F.lit(0)), "nsha")
    laid = rows.repartition(files, F.coalesce("id", F.lit(0)), "sha1")
    laid = laid.join(
        narrow,
        (F.coalesce(laid["id"], F.lit(0)) == F.coalesce(narrow["nid"], F.lit(0))) & (laid["sha1"] == narrow["nsha"]) & laid["id"].eqNullSafe(narrow["nid"]),
    )
    laid = laid.withColumn("seq", F.monotonically_increasing_id())
    laid = laid.withColumn("digest", F.concat(F.lit("sha1:"), base32_of_hex("sha1")))
    revisit = F.coalesce(F.col("winner") != F.col("id"), F.col("id").isNull() & F.col("winner").isNotNull())
    size = F.octet_length("html").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(CRLF * 2))
    parsed = F.regexp_extract("url", r"^[^:/?#]*://([^/?#]*)([^#]*)", 1), F.regexp_extract("url", r"^[^:/?#]*://([^/?#]*)([^#]*)", 2)
    request = F.concat(
        F.lit("GET "), F.when(parsed[1] == "", "/").otherwise(F.coalesce(parsed[1], F.lit("/"))), F.lit(" HTTP/1.1\r\nHost: "),
        F.coalesce(parsed[0], F.lit("")), F.lit(CRLF * 2),
    )
    fields = F.concat_ws("", F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit(CRLF)), F.concat(F.lit("payload-length: "), size, F.lit(CRLF)))
    target = ("WARC-Target-URI", F.col("url"))
    to = ("WARC-Concurrent-To", _uuid("response"))
    records = [
        _record("request", [("WARC-Record-ID", _uuid("request")), target, to, ("Content-Type", F.lit("application/http; msgtype=request"))], request),
        _record(
            F.when(revisit, "revisit").otherwise("response"),
            [("WARC-Record-ID", _uuid("response")), target, ("WARC-Payload-Digest", F.col("digest")), ("WARC-Profile", F.when(revisit, PROFILE)),
             ("Content-Type", F.lit("application/http; msgtype=response"))],
            F.concat(http, F.when(revisit, "").otherwise(F.col("html"))),
        ),
        _record("metadata", [("WARC-Record-ID", _uuid("metadata")), target, to, ("Content-Type", F.lit("application/warc-fields"))], fields),
    ]
    text = F.concat_ws(CRLF * 2, *records)
    laid.select(text.alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def parse_records(data: bytes):
    """(headers, body) of every record; raises on a damaged archive."""
    at, n = 0, len(data)
    while at < n:
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split(CRLF)[1:]
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
        body = end + 4
        at = body + int(headers["content-length"])
        if at > n or data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"damaged record before byte {at}")
        yield headers, data[body:at]
        at += 4


RECORD = (
    "kind string, record_id string, concurrent_to string, target_uri string, digest string, page_id long, "
    "payload_length long, payload_digest string, body binary"
)


def read_warc(spark: SparkSession, path: str, with_body: bool = True) -> DataFrame:
    """One row per record. The payload digest is computed from the payload of a response."""

    def parse(batches):
        for b in batches:
            for data in b["content"]:
                out = []
                data = bytes(data)
                for h, body in parse_records(gzip.decompress(data) if data[:2] == GZIP else data):
                    kind = h["warc-type"]
                    fields, payload, digest = {}, None, None
                    if kind == "metadata":
                        fields = dict(x.split(": ", 1) for x in body.decode().split(CRLF) if x)
                    elif kind == "response":
                        payload = body[body.index(b"\r\n\r\n") + 4 :]
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    named = h.get("warc-payload-digest")
                    if digest and named != f"sha1:{digest}":
                        raise ValueError(f"payload of {h['warc-record-id']} doesn't fit its digest")
                    length = fields.get("payload-length")
                    out.append((
                        kind, h["warc-record-id"], h.get("warc-concurrent-to"), h.get("warc-target-uri"), named.removeprefix("sha1:") if named else None,
                        int(fields["page-id"]) if "page-id" in fields else None,
                        len(payload) if payload is not None else int(length) if length else None, digest, body if with_body else None,
                    ))
                    if len(out) == 2000:
                        yield frame(out)
                        out = []
                if out:
                    yield frame(out)

    def frame(out):
        f = pd.DataFrame(out, columns=[x.split()[0] for x in RECORD.split(", ")])
        return f.astype({"page_id": "Int64", "payload_length": "Int64"})

    # one file per Arrow batch: files are bounded, batches of files would not be
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: request, response or revisit, and metadata, joined by WARC-Concurrent-To."""

    def of(kind: str, name: str) -> DataFrame:
        cols = [c for c in records.columns if c != "kind"]
        return records.where(F.col("kind") == kind).select(F.col("concurrent_to").alias("capture"), F.struct(*cols).alias(name))

    response = records.where(F.col("kind").isin("response", "revisit")).select(F.col("record_id").alias("capture"), F.struct(*records.columns).alias("response"))
    return response.join(of("request", "request"), "capture", "left").join(of("metadata", "metadata"), "capture", "left")


def captures(spark: SparkSession, path: str, with_body: bool = True) -> DataFrame:
    """Assembled captures with ``refers_to``, the page id of the response that a revisit stands for, and
    ``payload_bytes``, the length of the payload read back (for a revisit, that of its response)."""
    parsed = scratch_path(spark, "warc-records")
    read_warc(spark, path, with_body).write.parquet(parsed)
    rows = assemble(spark.read.schema(RECORD).parquet(parsed))
    found = rows.where(F.col("response.kind") == "response").groupBy(F.col("response.digest").alias("d")).agg(
        F.max("metadata.page_id").alias("holder"), F.max("response.payload_length").alias("held")
    )
    revisits = rows.where(F.col("response.kind") == "revisit").join(found, F.col("response.digest") == F.col("d"), "left")
    revisits = revisits.select(*rows.columns, F.col("holder").alias("refers_to"), F.col("held").alias("payload_bytes"))
    responses = rows.where(F.col("response.kind") == "response").withColumn("refers_to", F.lit(None).cast("long"))
    return revisits.unionByName(responses.withColumn("payload_bytes", F.col("response.payload_length")))


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write ``pages`` to a fresh archive in the shared folder and read its captures back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_warc(pages, path, **columns)
    return captures(pages.sparkSession, path, with_body=False)
