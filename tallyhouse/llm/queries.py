"""The registered queries of the text operators.

Queries without an entry in ``oracles`` (learned models, tokenizer ids, XXH64, rule positions) are
compared with brute-force versions in tests/llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import table
from tallyhouse.llm.decontaminate import decontaminate
from tallyhouse.llm.html_extract import extract_pages
from tallyhouse.llm.knn import top_k
from tallyhouse.llm.language_id import identify
from tallyhouse.llm.license_scan import scan_licenses
from tallyhouse.llm.oracles import ORACLE_SQL
from tallyhouse.llm.packing import pack
from tallyhouse.llm.periodicity import periodic_runs
from tallyhouse.llm.quality_model import score_quality
from tallyhouse.llm.quality_rules import quality_rules
from tallyhouse.llm.simhash import near_duplicates
from tallyhouse.llm.spelling import letter_runs, spelling_variants
from tallyhouse.llm.url_filter import filter_urls, host_of
from tallyhouse.llm.warc import round_trip

#: rules of the URL query
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", "_quality.*")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).select("doc_id", "_license.*").drop("detections")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract_pages(pages, out="text")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: URLs of the table picked by their MD5 (a tenth) and those that hosts with a label of the
    form ``spam-...`` serve, all spelled in another way (scheme, tracking parameter, fragment)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    picked = (F.substring(F.md5("url"), 1, 2) < "1a") | host_of(F.col("url")).rlike(r"(^|\.)spam-")
    plain = F.regexp_replace(F.regexp_replace("url", "#.*$", ""), "^https?:", "http:")
    mark = F.when(plain.contains("?"), "&utm_medium=list#listed").otherwise("?utm_medium=list#listed")
    return filter_urls(pages, pages.where(picked).select(F.concat(plain, mark).alias("url")), URL_RULES).select("page_id", "_url.*")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = round_trip(table(spark, sf_dir, "pages"))
    return rows.select(
        F.col("metadata.page_id").alias("page_id"),
        "payload_bytes",
        F.col("response.digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        "refers_to",
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_quality(docs, labels).select("doc_id", "_quality_score.*")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).select("doc_id", "_language.*")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate(docs, items).select("doc_id", "_contamination.*")


def misspelled(docs: DataFrame, least: int = 7, one_in: int = 31) -> DataFrame:
    """(word, n): the letter runs of every text, with a letter missing where the CRC of document and run says so.

    Runs of documents with a null id stay as they are.
    """
    runs = docs.select("doc_id", F.explode(letter_runs(F.col("text"), least)).alias("run"))
    crc = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    words = runs.select("run", crc.alias("h"))
    cut = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run")))
    word = F.when(F.col("h") % one_in == 0, shorter).otherwise(F.col("run"))
    return words.select(word.alias("word")).where(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = misspelled(table(spark, sf_dir, "documents")).where("n >= 2")
    return spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = table(spark, sf_dir, "embeddings")
    return top_k(data, data.where(F.col("vec_id") % 20 == 0), 20)


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth (by the CRC of its id) goes on from some word in a period of its own.

    A null id leaves the text as it is.
    """
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size(words).cast("long")
    head = (g % n).cast("int")
    period = (F.floor((n - head) / (3 + g % 8)) + 1).cast("int")
    unit = F.slice(words, head + 1, period)
    tail = F.flatten(F.array_repeat(unit, F.ceil((n - head) / period).cast("int")))
    again = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), head), tail), F.lit(1), n.cast("int")), " ")
    return docs.withColumn("text", F.when((h % 10 == 0) & (n > 0), again).otherwise(F.col("text")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeated_tail(table(spark, sf_dir, "documents").select("doc_id", "text")))
    runs = F.col("_periodic.runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), longest.alias("top"), F.array_join(lines, "").alias("lines"), F.col("_periodic.collapsed").alias("left"))
    return rows.select(
        "doc_id",
        "n_runs",
        (-F.col("top.s")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.expr("(1000 * top.length) div -top.p").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("left", 256).alias("collapsed_sha256"),
    )


def queries() -> dict:
    found = [op1_quality_rules, op2_license_scan, op3_html_extraction, op4_url_filter, op5_simhash, op6_warc, op7_quality_classifier, op8_packing, op9_language_id, op10_decontamination]
    found += [op11_spelling, op12_top_k, op13_periodic_runs]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
