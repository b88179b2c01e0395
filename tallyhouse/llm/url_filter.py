"""URL filter: a blocked Bloom filter before an exact hash join, plus host and path rules.

The list of blocked URLs is canonicalised and hashed into a blocked Bloom filter: one block is
eight 32-bit words, every URL sets one bit in each word of its block. The filter is a table with a
row per block, built by a grouped bit_or, and broadcast: its size is bounded by ``MAX_BLOCKS`` rows
whatever the length of the list (a longer list only lets more candidates through). Pages whose
bits are all set go on to an exact join on the canonical URL, which removes false positives; the
others skip the shuffle.

Rules have a host and a path prefix; a rule fits its host and subdomains; the longest wins. They
are a bounded parameter and become one column expression.

Defined cases: a null URL or one without ``://`` has empty host and path and fits no rule; blank
or null entries of the list are ignored; repeated rows get equal results; extra columns stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import UPPER, own_columns, settled, shield

WORDS = 8
BITS_PER_URL = 12
MAX_BLOCKS = 1 << 18
#: query parameters that don't name a page
TRACKING = r"(?:utm_[^=&]*|ref|fbclid|gclid)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Scheme, www., default port, fragment, tracking parameters and trailing slash dropped; null without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r"\.?(?::(?:80|443))?$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(?:=|$)")))
    tail = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, path, tail))


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks)).cast("int")


def _bit(url: Column, word: int) -> Column:
    return F.shiftright(F.xxhash64(url, F.lit(word // 4)), 5 * word).bitwiseAND(F.lit(31)).cast("int")


def bloom_filter(urls: DataFrame, url: str, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """(block, w0..w7) of the distinct canonical URLs in column ``url``, and the number of blocks."""
    wanted = -(-urls.count() * BITS_PER_URL // (32 * WORDS))
    blocks = min(max_blocks, max(1, 1 << max(0, wanted - 1).bit_length()))
    word = [F.bit_or(F.expr(f"shiftleft(1, b{j})")).alias(f"w{j}") for j in range(WORDS)]
    bits = urls.select(_block(F.col(url), blocks).alias("block"), *[_bit(F.col(url), j).alias(f"b{j}") for j in range(WORDS)])
    return settled(bits.groupBy("block").agg(*word)), blocks


def mark_listed(pages: DataFrame, listed: DataFrame, url: str = "url", listed_url: str = "url", out: str = "_listed") -> DataFrame:
    """``pages`` with a boolean ``out``: the canonical URL is on the list."""
    names = [f"`{c}`" for c in pages.columns if c != out]
    exact = listed.select(canonical(F.col(f"`{listed_url}`")).alias("_th_l")).where(F.col("_th_l").isNotNull()).distinct()
    exact = settled(exact)
    filt, blocks = bloom_filter(exact, "_th_l")
    filt = filt.toDF("_th_b", *[f"_th_w{j}" for j in range(WORDS)])
    d = pages.withColumn("_th_c", canonical(F.col(f"`{url}`")))
    d = d.join(F.broadcast(filt), _block(F.col("_th_c"), blocks) == F.col("_th_b"), "left")  # at most MAX_BLOCKS rows
    all_set = reduce(
        lambda a, b: a & b,
        [F.col(f"_th_w{j}").bitwiseAND(F.call_function("shiftleft", F.lit(1), _bit(F.col("_th_c"), j))) != 0 for j in range(WORDS)],
    )
    d = d.select(*names, "_th_c", F.coalesce(all_set & F.col("_th_c").isNotNull(), F.lit(False)).alias("_th_m"))
    passed = d.where("_th_m").join(exact.withColumn(out, F.lit(True)), F.col("_th_c") == F.col("_th_l"), "left")
    passed = passed.select(*names, F.coalesce(F.col(out), F.lit(False)).alias(out))
    return passed.unionByName(d.where("not _th_m").select(*names, F.lit(False).alias(out)))


def rule_expression(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text in sorted(rules, key=lambda r: (len(r), r)):  # later, longer rules overrule
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(rules[text])).otherwise(verdict)
    return rule, verdict


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: dict[str, str], url: str = "url", listed_url: str = "url", out: str = "_url"
) -> DataFrame:
    """``pages`` with a struct ``out``: host, path, rule, listed, verdict (the rule's, else by the list)."""
    d, names = shield(pages)
    u = names[url]
    d = mark_listed(d, listed, u, listed_url, "_th_listed")
    d = d.withColumns({"_th_host": host_of(F.col(u)), "_th_path": path_of(F.col(u))})
    rule, verdict = rule_expression(F.col("_th_host"), F.col("_th_path"), rules)
    by_list = F.when(F.col("_th_listed"), "block").otherwise("allow")
    result = F.struct(
        F.col("_th_host").alias("host"), F.col("_th_path").alias("path"), rule.alias("rule"),
        F.coalesce(verdict, by_list).alias("verdict"), F.col("_th_listed").alias("listed"),
    )
    return d.select(*own_columns(names, out), result.alias(out))
