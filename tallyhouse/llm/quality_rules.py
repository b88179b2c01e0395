"""Quality rules with cross-document line frequency, in DataFrame operations only.

Base rules look at one document: too few words, or too many words inside repeated 3-word windows.
The corpus rule hashes every normalised line, counts the distinct documents of a host that hold
it, removes lines above the limits and rejects documents that the removal depletes.

*Distinct documents*: for a line, a document is known by its whole set of other normalised lines (an
order-free hash of 128 bits). Copies have the same set and count once, so a group of copies doesn't
turn its own lines into boilerplate, while a line shared by otherwise different documents is counted
for each of them. Near copies that differ in a line are different documents.

Scale: the first pass shuffles (host, line hash, document hash) and is combined before the
shuffle; a hot host or line is spread by the document hash. Lines above the limits are few (each
stands for more than ``max_docs`` documents); they are broadcast if counted small, else joined by
shuffle. Nothing is collected.

Defined cases: null or blank text has no words and fails the base rules; a null host is a host of
its own; repeated rows get equal results; an empty table gives an empty result; extra columns stay
as they are (the result is one struct column). Window hashes are 64 bits wide within a document.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import KEY, SPACE_CHARS, add_key, ascii_lower, bounded, own_columns, settled, shield, with_result

#: white space inside a line, and the pieces that stand in every line with more of it than single blanks
LINE_SPACES = r"[\x20\x09\x0B-\x0D]+"
ODD_SPACES = ["  ", "\t", "\x0b", "\x0c", "\r"]
SYMBOLS = r"[#*$%&|<>]"
MAX_DOCS = 50  # a line may stand in this many distinct documents of a host ...
MAX_SHARE = 0.01  # ... or in this share of them; it is removed above both
MIN_LEFT_SHARE = 0.4  # a document left with a smaller share of its words is depleted
#: the two halves of a document's hash, and the hash of a line in each
LINE_HASHES = {"doc1": lambda x: F.xxhash64(x), "doc2": lambda x: F.xxhash64(F.lit(7919), x)}


def _words(df: DataFrame, text: str) -> DataFrame:
    """Add ``_th_t``, the text, ``_th_r``, its pieces between single white space characters, and ``_th_w``, its words."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    blank = t
    for c in SPACE_CHARS.replace(" ", ""):
        blank = F.replace(blank, F.lit(c), F.lit(" "))
    # a split at one plain character needs no regular expression
    d = df.withColumn("_th_t", t).withColumn("_th_r", F.split(blank, " "))
    return d.withColumn("_th_w", F.array_remove("_th_r", ""))


def _windows(w: Column) -> Column:
    """A 64-bit hash for each 3-word window, in order; neighbours are paired by slices, not looked up by position."""
    n = F.size(w) - 2
    two = F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.xxhash64(a, b))
    return F.when(n > 0, F.zip_with(two, F.slice(w, 3, n), lambda h, c: F.xxhash64(h, c))).otherwise(
        F.array().cast("array<bigint>")
    )


def _repeat_words(s: Column) -> Column:
    """Words covered by 3-word windows found twice or more; ``s`` has (hash, start) sorted by hash."""
    n = F.size(s) - 1
    three = [0, 1, 2]
    equal = F.zip_with(
        F.slice(s, 1, n), F.slice(s, 2, n), lambda a, b: F.when(a["h"] == b["h"], F.array(*[x["p"] + k for x in (a, b) for k in three]))
    )
    return F.size(F.array_distinct(F.flatten(F.array_compact(equal)))).cast("long")


def base_stats(docs: DataFrame, text: str) -> DataFrame:
    """Add the struct ``_th_base`` with the per-document counts."""
    d = _words(docs, text).withColumn("_th_h", _windows(F.col("_th_w")))
    # only documents with a repeated window pay for the sort
    d = d.withColumn(
        "_th_s",
        F.when(
            F.size(F.array_distinct("_th_h")) < F.size("_th_h"),
            F.sort_array(F.transform("_th_h", lambda x, i: F.struct(x.alias("h"), i.alias("p")))),
        ),
    )
    d = d.withColumn("_th_l", F.split("_th_t", "\n"))
    t = F.col("_th_t")
    n = F.size("_th_w").cast("long")
    filled = F.filter("_th_l", lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    # only documents with a repeated line, blank ones among them, look at which lines hold a word
    repeated = F.size(F.array_distinct("_th_l")) < F.size("_th_l")
    repeat = F.when(F.col("_th_s").isNotNull(), _repeat_words(F.col("_th_s")))
    d = d.withColumn(
        "_th_base",
        F.struct(
            n.alias("n_words"),
            (F.length(t) - F.size("_th_r") + 1).cast("long").alias("word_chars"),
            (F.size(F.split(t, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
            F.when(repeated, F.size(filled) - F.size(F.array_distinct(filled))).otherwise(0).cast("long").alias("n_dup_lines"),
            F.coalesce(repeat, F.lit(0).cast("long")).alias("n_repeat_words"),
        ),
    )
    return d.drop("_th_t", "_th_r", "_th_w", "_th_h", "_th_s", "_th_l")


def line_rows(docs: DataFrame, text: str, host: str) -> DataFrame:
    """One row per line with a word: keys, host, the normalised line and its hash, the hash of its document's other lines.

    A row with an empty hash stands for the document itself, so that documents of a host are
    counted in the same pass. No filter stands above the lines: the optimizer would repeat their
    expression in it, and each text would be normalised twice.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    norm = F.regexp_replace(ascii_lower(t), "[0-9]+", "0")
    odd = reduce(or_, [t.contains(c) for c in ODD_SPACES])
    norm = F.when(odd, F.regexp_replace(norm, LINE_SPACES, " ")).otherwise(norm)
    d = docs.select(*KEY, F.col(f"`{host}`").alias("host"), F.split(norm, "\n").alias("raw"))
    d = d.withColumn(
        "lines",
        F.transform(
            F.filter(F.transform("raw", lambda x: F.trim(x)), lambda x: x != ""),
            lambda x: F.struct(F.unhex(F.md5(x)).alias("line"), x.alias("norm")),
        ),
    )
    whole = F.array(F.struct(F.unhex(F.lit("")).alias("line"), F.lit("").alias("norm")))
    d = d.withColumns({c: _xor_distinct(h) for c, h in LINE_HASHES.items()})
    # a document without lines has no array to explode
    rows = d.select(*KEY, "host", *LINE_HASHES, F.posexplode(F.when(F.size("lines") > 0, F.concat(whole, F.col("lines"))))).select(
        *KEY, "host", *LINE_HASHES, "pos", "col.line", "col.norm"
    )
    # the set of the other lines: a line's own hash is taken out again
    others = {c: F.when(F.length("line") == 0, F.col(c)).otherwise(F.col(c).bitwiseXOR(h(F.col("line")))) for c, h in LINE_HASHES.items()}
    return rows.withColumns(others)


def _xor_distinct(h: Callable[[Column], Column]) -> Column:
    """A hash of the set of lines: the same in any order, and however often a line is repeated."""
    return F.aggregate(F.array_distinct(F.transform("lines", lambda x: h(x["line"]))), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def frequent_lines(lines: DataFrame, max_docs: int, max_share: float) -> DataFrame:
    """(host, line, n_docs) of the lines above both limits."""
    counts = lines.select("host", "line", *LINE_HASHES).distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = counts.where((F.col("n_docs") > max_docs) | (F.length("line") == 0))
    counts = settled(counts)
    hosts = counts.where(F.length("line") == 0).select(F.col("host").alias("h"), F.col("n_docs").alias("host_docs"))
    return (
        counts.where((F.length("line") > 0) & (F.col("n_docs") > max_docs))
        .join(hosts, F.col("host").eqNullSafe(F.col("h")))
        .where(F.col("n_docs") > max_share * F.col("host_docs"))
        .select("host", "line", "n_docs")
    )


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    id_col: str = "doc_id",
    out: str = "_quality",
    min_words: int = 50,
    max_repeat_pct: int = 50,
    max_docs: int = MAX_DOCS,
    max_share: float = MAX_SHARE,
    min_left_share: float = MIN_LEFT_SHARE,
) -> DataFrame:
    """``docs`` with a struct ``out``: counts, ``base_failed``, ``n_removed_words`` and ``kept``."""
    d, names = shield(docs)
    host, text = names[host], names[text]
    keyed = add_key(d, names[id_col], host, text)
    lines = line_rows(keyed, text, host)
    frequent = settled(frequent_lines(lines, max_docs, max_share))
    f = bounded(frequent.select(F.col("host").alias("fh"), F.col("line").alias("fl")))
    removed = (
        lines.join(f, (F.col("line") == F.col("fl")) & F.col("host").eqNullSafe(F.col("fh")), "left_semi")
        .groupBy(*KEY, "pos")  # repeated rows count once
        .agg(F.max(F.size(F.split("norm", " "))).alias("words"))
        .groupBy(*KEY)
        .agg(F.sum("words").alias("_th_removed"), F.count(F.lit(1)).alias("_th_rlines"))
    )
    b = F.col("_th_base")
    gone = F.coalesce(F.col("_th_removed"), F.lit(0)).cast("long")
    failed = (b["n_words"] < min_words) | (100 * b["n_repeat_words"] > max_repeat_pct * b["n_words"])
    depleted = (b["n_words"] - gone) < min_left_share * b["n_words"]
    # few documents lose lines: counted, they are broadcast, and no text is shuffled
    stats = base_stats(keyed, text).join(bounded(settled(removed)), KEY, "left")
    result = F.struct(
        *[b[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        gone.alias("n_removed_words"),
        F.coalesce(F.col("_th_rlines"), F.lit(0)).cast("long").alias("n_removed_lines"),
        (~failed & ~depleted).alias("kept"),
    )
    return with_result(stats, own_columns(names, out), result, out)
