"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Every benchmark item is cut into windows of ``window`` words (a shorter item is one window); windows of equal
words are one window with the items that hold it. For containment of a whole window the necessary
prefix is one token, so a window needs only its rarest shingle in the document. Steps:

1. shingles of the windows (``shingle`` words; fewer for shorter windows) meet the shingles of all
   documents: one map-side join when the window shingles are counted small enough to broadcast;
2. shingles are ordered by how often the documents hold them, each window keeps its rarest one;
3. the documents with such a prefix shingle, and only they, are read again. Each of its places fixes where the window
   would start; length and position bounds drop places where it doesn't fit, and the words there are
   compared one by one, on a few words around the shingle;
4. hit words are the union of the verified intervals, the items those of the verified windows.

The work follows the places of prefix shingles, whatever repeats: a window of a periodic item is one window, however
often the item holds it, and meets a periodic document once per place. Texts aren't shuffled; the results are broadcast
back to the documents when they are counted small enough.

Defined cases: null and empty texts have no words and are not contaminated; items without words
are skipped; repeated rows get equal results; item ids that occur twice count once, null ids are
verified but not counted; extra columns stay, whatever their names (the result is one struct column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import KEY, add_key, ascii_lower, bounded, own_columns, settled, shield, with_result

NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 3
BENCH_SHINGLES = 2_000_000  # item shingles that may be broadcast


def with_words(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the lower-cased words (an empty array for none)."""
    joined = F.trim(F.regexp_replace(ascii_lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), NON_WORD, " "))
    return df.withColumn("_th_n", joined).withColumn(
        out, F.when(F.col("_th_n") == "", F.array().cast("array<string>")).otherwise(F.split("_th_n", " "))
    ).drop("_th_n")


def _shingles(words: str, k: int) -> Column:
    w = F.col(words)
    return F.when(
        F.size(w) >= k,
        F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)])),
    )


def _explode_shingles(df: DataFrame, cols: list, words: str, sizes: list[int], size_col: str | None = None) -> DataFrame:
    """Rows (cols, pos, sh) for the shingles of each of ``sizes``."""
    parts = []
    for k in sizes:
        d = df if size_col is None else df.where(F.col(size_col) == k)
        parts.append(d.select(*cols, F.posexplode(_shingles(words, k)).alias("pos", "sh")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def windows_of(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """(win, ww, span, k, ids): every distinct window, its words, and the sorted ids of the items that hold it."""
    span = F.least(F.lit(window), F.size("iw"))
    starts = F.explode(F.sequence(F.lit(1), F.size("iw") - span + 1)).alias("s")
    cut = items.select("item_id", "iw", span.alias("span"), starts).select("item_id", F.slice("iw", F.col("s"), F.col("span")).alias("ww"))
    # an item holds a window once, however often it repeats it
    held = cut.withColumn("win", F.concat_ws(" ", "ww")).groupBy("win", "item_id").agg(F.any_value("ww").alias("ww"))
    one = held.groupBy("win").agg(F.any_value("ww").alias("ww"), F.array_sort(F.collect_set("item_id")).alias("ids"))
    size = F.size("ww")
    return one.select("win", "ww", size.alias("span"), F.least(F.lit(shingle), size).alias("k"), "ids")


def prefix_shingles(shingles: DataFrame, freq: DataFrame) -> DataFrame:
    """(win, off, sh): for every window its rarest shingle, ties by position. A window has few shingles."""
    w = Window.partitionBy("win").orderBy("n", "off")
    return shingles.join(freq, "sh").withColumn("r", F.row_number().over(w)).where("r = 1").select("win", "off", "sh")


def verified_places(hit_docs: DataFrame, prefix: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """(keys, start, end, win) of every window that a document holds. ``hit_docs``: keys and words ``_th_w``."""
    at = F.greatest(F.lit(0), F.col("pos") - window + 1)
    found = _explode_shingles(hit_docs, [*KEY, "_th_w"], "_th_w", sizes)
    around = found.select(
        *KEY, "pos", "sh", F.size("_th_w").alias("n"), at.alias("at"), F.slice("_th_w", at + 1, F.lit(2 * window - 1)).alias("near")
    )
    start = F.col("pos") - F.col("off")
    placed = around.join(prefix, "sh").withColumn("start", start)
    fits = placed.where((F.col("start") >= 0) & (F.col("start") + F.col("span") <= F.col("n")))
    same = F.concat_ws(" ", F.slice("near", F.col("start") - F.col("at") + 1, F.col("span"))) == F.col("win")
    return fits.where(same).select(*KEY, "start", (F.col("start") + F.col("span")).alias("end"), "win").distinct()


def covered_words(places: DataFrame) -> DataFrame:
    """(keys, n_hit): the words in the union of the intervals. A window holds one document's places."""
    before = Window.partitionBy(*KEY).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.col("reached")))
    return places.withColumn("reached", reached).groupBy(*KEY).agg(F.sum(new).cast("long").alias("n_hit"))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    out: str = "_contamination",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    one_in: int = 20,
) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit, n_items, items_sha256, contaminated."""
    shielded, names = shield(docs)
    keyed = add_key(shielded, names[id_col], names[text])
    it = items.select(F.col(f"`{item_id}`").cast("string").alias("item_id"), F.col(f"`{item_text}`").alias("it"))
    it = with_words(it, "it", "iw").where(F.size("iw") > 0).drop("it")
    wins = settled(windows_of(it, window, shingle))
    sizes = [r[0] for r in wins.select("k").distinct().collect()]  # at most ``shingle`` values
    found = None
    if sizes:
        found = settled(_contained(keyed.select(*KEY, F.col(names[text]).alias("text")), wins, sizes, window))
    return _with_counts(keyed, names, text, found, one_in, out)


def _contained(texts: DataFrame, wins: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """(keys, n_hit, ids) of every document that holds a window."""
    shingles = settled(_explode_shingles(wins, ["win"], "ww", sizes, "k").withColumnRenamed("pos", "off"))
    vocab = bounded(settled(shingles.select("sh").distinct()), BENCH_SHINGLES)
    doc_sh = _explode_shingles(with_words(texts, "text", "_th_w"), KEY, "_th_w", sizes).drop("pos")
    met = settled(doc_sh.join(vocab, "sh", "left_semi"))  # the document shingles that any window has
    freq = met.groupBy("sh").agg(F.count(F.lit(1)).alias("n"))
    freq = vocab.join(freq, "sh", "left").select("sh", F.coalesce("n", F.lit(0)).alias("n"))
    prefix = settled(prefix_shingles(shingles, freq).join(wins.select("win", "span"), "win"))
    hit = settled(met.join(bounded(prefix.select("sh").distinct()), "sh", "left_semi").select(*KEY).distinct())
    hit_docs = texts.join(bounded(hit), KEY, "left_semi").dropDuplicates(KEY)
    places = settled(verified_places(with_words(hit_docs, "text", "_th_w").select(*KEY, "_th_w"), bounded(prefix), sizes, window))
    # windows that the same items hold count as one before their items are listed
    sets = wins.select("win", F.xxhash64("ids").alias("s1"), F.xxhash64(F.lit(7919), "ids").alias("s2"), "ids")
    listed = sets.groupBy("s1", "s2").agg(F.any_value("ids").alias("ids"))
    held = places.select(*KEY, "win").distinct().join(sets.drop("ids"), "win").select(*KEY, "s1", "s2").distinct()
    ids = held.join(listed, ["s1", "s2"]).select(*KEY, F.explode_outer("ids").alias("item_id"))
    per_doc = ids.groupBy(*KEY).agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    return covered_words(places).join(per_doc, KEY)


def _with_counts(keyed: DataFrame, names: dict[str, str], text: str, found: DataFrame | None, one_in: int, out: str) -> DataFrame:
    rows = with_words(keyed, names[text], "_th_w")
    if found is None:
        rows = rows.withColumns({"n_hit": F.lit(None).cast("long"), "ids": F.lit(None).cast("array<string>")})
    else:
        rows = rows.join(bounded(found), KEY, "left")
    words, n_hit = F.size("_th_w").cast("long"), F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    result = F.struct(
        words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (one_in * n_hit >= words)).alias("contaminated"),
    )
    return with_result(rows, own_columns(names, out), result, out)
