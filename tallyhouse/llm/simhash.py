"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are made in Arrow batches (one pass over the text); everything after that works on
*distinct* fingerprints, so a group of thousands of exact copies is one node.

Search: the 64 bits are grouped into partitions so that correlated bits sit together. Partition i
gets its own threshold t_i >= -1 (-1: not probed) with sum(t_i + 1) = max_bits + 1; two
fingerprints within ``max_bits`` bits then differ in at most t_i bits of some partition i. A
dynamic program picks the partitions and thresholds with the least estimated cost (signatures
plus candidate pairs, from bit statistics over all fingerprints). A fingerprint is indexed by its
bits in each partition and probes the neighbours within t_i; candidates are verified on all bits.

Hot buckets: a bucket holding over ``bucket_cap`` distinct fingerprints is not paired. Its
fingerprints are linked exactly another way: two of them are within max_bits iff their balls of
radius max_bits / 2 meet, so each one lists its ball (65 points for 2 bits) and the members of a
point (at most 65) are joined in a star. That is linear in the bucket, and no link is lost.

Hot fingerprints: rows get their component by a join on the fingerprint. Those of a hot one (many
copies) take it from a broadcast of the hot fingerprints, so they stay where they are. Each holds
over a ``HOT_FINGERPRINTS``-th of all rows, so there are fewer than ``HOT_FINGERPRINTS`` of them.

Defined cases: no words (null, empty, blank) gives fingerprint 0, linked like any other; fewer
words than a shingle are one shingle; repeated rows share their component; a null id never is
the smallest id (a component of null ids has a null component_id); empty tables give empty
results.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallyhouse.llm.common import KEY, add_key, bounded, own_columns, settled, shield
from tallyhouse.llm.components import components

BITS = 64
SEED = 42
BUCKET_CAP = 32
HOT_ROWS = 1000  # a fingerprint of more rows than this, and than a HOT_FINGERPRINTS-th of all rows, is hot
HOT_FINGERPRINTS = 100_000
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint of one text, as a signed 64-bit integer."""
    # bytes.lower and bytes.split know only ASCII: A-Z and the six white-space characters
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingle = min(shingle, len(words))
    # shingles are slices of the words joined by one space
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    counts, n, h = np.zeros(BITS, dtype=np.int64), len(words) - shingle + 1, xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.fromiter([h(joined[a:b], SEED) for a, b in spans], dtype="<u8", count=n)
    for i in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    ones = np.packbits(2 * counts > n, bitorder="little")
    return int(ones.view("<i8")[0])


def fingerprint_udf(shingle: int):
    @pandas_udf("long")
    def f(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return f


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """(number of fingerprints, 64 x 64 counts of both bits set), summed by Spark."""

    def partial(batches):
        total = np.zeros((BITS, BITS))
        for b in batches:
            x = b["fp"].to_numpy(dtype="<i8")
            for i in range(0, len(x), CHUNK):
                bits = np.unpackbits(x[i : i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
        i, j = np.indices((BITS, BITS))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "n": total.ravel().astype("int64")})

    rows = fps.mapInPandas(partial, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both = np.zeros((BITS, BITS))  # 4,096 rows at most
    for r in rows:
        both[r["i"], r["j"]] = r["n"]
    return fps.count(), both


def correlations(n: int, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(share of ones per bit, absolute correlation of every two bits)."""
    if not n:
        return np.full(BITS, 0.5), np.eye(BITS)
    p = np.diag(both) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return p, np.clip(np.abs((both / n - np.outer(p, p)) / np.outer(sd, sd)), 0, 1)


def group_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """``parts`` groups of nearly equal size; each grows by the bit most correlated with it."""
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        off = corr - np.eye(BITS)
        first = max(left, key=lambda b: (off[b, list(left)].max(initial=0), -b))
        group = [first]
        left.discard(first)
        while len(group) < size:
            nxt = max(left, key=lambda b: (off[b, group].mean(), -b))
            group.append(nxt)
            left.discard(nxt)
        groups.append(sorted(group))
    return groups


def within(p: np.ndarray, corr: np.ndarray, group: list[int], most: int) -> np.ndarray:
    """Estimated chance that two fingerprints differ in at most t bits of the group, t = 0..most."""
    width = len(group)
    eff = width * width / max((corr[np.ix_(group, group)] ** 2).sum(), 1e-9)  # correlated bits count for fewer
    differ = sorted((2 * p[g] * (1 - p[g]) for g in group), reverse=True)[: max(1, round(min(eff, width)))]
    dist = np.zeros(most + 1)
    dist[0] = 1
    for q in differ:
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
    return np.minimum(np.cumsum(dist), 1)


def allocate(n: int, p: np.ndarray, corr: np.ndarray, max_bits: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of least estimated cost over 1 to max_bits + 2 partitions."""
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for parts in range(1, max_bits + 3):
        groups = group_bits(corr, parts)
        # table[s]: least cost and thresholds of the partitions so far that use s = sum(t + 1)
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for g in groups:
            chance = within(p, corr, g, max_bits)
            new: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, ts) in table.items():
                for t in range(-1, max_bits + 1 - used):
                    own = 0.0 if t < 0 else n * sum(comb(len(g), k) for k in range(t + 1)) + n * n / 2 * chance[t]
                    at = used + t + 1
                    if at not in new or cost + own < new[at][0]:
                        new[at] = (cost + own, [*ts, t])
            table = new
        cost, ts = table[max_bits + 1]
        if best is None or cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, ts, strict=True) if t >= 0])
    return best[1]


def _signed(bits) -> int:
    x = sum(1 << b for b in bits)
    return x - (1 << 64) if x >> 63 else x


def signatures(fps: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(fp, part, key, probe): the bits of each partition (probe 0) and their neighbours (probe 1)."""
    rows = []
    for i, (bits, t) in enumerate(plan):
        for k in range(t + 1):
            rows += [(i, _signed(bits), _signed(flip), int(k > 0)) for flip in combinations(bits, k)]
    lits = F.array(*[F.struct(*[F.lit(v).cast(c).alias(a) for v, c, a in zip(r, ("int", "long", "long", "int"), ("part", "mask", "flip", "probe"), strict=True)]) for r in rows])
    s = fps.select("fp", F.inline(lits))
    return s.select("fp", "part", F.col("fp").bitwiseAND(F.col("mask")).bitwiseXOR(F.col("flip")).alias("key"), "probe")


def _bucket_links(items: str, max_bits: int):
    """Verified links inside one bucket of at most ``bucket_cap`` fingerprints."""
    return F.flatten(
        F.transform(
            items,
            lambda x: F.transform(
                F.filter(
                    items,
                    lambda y: (y["fp"] > x["fp"])
                    & (x["probe"] * y["probe"] == 0)
                    & (F.bit_count(y["fp"].bitwiseXOR(x["fp"])) <= max_bits),
                ),
                lambda y: F.struct(x["fp"].alias("a"), y["fp"].alias("b")),
            ),
        )
    )


def ball_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints within ``max_bits`` (even) bits of each other."""
    flips = [_signed(f) for k in range(max_bits // 2 + 1) for f in combinations(range(BITS), k)]
    points = fps.select("fp", F.explode(F.array(*[F.lit(f).cast("long") for f in flips])).alias("flip"))
    points = points.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    stars = points.groupBy("point").agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1)  # at most len(flips)
    return stars.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a != b")


def links(fps: DataFrame, max_bits: int, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all within ``max_bits`` bits."""
    n, both = bit_statistics(fps)
    plan = allocate(n, *correlations(n, both), max_bits)
    sigs = signatures(fps, plan)
    sizes = sigs.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"), F.min("probe").alias("p"))
    sizes = settled(sizes.where("n > 1 and p = 0").select("part", "key", "n"))
    hot = bounded(sizes.where(F.col("n") > bucket_cap).select("part", "key"))
    cold = bounded(sizes.where(F.col("n") <= bucket_cap).select("part", "key"))
    buckets = sigs.join(cold, ["part", "key"]).groupBy("part", "key").agg(F.collect_list(F.struct("fp", "probe")).alias("items"))
    near = buckets.select(F.explode(_bucket_links("items", max_bits)).alias("l")).select("l.a", "l.b")
    dense = sigs.join(hot, ["part", "key"], "left_semi").select("fp").distinct()
    return near.unionByName(ball_links(dense, max_bits))


def near_duplicates(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3, max_bits: int = 2, bucket_cap: int = BUCKET_CAP
) -> DataFrame:
    """One row per input row: row keys, ``id_col``, ``fp`` and ``component_id`` (the smallest id linked)."""
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    keyed = add_key(docs.select(id_col, text), id_col, text)
    made = keyed.withColumn("fp", fingerprint_udf(shingle)(F.col(f"`{text}`")))
    rows = settled(made.select(*KEY, F.col(f"`{id_col}`").alias("id"), "fp"))
    fps = settled(rows.groupBy("fp").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")))
    linked = settled(components(links(fps.select("fp"), max_bits, bucket_cap)))
    linked = linked.withColumnRenamed("node", "fp").join(fps, "fp")
    firsts = linked.groupBy("component").agg(F.min("first_id").alias("lowest"))
    linked = linked.join(firsts, "component").select("fp", "lowest", F.lit(True).alias("in_group"))
    component = F.when(F.col("in_group"), F.col("lowest")).otherwise(F.col("first_id")).alias("component_id")
    named = settled(fps.join(linked, "fp", "left").select("fp", "n", component))
    total = named.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = named.where(F.col("n") > max(HOT_ROWS, total // HOT_FINGERPRINTS))
    hot = F.broadcast(hot.select("fp", F.col("component_id").alias("hot_id"), F.lit(True).alias("is_hot")))
    split = rows.join(hot, "fp", "left")
    spread = split.where("is_hot").select(*KEY, "id", "fp", F.col("hot_id").alias("component_id"))
    others = split.where("is_hot IS NULL").join(named, "fp").select(*KEY, "id", "fp", "component_id")
    return spread.unionByName(others).withColumnRenamed("id", id_col)


def drop_near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, then the smallest row key."""
    rows = settled(near_duplicates(docs, text, id_col, **options))
    # components of null ids only have no component_id; their fingerprint stands for them
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp"))]
    order = F.struct(F.col(f"`{id_col}`").isNull().alias("no_id"), F.col(f"`{id_col}`").alias("id"), *KEY)
    keep = settled(rows.groupBy(*[g.alias(f"g{i}") for i, g in enumerate(group)]).agg(F.min(order).alias("o")).select(*[F.col("o")[k].alias(k) for k in KEY]))
    repeated = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() > 0
    d, names = shield(docs)
    kept = add_key(d, names[id_col], names[text]).join(bounded(keep), KEY, "left_semi")
    return (kept.dropDuplicates(KEY) if repeated else kept).select(*own_columns(names))
