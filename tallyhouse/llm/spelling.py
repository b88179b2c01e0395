"""Spelling variants: words one edit apart, found with a bidirectional FM-index over the delimited vocabulary.

Search scheme. If one inserted, deleted or replaced code point turns a word w into v, then v begins with
w's left half or ends with w's right half (in the other half is the error). So for each half:
match it exactly together with its delimiter, then extend across the other half allowing one error, up
to the other delimiter. The index holds the suffix ranks of the words joined by delimiters and of the same text
reversed; a bidirectional interval is kept in step in both while the half is matched, so that the
extension may go on to the other side. Rank queries are binary searches in the sorted (symbol, row) pairs of
the Burrows-Wheeler transform, done for all words of a shard at once.

Shards. A word goes, as text, to the shards of the halves that a word of its length, one more or one less
could have, and, as a query, to those of its own two halves: six narrow rows a word, no word meets
the whole vocabulary. Halves that more than ``hot`` rows share are refined exactly: of a word whose left half is
hot, the rest of the word has a half without an error as well, so the key becomes the left half with that piece,
until a key is small enough or the piece is a single code point (then the alphabet bounds it).

Each pair is found once: a match that also has the exact left half is left to that side.

Forms and roots. A word's form is its near word of largest count if that is at least ``ratio`` times its own.
Counts grow by that ratio along a chain of forms, so it has no cycle and is short; roots follow by pointer
doubling.

Defined cases: null words and counts are ignored; counts of a repeated word are added up; an empty word is a
word; any code points may occur; an empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ascii_lower, settled

HOT = 50_000  # rows of a key above which it is refined
SHARD_ROWS = 60_000  # rows of a shard, on average
RATIO = 10
CHUNK = 1 << 15


# -- the index ------------------------------------------------------------------------------------
def suffix_array(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Ranked suffix starts of a text of ``symbols`` different codes, by prefix doubling."""
    n = len(codes)
    width = max(1, int(62 // max(1, int(symbols).bit_length())))  # symbols packed into the first key
    key, shifted = np.zeros(n, dtype=np.int64), codes.astype(np.int64) + 1
    for k in range(width):
        key = key * (symbols + 1)
        key[: max(n - k, 0)] += shifted[k:]
    step = width
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        key = (rank + 1) * (n + 1)
        key[: max(n - step, 0)] += rank[step:] + 1
        step *= 2


class Ranks:
    """Backward search in one text: C[c] + occ(c, i) is the number of sorted (symbol, row) pairs before (c, i)."""

    def __init__(self, codes: np.ndarray, symbols: int):
        self.sa = suffix_array(codes, symbols)
        self.n = len(codes)
        pairs = codes[self.sa - 1].astype(np.int64) * (self.n + 1) + np.arange(self.n)
        # nothing precedes the whole text: its row counts as the delimiter before all others
        pairs[np.flatnonzero(self.sa == 0)] = -1
        self.pairs = np.sort(pairs)

    def step(self, c: np.ndarray, row: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.pairs, c * (self.n + 1) + row)


class Vocabulary:
    """Words joined by delimiters (code 0), indexed in both directions."""

    def __init__(self, words: list[str]):
        points = [np.frombuffer(w.encode("utf-32-le", "surrogatepass"), dtype="<u4") for w in words]
        self.alphabet = np.unique(np.concatenate([*points, np.empty(0, dtype="<u4")]))
        self.symbols = len(self.alphabet) + 1
        self.lengths = np.array([len(p) for p in points], dtype=np.int64)
        self.offsets = 1 + np.cumsum(self.lengths + 1) - (self.lengths + 1)
        text = np.zeros(int(self.lengths.sum()) + len(words) + 1, dtype=np.int64)
        for at, p in zip(self.offsets, points, strict=True):
            text[at : at + len(p)] = np.searchsorted(self.alphabet, p) + 1
        self.text = text
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.symbols))])  # first row of each symbol
        self.ahead, self.back = Ranks(text, self.symbols), Ranks(text[::-1], self.symbols)

    def code_rows(self, words: np.ndarray) -> np.ndarray:
        """Codes of the words of the given numbers, one a row, padded with -1."""
        most = int(self.lengths[words].max(initial=0))
        cols = np.arange(most)
        at = np.minimum(self.offsets[words][:, None] + cols, len(self.text) - 1)
        return np.where(cols < self.lengths[words][:, None], self.text[at], -1)

    def grow(self, lo, lo_other, size, c, left: bool):
        """Bidirectional step: intervals (first row in the step's own index, first row in the other, size) of
        every string, not empty and without a delimiter, with symbol ``c`` put on its left (or right) end."""
        index = self.ahead if left else self.back
        every = np.arange(self.symbols)
        low = index.step(every, lo[:, None])
        counts = index.step(every, (lo + size)[:, None]) - low
        smaller = np.cumsum(counts, axis=1) - counts
        r = np.arange(len(lo))
        return low[r, c], lo_other + smaller[r, c], counts[r, c]

    def match_half(self, codes: np.ndarray, length: np.ndarray, left_half: bool):
        """Rows of each word's half together with its outer delimiter, matched inside out, in the index
        of the direction in which the search goes on."""

        def symbol(part, t):  # the delimiter comes after the half's outermost symbol
            if not codes.shape[1]:
                return np.zeros(len(part), dtype=np.int64)
            at = np.clip(length[part] - 1 - t if left_half else np.full(len(part), t), 0, codes.shape[1] - 1)
            return np.where(t == length[part], 0, codes[part, at])

        c = symbol(np.arange(len(codes)), 0)
        lo, other, size = self.starts[c], self.starts[c], self.starts[c + 1] - self.starts[c]
        for t in range(1, int(length.max(initial=0)) + 1):
            act = np.flatnonzero((t <= length) & (size > 0))
            for part in np.array_split(act, max(1, -(-len(act) * self.symbols // (CHUNK * 64)))):
                c = symbol(part, t)
                lo[part], other[part], size[part] = self.grow(lo[part], other[part], size[part], c, left_half)
        return other, size


def near_words(v: Vocabulary, queries: np.ndarray, half: np.ndarray, left_half: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query position, word number) of words one edit from the query that share its exact half of
    ``half`` symbols (left or right)."""
    if not len(queries):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    codes, length = v.code_rows(queries), v.lengths[queries]
    cols, rest_len = np.arange(codes.shape[1]), length - half

    def pick(at, n):  # the codes at the given columns, -1 from the n-th on
        if not codes.shape[1]:
            return codes
        return np.where(cols < n[:, None], np.take_along_axis(codes, np.clip(at, 0, codes.shape[1] - 1), 1), -1)

    # the half in reading order, and what the search extends across, outward
    inner = pick(cols + (0 if left_half else rest_len[:, None]) + np.zeros_like(codes), half)
    rest = pick(half[:, None] + cols if left_half else rest_len[:, None] - 1 - cols, rest_len)
    halves, of = np.unique(np.concatenate([inner, half[:, None]], axis=1), axis=0, return_inverse=True)
    lo, size = v.match_half(halves[:, :-1], halves[:, -1], left_half)
    index = v.back if left_half else v.ahead  # the extension goes away from the half
    of = of.ravel()
    q0 = np.arange(len(queries))
    zero = (q0, lo[of], lo[of] + size[of])  # states without an error: query, first and last row
    one = tuple(np.empty(0, dtype=np.int64) for _ in range(3))  # states with one
    found_q, found_w = [], []
    letters = np.arange(1, v.symbols)

    def take(state, c):
        q, a, b = state
        a, b = index.step(c, a), index.step(c, b)
        on = b > a
        return q[on], a[on], b[on]

    def join(*states):
        return tuple(np.concatenate(x) for x in zip(*states, strict=True))

    for t in range(int(rest_len.max(initial=0)) + 1):
        q, a, b = zero
        # every letter that some word goes on with, for a replaced or an inserted code point
        spread = []
        for k in range(0, len(q), CHUNK):
            part = slice(k, k + CHUNK)
            low, high = index.step(letters, a[part][:, None]), index.step(letters, b[part][:, None])
            r, c = np.nonzero(high > low)
            spread.append((q[part][r], low[r, c], high[r, c], letters[c]))
        sq, sa, sb, sc = (np.concatenate(x) for x in zip(*spread, strict=True)) if spread else (np.empty(0, dtype=np.int64),) * 4
        here = rest[sq, t] if t < rest.shape[1] else np.full(len(sq), -1)
        other = sc != here  # inserting the next letter equals inserting it behind that letter
        one = join(one, (sq[other], sa[other], sb[other]))
        ended = rest_len[one[0]] == t
        done = take(tuple(x[ended] for x in one), np.zeros(int(ended.sum()), dtype=np.int64))
        found_q.append(done[0])
        found_w.append(index.sa[done[1]])  # one row: a delimited word occurs once
        one = tuple(x[~ended] for x in one)
        one = take(one, rest[one[0], t]) if len(one[0]) else one
        alive = rest_len[sq] > t
        replaced = other & alive
        go = rest_len[q] > t
        dropped = tuple(x[go] for x in zero)
        one = join(one, (sq[replaced], sa[replaced], sb[replaced]), dropped)
        zero = take(dropped, rest[dropped[0], t]) if len(dropped[0]) else dropped
    q, row = np.concatenate(found_q), np.concatenate(found_w)
    # the row starts at the delimiter that the search ended with
    if left_half:
        word = np.searchsorted(v.offsets, len(v.text) - 1 - row, side="right") - 1
    else:
        word = np.searchsorted(v.offsets, row + 1)
    pairs = np.unique(np.stack([q, word], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


# -- shards -----------------------------------------------------------------------------------------
KEYS = ["a", "b", "head", "tail"]


def _keyed(views: DataFrame) -> DataFrame:
    """Add the key: the exact first ``a`` and last ``b`` code points. A word too short for both isn't near."""
    fits = views.where("length(word) >= a + b")
    return fits.withColumns({"head": F.expr("substring(word, 1, a)"), "tail": F.expr("if(b = 0, '', right(word, b))")})


def views(words: DataFrame) -> DataFrame:
    """A word under the halves of the lengths (``size``) that its near words and itself can have."""
    sizes = F.filter(F.array(*[F.length("word") + d for d in (-1, 0, 1)]), lambda x: x >= 0)
    rows = words.select("word", "n", F.explode(sizes).alias("size"))
    half = (F.col("size") / 2).cast("int")
    left = F.struct(half.alias("a"), F.lit(0).alias("b"), F.lit(0).alias("skip"))
    right = F.struct(F.lit(0).alias("a"), (F.col("size") - half).cast("int").alias("b"), half.alias("skip"))
    # an empty left half is in every word: the other side has nothing left to find
    return _keyed(rows.select("word", "n", "size", F.inline(F.when(half > 0, F.array(left, right)).otherwise(F.array(left)))))


def refine(rows: DataFrame, hot: int) -> DataFrame:
    """Views with the keys of over ``hot`` rows replaced by longer ones, level by level."""
    done = None
    while True:
        rows = settled(rows)
        sizes = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("size") - F.col("a") - F.col("b")).alias("left"))
        large = settled(sizes.where((F.col("rows") > hot) & (F.col("left") > 1)).select(*KEYS))
        if not large.limit(1).count():
            return rows if done is None else done.unionByName(rows)
        kept = rows.join(large, KEYS, "left_anti")
        done = kept if done is None else done.unionByName(kept)
        mid = F.col("size") - F.col("a") - F.col("b")
        piece = (mid / 2).cast("int")
        longer = F.struct((F.col("a") + piece).alias("a"), F.col("b").alias("b"), F.col("skip").alias("skip"))
        later = F.struct(F.col("a").alias("a"), (F.col("b") + mid - piece).cast("int").alias("b"), (F.col("a") + piece).alias("skip"))
        halves = F.when(piece > 0, F.array(longer, later)).otherwise(F.array(longer))
        rows = _keyed(rows.join(large, KEYS, "left_semi").select("word", "n", "size", F.inline(halves)))


def _shard_results(frames) -> pd.DataFrame:
    """Near words of the queries of one shard (all rows of a partition)."""
    rows = pd.concat(list(frames), ignore_index=True)
    if rows.empty:
        return rows.assign(n_near=[], best_n=[], best=[])[["word", "n", "n_near", "best_n", "best"]]
    words, of = np.unique(rows["word"].to_numpy(dtype=object), return_inverse=True)
    counts = np.zeros(len(words), dtype=np.int64)
    counts[of] = rows["n"]
    v = Vocabulary(words.tolist())
    rows = rows.assign(w=of)
    asked = rows[rows["size"].to_numpy() == v.lengths[of]]
    out = []
    for left_half in (True, False):
        q = asked[(asked["b"] == 0) | (asked["a"] > 0)] if left_half else asked[(asked["b"] > 0) & (asked["a"] == 0)]
        a, b, skip, w = (q[c].to_numpy(dtype=np.int64) for c in ("a", "b", "skip", "w"))
        qi, found = near_words(v, w, a if left_half else b, left_half)
        words_q, words_f, b, skip = words[w[qi]], words[found], b[qi], skip[qi]
        ok = np.array(
            [
                len(f) >= a_ + b_ and (not b_ or f[-b_:] == x[-b_:]) and not (s and f[:s] == x[:s])
                for x, f, a_, b_, s in zip(words_q, words_f, a[qi], b, skip, strict=True)
            ],
            dtype=bool,
        )
        near = pd.DataFrame({"q": qi[ok], "best_n": counts[found[ok]], "found": found[ok]})
        sizes = near.groupby("q").size()
        first = near.sort_values(["q", "best_n", "found"], ascending=[True, False, True]).drop_duplicates("q").set_index("q")
        res = pd.DataFrame({"word": words[w], "n": counts[w]})
        res["n_near"] = sizes.reindex(res.index, fill_value=0).astype("int64")
        res["best_n"] = first["best_n"].reindex(res.index).astype("Int64")
        best = first["found"].reindex(res.index)
        res["best"] = [None if pd.isna(x) else words[int(x)] for x in best]
        out.append(res)
    return pd.concat(out, ignore_index=True)


def near_counts(words: DataFrame, hot: int = HOT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """word, n, n_near and its near word of largest count (``best``, ``best_n``; ties: the smallest)."""
    rows = refine(views(words), hot)
    shards = max(1, -(-rows.count() // shard_rows))
    placed = rows.select("word", "n", "size", "a", "b", "skip", *[F.col(c).alias(f"key_{c}") for c in ("head", "tail")])
    placed = placed.repartition(shards, "a", "b", "key_head", "key_tail").drop("key_head", "key_tail")

    def solve(frames):
        yield _shard_results(frames)

    part = placed.mapInPandas(_guarded(solve), "word string, n long, n_near long, best_n long, best string")
    pick = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("neg"), F.col("best").alias("word")))).alias("pick")
    all_ = part.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), pick)
    return all_.select("word", "n", "n_near", F.col("pick.word").alias("best"), (-F.col("pick.neg")).alias("best_n"))


def _guarded(solve):
    """A partition without rows yields none."""

    def f(frames):
        held = [x for x in frames if len(x)]
        if held:
            yield from solve(held)

    return f


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) without cycles -> (word, root): pointers doubled until none moves."""
    at = settled(forms.select("word", F.col("form").alias("root")))
    while True:
        jump = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settled(at.join(jump, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not moved.where("moved").limit(1).count():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def spelling_variants(
    words: DataFrame, word: str = "word", n: str = "n", ratio: int = RATIO, hot: int = HOT, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    rows = words.select(F.col(f"`{word}`").alias("word"), F.col(f"`{n}`").cast("long").alias("n")).where("word IS NOT NULL AND n IS NOT NULL")
    rows = settled(rows.groupBy("word").agg(F.sum("n").alias("n")))
    has_form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    near = near_counts(rows, hot, shard_rows)
    near = settled(near.select("word", "n", "n_near", F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n")))
    found = roots(near.where("form IS NOT NULL").select("word", "form"))
    return near.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def letter_runs(text: Column, least: int) -> Column:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF of at least ``least`` code points, A-Z lower-cased."""
    return F.regexp_extract_all(ascii_lower(text), F.lit("([a-zÀ-ÿ]{%d,})" % least), F.lit(1))
