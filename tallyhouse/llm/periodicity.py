"""Periodic runs of words by recompression (a run-length grammar with longest-common-extension queries).

A run is a stretch of words with smallest period q, at least ``max(min_length, 2 q)`` long, that no
neighbouring word extends with period q. Steps, on the texts of one slice of an Arrow batch laid end
to end with a unique separator between them:

1. *Recompression.* Block compression (a maximal block of one symbol becomes one symbol) and pair
   compression (symbols are split into left and right ones; each left-right pair becomes one symbol)
   alternate until every text is a few symbols long. Equal stretches get equal symbols but for a few
   at their ends, whatever surrounds them.
2. *Extension queries.* How far two positions agree, forward or backward, is found by climbing the
   levels while the symbols agree and descending to the first difference, with at most one step on
   each level both ways. No suffix array is built.
3. *Candidates.* A run of period q covers two grid points i and i + q of every grid of step q (or of
   ``min_length - q``, when that is larger). Over all q these are harmonically many, n log n. Where the
   words at i and i + q agree, both extensions give the exact run; multiples of a smallest period find
   the same stretch and lose to it.

Texts are independent, so no row is shuffled. Memory is bounded by a slice of ``slice_chars`` bytes of
text, or one text if that is longer.

Defined cases: a null, empty or blank text has no words, no runs and an empty collapsed text; repeated
rows get equal results; an empty table gives an empty table; a column named like ``out`` is replaced,
other columns are kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyhouse.llm.common import own_columns, shield, with_result

MIN_LENGTH = 12
SLICE_CHARS = 1 << 21  # bytes of text compressed together
FLUSH = 1 << 18  # candidates extended together
SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
RESULT = "array<struct<start:long,length:long,period:long>>"


class Level:
    """One compression step: symbols, each one's parent, and each parent's first child (and an end mark)."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, parent: np.ndarray, blocks: bool):
        self.symbols, self.first, self.parent, self.blocks = symbols, first, parent, blocks


def _left_symbols(s: np.ndarray, level: int) -> np.ndarray:
    """Of a few splits of the symbols into left and right, the one that pairs most; a function of the symbols."""
    best, found = None, -1
    for salt in SALTS:
        mixed = (s.astype(np.uint64) + np.uint64(level + 1)) * np.uint64(salt)
        left = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63)).astype(bool)
        for side in (left, ~left):
            n = int(np.count_nonzero(side[:-1] & ~side[1:]))
            if n > found:
                best, found = side, n
    return best


class Grammar:
    """Run-length grammar of an integer sequence whose first and last symbols occur once."""

    def __init__(self, symbols: np.ndarray, short: int):
        """Compress until at most ``short`` symbols are left or a round changes nothing."""
        s, fresh = symbols.astype(np.int64), int(symbols.max(initial=0)) + 1
        self.levels: list[Level] = []
        while len(s) > max(short, 2):
            before = len(s)
            change = s[1:] != s[:-1]
            if not change.all():
                starts = np.concatenate([[0], np.flatnonzero(change) + 1])
                runs = np.diff(np.append(starts, len(s)))
                up, long = s[starts], runs > 1
                ids = np.unique(np.stack([up[long], runs[long]]), axis=1, return_inverse=True)[1].ravel()
                parent = np.repeat(np.arange(len(starts), dtype=np.int32), runs)
                self.levels.append(Level(s, np.append(starts, len(s)).astype(np.int32), parent, True))
                up[long] = fresh + ids
                fresh += len(ids)
                s = up
            left = _left_symbols(s, len(self.levels))
            at = np.flatnonzero(left[:-1] & ~left[1:])
            if len(at):
                ids = np.unique(s[at] * fresh + s[at + 1], return_inverse=True)[1].ravel()
                heads = np.ones(len(s), dtype=bool)
                heads[at + 1] = False
                first, parent = np.flatnonzero(heads), np.cumsum(heads, dtype=np.int32) - 1
                up = s[first]
                up[parent[at]] = fresh + ids
                fresh += len(ids)
                self.levels.append(Level(s, np.append(first, len(s)).astype(np.int32), parent, False))
                s = up
            if len(s) == before:
                break
        self.top = s

    def extend(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from i and j (i != j) on: forward (step 1) or backward (step -1), both included."""
        where, a, b = np.arange(len(i)), i.astype(np.int64), j.astype(np.int64)
        stopped: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # per level: first difference met there
        for lv in self.levels:
            pa_, pb = lv.parent[a], lv.parent[b]
            if step > 0:  # symbols left of the parent, the one at hand included
                ra, rb = lv.first[pa_ + 1] - a, lv.first[pb + 1] - b
                inside = (lv.first[pa_] != a) | (lv.first[pb] != b)
            else:
                ra, rb = a - lv.first[pa_] + 1, b - lv.first[pb] + 1
                inside = (lv.first[pa_ + 1] - 1 != a) | (lv.first[pb + 1] - 1 != b)
            agree = lv.symbols[a] == lv.symbols[b]
            if lv.blocks:
                move = np.where(inside & agree, np.minimum(ra, rb), 0)
                stop = inside & (~agree | (ra != rb))
            else:
                move = (inside & agree).astype(np.int64)
                stop = inside & ~agree
            a, b = a + step * move, b + step * move
            stopped.append((where[stop], a[stop], b[stop]))
            on = ~stop
            where, a, b = where[on], lv.parent[a[on]], lv.parent[b[on]]
        going = np.flatnonzero(self.top[a] == self.top[b])
        a, b = a.astype(np.int64), b.astype(np.int64)
        while len(going):
            a[going] += step
            b[going] += step
            going = going[self.top[a[going]] == self.top[b[going]]]
        for lv, (w, sa, sb) in zip(reversed(self.levels), reversed(stopped), strict=True):
            fa, fb = lv.first[a], lv.first[b]
            ea, eb = lv.first[a + 1], lv.first[b + 1]
            ca, cb = (fa, fb) if step > 0 else (ea - 1, eb - 1)
            move = (lv.symbols[ca] == lv.symbols[cb]).astype(np.int64)
            if lv.blocks:
                move *= np.minimum(ea - fa, eb - fb)
            where = np.concatenate([where, w])
            a, b = np.concatenate([ca + step * move, sa]), np.concatenate([cb + step * move, sb])
        out = np.empty(len(i), dtype=np.int64)
        out[where] = (a - i[where]) * step
        return out


def _extend_all(g: Grammar, i: np.ndarray, q: np.ndarray, min_length: int) -> np.ndarray:
    """Rows (start, end, period) of the stretches found from grid points i and i + q."""
    ahead = g.extend(i, i + q, 1)
    back = g.extend(i, i + q, -1) - 1
    runs = np.stack([i - back, i + q + ahead, q], axis=1)[ahead + back + q >= np.maximum(min_length, 2 * q)]
    return np.unique(runs, axis=0)


def runs_of(words: np.ndarray, lengths: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """All runs of several texts: rows (text, start, length, period) by text, start, period.

    ``words`` are the texts' word numbers (0 and up) one after the other, ``lengths`` the words of each.
    """
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] >= max(min_length, 2)]  # longest first: period q concerns a prefix of the texts
    if not len(order):
        return np.empty((0, 4), dtype=np.int64)
    size = lengths[order]
    begin = (np.cumsum(lengths) - lengths)[order]
    at = 1 + np.cumsum(size + 1) - (size + 1)  # first word of each text behind its separator
    end = int(at[-1] + size[-1] + 1)
    s = np.empty(end, dtype=np.int64)
    marks = np.concatenate([[0], at + size])
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    s[np.repeat(at, size) + within] = words[np.repeat(begin, size) + within]
    s[marks] = int(words.max()) + 1 + np.arange(len(marks))
    grammar = Grammar(s, 2 * len(marks))
    found, grid, periods, held = [], [], [], 0

    def flush():
        nonlocal held
        if held:
            q = np.repeat(np.array(periods, dtype=np.int64), [len(x) for x in grid])
            found.append(_extend_all(grammar, np.concatenate(grid), q, min_length))
        grid.clear()
        periods.clear()
        held = 0

    shortest = size[::-1]
    for q in range(1, int(size[0]) // 2 + 1):
        need = max(min_length, 2 * q)
        texts = len(size) - int(np.searchsorted(shortest, need))
        if not texts:
            break
        stop, step = int(at[texts - 1] + size[texts - 1]), need - q
        i = np.flatnonzero(s[1 : stop - q : step] == s[1 + q : stop : step]) * step + 1
        if len(i):
            for k in range(0, len(i), FLUSH):
                grid.append(i[k : k + FLUSH])
                periods.append(q)
                held += len(grid[-1])
                if held >= FLUSH:
                    flush()
    flush()
    if not found:
        return np.empty((0, 4), dtype=np.int64)
    runs = np.unique(np.concatenate(found), axis=0)  # by start, end, period
    smallest = np.ones(len(runs), dtype=bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[smallest]
    k = np.searchsorted(at, runs[:, 0], side="right") - 1
    out = np.stack([order[k], runs[:, 0] - at[k], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def kept_words(runs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per word of all texts: no run contains it after that run's first period."""
    begin = np.cumsum(lengths) - lengths
    edge = np.zeros(int(lengths.sum()) + 1, dtype=np.int64)
    first = begin[runs[:, 0]] + runs[:, 1]
    np.add.at(edge, first + runs[:, 3], 1)
    np.add.at(edge, first + runs[:, 2], -1)
    return np.cumsum(edge)[:-1] == 0


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words one after the other, words of each text); white space is the six ASCII characters."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(trimmed)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths[pc.equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)] = 0
    words = lists.flatten()
    return words.filter(pc.greater(pc.binary_length(words), 0)), lengths


def _solve(texts: pa.Array, min_length: int) -> pa.StructArray:
    words, lengths = _split(texts)
    coded = words.dictionary_encode()
    runs = runs_of(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), lengths, min_length)
    keep = kept_words(runs, lengths)
    begin = np.concatenate([[0], np.cumsum(lengths)])
    left = np.concatenate([[0], np.cumsum(keep)])[begin]
    collapsed = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(left), words.filter(pa.array(keep))), pa.scalar(" ", pa.large_string()))
    per_text = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
    found = pa.ListArray.from_arrays(pa.array(per_text), spans)
    return pa.StructArray.from_arrays([found, collapsed.cast(pa.string())], ["runs", "collapsed"])


def runs_udf(min_length: int, slice_chars: int):
    @arrow_udf(f"struct<runs:{RESULT},collapsed:string>")
    def f(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            parts, k = [], 0
            while k < len(texts):
                done = ends[k - 1] if k else 0
                upto = max(k + 1, int(np.searchsorted(ends, done + slice_chars, side="right")))
                parts.append(_solve(texts.slice(k, upto - k), min_length))
                k = upto
            yield pa.concat_arrays(parts) if parts else _solve(texts, min_length)

    return f


def periodic_runs(
    docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, out: str = "_periodic", slice_chars: int = SLICE_CHARS
) -> DataFrame:
    """``docs`` with the struct ``out``: ``runs`` (start, length and period in words, by start, then period)
    and ``collapsed``, the text without the words that only repeat a run's first period."""
    d, names = shield(docs)
    return with_result(d, own_columns(names, out), runs_udf(min_length, slice_chars)(F.col(names[text])), out)
