"""Packing by cutting-stock column generation.

1. One pass tokenises the documents and cuts them into pieces of at most ``seq_len`` tokens (all
   full but the last); the pieces (without their ids unless asked for) are written to the shared
   folder.
2. The histogram of piece lengths, in classes of ``unit`` tokens, is the demand of a cutting-stock
   problem: at most seq_len / unit numbers reach the driver, however many documents there are.
3. The linear program over patterns (how many pieces of each class share a sequence) is solved by
   column generation: a knapsack dynamic program prices new patterns until none improves. Patterns
   are rounded down; the few pieces left over are packed first-fit decreasing.
4. Pieces are ranked within their class (cells of a bounded number of rows are ranked apart and
   offset by counts, so one hot length doesn't meet in one task), and rank ranges map them to the
   rounded patterns, a sequence and a slot. Offsets add up the lengths within a sequence.

Defined cases: null and empty texts are one piece with the end id alone; repeated rows are packed
once each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import string
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import bounded, settled

SEQ_LEN = 2048
UNIT = 16
CELL_ROWS = 256  # rows ranked together
MAX_CELLS = 4096
SLICE = 1000  # texts encoded together
CACHE_CHARS = 40_000_000  # a worker forgets the words it has met after so many characters
LATIN_END = "\u0250"
MARKS = frozenset(string.punctuation)
#: fixed value: the pattern by which the tokenizer cuts words
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordTokenizer:
    """Ids as little-endian uint32 bytes, remembered by word.

    The tokenizer never joins across white space, so a text is cut there. A new word of Latin
    letters is cut further as the tokenizer's own pattern does, and its unknown parts are encoded
    many at a time: the last id of every part is one that ends a word, which separates them. Any
    other word is encoded by itself, and so is one that holds a special string such as
    ``<|endoftext|>``: it gets its own id there, as the tokenizer gives it by default.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core already
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.parts_of = regex.compile(PARTS).findall
        self.forget()

    def forget(self) -> None:
        self.words, self.parts, self.kept_chars = {"": b""}, {}, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def learn_parts(self, parts: list[str]) -> None:
        for i in range(0, len(parts), 1000):
            some = parts[i : i + 1000]
            ids = self.encode([" ".join(some)])[0]
            last = np.flatnonzero(self.ends[np.frombuffer(ids, dtype="<u4")]) + 1
            if len(last) == len(some):
                cuts = [0, *(4 * last).tolist()]
                self.parts.update(zip(some, [ids[x:y] for x, y in zip(cuts, cuts[1:], strict=False)], strict=True))
            else:
                self.parts.update(zip(some, self.encode(some), strict=True))

    def learn_words(self, words: list[str]) -> None:
        low = {w: w.lower() for w in words if w.isascii()}
        latin = [w for w in words if w not in low and max(w) < LATIN_END]
        low.update(zip(latin, [unicodedata.normalize("NFC", w).lower() for w in latin], strict=True))
        letters = {w: x for w, x in low.items() if x.isalpha()}  # most words are one part, or one and a mark behind it
        marked = {w: x for w, x in low.items() if x[-1] in MARKS and x[:-1].isalpha()}
        rest = set(words).difference(letters, marked)
        plain = [w for w in rest if w in low and not any(s in w for s in self.special)]
        if len(plain) < len(rest):
            other = list(rest.difference(plain))
            self.words.update(zip(other, self.encode(other), strict=True))
        cut = [self.parts_of(low[w]) for w in plain]
        parts = set().union(letters.values(), *cut)
        for x in marked.values():
            parts.add(x[:-1])
            parts.add(x[-1])
        self.learn_parts(list(parts - self.parts.keys()))
        get = self.parts.__getitem__
        self.words.update(zip(letters, map(get, letters.values()), strict=True))
        self.words.update({w: get(x[:-1]) + get(x[-1]) for w, x in marked.items()})
        self.words.update(zip(plain, [b"".join(map(get, c)) for c in cut], strict=True))

    def encode_batch(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of every text; null is empty."""
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, type=pa.large_string())
        trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
        lists = pc.ascii_split_whitespace(trimmed)
        words = lists.flatten().dictionary_encode()
        distinct, which = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy(zero_copy_only=False)
        if self.kept_chars > CACHE_CHARS:
            self.forget()
        new = [w for w in distinct if w not in self.words]
        self.kept_chars += sum(map(len, new)) + 40 * len(new)
        self.learn_words(new)
        known = [self.words[w] for w in distinct]
        ids = np.frombuffer(b"".join(known), dtype="<u4")
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        size = sizes[which]
        ends = np.cumsum(size)
        # every word's ids, one word after the other
        at = np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - size), size) + np.arange(int(size.sum()))
        out = ids[at].tobytes()
        stops = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        cuts = (4 * np.concatenate([[0], ends])[stops]).tolist()
        return [out[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]


def token_pieces(docs: DataFrame, tokenizer_path: str, text: str, id_col: str, seq_len: int, end_id: int, with_ids: bool) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens (and ids)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else "")
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        tok = WordTokenizer(tokenizer_path)
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):  # a slice shares the batch's memory
                part = b.slice(lo, SLICE)
                rows, pieces = [], []
                for doc, enc in enumerate(tok.encode_batch(part.column(1))):
                    enc += end
                    n = len(enc) // 4
                    for s in range(0, n, seq_len):
                        piece = enc[4 * s : 4 * (s + seq_len)]
                        rows.append((doc, s, len(piece) // 4, zlib.crc32(piece), n))
                        if with_ids:
                            pieces.append(piece)
                doc, *numbers = np.array(rows, dtype=np.int64).T.copy()
                columns = [part.column(0).take(pa.array(doc)), *map(pa.array, numbers)]
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum(numbers[1])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(pieces), dtype="<i4"))))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(columns)])

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(cut, schema)


def price(duals: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of greatest value."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        fits = np.searchsorted(sizes, c, side="right")
        if fits:
            v = best[c - sizes[:fits]] + duals[:fits]
            k = int(v.argmax())
            if v[k] > best[c] + 1e-12:
                best[c], pick[c] = v[k], k
    pattern, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            pattern[pick[c]] += 1
            c -= sizes[pick[c]]
    return float(best[capacity]), pattern


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 0.002, max_rounds: int = 4000) -> list[tuple[dict[int, int], int]]:
    """[(pattern: class index -> pieces, how many sequences)] covering ``demand`` exactly.

    It stops within ``gap`` of the optimum: when the best new pattern is worth at most 1 + gap, or
    when the sequences are that close to the total length over the capacity. ``sizes`` ascend. Revised simplex from the homogeneous patterns; every basis is feasible, so the
    bound on the rounds costs padding at most, never a piece.
    """
    m = len(sizes)
    if not m:
        return []
    patterns = np.diag((capacity // sizes).astype(float))  # column j is the pattern of basis variable j
    inverse = np.diag(1 / np.diag(patterns))
    x = inverse @ demand
    least = demand @ sizes / capacity
    for _ in range(max_rounds):
        if x.sum() <= (1 + gap) * least:
            break
        duals = inverse.sum(axis=0)
        value, new = price(duals, sizes, capacity)
        if value <= 1 + gap:
            break
        step = inverse @ new
        up = step > 1e-10
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, step, 1), np.inf)
        j = int(ratio.argmin())
        x = np.maximum(x - ratio[j] * step, 0)
        x[j] = ratio[j]
        inverse[j] /= step[j]
        other = np.arange(m) != j
        inverse[other] -= np.outer(step[other], inverse[j])
        patterns[:, j] = new
    times = np.floor(x + 1e-9).astype(np.int64)
    left = demand.astype(np.int64) - (patterns @ times).astype(np.int64)
    while (left < 0).any():  # rounding noise: give back a sequence that overfills a class
        k = int(np.argmin(left))
        j = int(np.argmax((patterns[k] > 0) & (times > 0)))
        times[j] -= 1
        left += patterns[:, j].astype(np.int64)
    plan = [({int(k): int(patterns[k, j]) for k in np.flatnonzero(patterns[:, j])}, int(times[j])) for j in range(m) if times[j]]
    # at most (classes x pieces of a pattern) pieces are left: first fit, longest first
    bins: list[tuple[int, dict[int, int]]] = []
    for k in range(m - 1, -1, -1):
        for _ in range(int(left[k])):
            for i, (free, p) in enumerate(bins):
                if free >= sizes[k]:
                    p[k] = p.get(k, 0) + 1
                    bins[i] = (free - int(sizes[k]), p)
                    break
            else:
                bins.append((capacity - int(sizes[k]), {k: 1}))
    return plan + [(p, 1) for _, p in bins]


def slot_ranges(plan: list[tuple[dict[int, int], int]], m: int) -> list[tuple[np.ndarray, ...]]:
    """Per class: first rank, pieces per sequence, first sequence and first slot of each range."""
    rows: list[list[tuple[int, int, int, int]]] = [[] for _ in range(m)]
    rank, seq = [0] * m, 0
    for pattern, times in plan:
        slot = 0
        for k, count in pattern.items():
            rows[k].append((rank[k], count, seq, slot))
            rank[k] += count * times
            slot += count
        seq += times
    return [tuple(np.array(r, dtype=np.int64).reshape(-1, 4).T) for r in rows]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    id_col: str = "doc_id",
    seq_len: int = SEQ_LEN,
    end_id: int = 1,
    unit: int = UNIT,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    pieces = settled(token_pieces(docs, tokenizer_path, text, id_col, seq_len, end_id, with_ids))
    pieces = pieces.withColumn("cls", F.ceil(F.col("length") / unit).cast("int"))
    demand = {r["cls"]: r["n"] for r in pieces.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(demand)
    plan = cutting_stock(np.array(classes, dtype=np.int64), np.array([demand[c] for c in classes], dtype=float), seq_len // unit)
    ranges = dict(zip(classes, slot_ranges(plan, len(classes)), strict=True))

    cells = min(MAX_CELLS, max(1, -(-max(demand.values(), default=1) // CELL_ROWS)))
    pieces = pieces.withColumn("cell", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(cells)).cast("int"))
    counts = pieces.groupBy("cls", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("cls").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_CELLS rows
    offsets = settled(counts.select("cls", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    inside = Window.partitionBy("cls", "cell").orderBy("id", "start", "ids_crc32")
    ranked = pieces.withColumn("r", F.row_number().over(inside)).join(bounded(offsets, MAX_CELLS * 256), ["cls", "cell"])
    ranked = ranked.withColumn("rank", F.col("first") + F.col("r") - 1)

    @F.pandas_udf("sequence_id long, slot long")
    def place(cls: pd.Series, rank: pd.Series) -> pd.DataFrame:
        seq, slot = np.zeros(len(cls), dtype=np.int64), np.zeros(len(cls), dtype=np.int64)
        c, r = cls.to_numpy(), rank.to_numpy()
        for k in np.unique(c):
            at = np.flatnonzero(c == k)
            first, count, seq0, slot0 = ranges[int(k)]
            i = np.searchsorted(first, r[at], side="right") - 1
            past = r[at] - first[i]
            seq[at], slot[at] = seq0[i] + past // count[i], slot0[i] + past % count[i]
        return pd.DataFrame({"sequence_id": seq, "slot": slot})

    placed = ranked.withColumn("p", place("cls", "rank"))
    along = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # one sequence
    placed = placed.withColumn("sequence_id", F.col("p.sequence_id")).withColumn("slot", F.col("p.slot"))
    cols = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(along), F.lit(0)).cast("long")).select(F.col("id").alias(id_col), *cols)
