"""Language identification with hyperdimensional profiles.

Every letter has a random +1/-1 vector drawn from its code point. An n-gram binds the vectors of its
letters, each permuted by its place (product of rotated vectors); a text bundles the vectors of
all its n-grams (sum). The prototype of a language bundles its training texts; a text gets the language
whose prototype has the greatest cosine with it.

Training: every partition bundles its texts per language; Spark adds the partial bundles
(languages x dimensions numbers). Prediction: an Arrow batch UDF over whole texts. Nothing is
shuffled but the partial bundles, so no key can be hot. The prototypes (8 bytes x dimensions x
languages) travel with the UDF; ``MAX_LANGUAGES`` bounds them and is checked.

Defined cases: null text or text without a letter is ``und`` with score 0; rows with null language or id are
never learned; with nothing to learn from every text is ``und``; repeated rows count as often as
they occur; extra columns stay.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import own_columns, shield

DIM = 512
NGRAM = 3
SEED = 20_011
BLOCK = 32  # texts bundled by one matrix product
COLUMNS = 8192
MAX_LANGUAGES = 10_000
SPACE = 32


def ngrams(text: str | None, letters: "Letters") -> np.ndarray | None:
    """Codes of the n-grams of a text (letters lower-cased, all else one space), None without a letter."""
    if not text:
        return None
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ok = letters.is_letter(a)
    if not ok.any():
        return None
    a = np.where(ok, a, SPACE).astype(np.uint64)
    a = np.concatenate([[SPACE], a, [SPACE]]).astype(np.uint64)
    a = a[np.concatenate([[True], ~((a[1:] == SPACE) & (a[:-1] == SPACE))])]
    return (a[:-2] << np.uint64(42)) | (a[1:-1] << np.uint64(21)) | a[2:]


class Letters:
    """Vectors of letters and n-grams; the same in every process."""

    def __init__(self, dim: int):
        self.dim, self.known = dim, {}
        self.kind = np.full(sys.maxunicode + 1, -1, dtype=np.int8)  # -1: not asked yet

    def is_letter(self, codes: np.ndarray) -> np.ndarray:
        kind = self.kind[codes]
        if (kind < 0).any():
            for c in np.unique(codes[kind < 0]).tolist():
                self.kind[c] = chr(c).isalpha()
            kind = self.kind[codes]
        return kind == 1

    def letter(self, code: int) -> np.ndarray:
        if code not in self.known:
            self.known[code] = np.random.default_rng([SEED, code]).integers(0, 2, self.dim, dtype=np.int8) * np.int8(2) - np.int8(1)
        return self.known[code]

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """One row per n-gram code: rotated letter vectors multiplied."""
        out = None
        mask = np.uint64((1 << 21) - 1)
        for place in range(NGRAM):
            letters, inv = np.unique((codes >> np.uint64(21 * place)) & mask, return_inverse=True)
            rotated = np.stack([np.roll(self.letter(int(c)), place) for c in letters])[inv]
            out = rotated if out is None else out * rotated
        return out

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """counts (rows x codes) times the n-gram vectors."""
        total = np.zeros((len(counts), self.dim))
        for i in range(0, len(codes), COLUMNS):
            total += counts[:, i : i + COLUMNS].astype(np.float32) @ self.vectors(codes[i : i + COLUMNS]).astype(np.float32)
        return total


def bundles(texts: list, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """(vector per text, whether it has a letter)."""
    vec, some = np.zeros((len(texts), letters.dim)), np.zeros(len(texts), dtype=bool)
    for lo in range(0, len(texts), BLOCK):
        grams = [ngrams(t, letters) for t in texts[lo : lo + BLOCK]]
        at = [i for i, g in enumerate(grams) if g is not None]
        if not at:
            continue
        codes, inv = np.unique(np.concatenate([grams[i] for i in at]), return_inverse=True)
        owner = np.repeat(np.arange(len(at)), [len(grams[i]) for i in at])
        counts = np.bincount(owner * len(codes) + inv, minlength=len(at) * len(codes)).reshape(len(at), len(codes))
        vec[[lo + i for i in at]] = letters.bundle(codes, counts)
        some[[lo + i for i in at]] = True
    return vec, some


def train(docs: DataFrame, learn: Column, text: str, lang: str, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """(languages, prototypes) from the rows where ``learn`` holds."""

    def partial(batches):
        seen: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        letters = Letters(dim)
        for b in batches:
            for name, part in b.groupby("lang")["text"]:
                pending, size = [], 0
                texts = list(part)
                for i, t in enumerate(texts):
                    g = ngrams(t, letters)
                    if g is not None:
                        pending.append(g)
                        size += len(g)
                    if pending and (size > 1 << 21 or i == len(texts) - 1):
                        codes, n = np.unique(np.concatenate(pending), return_counts=True)
                        if name in seen:
                            codes, inv = np.unique(np.concatenate([seen[name][0], codes]), return_inverse=True)
                            n = np.bincount(inv, weights=np.concatenate([seen[name][1], n]))
                        seen[name] = (codes, n)
                        pending, size = [], 0
        for name, (codes, n) in seen.items():
            v = np.zeros(dim)
            for i in range(0, len(codes), COLUMNS):
                v += n[i : i + COLUMNS] @ letters.vectors(codes[i : i + COLUMNS])
            yield pd.DataFrame({"lang": name, "i": np.arange(dim), "v": np.rint(v).astype("int64")})

    rows = docs.where(learn & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    rows = rows.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    summed = rows.mapInPandas(partial, "lang string, i int, v long").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    got = summed.limit(MAX_LANGUAGES * dim + 1).toPandas()
    if len(got) > MAX_LANGUAGES * dim:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    names = sorted(got["lang"].unique())
    protos = np.zeros((len(names), dim))
    protos[[names.index(x) for x in got["lang"]], got["i"].to_numpy()] = got["v"].to_numpy(dtype=float)
    return names, protos / np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-9)


def predict_udf(names: list[str], protos: np.ndarray, dim: int = DIM):
    @F.pandas_udf("lang_pred string, score double")
    def f(texts: pd.Series) -> pd.DataFrame:
        letters = Letters(dim)
        out_lang, out_score = [], []
        for lo in range(0, len(texts), 1024):
            part = [t if isinstance(t, str) else None for t in texts[lo : lo + 1024]]
            vec, some = bundles(part, letters)
            if names:
                cos = vec @ protos.T / np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-9)
                best = cos.argmax(axis=1)
                top = np.clip(cos[np.arange(len(part)), best], 0, 1)
            else:
                some[:] = False
            out_lang += [names[best[i]] if some[i] else "und" for i in range(len(part))]
            out_score += [float(top[i]) if some[i] else 0.0 for i in range(len(part))]
        return pd.DataFrame({"lang_pred": pd.Series(out_lang, dtype="str"), "score": pd.Series(out_score, dtype="float64")})

    return f


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds


def identify(
    docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", out: str = "_language",
    folds: int = 4, held_out: int = 2, dim: int = DIM,
) -> DataFrame:
    """``docs`` with a struct ``out``: held_out, lang_pred, score. Rows of the held-out fold are not learned."""
    learn = F.coalesce(fold(id_col, folds) != held_out, F.lit(False))
    names, protos = train(docs, learn, text, lang, dim)
    d, own = shield(docs)
    named = d.withColumn("_th_p", predict_udf(names, protos, dim)(F.col(own[text])))
    held = F.coalesce(fold(own[id_col], folds) == held_out, F.lit(False))
    result = F.struct(held.alias("held_out"), F.col("_th_p.lang_pred").alias("lang_pred"), F.col("_th_p.score").alias("score"))
    return named.select(*own_columns(own, out), result.alias(out))
