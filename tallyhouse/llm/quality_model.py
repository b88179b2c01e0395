"""Quality classifier: a sparse ensemble of conjunctive rules.

1. Statistics of a text are column expressions (JVM-side, whole text).
2. On a bounded sample of labelled rows (``MAX_TRAIN_ROWS``, picked by a hash of the id) shallow
   trees are grown on bootstrap samples and random subsets of the statistics; every path of a
   tree is a conjunctive rule.
3. Lasso logistic regression (accelerated proximal gradient) weighs the rules; most get zero.
4. The rules that are left are compiled into one column expression, so scoring all documents
   is a projection without shuffle or Python.

Defined cases: null and empty texts have zero statistics and are scored like any other; labels
that are null or without a document aren't learned, of several labels of an id the largest
counts; without labels of both kinds the score is the share of ones (0.5 if none); ids that are
null are never learned and not held out; repeated rows score alike; extra columns stay.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import SPACE_CHARS, own_columns, shield, with_result
from tallyhouse.llm.language_id import fold

MAX_TRAIN_ROWS = 20_000
TREES, DEPTH, CUTS = 40, 3, 16
SEED = 11
LASSO = 2e-3
FEATURES = [
    "log_words", "word_length", "upper", "symbols", "bangs", "digits", "letters", "stops", "distinct", "adjacent", "line_words", "line_repeats",
]

Rule = tuple[tuple[str, bool, float], ...]  # (feature, at most?, threshold)


def with_statistics(docs: DataFrame, text: str, out: str = "_th_f") -> DataFrame:
    """Add the struct ``out`` of FEATURES."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    d = docs.withColumn("_th_t", t).withColumn("_th_b", F.btrim(t, F.lit(SPACE_CHARS)))
    d = d.withColumn("_th_w", F.when(F.col("_th_b") == "", F.array().cast("array<string>")).otherwise(F.split("_th_b", r"[\x20\x09-\x0D]+")))
    d = d.withColumn("_th_l", F.filter(F.split("_th_t", "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""))
    w, t = F.col("_th_w"), F.col("_th_t")
    n, chars = F.size(w), F.length(t)
    solid = F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", ""))
    count = lambda cls: chars - F.length(F.regexp_replace(t, f"[{cls}]+", ""))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    again = F.size(F.filter(F.transform(w, lambda x, i: x == F.get(w, i + 1)), lambda x: F.coalesce(x, F.lit(False))))
    values = {
        "log_words": F.log1p(n),
        "word_length": share(solid, n),
        "upper": share(count(r"\p{Lu}"), solid),
        "symbols": share(count(r"#*$%&|<>"), solid),
        "bangs": share(count("!?"), solid),
        "digits": share(count("0-9"), solid),
        "letters": share(count(r"\p{L}"), solid),
        "stops": share(count(".,;:"), n),
        "distinct": share(F.size(F.array_distinct(w)), n),
        "adjacent": share(again, n),
        "line_words": share(n, F.size("_th_l")),
        "line_repeats": share(F.size("_th_l") - F.size(F.array_distinct("_th_l")), F.size("_th_l")),
    }
    d = d.withColumn(out, F.struct(*[values[k].cast("double").alias(k) for k in FEATURES]))
    return d.drop("_th_t", "_th_b", "_th_w", "_th_l")


def grow(x: np.ndarray, y: np.ndarray, columns: np.ndarray, depth: int, path: Rule = ()) -> list[Rule]:
    """The paths of one tree (Gini splits at quantiles), inner nodes included."""
    found = [path] if path else []
    if depth == 0 or len(y) < 20 or y.min() == y.max():
        return found
    best = (y.var() * len(y) - 1e-9, None, None)
    for j in columns:
        for cut in np.unique(np.quantile(x[:, j], np.linspace(0, 1, CUTS + 2)[1:-1])):
            low = x[:, j] <= cut
            k = int(low.sum())
            if 5 <= k <= len(y) - 5:
                a, b = y[low].mean(), y[~low].mean()
                loss = k * a * (1 - a) + (len(y) - k) * b * (1 - b)
                if loss < best[0]:
                    best = (loss, j, float(cut))
    if best[1] is None:
        return found
    low = x[:, best[1]] <= best[2]
    for side in (True, False):
        at = low if side else ~low
        found += grow(x[at], y[at], columns, depth - 1, (*path, (FEATURES[best[1]], side, best[2])))
    return found


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for name, low, cut in rule:
        v = x[:, FEATURES.index(name)] <= cut
        out &= v if low else ~v
    return out


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """(intercept, weights) by accelerated proximal gradient; the intercept isn't penalised."""
    a = np.column_stack([np.ones(len(z)), z])
    step = 4 * len(y) / max(np.linalg.norm(a, 2) ** 2, 1e-9)
    w = v = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        grad = a.T @ (1 / (1 + np.exp(-np.clip(a @ v, -30, 30))) - y) / len(y)
        new = v - step * grad
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, seed: int = SEED, penalty: float = LASSO) -> tuple[float, list[tuple[Rule, float]]]:
    """(intercept, rules with non-zero weight)."""
    if not len(y) or y.min() == y.max():
        p = min(max(float(y.mean()), 0.01), 0.99) if len(y) else 0.5
        return float(np.log(p / (1 - p))), []
    rng = np.random.default_rng(seed)
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        rows = rng.integers(0, len(y), min(len(y), 4000))
        columns = rng.choice(len(FEATURES), size=max(2, len(FEATURES) // 2), replace=False)
        rules |= dict.fromkeys(grow(x[rows], y[rows], columns, DEPTH))
    names = list(rules)
    z = np.column_stack([holds(r, x) for r in names]).astype(float)
    intercept, weights = lasso_logistic(z, y, penalty)
    return intercept, [(r, float(w)) for r, w in zip(names, weights, strict=True) if abs(w) > 1e-6]


def compile_rules(intercept: float, rules: list[tuple[Rule, float]], features: str) -> Column:
    """The score as a column expression over the struct ``features``."""
    total = F.lit(intercept)
    for rule, weight in rules:
        cond = F.lit(True)
        for name, low, cut in rule:
            c = F.col(f"{features}.{name}")
            cond = cond & ((c <= cut) if low else (c > cut))
        total = total + F.when(cond, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def score_quality(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", label_id: str = "doc_id",
    out: str = "_quality_score", folds: int = 5, held_out: int = 0, threshold: float = 0.3, max_train_rows: int = MAX_TRAIN_ROWS,
) -> DataFrame:
    """``docs`` with a struct ``out``: held_out, score, predicted. Labels of the held-out fold are not learned."""
    known = labels.select(F.col(f"`{label_id}`").alias("_th_id"), F.col(f"`{label}`").cast("double").alias("_th_y"))
    known = known.where(F.col("_th_id").isNotNull() & F.col("_th_y").isNotNull() & (fold("_th_id", folds) != held_out))
    # labels of other documents must not use up the sample
    known = known.groupBy("_th_id").agg(F.max("_th_y").alias("_th_y")).join(docs.select(F.col(f"`{id_col}`").alias("_th_id")), "_th_id", "left_semi")
    known = known.orderBy(F.xxhash64("_th_id"), "_th_id").limit(max_train_rows)
    sample = docs.select(F.col(f"`{id_col}`").alias("_th_id"), F.col(f"`{text}`").alias("_th_text"))
    sample = sample.join(F.broadcast(known), "_th_id")  # at most max_train_rows rows
    sample = with_statistics(sample, "_th_text").select("_th_id", "_th_y", "_th_f").dropDuplicates(["_th_id"])
    got = sample.orderBy("_th_id").select("_th_y", "_th_f.*").toPandas()
    intercept, rules = fit(got[FEATURES].to_numpy(dtype=float), got["_th_y"].to_numpy(dtype=float))
    d, names = shield(docs)
    d = with_statistics(d, names[text]).withColumn("_th_s", compile_rules(intercept, rules, "_th_f"))
    result = F.struct(
        F.coalesce(fold(names[id_col], folds) == held_out, F.lit(False)).alias("held_out"),
        F.col("_th_s").alias("score"),
        (F.col("_th_s") >= threshold).cast("int").alias("predicted"),
    )
    return with_result(d, own_columns(names, out), result, out)
