"""Exact top-k search by inner product: a Voronoi kNN join.

Inner products become distances: with M the largest norm of the data, a vector s gets the further
component sqrt(M^2 - |s|^2) and a query q the component 0; then |q - s|^2 = |q|^2 + M^2 - 2 q.s, so
the nearest vectors are those of the largest inner products.

1. *Pivots* are data vectors, the ones of smallest hash. Data and queries go to their nearest pivot's cell.
2. *Summaries*: per data cell its size, its smallest and largest pivot distance and the k + 1 smallest ones;
   per query cell its size and largest pivot distance U. They are all that the driver sees: at most
   ``pivots`` x (k + 5) numbers.
3. *Bounds*. For query cell i, U_i + |p_i p_j| + |p_j s| bounds the distance of any of its queries to a vector
   s of data cell j, so the (k+1)-th smallest of these sums over all summaries, theta_i, bounds every
   query's (k+1)-th neighbour. By the triangle inequality a vector of cell j can only be needed if its
   pivot distance is within |p_i p_j| -+ (U_i + theta_i).
4. *Replication*. Neighbouring query cells form groups; a vector is sent to the groups whose ring for its
   cell holds it. Large groups are cut into blocks of queries and of data, each pair of blocks is solved
   by one matrix product, and the best of the blocks are merged per query.

Equal vectors are one candidate with their k + 1 smallest ids (larger ones can't be in an answer), and one
query, so a vector that a third of all rows share costs no more than any other.

Scores are exact integers: products in doubles while they stay under 2^53, else in Python integers; a
score beyond 64 bits is an error. Bounds on distances have a margin for rounding.

Defined cases: vectors that are null or hold a null, NaN or infinite component take no part; so do null ids.
Equal (id, vector) rows are one row; a query's own row is the one of its id and vector. Vectors of
different lengths are compared as if the shorter one went on with zeros. Ties go to the smaller id. An
empty table or no queries give no rows. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallyhouse.llm.common import KEY, add_key, bounded, settled

PIVOTS = 128
GROUP_QUERIES = 8192  # queries of a group, and of a block of a larger group
BLOCK_VALUES = 1 << 22  # components in a block of data: 65,536 vectors of 64
LEAST_BLOCK = 4096  # smaller blocks aren't worth a task
ANSWER_ROWS = 50_000  # queries whose answers may be broadcast
EXACT = float(1 << 53)


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component x, as longs; null where a component is null or not finite."""
    doubles = F.transform(vector, lambda x: x.cast("double") * F.lit(float(scale)))
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(vector.isNotNull() & fine, F.transform(doubles, lambda x: F.floor(x)))


def _matrix(vectors, width: int, dtype=np.float64) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=dtype)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


@dataclass(frozen=True)
class Pivots:
    """Pivot vectors (one a row), their further component, and the largest norm of the data."""

    vectors: np.ndarray
    extra: np.ndarray
    norm: float

    @property
    def margin(self) -> float:
        return 1e-6 * (1.0 + self.norm)

    def between(self) -> np.ndarray:
        both = np.concatenate([self.vectors, self.extra[:, None]], axis=1)
        sq = (both**2).sum(axis=1)
        return np.sqrt(np.maximum(sq[:, None] + sq[None, :] - 2 * both @ both.T, 0))

    def cells(self, queries: bool):
        """UDF: a vector's nearest pivot and the distance to it."""
        pivots, extra, norm = self.vectors, self.extra, self.norm
        width = pivots.shape[1]

        @pandas_udf("cell int, dist double")
        def f(vectors: pd.Series) -> pd.DataFrame:
            x = _matrix(vectors, max(width, max((len(v) for v in vectors), default=0)))
            sq = (x**2).sum(axis=1)
            own = np.zeros(len(x)) if queries else np.sqrt(np.maximum(norm * norm - sq, 0))
            to = (sq + own**2)[:, None] + (pivots**2).sum(axis=1) + extra**2 - 2 * (x[:, :width] @ pivots.T + np.outer(own, extra))
            cell = to.argmin(axis=1)
            return pd.DataFrame({"cell": cell.astype("int32"), "dist": np.sqrt(np.maximum(to[np.arange(len(x)), cell], 0))})

        return f


def choose_pivots(points: DataFrame, n: int) -> Pivots | None:
    """The ``n`` distinct vectors of smallest hash. None without data."""
    norm = points.agg(F.max("sq").alias("m")).first()["m"]
    if norm is None:
        return None
    found = points.orderBy(*KEY).limit(n).select("v").collect()
    vectors = _matrix([r["v"] for r in found], max(len(r["v"]) for r in found))
    extra = np.sqrt(np.maximum(norm - (vectors**2).sum(axis=1), 0))
    return Pivots(vectors, extra, float(np.sqrt(norm)))


@dataclass
class Plan:
    """Where rows go: rings (group, data cell, least and largest distance) and each group's blocks."""

    group_of: dict[int, int]  # query cell -> group
    rings: list[tuple[int, int, float, float]]
    query_blocks: list[int]
    data_blocks: list[int]


def make_plan(between: np.ndarray, margin: float, queries: dict, data: dict, k: int, group_queries: int, block: int) -> Plan:
    """``queries``: cell -> (rows, U); ``data``: cell -> (rows, least, largest distance, smallest distances)."""
    reach = {}
    for i, (_, far) in queries.items():
        sums = np.concatenate([np.asarray(d[3]) + between[i, j] for j, d in data.items()]) + far
        theta = np.sort(sums)[k] if len(sums) > k else np.inf
        reach[i] = far + theta + margin
    group_of, groups, open_cells = {}, [], set(queries)
    while open_cells:  # a group starts at the fullest cell left and takes the nearest others
        first = max(open_cells, key=lambda c: (queries[c][0], -c))
        members, rows = [], 0
        for c in sorted(open_cells, key=lambda c: (between[first, c], c)):
            if members and rows + queries[c][0] > group_queries:
                break
            members.append(c)
            rows += queries[c][0]
        open_cells -= set(members)
        group_of |= dict.fromkeys(members, len(groups))
        groups.append((members, rows))
    rings, data_blocks = [], []
    for g, (members, _) in enumerate(groups):
        sent = 0
        for j, (rows, least, largest, _) in data.items():
            low = min(between[i, j] - reach[i] for i in members)
            high = max(between[i, j] + reach[i] for i in members)
            if low <= largest and high >= least:
                rings.append((g, j, float(low), float(high)))
                sent += rows
        data_blocks.append(max(1, -(-sent // block)))
    return Plan(group_of, rings, [max(1, -(-rows // group_queries)) for _, rows in groups], data_blocks)


def _ranked(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row the columns of the k best scores, best first; of equal scores the left one first."""
    n = scores.shape[1]
    if scores.dtype != object and np.abs(scores).max(initial=0) < EXACT / (2 * n):
        order = scores * n - np.arange(n)  # exact and without ties
        best = np.argpartition(-order, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(n), (len(scores), 1))
        return np.take_along_axis(best, np.argsort(-np.take_along_axis(order, best, axis=1), axis=1), axis=1)
    return np.stack([np.array(sorted(range(n), key=lambda c: (-row[c], c))[:k], dtype=np.int64) for row in scores])


def _solver(k: int, piece: int = 256):
    """One block: the k best rows of every query, as (query key, vec_id, score, own)."""

    def solve(q: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"k1": [], "k2": [], "vec_id": [], "score": [], "own": []}).astype(
            {"k1": "int64", "k2": "int64", "vec_id": "int64", "score": "int64", "own": "bool"}
        )
        if q.empty or s.empty:
            return empty
        s = s.assign(low=[int(min(x)) for x in s["ids"]]).sort_values("low", kind="stable", ignore_index=True)
        width = max(max(map(len, q["v"])), max(map(len, s["v"])), 1)
        x, y = _matrix(q["v"], width), _matrix(s["v"], width)
        if np.sqrt((x**2).sum(axis=1).max() * (y**2).sum(axis=1).max()) >= EXACT / 4:
            x, y = _matrix(q["v"], width, object), _matrix(s["v"], width, object)
        ids, keys = s["ids"].tolist(), list(zip(s[KEY[0]], s[KEY[1]], strict=True))
        out = []
        for at in range(0, len(q), piece):
            scores = x[at : at + piece] @ y.T
            best = _ranked(scores, min(k, len(s)))
            for r, cols in enumerate(best):
                own = (q[KEY[0]].iat[at + r], q[KEY[1]].iat[at + r])
                rows = sorted((-int(scores[r, c]), int(i), keys[c] == own) for c in cols.tolist() for i in ids[c])[:k]
                out += [(*own, i, -score, same) for score, i, same in rows]
        if any(abs(row[3]) >= 1 << 63 for row in out):
            raise OverflowError("a score doesn't fit into 64 bits")
        return pd.DataFrame(out, columns=list(empty.columns)).astype(dict(empty.dtypes)) if out else empty

    return solve


def top_k(
    data: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
    pivots: int = PIVOTS,
    group_queries: int = GROUP_QUERIES,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """The ``k`` best rows of ``data`` for every row of ``queries`` (own row left out): query_id, rank, vec_id, score."""
    spark = data.sparkSession

    def rows_of(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), quantised(F.col(f"`{vector}`"), scale).alias("v"))
        rows = add_key(rows.where("id IS NOT NULL AND v IS NOT NULL"), "v")
        return rows.groupBy("id", *KEY).agg(F.any_value("v").alias("v"))  # rows repeated in full are one

    few = Window.partitionBy(*KEY).orderBy("id")
    kept = rows_of(data).withColumn("r", F.row_number().over(few)).where(F.col("r") <= k + 1)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    points = kept.groupBy(*KEY).agg(F.any_value("v").alias("v"), F.collect_list("id").alias("ids"))  # k + 1 ids at most
    points = settled(points.withColumn("sq", square))
    asked = settled(rows_of(queries).select("id", *KEY, "v"))
    chosen = choose_pivots(points, pivots)
    if chosen is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    cell = F.col("at.cell").alias("cell"), F.col("at.dist").alias("dist")
    points = settled(points.withColumn("at", chosen.cells(queries=False)("v")).select(*KEY, "v", "ids", *cell))
    distinct = asked.groupBy(*KEY).agg(F.any_value("v").alias("v"))
    distinct = settled(distinct.withColumn("at", chosen.cells(queries=True)("v")).select(*KEY, "v", *cell))
    plan = summaries_plan(points, distinct, chosen, k, group_queries, block_values)
    best = solve_blocks(points, distinct, plan, k + 1)
    answers = best.groupBy(*KEY).agg(F.collect_list(F.struct("rank", "vec_id", "score", "own")).alias("all"))  # k + 1 at most
    answered = asked.select("id", *KEY).join(bounded(settled(answers), ANSWER_ROWS), KEY)
    others = F.array_sort(F.filter("all", lambda a: ~(a["own"] & (a["vec_id"] == F.col("id")))))
    ranked = answered.select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("pos", "a"))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("a.vec_id").alias("vec_id"), F.col("a.score").alias("score"))


def summaries_plan(points: DataFrame, distinct: DataFrame, chosen: Pivots, k: int, group_queries: int, block_values: int) -> Plan:
    """Cell summaries gathered by Spark (one row a cell, and k + 1 distances a cell), and the plan from them."""
    near = Window.partitionBy("cell").orderBy("dist")
    least = points.select("cell", "dist").withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1)
    smallest = {r["cell"]: sorted(r["d"]) for r in least.groupBy("cell").agg(F.collect_list("dist").alias("d")).collect()}
    cells = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("a"), F.max("dist").alias("b")).collect()
    data = {r["cell"]: (r["n"], r["a"], r["b"], smallest[r["cell"]]) for r in cells}
    cells = distinct.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("b")).collect()
    queries = {r["cell"]: (r["n"], r["b"]) for r in cells}
    most = max(LEAST_BLOCK, block_values // max(chosen.vectors.shape[1], 1))
    rows = sum(d[0] for d in data.values())
    # blocks as large as memory allows, but enough of them for the cluster's cores
    block = min(most, max(LEAST_BLOCK, rows // (2 * points.sparkSession.sparkContext.defaultParallelism)))
    return make_plan(chosen.between(), chosen.margin, queries, data, k, group_queries, block)


def _frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def solve_blocks(points: DataFrame, distinct: DataFrame, plan: Plan, k: int) -> DataFrame:
    """(query key, rank, vec_id, score, own): the k best rows of every distinct query vector."""
    spark = points.sparkSession
    blocks = list(enumerate(zip(plan.query_blocks, plan.data_blocks, strict=True)))
    rings = [(j, low, high, g, *dict(blocks)[g]) for g, j, low, high in plan.rings]
    cells = [(c, g, *dict(blocks)[g]) for c, g in plan.group_of.items()]
    ring = bounded(_frame(spark, rings, "cell int, low double, high double, g int, qn int, dn int"))
    cell = bounded(_frame(spark, cells, "cell int, g int, qn int, dn int"))  # at most one row a pivot
    place = lambda n: F.pmod(F.col(KEY[0]), F.col(n)).cast("int")
    sent = points.join(ring, "cell").where("dist >= low AND dist <= high")
    sent = sent.select(*KEY, "v", "ids", "g", place("dn").alias("db"), F.explode(F.sequence(F.lit(0), F.col("qn") - 1)).alias("qb"))
    wants = distinct.join(cell, "cell")
    wants = wants.select(*KEY, "v", "g", place("qn").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("dn") - 1)).alias("db"))
    at = ["g", "qb", "db"]
    solved = wants.groupBy(*at).cogroup(sent.groupBy(*at)).applyInPandas(
        _solver(k), "k1 long, k2 long, vec_id long, score long, own boolean"
    )
    order = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id")
    ranked = solved.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("k1").alias(KEY[0]), F.col("k2").alias(KEY[1]), "rank", "vec_id", "score", "own")
