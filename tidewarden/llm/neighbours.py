"""Nearest neighbours by inner product with vantage-point trees.

Vectors are dealt by a hash of their id to shards of about SHARD_ROWS rows; each shard becomes one tree. Inner products are
turned into distances by the usual lift: with M the largest norm, x becomes (x, sqrt(M^2 - |x|^2)) and q becomes (q, 0),
and then a larger inner product is a smaller distance, for which the triangle inequality holds. A subtree whose distances
to the vantage point lie in [lo, hi] is pruned for a query at distance v when relax * max(v - hi, lo - v) exceeds the
query's k-th distance; relax = 1 is exact, larger values prune more. Queries run in blocks against each tree: a query first
visits its home leaf for a bound, then the whole block walks the tree once.

Leaves are scanned with a matrix product; whatever comes within rounding of a query's k-th score is scored again term by
term in double precision, so that scores and ties don't depend on shapes or shards. Identical vectors of a shard are one
point with its k + 1 smallest ids, which is all that ties can ever need: thousands of copies don't deepen a tree.

Defined results: null, zero and non-finite vectors, and ones with null components, take no part; a query meets candidates
of its own length only; a null vec_id takes no part; repeated (vec_id, vector) rows are one candidate and one
query; a query id of several vectors is searched with each, and its k best hits are of all of them; fewer candidates than k give fewer rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

K = 20
EVERY = 20
SHARD_ROWS = 4096
BLOCK_ROWS = 1024
LEAF = 128
RELAX = 1.0
EPS = 1e-9


def vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v, dim, norm2) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    ok = df.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    )
    return ok.withColumn("dim", F.size("v")).withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed from the first component to the last."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def build(ids: np.ndarray, x: np.ndarray, top: float, k: int = K, leaf: int = LEAF) -> dict:
    """A tree over the distinct vectors of a shard. top: M^2."""
    order = np.lexsort((ids, *x.T[::-1]))
    x, ids = x[order], ids[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]).any(axis=1)
    start = np.nonzero(new)[0]
    group = np.cumsum(new) - 1
    keep = np.ones(len(ids), bool)
    keep[1:] = new[1:] | (ids[1:] != ids[:-1])  # repeated rows
    place = np.cumsum(keep) - 1
    keep &= place - place[start][group] <= k
    points = x[start]
    lifted = np.hstack([points, np.sqrt(np.maximum(top - (points * points).sum(1), 0))[:, None]])
    perm, nodes = np.arange(len(points)), []

    def grow(a: int, b: int, spread: np.random.Generator) -> int:
        at = len(nodes)
        nodes.append(None)
        if b - a <= leaf:
            nodes[at] = (a, b, -1, None)
            return at
        v = perm[spread.integers(a, b)]
        d = np.sqrt(((lifted[perm[a:b]] - lifted[v]) ** 2).sum(1))
        by = np.argsort(d, kind="stable")
        perm[a:b], d = perm[a:b][by], d[by]
        m = (b - a) // 2
        kids = [(grow(a, a + m, spread), d[0], d[m - 1]), (grow(a + m, b, spread), d[m], d[-1])]
        nodes[at] = (a, b, v, kids)
        return at

    grow(0, len(points), np.random.default_rng(len(points)))
    counts = np.bincount(group[keep], minlength=len(points))
    return {"nodes": nodes, "perm": perm, "x": points, "lifted": lifted, "ids": ids[keep], "first": np.cumsum(counts) - counts, "n": counts, "top": top}


class _Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.s, self.i = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        self.len2 = (q * q).sum(1)
        self.size = np.sqrt(self.len2)

    def scan(self, tree: dict, a: int, b: int, active: np.ndarray) -> None:
        rows = tree["perm"][a:b]
        slack = EPS * (1 + self.size[active] * np.sqrt(tree["top"]))
        near = self.q[active] @ tree["x"][rows].T >= (self.s[active, -1] - slack)[:, None]
        qi, pi = np.nonzero(near)
        if not len(qi):
            return
        qi, point = active[qi], rows[pi]
        score = exact_scores(self.q[qi], tree["x"][point])
        n = tree["n"][point]
        every = np.repeat(tree["first"][point] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        qi, score, ids = np.repeat(qi, n), np.repeat(score, n), tree["ids"][every]
        other = ids != self.ids[qi]
        qi, score, ids = qi[other], score[other], ids[other]
        who = np.unique(qi)
        qi, score, ids = np.concatenate([np.repeat(who, self.k), qi]), np.concatenate([self.s[who].ravel(), score]), np.concatenate([self.i[who].ravel(), ids])
        order = np.lexsort((ids, -score, qi))
        qi, score, ids = qi[order], score[order], ids[order]
        start = np.searchsorted(qi, who)
        take = start[:, None] + np.arange(self.k)
        self.s[who], self.i[who] = score[take], ids[take]

    def reach(self, tree: dict, active: np.ndarray) -> np.ndarray:
        """Distance of the k-th best; infinite while there are fewer."""
        return np.sqrt(np.maximum(self.len2[active] + tree["top"] - 2 * self.s[active, -1], 0))


def search(tree: dict, ids: np.ndarray, q: np.ndarray, k: int = K, relax: float = RELAX) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of each query's k best in the tree; missing ones score -inf."""
    best, nodes = _Best(ids, q, k), tree["nodes"]
    lifted = np.hstack([q, np.zeros((len(q), 1))])
    margin = EPS * (1 + best.size + np.sqrt(tree["top"]))
    home = np.full(len(q), -1)

    def to(at: int, active: np.ndarray) -> np.ndarray:
        return np.sqrt(((lifted[active] - tree["lifted"][nodes[at][2]]) ** 2).sum(1))

    stack = [(0, np.arange(len(q)))]
    while stack:  # each query to one leaf
        at, active = stack.pop()
        a, b, v, kids = nodes[at]
        if v < 0:
            home[active] = at
            best.scan(tree, a, b, active)
            continue
        d = to(at, active)
        inner = d <= (kids[0][2] + kids[1][1]) / 2
        stack += [(kids[j][0], part) for j, part in ((0, active[inner]), (1, active[~inner])) if len(part)]
    stack = [(0, np.arange(len(q)))]
    while stack:
        at, active = stack.pop()
        a, b, v, kids = nodes[at]
        if v < 0:
            active = active[home[active] != at]
            if len(active):
                best.scan(tree, a, b, active)
            continue
        d, reach = to(at, active), best.reach(tree, active)
        for child, lo, hi in kids:
            bound = relax * np.maximum(np.maximum(d - hi, lo - d), 0)
            part = active[bound <= reach + margin[active]]
            if len(part):
                stack.append((child, part))
    return best.i, best.s


def nearest(df: DataFrame, is_query, k: int = K, relax: float = RELAX, shard_rows: int = SHARD_ROWS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score). is_query: a column over vec_id."""
    vecs = vectors(df, key, vector)
    sizes = {r["dim"]: r for r in vecs.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("top"), F.count_if(is_query).alias("q")).collect()}
    if not sizes:
        sizes = {0: {"n": 0, "top": 0.0, "q": 0}}
    n_shards = {d: max(1, -(-r["n"] // shard_rows)) for d, r in sizes.items()}
    n_blocks = {d: max(1, -(-r["q"] // BLOCK_ROWS)) for d, r in sizes.items()}
    tops = {d: r["top"] * (1 + 1e-12) for d, r in sizes.items()}

    def by_dim(counts: dict[int, int]):
        return F.element_at(F.create_map(*[F.lit(x) for pair in counts.items() for x in pair]), F.col("dim"))

    def grown(pdf: pd.DataFrame) -> pd.DataFrame:
        d = int(pdf["dim"].iloc[0])
        tree = build(pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()).astype(np.float64), tops[d], k)
        return pd.DataFrame({"dim": [d], "shard": [int(pdf["shard"].iloc[0])], "tree": [pickle.dumps(tree)]})

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        data = pickle.dumps((pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()).astype(np.float64)))
        return pd.DataFrame({"dim": [int(pdf["dim"].iloc[0])], "queries": [data]})

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tree, queries in zip(batch["tree"], batch["queries"]):
                ids, q = pickle.loads(queries)
                i, s = search(pickle.loads(tree), ids, q, k, relax)
                got = np.isfinite(s)
                yield pd.DataFrame({"query_id": np.repeat(ids, got.sum(1)), "vec_id": i[got], "score": s[got]})

    dealt = vecs.select("vec_id", "v", "dim", F.pmod(F.xxhash64("vec_id"), by_dim(n_shards)).cast("int").alias("shard"))
    trees = dealt.groupBy("dim", "shard").applyInPandas(grown, "dim int, shard int, tree binary")
    asked = vecs.where(is_query).select("vec_id", "v", "dim", F.pmod(F.xxhash64("vec_id", "v", F.lit(7)), by_dim(n_blocks)).cast("int").alias("block"))
    asked = asked.dropDuplicates(["vec_id", "v"])
    blocks = asked.groupBy("dim", "block").applyInPandas(packed, "dim int, queries binary")
    blocks = blocks.select("dim", "queries", F.explode(F.sequence(F.lit(0), by_dim(n_shards) - 1)).alias("shard"))
    hits = trees.join(blocks, ["dim", "shard"]).select("tree", "queries").mapInPandas(found, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


OP10_SQL = """
WITH e AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x != 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
      FROM e q JOIN e c ON c.vec_id != q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20
"""
