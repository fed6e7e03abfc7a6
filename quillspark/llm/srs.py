"""Nearest neighbours by inner product through low-dimensional stable projections.

Vectors are lifted so that the largest inner product is the smallest distance (one more coordinate evens out their norms),
and projected on ``dims`` Gaussian directions: the squared projected distance over the squared distance is chi-square
distributed. A kd-tree over a bounded sample's projections cuts the table into cells, and each cell's rows into a kd-tree of
leaves. A query reads its projected neighbours leaf by leaf, nearest leaf first, verifies those whose own projected distance
passes the chi-square test, and stops once a whole leaf fails it: a vector as near as its k-th best would have shown itself
with probability ``confidence``.

A query first searches a shard of its own cell, which gives it a bound, and then only the cells that the bound lets pass.
Equal queries are searched once, and of equal vectors only the ``k + 1`` smallest ids can be among the nearest, so the others
are set aside. The sample (at most ``SAMPLE`` rows) only fits the cells; every vector is indexed. Cells with more rows than
``SHARD`` are cut into shards by a hash of the id. Queries come in blocks of neighbouring cells, about ``QUERIES`` each, and a
shard is copied only to the blocks that ask for it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.common import written

SAMPLE, SHARD, QUERIES, LEAF, CELLS = 16384, 4096, 8192, 64, 4096
#: Slack on sums of floating-point products, relative to the largest norm squared, before scores are computed exactly.
SLACK = 1e-9
_NONE = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})


def chi_square_bound(dims: int, confidence: float) -> float:
    """The quantile of the chi-square distribution with an even number of degrees of freedom, by bisection."""
    half = dims // 2
    lo, hi = 0.0, 50.0 * dims
    for _ in range(200):
        x = (lo + hi) / 2
        term = tail = math.exp(-x / 2)
        for i in range(1, half):
            term *= x / 2 / i
            tail += term
        lo, hi = (x, hi) if 1 - tail < confidence else (lo, x)
    return hi


class Projection:
    """Lifts and projects vectors; ``norm`` is the largest norm in the table."""

    def __init__(self, size: int, norm: float, dims: int, seed: int):
        self.norm = norm
        self.matrix = np.random.default_rng(seed).standard_normal((size + 1, dims))

    def points(self, x: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.norm**2 - (x**2).sum(axis=1), 0.0))
        return x @ self.matrix[:-1] + lift[:, None] * self.matrix[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return (q * (self.norm / np.linalg.norm(q, axis=1))[:, None]) @ self.matrix[:-1]

    def distance(self, score: np.ndarray, q_norm: np.ndarray) -> np.ndarray:
        """Squared distance between a lifted query and vector with this inner product."""
        return np.maximum(2 * self.norm**2 - 2 * self.norm * score / q_norm, 0.0)


def kd_split(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and threshold of each inner node of a complete tree of medians, in heap order from 1."""
    dim, cut = np.zeros(1 << depth, dtype=np.int64), np.zeros(1 << depth)
    rows = {1: np.arange(len(points))}
    for node in range(1, 1 << depth):
        own = rows.pop(node)
        at = points[own]
        if len(own):
            dim[node] = int(np.argmax(at.max(axis=0) - at.min(axis=0)))
            cut[node] = float(np.median(at[:, dim[node]]))
        left = at[:, dim[node]] <= cut[node]
        rows[2 * node], rows[2 * node + 1] = own[left], own[~left]
    return dim, cut


def kd_cell(points: np.ndarray, dim: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The leaf, from 0, that each point falls into."""
    node = np.ones(len(points), dtype=np.int64)
    rows = np.arange(len(points))
    while len(node) and node[0] < len(dim):
        node = 2 * node + (points[rows, dim[node]] > cut[node])
    return node - len(dim)


def kd_order(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of a kd-tree's leaves, and where each leaf begins, with the end: halves along the widest dimension."""
    parts = [np.arange(len(points))]
    while max(map(len, parts)) > leaf:
        split = []
        for p in parts:
            if len(p) <= leaf:
                split.append(p)
                continue
            own = points[p]
            widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            halves = np.argpartition(own[:, widest], len(p) // 2)
            split += [p[halves[: len(p) // 2]], p[halves[len(p) // 2 :]]]
        parts = split
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each query to each box."""
    out = np.zeros((len(q), len(low)))
    for d in range(q.shape[1]):
        gap = np.maximum(np.maximum(low[None, :, d] - q[:, d, None], q[:, d, None] - high[None, :, d]), 0.0)
        out += gap * gap
    return out


def _matrix(values: pd.Series, size: int) -> np.ndarray:
    """Vectors from their bytes, as doubles; floats are kept as they came, and exact."""
    raw = b"".join(values)
    wide = len(raw) == 8 * size * len(values)
    return np.frombuffer(raw, dtype="<f8" if wide else "<f4").reshape(-1, size).astype(float)


def search_shard(queries: pd.DataFrame, vectors: pd.DataFrame, projection: Projection, k: int, bound: float, counted: list[int] | None = None) -> pd.DataFrame:
    """query_id, vec_id, score: the k best of a shard for each query, as far as they reach the bound (kth) that it came with.

    All queries step through the leaves together, each from its nearest on. Of a leaf a query verifies the vectors whose
    projected distance passes the test against its k-th best so far; once a leaf's box fails it, so would all that follow.
    ``counted`` takes the number of verified pairs.
    """
    size = len(projection.matrix) - 1
    x, ids = _matrix(vectors["vec"], size), vectors["id"].to_numpy(np.int64)
    order, begins = kd_order(projection.points(x), LEAF)
    x, ids = np.ascontiguousarray(x[order]), ids[order]
    p = projection.points(x)
    q, q_ids = _matrix(queries["vec"], size), queries["id"].to_numpy(np.int64)
    q_norm, q_points = np.linalg.norm(q, axis=1), projection.queries(q)
    slack = SLACK * projection.norm * q_norm
    away = box_distance(q_points, np.minimum.reduceat(p, begins[:-1]), np.maximum.reduceat(p, begins[:-1]))
    nearest_leaf = np.argsort(away, axis=1)
    kth, best = queries["kth"].to_numpy(float).copy(), np.full((len(q), k), -np.inf)  # the k-th best score known, and the best scores of this shard
    found: list[tuple[np.ndarray, np.ndarray]] = []
    going = np.arange(len(q))
    for step in range(away.shape[1]):
        leaf = nearest_leaf[going, step]
        limit = bound * projection.distance(kth[going], q_norm[going])
        on = away[going, leaf] <= limit
        going, leaf, limit = going[on], leaf[on], limit[on]
        if not len(going):
            break
        by_leaf = np.argsort(leaf, kind="stable")
        for some in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
            rows = going[some]
            a, b = begins[nearest_leaf[rows[0], step]], begins[nearest_leaf[rows[0], step] + 1]
            gap = (q_points[rows] ** 2).sum(axis=1)[:, None] + (p[a:b] ** 2).sum(axis=1)[None, :] - 2 * q_points[rows] @ p[a:b].T
            near = gap <= limit[some][:, None] * (1 + SLACK)
            r, c = np.nonzero(near)
            if counted is not None:
                counted.append(len(r))
            scores = np.full(near.shape, -np.inf)
            # Many pairs of a leaf are one product of matrices, few are products of rows.
            if len(r) * 8 > near.size:
                scores[near] = (q[rows] @ x[a:b].T)[near]
            else:
                scores[r, c] = (q[rows[r]] * x[a + c]).sum(axis=1)
            r, c = np.nonzero((scores >= (kth[rows] - slack[rows])[:, None]) & (scores > -np.inf))
            found.append((rows[r], a + c))
            best[rows] = np.partition(np.concatenate([best[rows], scores], axis=1), -k, axis=1)[:, -k:]
            kth[rows] = np.maximum(kth[rows], best[rows, 0])
    if not found:
        return _NONE.copy()
    row, at = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    exact = np.concatenate([(x[at[i : i + 65536]] * q[row[i : i + 65536]]).sum(axis=1) for i in range(0, max(len(at), 1), 65536)])
    held = exact >= kth[row] - slack[row]
    row, at, exact = row[held], at[held], exact[held]
    order = np.lexsort((ids[at], -exact, row))
    row, at, exact = row[order], at[order], exact[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    top = rank < k
    return pd.DataFrame({"query_id": q_ids[row[top]], "vec_id": ids[at[top]], "score": exact[top]})


def valid(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """id, vec (as doubles), norm2: rows with an id and a vector that is finite and not zero, of the table's usual length.

    The usual length is the most frequent one, of equally frequent ones the smallest; it is read off a count by length.
    """
    v = F.col("vec")
    odd = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    held = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vec"))
    held = held.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(~odd)
    held = held.withColumn("norm2", F.aggregate(v, F.lit(0.0), lambda a, e: a + e * e))
    return held.where((F.col("norm2") > 0) & (F.col("norm2") < float("inf")))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query with their rank, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", column: str = "embedding",
    dims: int = 8, confidence: float = 0.9, seed: int = 11,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k nearest rows found, by inner product, ties to the smaller id.

    ``is_query`` picks the queries among the rows (over the column ``id``). Rows with the query's own id are no candidates;
    fewer than k candidates are all returned. Rows that repeat an id count once, with the least of their vectors, compared
    element by element. Vectors that are null, zero, hold null or non-finite components or have an unusual length take no
    part, neither do null ids. Empty tables give an empty result; further columns are ignored.
    """
    spark = vectors.sparkSession
    schema = "query_id long, vec_id long, score double"
    held = valid(vectors, id_column, column)
    usual = held.groupBy(F.size("vec").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("norm2")).orderBy(F.desc("n"), "size").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = usual["size"]
    held = held.where(F.size("vec") == size).select("id", "vec")
    projection = Projection(size, math.sqrt(usual["norm2"]), dims, seed)
    bound = chi_square_bound(dims, confidence)
    kind = vectors.schema[column].dataType
    dtype = "<f4" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "<f8"

    drawn = np.array([r["vec"] for r in held.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()], dtype=float)
    depth = max(0, math.ceil(math.log2(min(CELLS, max(1, usual["n"] / SHARD)))))
    dim, cut = kd_split(projection.points(drawn), depth)
    axes = [f"p{d}" for d in range(dims)]

    def index(batches):
        for batch in batches:
            x = np.array(batch["vec"].tolist(), dtype=float).reshape(-1, size)
            p = projection.points(x)
            yield pd.concat([pd.DataFrame({"id": batch["id"].to_numpy(), "vec": [r.tobytes() for r in x.astype(dtype)], "cell": kd_cell(p, dim, cut)}), pd.DataFrame(p, columns=axes)], axis=1)

    # Partial aggregates meet before the shuffle, so an id with a third of all rows is no hot group.
    once = held.groupBy("id").agg(F.min("vec").alias("vec"))
    placed = once.mapInPandas(index, "id long, vec binary, cell long, " + ", ".join(f"{a} double" for a in axes))
    placed = written(placed.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), "vec")}), "placed")
    equal = Window.partitionBy("h1", "h2").orderBy("id")
    indexed = written(placed.withColumn("place", F.row_number().over(equal)).where(F.col("place") <= k + 1).drop("h1", "h2", "place"), "vectors")
    # At most CELLS rows come to the driver: the size and the box of each cell, and further down its queries.
    boxes = indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *[f(a).alias(f"{c}{a}") for c, f in (("lo", F.min), ("hi", F.max)) for a in axes]).orderBy("cell").toPandas()
    cells, shards = boxes["cell"].to_numpy(np.int64), np.ceil(boxes["n"].to_numpy(float) / SHARD).astype(np.int64)
    low, high = (boxes[[f"{c}{a}" for a in axes]].to_numpy(float) for c in ("lo", "hi"))
    split = F.broadcast(spark.createDataFrame(pd.DataFrame({"cell": cells, "shards": shards}), "cell long, shards long"))
    shard = F.pmod(F.xxhash64("id"), F.col("shards")).alias("shard")
    stored = indexed.join(split, "cell").select("id", "vec", "cell", shard)

    # Queries of equal vectors are asked once, under the smallest of their ids.
    of_query = placed.where(is_query)
    asked = of_query.withColumn("place", F.row_number().over(equal)).where(F.col("place") == 1).select("id", "vec", "cell", "h1", "h2")
    asked = written(asked.join(split, "cell").select("id", "vec", "cell", "h1", "h2", shard), "queries")
    members = of_query.select(F.col("id").alias("member"), "h1", "h2").join(asked.select(F.col("id").alias("query_id"), "h1", "h2"), ["h1", "h2"]).select("member", "query_id")

    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or rows.empty:
            return _NONE.copy()
        return search_shard(queries, rows, projection, k + 1, bound)

    at_home = asked.select("id", "vec", "cell", "shard", F.lit(float("-inf")).alias("kth"))
    own = written(at_home.groupBy("cell", "shard").cogroup(stored.toDF("id", "vec", "i_cell", "i_shard").groupBy("i_cell", "i_shard")).applyInPandas(search, schema), "own")
    known = own.groupBy("query_id").agg(F.when(F.count(F.lit(1)) > k, F.min("score")).alias("kth"))
    told = asked.join(known, asked["id"] == known["query_id"], "left").select("id", "vec", "cell", "shard", F.coalesce("kth", F.lit(float("-inf"))).alias("kth"))
    told = written(told, "told")
    # Blocks of neighbouring cells in the tree's order; a cell with many queries has several.
    per = told.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").toPandas()
    begin = np.cumsum(per["n"].to_numpy(np.int64)) - per["n"].to_numpy(np.int64)
    first, parts = begin // QUERIES, -(-per["n"].to_numpy(np.int64) // QUERIES)
    first = first + np.concatenate([[0], np.cumsum(parts - 1)[:-1]]) if len(per) else first
    blocks = dict(zip(per["cell"].tolist(), zip(first.tolist(), parts.tolist(), strict=True), strict=True))

    def route(batches):
        """A row for each further shard that a query must see, as the bound from its own shard tells."""
        for batch in batches:
            q, ids = _matrix(batch["vec"], size), batch["id"].to_numpy(np.int64)
            norm, kth = np.linalg.norm(q, axis=1), batch["kth"].to_numpy(float)
            kth = np.where(np.isfinite(kth), kth - SLACK * projection.norm * norm, -np.inf)
            limit = np.where(np.isfinite(kth), bound * projection.distance(np.where(np.isfinite(kth), kth, 0.0), norm), np.inf)
            row, cell = np.nonzero(box_distance(projection.queries(q), low, high) <= limit[:, None])
            times = shards[cell]
            shard = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            home = batch["cell"].to_numpy(np.int64)
            other = (cells[cell] != home[row]) | (shard != batch["shard"].to_numpy(np.int64)[row])
            row, cell, shard = row[other], cell[other], shard[other]
            block = np.array([blocks[c][0] + i % blocks[c][1] for c, i in zip(home.tolist(), ids.tolist(), strict=True)], dtype=np.int64)
            yield pd.DataFrame({"cell": cells[cell], "shard": shard, "block": block[row], "id": ids[row], "vec": batch["vec"].to_numpy()[row], "kth": kth[row]})

    key = ["cell", "shard", "block"]
    routed = told.mapInPandas(route, "cell long, shard long, block long, id long, vec binary, kth double")
    wanted = routed.select(*key).distinct()
    copies = stored.join(wanted, ["cell", "shard"]).select("id", "vec", *key).toDF("id", "vec", "i_cell", "i_shard", "i_block")
    further = routed.groupBy(*key).cogroup(copies.groupBy("i_cell", "i_shard", "i_block")).applyInPandas(search, schema)
    best = _best(own.union(further), k + 1).drop("rank")
    found = members.join(best, "query_id").where("vec_id != member").select(F.col("member").alias("query_id"), "vec_id", "score")
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
