"""Approximate nearest neighbours with robust-pruned directed graphs.

(After Subramanya, Devvrit, Kadekodi, Krishnaswamy and Simhadri, "DiskANN",
2019.) Every row is indexed; rows with equal vectors share one point, that of
the smallest id (``rep``), as copies would only point at each other. The points
are dealt by a hash of their id over shards of about ``SHARD_ROWS``. In each
shard a directed graph is built: from a random graph, greedy searches from fixed entry points propose
neighbours for every point, and robust pruning keeps a candidate only if no
kept neighbour is closer to it by the factor ``alpha``, so edges are diverse.
Reverse edges are added and pruned alike. Two passes, alpha 1 and ``ALPHA``.

A query runs a beam search in every shard, then the shards' best are merged.
The queries of a shard come in blocks of ``QUERY_BLOCK``: a group is one
shard's graph and one block, both bounded, and it returns ``k + 1`` points a
query. A shard's vectors are scaled by a power of two and centred, so that very
large, very small and far-off ones keep their order; the best ``SPARE * k`` of
a shard get their distance on the original values. All is in double precision.
The best ``k + 1`` points of all shards are then replaced by their rows, of which
the ``k + 1`` smallest ids of each point can matter, before ranks are given.

Cases: vectors that are null, empty, zero or hold a null or non-finite
component, and rows with a null id, take no part, neither as queries nor as
candidates. Vectors must have one dimension; those of another than the most
common one are found only by brute force within their own dimension, that is,
each dimension is indexed on its own. Rows with equal vectors, however many, are
candidates like others, of the query's own vector too, and ties go to the
smaller id; of rows with a repeated id the smallest vector
counts. Other columns are ignored. Fewer candidates than ``k``: all are given.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ship, stage

SHARD_ROWS = 4096
DEGREE = 32
BUILD_BEAM = 40
BEAM = 96
ALPHA = 1.1
SPARE = 2
QUERY_BLOCK = 4096
SLICE_ROWS = 65536
_ENTRIES = 4
_BATCH = 512


# -- one shard's graph (numpy inside a task) --------------------------------

def beam_search(vectors, squares, graph, entries, queries, beam: int, visited: bool = False):
    """Beam search for a batch of queries: (ids, squared distances), nearest
    first, and with ``visited`` the expanded points instead of the beam.

    A beam slot without a point has id -1 and infinite distance.
    """
    n, b = len(vectors), len(queries)
    rows = np.arange(b)
    q2 = (queries ** 2).sum(axis=1)

    def distances(ids):
        return np.maximum(squares[ids] + q2[:, None] - 2 * np.einsum("bkd,bd->bk", vectors[ids], queries), 0)

    seen = np.zeros((b, n), bool)
    start = np.unique(entries)
    ids = np.broadcast_to(start, (b, len(start))).copy()
    dist = distances(ids)
    seen[:, start] = True
    pad = beam - ids.shape[1]
    if pad > 0:
        ids = np.concatenate((ids, np.full((b, pad), -1)), axis=1)
        dist = np.concatenate((dist, np.full((b, pad), np.inf)), axis=1)
    order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    done = ids < 0
    trail_ids, trail_dist = [], []
    while True:
        open_ = ~done
        at = open_.argmax(axis=1)
        live = open_[rows, at]
        if not live.any():
            break
        point = np.where(live, ids[rows, at], 0)
        if visited:
            trail_ids.append(np.where(live, point, -1))
            trail_dist.append(np.where(live, dist[rows, at], np.inf))
        done[rows, at] = True
        out = graph[point]
        fresh = (out >= 0) & live[:, None]
        safe = np.where(fresh, out, 0)
        fresh &= ~seen[rows[:, None], safe]
        seen[rows[:, None].repeat(out.shape[1], 1)[fresh], safe[fresh]] = True
        d = np.where(fresh, distances(safe), np.inf)
        ids = np.concatenate((ids, np.where(fresh, safe, -1)), axis=1)
        dist = np.concatenate((dist, d), axis=1)
        done = np.concatenate((done, ~fresh), axis=1)
        order = np.argpartition(dist, beam - 1, axis=1)[:, :beam]
        order = np.take_along_axis(order, np.argsort(np.take_along_axis(dist, order, 1), axis=1, kind="stable"), 1)
        ids, dist, done = (np.take_along_axis(x, order, 1) for x in (ids, dist, done))
    if visited:
        return np.stack(trail_ids, 1), np.stack(trail_dist, 1)
    return ids, dist


def robust_prune(vectors, squares, points, cand, dist, degree: int, alpha: float):
    """Neighbours (-1 padded) of each point from its candidates, diverse edges first kept.

    ``cand`` may hold -1, the point itself and repeats; distances are squared.
    """
    order = np.argsort(np.where(cand < 0, np.inf, dist), axis=1, kind="stable")
    cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
    alive = (cand >= 0) & (cand != points[:, None])
    by_id = np.argsort(cand, axis=1, kind="stable")
    ids = np.take_along_axis(cand, by_id, 1)
    again = np.zeros_like(alive)
    np.put_along_axis(again, by_id[:, 1:], ids[:, 1:] == ids[:, :-1], axis=1)
    alive &= ~again
    safe = np.where(cand < 0, 0, cand)
    x = vectors[safe]
    between = squares[safe][:, :, None] + squares[safe][:, None, :] - 2 * (x @ x.transpose(0, 2, 1))
    rows = np.arange(len(points))
    out = np.full((len(points), degree), -1, np.int64)
    for slot in range(degree):
        at = alive.argmax(axis=1)
        live = alive[rows, at]
        if not live.any():
            break
        out[live, slot] = cand[rows, at][live]
        alive &= ~((alpha * alpha * between[rows, at] <= dist) & live[:, None])
        alive[rows, at] = False
    return out


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA,
                seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entries): neighbours by point, -1 padded, and the entry points."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    squares = (vectors ** 2).sum(axis=1)
    middle = ((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1).argmin()
    entries = np.unique(np.concatenate(([middle], rng.integers(0, n, _ENTRIES - 1))))
    graph = np.full((n, degree), -1, np.int64)
    some = min(degree, n - 1)
    if some:
        graph[:, :some] = (np.arange(n)[:, None] + rng.integers(1, n, (n, some))) % n
    for factor in (1.0, alpha):
        for batch in np.array_split(rng.permutation(n), max(1, -(-n // _BATCH))):
            ids, dist = beam_search(vectors, squares, graph, entries, vectors[batch], beam, visited=True)
            own = graph[batch]
            own_dist = ((vectors[np.where(own < 0, 0, own)] - vectors[batch][:, None]) ** 2).sum(axis=2)
            graph[batch] = robust_prune(vectors, squares, batch, np.concatenate((ids, own), 1),
                                        np.concatenate((dist, own_dist), 1), degree, factor)
            _add_reverse(vectors, squares, graph, batch, degree, factor)
    return graph, entries


def _add_reverse(vectors, squares, graph, batch, degree, alpha):
    """Edges back to the points of ``batch``; where a list is full it is pruned."""
    source = np.repeat(batch, degree)
    target = graph[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    known = (graph[target] == source[:, None]).any(axis=1)
    source, target = source[~known], target[~known]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    while len(target):  # rounds of at most ``degree`` new edges a point
        now = place < degree
        points, row = np.unique(target[now], return_inverse=True)
        cand = np.full((len(points), 2 * degree), -1, np.int64)
        cand[:, :degree] = graph[points]
        cand[row, degree + place[now]] = source[now]
        for part in np.array_split(np.arange(len(points)), max(1, -(-len(points) // _BATCH))):
            c, p = cand[part], points[part]
            room = (c >= 0).sum(axis=1) <= degree
            packed = np.take_along_axis(c, np.argsort(c < 0, axis=1, kind="stable"), 1)[:, :degree]
            graph[p[room]] = packed[room]
            full = ~room
            if full.any():
                c, p = c[full], p[full]
                d = ((vectors[np.where(c < 0, 0, c)] - vectors[p][:, None]) ** 2).sum(axis=2)
                graph[p] = robust_prune(vectors, squares, p, c, d, degree, alpha)
        source, target, place = source[~now], target[~now], place[~now] - degree


# -- Spark ------------------------------------------------------------------

def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vec array<double>) of the rows that take part, one per id."""
    x = F.col(embedding).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & ~bad
                          & F.exists(x, lambda v: v != 0))
            .groupBy(F.col(vec_id).cast("bigint").alias("vec_id")).agg(F.min(x).alias("vec")))


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def _normal(points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with components scaled into -1 .. 1, and the points' centre as origin."""
    largest = max(np.abs(points).max(initial=0), np.abs(queries).max(initial=0))
    exponent = int(np.frexp(largest)[1])
    points = np.ldexp(points, -exponent)
    centre = points.mean(axis=0)
    return points - centre, np.ldexp(queries, -exponent) - centre


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows; where squares could leave the range of
    doubles, on values scaled by a power of two."""
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    exponent = 0 if 1e-140 < largest < 1e140 else int(np.frexp(largest)[1])
    apart = np.ldexp(a, -exponent) - np.ldexp(b, -exponent)
    return np.ldexp(np.sqrt((apart ** 2).sum(axis=1)), exponent)


def _build(degree: int, beam: int, alpha: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", ignore_index=True)
        vectors = _matrix(pdf["vec"])
        vectors, _ = _normal(vectors, vectors[:0])
        graph, entries = build_graph(vectors, degree, beam, alpha)
        pdf["neighbours"] = list(graph.astype(np.int32))
        pdf["place"] = np.arange(len(pdf))
        pdf["entry"] = np.isin(np.arange(len(pdf)), entries)
        return pdf
    return run


def _search(k: int, beam: int):
    def run(key, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": np.zeros(0, np.int64), "rep": np.zeros(0, np.int64), "score": np.zeros(0)}
        if len(points) and len(queries):
            points = points.sort_values("place", ignore_index=True)
            exact = _matrix(points["vec"])
            asked = _matrix(queries["vec"])
            vectors, near = _normal(exact, asked)
            squares = (vectors ** 2).sum(axis=1)
            graph = np.array(points["neighbours"].tolist(), np.int64)
            entries = np.flatnonzero(points["entry"].to_numpy())
            ids = points["rep"].to_numpy()
            parts = []
            for part in np.array_split(np.arange(len(queries)), max(1, -(-len(queries) // _BATCH))):
                q = asked[part]
                query_ids = queries["vec_id"].to_numpy()[part]
                found, _ = beam_search(vectors, squares, graph, entries, near[part], beam)
                found = found[:, :SPARE * k + 1]
                row, at = np.nonzero(found >= 0)
                hit = found[row, at]
                score = _distance(exact[hit], q[row])
                parts.append(pd.DataFrame({"query_id": query_ids[row], "rep": ids[hit], "score": score})
                             .sort_values(["query_id", "score", "rep"]).groupby("query_id").head(k + 1))
            return pd.concat(parts, ignore_index=True)
        return pd.DataFrame(out)
    return run


def build_index(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BUILD_BEAM,
                alpha: float = ALPHA) -> DataFrame:
    """The staged index, one row per usable row: vec_id, vec, dim, rep, and for
    the points (``vec_id = rep``) shard, neighbours, place and entry.

    A shard's number of points does not grow with the table, so neither does
    the work or memory of the task that builds it.
    """
    ship(vectors.sparkSession)
    rows = stage(usable(vectors, vec_id, embedding), "vectors")
    points = stage(rows.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
                   .withColumn("dim", F.size("vec")), "ann-points")
    per_dim = points.groupBy("dim").agg(F.ceil(F.count("*") / F.lit(shard_rows)).alias("shards"))
    sharded = points.join(F.broadcast(per_dim), "dim") \
        .withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards"))).drop("shards", "size")
    graph = sharded.groupBy("dim", "shard").applyInPandas(
        _build(degree, beam, alpha),
        "rep bigint, vec array<double>, dim int, shard bigint, neighbours array<int>, place bigint, entry boolean")
    copies = rows.join(points.where("size > 1").select("vec", "rep", "dim"), "vec").where("vec_id <> rep")
    return stage(graph.withColumn("vec_id", F.col("rep")).unionByName(copies, allowMissingColumns=True), "ann-graph")


def _smallest_ids(index: DataFrame, n: int) -> DataFrame:
    """(rep, vec_id): the ``n`` smallest ids of every point; those of many
    copies are first ranked in slices."""
    sizes = index.groupBy("rep").agg(F.count("*").alias("size"))
    cut = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("size") / F.lit(SLICE_ROWS)))
    some = index.where("vec_id <> rep").select("rep", "vec_id").join(sizes.where("size > 1"), "rep") \
        .withColumn("slice", cut)
    for keys in (["rep", "slice"], ["rep"]):
        some = some.withColumn("at", F.row_number().over(W.partitionBy(*keys).orderBy("vec_id"))) \
            .where(F.col("at") < n)
    return index.where("vec_id = rep").select("rep", "vec_id").union(some.select("rep", "vec_id"))


def search(index: DataFrame, queries: DataFrame, k: int = 10, beam: int = BEAM) -> DataFrame:
    """The ``k`` nearest found of every query (vec_id, vec): query_id, rank, vec_id, score."""
    ship(index.sparkSession)
    queries = stage(queries.select("vec_id", "vec", F.size("vec").alias("dim")), "ann-queries")
    points = index.where("vec_id = rep").drop("vec_id")
    shards = stage(points.select("dim", "shard").distinct(), "shards")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = queries.join(shards, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    held = points.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                           F.lit(blocks - 1).cast("bigint"))))
    keys = ["dim", "shard", "block"]
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)) \
        .applyInPandas(_search(k, beam), "query_id bigint, rep bigint, score double")
    best = found.withColumn("at", F.row_number().over(W.partitionBy("query_id").orderBy("score", "rep"))) \
        .where(F.col("at") <= k + 1)
    rows = best.join(_smallest_ids(index, k + 1), "rep").where("vec_id <> query_id")
    nearest = W.partitionBy("query_id").orderBy("score", "vec_id")
    return rows.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id",
                       embedding: str = "embedding", beam: int = BEAM, **build) -> DataFrame:
    """Index all of ``vectors`` and search with the rows that ``is_query`` selects."""
    index = build_index(vectors, vec_id, embedding, **build)
    return search(index, index.where(is_query).select("vec_id", "vec"), k, beam)
