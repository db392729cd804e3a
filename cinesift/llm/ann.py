"""Approximate nearest neighbours over balanced posting lists.

* Centroids come from a balanced hierarchical 2-means over a bounded sample (``SAMPLE_ROWS``);
  their number follows the number of vectors, up to ``MAX_CENTROIDS`` (bounded, so the model
  can be broadcast).
* A small-world graph over the centroids is searched in memory, by a beam, for whole batches.
* Every vector is in the list of its nearest centroid, and boundary vectors are replicated to
  further lists whose centroid is hardly farther (ratio ``REPLICA_RATIO``).
* A query reads the lists whose centroid is within a *ratio* of its nearest one's distance, and
  at least enough of them to hold ``LEAST_CANDIDATES``. The ratio is measured: ``CALIBRATION_QUERIES`` queries
  are compared with brute force over all rows, and it is the one that brings ``TARGET_RECALL`` of
  their true neighbours' lists in. The graph's beam widens until its last centroid is beyond the
  ratio, so no number of lists is a limit.
* Lists are read in bins of several, a query coming to a bin once. Bins with more than
  ``SHARD_ROWS`` rows are cut into shards, so neither a common vector nor a crowded region is
  one task; a shard returns its nearest ``k`` for each query.

All distances that rank results are Euclidean in double precision on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinesift.llm.common import shipped, written

SAMPLE_ROWS = 20_000
MAX_CENTROIDS = 8_192
LIST_ROWS = 64
REPLICA_RATIO = 1.10
MAX_REPLICAS = 4
# Where there is nothing to measure the ratio with.
PROBE_RATIO = 1.35
BEAM = 96
LEAST_CANDIDATES = 256
SHARD_ROWS = 4_096
DEGREE = 16
CALIBRATION_QUERIES = 64
TARGET_RECALL = 0.95
_LEAST_BINS = 256
_BATCH = 512


@dataclass
class Centroids:
    points: np.ndarray
    graph: np.ndarray  # neighbours of each centroid
    entries: np.ndarray

    def nearest(self, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest centroids found for each vector, nearest first (-1: no more), and
        their distances: best-first search of the graph, all vectors of a batch at once."""
        n, beam = len(vectors), min(beam, len(self.points))
        at_once = max(4, beam // 8)
        rows = np.arange(n)[:, None]
        seen = np.zeros((n, len(self.points)), bool)
        seen[:, self.entries] = True
        ids = np.broadcast_to(self.entries, (n, len(self.entries))).copy()
        far = self._distances(vectors, ids)
        done = np.zeros(ids.shape, bool)
        while True:
            keep = np.argsort(far, axis=1, kind="stable")[:, :beam]
            ids, far, done = ids[rows, keep], far[rows, keep], done[rows, keep]
            open_far = np.where(done | np.isinf(far), np.inf, far)
            pick = np.argsort(open_far, axis=1, kind="stable")[:, :at_once]
            live = np.isfinite(open_far[rows, pick])
            if not live.any():
                return np.where(np.isinf(far), -1, ids), far
            done[rows, pick] = True
            new = self.graph[ids[rows, pick]].reshape(n, -1)
            use = np.repeat(live, self.graph.shape[1], axis=1) & (new >= 0) & ~seen[rows, np.maximum(new, 0)]
            new = np.where(use, new, -1)
            # a centroid reached twice in one step counts once
            order = np.sort(new, axis=1)
            order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
            at = np.nonzero(order >= 0)
            seen[at[0], order[at]] = True
            more = np.full(order.shape, np.inf)
            more[at] = np.sqrt(((vectors[at[0]] - self.points[order[at]]) ** 2).sum(axis=1))
            ids = np.concatenate([ids, np.maximum(order, 0)], axis=1)
            far = np.concatenate([far, more], axis=1)
            done = np.concatenate([done, np.zeros(order.shape, bool)], axis=1)

    def within(self, vectors: np.ndarray, ratio: float, floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centroids found, their distances, and which are within ``ratio`` of the nearest one's
        distance (of ``floor`` if that is less); the beam is widened until it reaches beyond."""
        beam = BEAM
        while True:
            ids, far = self.nearest(vectors, beam)
            limit = ratio * np.maximum(far[:, :1], floor)
            if beam >= len(self.points) or (far[:, -1:] > limit).all():
                return ids, far, (far <= limit) & (ids >= 0)
            beam *= 2

    def _distances(self, vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return np.sqrt(((vectors[:, None, :] - self.points[ids]) ** 2).sum(axis=2))


def _balanced(points: np.ndarray, size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Means of groups of at most ``size`` points, by 2-means whose halves are of equal size."""
    todo, means = [points], []
    while todo:
        own = todo.pop()
        if len(own) <= size or (own == own[0]).all():
            means.append(own.mean(axis=0))
            continue
        a, b = own[rng.choice(len(own), 2, replace=False)]
        for _ in range(6):
            side = ((own - a) ** 2).sum(axis=1) - ((own - b) ** 2).sum(axis=1)
            order = np.argsort(side, kind="stable")
            half = len(own) // 2
            a, b = own[order[:half]].mean(axis=0), own[order[half:]].mean(axis=0)
        todo += [own[order[:half]], own[order[half:]]]
    return means


def build_centroids(sample: np.ndarray, n_lists: int, seed: int = 11) -> Centroids:
    rng = np.random.default_rng(seed)
    points = np.unique(np.array(_balanced(sample, max(1, math.ceil(len(sample) / n_lists)), rng)), axis=0)
    c, near = len(points), []
    for i in range(0, c, 256):
        apart = ((points[i : i + 256, None, :] - points[None, :, :]) ** 2).sum(axis=2) if c <= 2048 else (
            (points[i : i + 256] ** 2).sum(axis=1)[:, None] - 2 * points[i : i + 256] @ points.T + (points**2).sum(axis=1))
        near.append(np.argsort(apart, axis=1, kind="stable")[:, 1 : DEGREE + 1])
    graph = np.concatenate(near)
    # long links keep far regions within a few steps
    graph = np.concatenate([graph, rng.integers(0, c, (c, 4))], axis=1)
    return Centroids(points, graph, np.unique(rng.integers(0, c, max(1, math.isqrt(c)))))


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id long, v array<double>)`` of the vectors that take part.

    Rows with a null id, and vectors that are null, empty, zero or hold a null or non-finite
    component take no part; of vectors of several lengths only those of the most common one
    do. Repeated ids count once (with the smallest vector).
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = (
        vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & v.isNotNull()).where(finite & F.exists(v, lambda x: x != 0))
        .groupBy("vec_id").agg(F.min("v").alias("v"))
    )
    kept = written(kept, "vectors")
    common = kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return kept if common is None else kept.where(F.size("v") == common["d"])


def _matrix(column) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _lists_of(model, vectors: DataFrame, choose, schema: str) -> DataFrame:
    """``choose(centroid ids, distances)`` -> a mask, for each batch; one row per chosen list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, _BATCH):
                part = batch.slice(i, _BATCH)
                ids, far = choose(model.value, _matrix(part.column(1)))
                row, col = np.nonzero(far)
                took = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row, col].astype(np.int32)), took.column(0), took.column(1)], ["list", "vec_id", "v"])

    return shipped(vectors.select("vec_id", "v")).mapInArrow(run, schema)


def _bins_of(model, vectors: DataFrame, choose, width: int, schema: str) -> DataFrame:
    """As :func:`_lists_of`, with one row per chosen bin of ``width`` lists and its chosen lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, _BATCH):
                part = batch.slice(i, _BATCH)
                ids, far = choose(model.value, _matrix(part.column(1)))
                row, col = np.nonzero(far)
                lists = ids[row, col]
                order = np.lexsort((lists, row))
                row, lists = row[order], lists[order]
                bins = lists // width
                first = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(bins) != 0)][: len(row)])
                chosen = pa.ListArray.from_arrays(
                    pa.array(np.append(first, len(row)).astype(np.int32)), pa.array(lists.astype(np.int32)))
                took = part.take(pa.array(row[first]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bins[first].astype(np.int32)), chosen, took.column(0), took.column(1)],
                    ["bin", "lists", "query_id", "v"])

    return shipped(vectors.select("vec_id", "v")).mapInArrow(run, schema)


def _true_neighbours(vectors: DataFrame, asked: pa.Table, k: int) -> DataFrame:
    """``(query_id, vec_id)``: the ``k`` nearest of all rows for each of the few ``asked(vec_id, v)``."""
    schema = "query_id long, vec_id long, score double"
    known = vectors.sparkSession.sparkContext.broadcast((asked["vec_id"].to_numpy(), _matrix(asked["v"])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, points = known.value
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        for batch in batches:
            own, rows = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            for i, (q, point) in enumerate(zip(queries, points)):
                far = np.sqrt(((rows - point) ** 2).sum(axis=1))
                far[own == q] = np.inf
                ids, far = np.concatenate([best[i][0], own]), np.concatenate([best[i][1], far])
                keep = np.lexsort((ids, far))[:k]
                best[i] = ids[keep], far[keep]
        for q, (ids, far) in zip(queries, best):
            ids, far = ids[np.isfinite(far)], far[np.isfinite(far)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), q)), pa.array(ids), pa.array(far)], ["query_id", "vec_id", "score"])

    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return shipped(vectors.select("vec_id", "v")).mapInArrow(run, schema).withColumn(
        "rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "vec_id")


def _calibrated(own: Centroids, vectors: DataFrame, is_query: Column, postings: DataFrame, k: int) -> tuple[float, float]:
    """The ratio within which a sample of the queries finds ``TARGET_RECALL`` of its true neighbours,
    and half the sample's median distance to its nearest centroid, which is the least distance that
    the ratio is taken of (a query may be a centroid itself)."""
    asked = vectors.where(is_query).orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION_QUERIES).select("vec_id", "v").toArrow()
    if not asked.num_rows:
        return PROBE_RATIO, 0.0
    points = _matrix(asked["v"])
    far = np.sqrt(np.maximum((points**2).sum(axis=1)[:, None] - 2 * points @ own.points.T + (own.points**2).sum(axis=1), 0))
    floor = float(np.median(far.min(axis=1))) / 2
    least = np.maximum(far.min(axis=1), floor)
    at = {q: i for i, q in enumerate(asked["vec_id"].to_pylist())}
    # at most CALIBRATION_QUERIES * k * MAX_REPLICAS rows
    needed: dict[tuple[int, int], float] = {}
    true = F.broadcast(written(_true_neighbours(vectors, asked, k), "neighbours"))
    for row in postings.select("vec_id", "list").join(true, "vec_id").collect():
        i = at[row["query_id"]]
        ratio = float(far[i, row["list"]] / least[i]) if least[i] else (1.0 if far[i, row["list"]] == 0 else math.inf)
        pair = row["query_id"], row["vec_id"]
        needed[pair] = min(ratio, needed.get(pair, math.inf))
    if not needed:
        return PROBE_RATIO, floor
    return sorted(needed.values())[math.ceil(TARGET_RECALL * len(needed)) - 1] * (1 + 1e-9), floor


def search(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each query, nearest first.

    ``vectors(vec_id, v)`` as from :func:`usable`; queries are its rows where ``is_query`` holds,
    candidates all rows but the query's own. Ties in distance go to the smaller vec_id. With
    fewer candidates all are returned; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    n = vectors.count()
    if n == 0:
        return spark.createDataFrame([], schema)
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").toArrow()
    n_lists = max(1, min(MAX_CENTROIDS, math.ceil(n / LIST_ROWS)))
    model = spark.sparkContext.broadcast(build_centroids(_matrix(sample.column(0)), n_lists))

    def homes(own: Centroids, points: np.ndarray):
        ids, far = own.nearest(points, 2 * MAX_REPLICAS)
        take = (ids >= 0) & (far <= REPLICA_RATIO * far[:, :1])
        take[:, MAX_REPLICAS:] = False
        return ids, take

    listed = "list int, vec_id long, v array<double>"
    postings = written(_lists_of(model, vectors, homes, listed), "postings")
    # one row per centroid at most
    sizes = np.zeros(len(model.value.points), np.int64)
    for row in postings.groupBy("list").count().collect():
        sizes[row["list"]] = row["count"]
    ratio, floor = _calibrated(model.value, vectors, is_query, postings, k)

    def probed(own: Centroids, points: np.ndarray):
        ids, _, near = own.within(points, ratio, floor)
        held = np.cumsum(np.where(ids >= 0, sizes[ids], 0), axis=1)
        before = np.concatenate([np.zeros((len(ids), 1), np.int64), held[:, :-1]], axis=1)
        return ids, (near | (before < LEAST_CANDIDATES)) & (ids >= 0)

    # bins of about SHARD_ROWS rows, but not so wide that only a few are left
    width = max(1, min(SHARD_ROWS * len(sizes) // max(1, int(sizes.sum())), len(sizes) // _LEAST_BINS))
    held = np.add.reduceat(sizes, np.arange(0, len(sizes), width))
    shards = np.maximum(1, -(-held // SHARD_ROWS))
    probes = _bins_of(model, vectors.where(is_query), probed, width,
                      "bin int, lists array<int>, query_id long, v array<double>")
    counts = F.broadcast(spark.createDataFrame(
        [(i, int(s)) for i, s in enumerate(shards.tolist())], "bin int, shards int"))
    left = postings.withColumn("bin", F.floor(F.col("list") / width).cast("int")).join(counts, "bin").select(
        "bin", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int").alias("shard"), "list", "vec_id", "v")
    right = probes.join(counts, "bin").select(
        "bin", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "lists", "query_id", "v")

    def nearest_in(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and asked.num_rows:
            ids, points, lists = rows["vec_id"].to_numpy(), _matrix(rows["v"]), rows["list"].to_numpy() % width
            order = np.argsort(ids, kind="stable")
            ids, points, lists = ids[order], points[order], lists[order]
            for q, chosen, point in zip(asked["query_id"].to_pylist(), asked["lists"].to_pylist(), _matrix(asked["v"])):
                wanted = np.zeros(width, bool)
                wanted[np.array(chosen) % width] = True
                at = np.flatnonzero(wanted[lists])
                # replicas in several lists of the bin count once
                at = at[np.r_[True, np.diff(ids[at]) != 0][: len(at)]]
                far = np.sqrt(((points[at] - point) ** 2).sum(axis=1))
                far[ids[at] == q] = np.inf
                best = np.argsort(far, kind="stable")[:k]  # ids ascend, so ties go to the smaller
                best = best[np.isfinite(far[best])]
                out.append((np.full(len(best), q), ids[at[best]], far[best]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))],
                        names=["query_id", "vec_id", "score"])

    found = left.groupBy("bin", "shard").cogroup(right.groupBy("bin", "shard")).applyInArrow(
        nearest_in, "query_id long, vec_id long, score double")
    # a replica gives the same distance in every list
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
