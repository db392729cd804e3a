"""Centroid clustering over Hilbert-ordered blocks with min/max boxes (zone maps).

Vectors are sorted along a Hilbert curve and cut into blocks of ``BLOCK_ROWS``; a block is one row
of a table: its ids, its vectors, and the least and greatest value of each component. For every
round, bounds on the distance from a block's box to the centroids say which of them can be
nearest to some vector inside; only those *candidates* are compared, exactly and for the whole
block at once. All arithmetic is on integers, so results do not depend on the order of rows,
blocks or tasks.

The curve's partitions are ranges of its key (then of the id, then of a random number, so that
equal vectors are no hot key). Rounds read the block table and return one row of sums per task and
centroid; the centroids themselves, a fixed number of vectors, are all that the driver holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinesift.llm.common import shipped, small_batches, written

DIMENSIONS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
BLOCK_ROWS = 256
CURVE_BITS = 4
# Components are scaled to integers under 2**27, so that a squared distance fits a long.
LARGEST = 2.0**19
_BLOCKS_AT_ONCE = 64
_ROWS_AT_ONCE = 4096


def scaled(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """``(vec_id long, v array<int>)``: vectors with exactly ``dimensions`` components, none null or
    non-finite, as ``floor(256 * x)``. A component of 2**19 or beyond raises."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.when(F.abs(x) < LARGEST, F.floor(x * float(SCALE)).cast("int")).otherwise(
        F.raise_error(F.lit(f"a vector component is beyond {LARGEST}")).cast("int")))
    return (
        vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        .where(v.isNotNull() & (F.size(v) == dimensions)).where(finite).select("vec_id", whole.alias("v"))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int32)


def hilbert_keys(cells: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """The place of each cell (a row of coordinates under ``2**bits``) on the Hilbert curve through
    them, as rows of bytes in order of the curve: coordinates are turned and mirrored level by
    level, Gray-decoded, and their bits interleaved."""
    x = cells.astype(np.uint8).T.copy()
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint8(1 << level), np.uint8((1 << level) - 1)
        for axis in x:
            mirrored = (axis & bit) != 0
            swap = np.where(mirrored, np.uint8(0), (x[0] ^ axis) & low)
            x[0] ^= np.where(mirrored, low, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint8(level)) & 1, np.uint8((1 << level) - 1), np.uint8(0))
    x ^= turn
    planes = [(x >> np.uint8(level)) & 1 for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T, axis=1)


def _curve(vectors: DataFrame) -> DataFrame:
    """``vectors`` with ``place``, the Hilbert key of each; the curve's cells divide two standard
    deviations on either side of the mean, components of greatest variance first."""
    some = vectors.limit(1).select(F.size("v").alias("d")).first()
    d = some["d"] if some else 0
    x = [F.col("v")[i].cast("double") for i in range(d)]
    row = vectors.agg(*(F.avg(c) for c in x), *(F.stddev_pop(c) for c in x)).first() if d else ()
    mean, spread = np.array(row[:d], float), np.array(row[d:], float)
    order = np.argsort(-spread, kind="stable")
    low, width = (mean - 2 * spread)[order], np.maximum(4 * spread, 1.0)[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, _ROWS_AT_ONCE):
            cells = ((_matrix(batch.column(1))[:, order] - low) / width * (1 << CURVE_BITS)).clip(0, (1 << CURVE_BITS) - 1)
            keys = [k.tobytes() for k in hilbert_keys(cells.astype(np.uint8))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], ["vec_id", "v", "place"])

    return shipped(vectors.select("vec_id", "v")).mapInArrow(run, "vec_id long, v array<int>, place binary")


def blocks_of(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The table of blocks ``(ids array<long>, flat array<int>, lo array<int>, hi array<int>)`` of
    ``vectors(vec_id, v)``, all of one length; written to the shared folder."""
    keys = ["place", "vec_id", "split"]
    curve = _curve(vectors).withColumn("split", F.rand(5)).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(table: pa.Table) -> pa.RecordBatch:
            points = _matrix(table.column("v").combine_chunks())
            return pa.RecordBatch.from_arrays(
                [pa.array([table.column("vec_id").combine_chunks()], pa.list_(pa.int64())),
                 *(pa.array([x], pa.list_(pa.int32())) for x in (points.ravel(), points.min(axis=0), points.max(axis=0)))],
                ["ids", "flat", "lo", "hi"])

        left = None  # fewer rows than a block
        for batch in batches:
            table = pa.Table.from_batches([batch] if left is None else [*left.to_batches(), batch])
            full = table.num_rows // block_rows * block_rows
            for i in range(0, full, block_rows):
                yield out(table.slice(i, block_rows))
            left = table.slice(full)
        if left is not None and left.num_rows:
            yield out(left)

    schema = "ids array<long>, flat array<int>, lo array<int>, hi array<int>"
    return written(shipped(curve.select("vec_id", "v")).mapInArrow(run, schema), "blocks")


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that may be nearest to some vector between ``lo`` and ``hi``, in order.

    Those whose least distance to the box is over another one's greatest go; so do those that lie
    behind the bisector with the one nearest to the middle of the box, seen from all of the box.
    """
    near = np.maximum(np.maximum(lo - centroids, centroids - hi), 0)
    far = np.maximum(np.abs(centroids - lo), np.abs(centroids - hi))
    left = np.flatnonzero((near**2).sum(axis=1) <= (far**2).sum(axis=1).min())
    own = centroids[left]
    # twice the middle, so that it stays whole
    best = own[((2 * own - (lo + hi)) ** 2).sum(axis=1).argmin()]
    apart = own - best
    # greatest value of distance(best) - distance(own) in the box: linear, so taken at a corner
    corner = np.where(apart > 0, hi, lo)
    lead = (best**2).sum() - (own**2).sum(axis=1) + 2 * (corner * apart).sum(axis=1)
    return left[lead >= 0]


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point (of several the first) and its squared distance, exactly:
    in doubles while all sums stay under 2**53, else in 64-bit integers."""
    largest = max(int(np.abs(points).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    kind = np.float64 if 4 * largest * largest * points.shape[1] < 2**53 else np.int64
    x, c = points.astype(kind), centroids.astype(kind)
    apart = (x**2).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c**2).sum(axis=1)
    best = apart.argmin(axis=1)
    return best, apart[np.arange(len(x)), best].astype(np.int64)


def _assigned(blocks: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple]:
    """Per block its ids, vectors, clusters, distances and number of candidates."""
    d = centroids.shape[1]
    for ids, flat, lo, hi in zip(*(blocks.column(i) for i in range(4))):
        points = flat.values.to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.int64)
        some = candidates(*(x.values.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lo, hi)), centroids)
        at, apart = nearest(points, centroids[some])
        yield ids.values, points, some[at], apart, len(some)


def sums(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(cluster, dim, n, total, compared)``: for each non-empty cluster the number of its vectors and the
    sum of each component (decimals); ``compared`` is the number of distances that were computed."""
    k, d = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, compared = np.zeros(k, np.int64), np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for batch in small_batches(batches, _BLOCKS_AT_ONCE):
            for _, points, cluster, _, some in _assigned(batch, centroids):
                n += np.bincount(cluster, minlength=k)
                compared += some * np.bincount(cluster, minlength=k)
                order = np.argsort(cluster, kind="stable")
                first = np.flatnonzero(np.r_[True, np.diff(cluster[order]) != 0])
                total[cluster[order][first]] += np.add.reduceat(points[order], first, axis=0)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(n[used]), pa.array(list(total[used]), pa.list_(pa.int64())),
             pa.array(compared[used])], ["cluster", "n", "total", "compared"])

    parts = shipped(blocks).mapInArrow(run, "cluster int, n long, total array<long>, compared long")
    return parts.select("cluster", "n", "compared", F.posexplode("total").alias("dim", "total")).groupBy("cluster", "dim").agg(
        *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "total", "compared")))


def moved_centroids(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid that is nearest to some vector becomes the floor of their mean."""
    out = centroids.copy()
    for row in sums(blocks, centroids).collect():  # centroids x components rows at most
        out[row["cluster"], row["dim"]] = int(row["total"]) // int(row["n"])
    return out


def first_centroids(vectors: DataFrame, n: int = CENTROIDS, salt: str = "2:") -> np.ndarray:
    """The ``n`` vectors whose id, behind ``salt``, has the smallest SHA-256 (equal ids: the smaller vector)."""
    rank = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(rank.alias("rank"), "v").orderBy("rank", "v").limit(n).collect()
    return np.array([r["v"] for r in rows], np.int64)


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)`` for every vector of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, _BLOCKS_AT_ONCE):
            for ids, _, cluster, apart, _ in _assigned(batch, centroids):
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster.astype(np.int32)), pa.array(apart)], ["vec_id", "cluster", "distance"])

    return shipped(blocks).mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, n: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` for every vector of
    ``vectors(vec_id, v)`` as from :func:`scaled`.

    With fewer vectors than ``n`` each begins as a centroid; centroids that lose all vectors stay
    where they are; ties go to the smaller number. Repeated rows count and are returned as often
    as they occur, a null vec_id stays null (and ranks as the empty text). An empty table gives
    an empty result.
    """
    spark = vectors.sparkSession
    centroids = first_centroids(vectors, n)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    blocks = blocks_of(vectors)
    for _ in range(rounds):
        centroids = moved_centroids(blocks, centroids)
    rows = written(assign(blocks, centroids), "assigned")
    # one row per centroid
    own = {r["cluster"]: int(r["own"]) for r in rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()}
    totals = spark.createDataFrame(
        [(i, own[i], sum(own.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
         for i, c in enumerate(centroids.tolist()) if i in own],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(n: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for the same rows: every vector against every centroid."""
    def assigned(i: int) -> str:
        # the least (distance, number) of each vector
        return f"""a{i} AS (SELECT rid, min({{'d': d, 'c': c}}) AS best FROM (
      SELECT rid, c, list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM x, c{i}) GROUP BY rid)"""

    parts = [f"""x AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda y: floor(256 * y::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda y: isfinite(y))) = {DIMENSIONS})""",
             f"""c0 AS (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS w FROM (
    SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM x ORDER BY h, v LIMIT {n}))"""]
    for i in range(rounds):
        parts += [assigned(i), f"""m{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY dim) AS w FROM (
      SELECT best.c AS c, dim, sum(v[dim])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{i} JOIN x USING (rid), range(1, {DIMENSIONS + 1}) r(dim) GROUP BY ALL)
    GROUP BY c)""", f"c{i + 1} AS (SELECT c, coalesce(m.w, o.w)::BIGINT[] AS w FROM c{i} o LEFT JOIN m{i} m USING (c))"]
    parts.append(assigned(rounds))
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, c::INTEGER AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a{rounds} JOIN x USING (rid) JOIN c{rounds} ON c = best.c
"""


ORACLE = _oracle()
