"""Clusters against plain integer k-means, the curve, the boxes' bounds, SQL."""

from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from cinesift.llm import centroids

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, n=40, rounds=5, d=64):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    ranked = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centers = [v for _, v in ranked[:n]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, own in groups.items():
            centers[k] = [sum(column) // len(own) for column in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {}
    for _, apart, k in found:
        inertia[k] = inertia.get(k, 0) + apart
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, k, apart, inertia[k], sum(inertia.values()), digests[k]) for i, apart, k in found), key=str)


def vectors(rng, n, d=64, groups=9):
    middles = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(groups)]
    return [(i, [round(x + rng.gauss(0, .3), 4) for x in rng.choice(middles)]) for i in range(n)]


def run(spark, rows, **more):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS cluster", "2 AS v", "3 AS distance", "'p' AS place", "4 AS split")
    return sorted((tuple(r) for r in centroids.cluster(centroids.scaled(frame), **more).collect()), key=str)


def test_rows_equal_plain_k_means(spark, monkeypatch):
    monkeypatch.setattr(centroids.blocks_of, "__defaults__", (16,))
    rng = random.Random(1)
    rows = vectors(rng, 260)
    rows += [(5, rows[5][1])] * 3 + [(900 + i, rows[7][1]) for i in range(120)] + [(None, rows[8][1]), (None, rows[9][1])]
    odd = [(1000, None), (1001, []), (1002, [1.0] * 63), (1003, [1.0] * 65), (1004, [None] + [1.0] * 63),
           (1005, [float("nan")] + [1.0] * 63), (1006, [float("inf")] + [1.0] * 63), (1007, [0.0] * 64), (1008, [4e5] * 64), (1009, [-4e5] * 64)]
    assert run(spark, rows + odd) == brute(rows + odd)


def test_fewer_vectors_than_centroids_ties_and_empty_clusters(spark):
    rows = [(i, [float(i % 5)] * 64) for i in range(20)]  # equal vectors begin as several centroids
    assert run(spark, rows) == brute(rows)


def test_no_rows_and_too_large_components(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []
    with pytest.raises(Exception, match="beyond"):
        run(spark, [(1, [1e30] + [0.0] * 63)])


@pytest.mark.parametrize("d,bits", [(2, 3), (3, 3), (2, 5), (5, 2)])
def test_the_curve_goes_from_cell_to_neighbouring_cell(d, bits):
    cells = np.array(np.meshgrid(*[range(1 << bits)] * d)).reshape(d, -1).T
    keys = [k.tobytes() for k in centroids.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(keys)
    path = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_no_nearest_centroid_is_pruned():
    rng = np.random.default_rng(3)
    kept = 0
    for _ in range(300):
        d, k = int(rng.integers(1, 7)), int(rng.integers(1, 30))
        points = rng.integers(-30, 30, d) + rng.integers(-9, 9, (20, d))
        centers = rng.integers(-40, 40, (k, d))
        some = centroids.candidates(points.min(axis=0), points.max(axis=0), centers)
        apart = ((points[:, None, :] - centers[None]) ** 2).sum(axis=2)
        assert set(apart.argmin(axis=1)) <= set(some.tolist())
        best, far = centroids.nearest(points, centers[some])
        assert (some[best] == apart.argmin(axis=1)).all() and (far == apart.min(axis=1)).all()
        kept += len(some) / k
    assert kept < 200  # of 300: something is pruned


def test_large_values_stay_exact():
    points = np.array([[2**27 - 1, -(2**27)], [2**27 - 2, -(2**27)]])
    best, far = centroids.nearest(points, np.array([[2**27 - 1, -(2**27) + 1], [-(2**27), 2**27 - 1]]))
    assert best.tolist() == [0, 0] and far.tolist() == [1, 2]


def test_blocks_hold_every_vector_within_its_box(spark):
    rows = vectors(random.Random(2), 700)
    blocks = centroids.blocks_of(centroids.scaled(spark.createDataFrame(rows, SCHEMA)), 50).collect()
    assert sorted(i for b in blocks for i in b.ids) == list(range(700))
    for b in blocks:
        points = np.array(b.flat).reshape(-1, 64)
        assert len(points) == len(b.ids) <= 50
        assert points.min(axis=0).tolist() == b.lo and points.max(axis=0).tolist() == b.hi


def test_sql_gives_the_same_rows(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    cursor = con.execute(centroids.ORACLE)
    names = [c[0] for c in cursor.description]
    got = centroids.cluster(centroids.scaled(spark.read.parquet(f"{SF}/embeddings.parquet"))).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cursor.fetchall())
