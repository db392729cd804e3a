"""Search against brute force: recall, order, ties, excluded vectors and hot lists."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinesift.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr(
        "*", "1 AS list", "2 AS shard", "3.0 AS score", "4 AS rank", "5 AS query_id")


def brute(vectors: dict[int, np.ndarray], q: int, k: int = 10) -> list[tuple[float, int]]:
    own = vectors[q]
    return sorted((float(np.sqrt(((v - own) ** 2).sum())), i) for i, v in vectors.items() if i != q)[:k]


def run(spark, rows, k=10):
    got = ann.search(ann.usable(frame(spark, rows)), F.col("vec_id") % 100 == 0, k).collect()
    out: dict[int, list] = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 24))
    points = (centres[rng.integers(0, 30, 4000)] + rng.normal(scale=0.5, size=(4000, 24))).astype(np.float32)
    got = run(spark, [(i, p.tolist()) for i, p in enumerate(points)])
    vectors = {i: p.astype(np.float64) for i, p in enumerate(points)}
    hit = 0
    assert set(got) == set(range(0, 4000, 100))
    for q, found in got.items():
        want = brute(vectors, q)
        hit += len({i for _, i in want} & {i for _, i in found})
        for score, i in found:
            assert score == pytest.approx(float(np.sqrt(((vectors[i] - vectors[q]) ** 2).sum())), rel=1e-14)
        assert found == sorted(found)
    assert hit >= 0.95 * 10 * len(got)


def test_recall_over_many_lists_without_clusters(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 8)
    points = np.random.default_rng(5).normal(size=(12_000, 64))
    points = (points / np.sqrt((points**2).sum(axis=1))[:, None]).astype(np.float32)
    got = run(spark, [(i, p.tolist()) for i, p in enumerate(points)])
    exact, hit = points.astype(np.float64), 0
    for q, found in got.items():
        far = ((exact - exact[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hit += len(set(np.argsort(far, kind="stable")[:10].tolist()) & {i for _, i in found})
    assert len(got) == 120 and hit >= 0.9 * 10 * len(got)


def test_hot_vector_is_cut_into_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 50)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(600)] + [(600 + i, rng.normal(size=3).tolist()) for i in range(400)]
    got = run(spark, rows)
    assert got[0] == [(0.0, i) for i in range(1, 11)]
    assert got[100] == [(0.0, i) for i in range(10)]
    vectors = {i: np.array(v, np.float32).astype(np.float64) for i, v in rows}
    assert [i for _, i in got[700]] == [i for _, i in brute(vectors, 700)]


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [math.nan, 1.0]),
            (7, [math.inf, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (100, [2.0, 0.0]), (100, [2.0, 0.0]), (200, None)]
    assert run(spark, rows) == {
        0: [(1.0, 100), (math.sqrt(2), 1)], 100: [(1.0, 0), (math.sqrt(5), 1)]}


def test_few_and_no_vectors(spark):
    assert run(spark, [(0, [1.0, 0.0])]) == {}
    assert run(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0])]) == {}
    assert run(spark, []) == {}


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(3)
    own = ann.build_centroids(rng.normal(size=(3000, 8)), 300)
    asked = rng.normal(size=(200, 8))
    ids, far = own.nearest(asked, 48)
    exact = np.sqrt(((asked[:, None] - own.points[None]) ** 2).sum(axis=2))
    want = np.argsort(exact, axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b[:10])) for a, b in zip(want.tolist(), ids.tolist())]) > 9.5
    assert (np.diff(far, axis=1) >= 0).all()
    assert all(len(set(r)) == len(r) for r in ids.tolist())


def test_the_beam_widens_to_the_ratio():
    rng = np.random.default_rng(6)
    own = ann.build_centroids(rng.normal(size=(4000, 6)), 1000)
    asked = rng.normal(size=(100, 6))
    exact = np.sqrt(((asked[:, None] - own.points[None]) ** 2).sum(axis=2))
    for ratio in (1.0, 1.5, 3.0, 50.0):
        ids, far, near = own.within(asked, ratio, 0.0)
        want = exact <= ratio * exact.min(axis=1, keepdims=True) + 1e-12
        found = np.zeros_like(want)
        row, col = np.nonzero(near)
        found[row, ids[row, col]] = True
        assert not (found & ~want).any() and found.sum() >= 0.98 * want.sum()


def test_the_ratio_prunes_where_there_are_clusters(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 16)) * 4
    points = centres[rng.integers(0, 60, 6000)] + rng.normal(scale=0.4, size=(6000, 16))
    vectors = ann.usable(frame(spark, [(i, p.tolist()) for i, p in enumerate(points)]))
    own = ann.build_centroids(points[:3000], 94)
    postings = ann._lists_of(spark.sparkContext.broadcast(own), vectors, lambda c, p: (lambda ids, far: (ids, far <= 1.1 * far[:, :1]))(*c.nearest(p, 8)),
                             "list int, vec_id long, v array<double>")
    ratio, floor = ann._calibrated(own, vectors, F.col("vec_id") % 100 == 0, postings, 10)
    _, _, near = own.within(points[::100], ratio, floor)
    assert near.sum(axis=1).mean() < 0.15 * len(own.points)


def test_groups_are_balanced():
    rng = np.random.default_rng(4)
    sample = np.concatenate([rng.normal(size=(900, 4)), np.ones((100, 4))])
    own = ann.build_centroids(sample, 50)
    near = np.bincount(((sample[:900, None] - own.points[None]) ** 2).sum(axis=2).argmin(axis=1), minlength=len(own.points))
    assert near.max() <= 8 * 900 / 50
