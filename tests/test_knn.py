"""The bounded kNN equals a brute-force ranking over all same-genre pairs."""

from __future__ import annotations

import random

import pytest

from cinesift import operators as ops
from tests.conftest import MOVIES_SCHEMA, RATINGS_SCHEMA


def _random_data(spark, seed: int, n_users: int, n_movies: int, genres: list[str], ratings_per_user: int):
    rnd = random.Random(seed)
    movies = []
    for m in range(n_movies):
        gs = rnd.sample(genres, rnd.randint(1, 2))
        movies.append((m, f"Movie {m} ({1950 + m % 50})", "|".join(gs)))
    ratings = []
    for u in range(n_users):
        for _ in range(rnd.randint(1, ratings_per_user)):
            # Few distinct values -> many equal scores -> heavy distance ties.
            ratings.append((u, rnd.randrange(n_movies), rnd.choice([0.5, 1.0, 4.0, 5.0])))
    return spark.createDataFrame(ratings, RATINGS_SCHEMA), spark.createDataFrame(movies, MOVIES_SCHEMA)


def _brute_force(fav_rows, k):
    by_genre = {}
    for r in fav_rows:
        by_genre.setdefault(r.genre, []).append((r.user_id, r.rating_sum))
    out = set()
    for members in by_genre.values():
        for u, s in members:
            cands = sorted((abs(s - s2), v) for v, s2 in members if v != u)
            for rank, (d, v) in enumerate(cands[:k], start=1):
                out.add((u, v, rank, d / 10.0))
    return out


@pytest.mark.parametrize("seed,k", [(1, 3), (2, 1), (3, 5), (4, 3)])
def test_knn_equals_brute_force(spark, seed, k):
    ratings, movies = _random_data(spark, seed, n_users=120, n_movies=15, genres=list("ABCD"), ratings_per_user=6)
    fav = ops.favourite_genre(ratings, movies).collect()
    expected = _brute_force(fav, k)
    got = {
        (r.user_id, r.neighbour_id, r.rank, r.distance)
        for r in ops.similar_users(ratings, movies, k=k).collect()
    }
    assert got == expected


def test_knn_one_dominant_score(spark):
    # 60 users share one genre and one score: ties broken purely by neighbour id.
    movies = spark.createDataFrame([(1, "Only (2000)", "Solo")], MOVIES_SCHEMA)
    ratings = spark.createDataFrame([(u, 1, 4.0) for u in range(60)], RATINGS_SCHEMA)
    got = {}
    for r in ops.similar_users(ratings, movies, k=3).collect():
        got.setdefault(r.user_id, []).append((r.rank, r.neighbour_id))
    assert len(got) == 60
    assert [n for _, n in sorted(got[0])] == [1, 2, 3]
    assert [n for _, n in sorted(got[2])] == [0, 1, 3]
    assert [n for _, n in sorted(got[59])] == [0, 1, 2]


@pytest.mark.parametrize(
    "k,partitions,reuse", [(1, 64, "true"), (3, 64, "true"), (5, 200, "true"), (3, 3, "true"), (3, 64, "false")]
)
def test_knn_continuous_scores_across_range_partitions(spark, k, partitions, reuse):
    # Continuous ratings: nearly every user has a distinct score, so the distinct
    # scores of a genre span many range partitions, many holding fewer than k scores.
    rnd = random.Random(100 + k)
    movies = spark.createDataFrame(
        [(m, f"M{m} (2000)", ["Drama", "Comedy", "Drama|Comedy"][m % 3]) for m in range(9)], MOVIES_SCHEMA
    )
    # Multiples of 1/1024: nearly all distinct, yet summed exactly in any order, so the
    # favourite-genre sums of the brute force and of the plan are the same doubles.
    data = [
        (u, rnd.randrange(9), rnd.randint(512, 5120) / 1024.0) for u in range(150) for _ in range(rnd.randint(1, 3))
    ]
    ratings = spark.createDataFrame(data, RATINGS_SCHEMA)
    # reuse=false: correctness must not depend on Spark sharing one exchange between branches.
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.exchange.reuse": reuse,
    }
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        fav = ops.favourite_genre(ratings, movies).collect()
        got = {
            (r.user_id, r.neighbour_id, r.rank, r.distance)
            for r in ops.similar_users(ratings, movies, k=k).collect()
        }
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == _brute_force(fav, k)
