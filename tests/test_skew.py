"""One user and one movie each hold about a third of all ratings.

With broadcasts disabled every join is a sort-merge join, and AQE is told that any
partition over 1 KB is skewed, so the hot keys' partitions are split across tasks.
Results must equal those of the default plan, and the final plan must show the split.
"""

from __future__ import annotations

import random

import pytest

from cinesift import operators as ops
from tests.conftest import MOVIES_SCHEMA, RATINGS_SCHEMA

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(5)
    genres = ["Drama", "Comedy", "Horror", "Noir"]
    movies = [(m, f"Film {m} ({1960 + m % 40})", "|".join(rnd.sample(genres, 2))) for m in range(60)]
    data = []
    for u in range(1, 300):
        for _ in range(rnd.randint(1, 8)):
            data.append((u, rnd.randrange(60), rnd.choice([1.0, 2.5, 4.0, 4.5, 5.0])))
    hot = len(data) // 2
    data += [(0, rnd.randrange(60), rnd.choice([3.0, 4.0, 5.0])) for _ in range(hot // 2)]  # hot user 0
    data += [(rnd.randrange(1, 300), 7, 4.5) for _ in range(hot // 2)]  # hot movie 7
    return spark.createDataFrame(data, RATINGS_SCHEMA), spark.createDataFrame(movies, MOVIES_SCHEMA)


def _run_with(spark, conf, build):
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = build()
        result = sorted((tuple(r) for r in df.collect()), key=repr)
        plan = df._jdf.queryExecution().executedPlan().toString()
        return result, plan
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize(
    "name,build",
    [
        ("profile", lambda r, m: ops.user_genre_profile(r, m)),
        ("genre_counts", lambda r, m: ops.user_genre_counts(r, m)),
        ("recommend", lambda r, m: ops.with_rating_list(ops.recommend(r, m)).drop("rating_counts")),
        ("pairs", lambda r, m: ops.pair_cosine(r, [(0, 1), (0, 2), (3, 0), (5, 6)])),
    ],
)
def test_skewed_keys_same_result(spark, skewed, name, build):
    ratings, movies = skewed
    base, _ = _run_with(spark, {}, lambda: build(ratings, movies))
    split, plan = _run_with(spark, SKEW_CONF, lambda: build(ratings, movies))
    assert base == split
    assert "BroadcastHashJoin" not in plan
    assert "SortMergeJoin" in plan


def test_hot_movie_join_is_split(spark, skewed):
    ratings, movies = skewed
    _, plan = _run_with(spark, SKEW_CONF, lambda: ops.user_genre_profile(ratings, movies))
    assert "skew=true" in plan
