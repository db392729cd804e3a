"""Ratings are dealt out in bounded partitions before they are aggregated by user."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cinesift import operators as ops
from cinesift.operators.catalog import explode_genres, rated_genres
from tests.conftest import MOVIES_SCHEMA, RATINGS_SCHEMA

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _tables(spark, hot: int = 0):
    rnd = random.Random(11)
    movies = [(m, f"M{m} (2000)", "|".join(rnd.choices("ABCDEF", k=3))) for m in range(40)]
    movies += [(40, "None (2000)", None), (41, "Twice (2000)", "A"), (41, "Twice (2000)", "A|B"), (None, "Lost (2000)", "C")]
    data = [(rnd.choice([*range(60), None]), rnd.choice([*range(44), None]), rnd.choice([0.5, 3.0, 4.5, None])) for _ in range(2000)]
    data += [(7, rnd.randrange(40), 4.0) for _ in range(hot)]
    return data, movies, spark.createDataFrame(data, RATINGS_SCHEMA).repartition(8), spark.createDataFrame(movies, MOVIES_SCHEMA)


def test_a_users_rows_meet_before_they_are_aggregated(spark):
    _, _, ratings, movies = _tables(spark)
    places = defaultdict(set)
    for r in rated_genres(ratings, movies).withColumn("at", F.spark_partition_id()).collect():
        places[r["user_id"]].add(r["at"])
    assert len(places) == 61 and all(len(x) == 1 for x in places.values())


def test_a_hot_user_is_split(spark, small_partitions):
    _, _, ratings, movies = _tables(spark, hot=20_000)
    df = ops.user_genre_profile(ratings, movies)
    n = {r["genre"]: r["n_rated"] for r in df.where("user_id = 7").collect()}
    assert sum(n.values()) > 60_000
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "AQEShuffleRead coalesced and skewed" in final or "AQEShuffleRead skewed" in final


@pytest.mark.parametrize("outer", [False, True])
def test_rated_genres_equal_the_join_with_exploded_genres(spark, outer):
    data, movies, ratings, frame = _tables(spark)
    genres = defaultdict(list)
    for m, _, listed in movies:
        if m is not None and listed is not None:
            genres[m] += listed.split("|")
    expected = sorted(
        ((u, v, g) for u, m, v in data for g in genres.get(m, [None] if outer else [])), key=repr)
    got = rated_genres(ratings, frame, outer).select("user_id", "rating", "genre")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected


def test_explode_genres_keeps_the_columns_asked_for(spark):
    movies = spark.createDataFrame([(1, "a", "X|Y"), (2, "b", None)], MOVIES_SCHEMA)
    assert sorted(tuple(r) for r in explode_genres(movies, ["title"]).collect()) == [("a", "X"), ("a", "Y")]
    assert sorted((tuple(r) for r in explode_genres(movies, ["title"], True).collect()), key=repr) == [
        ("a", "X"), ("a", "Y"), ("b", None)]


def test_votes_are_dealt_out_before_they_are_counted(spark, micro):
    plan = ops.recommend(*micro)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert re.search(r"hash\(user_id#\d+L, movie_id#\d+L, 42\) AS _deal", plan)
