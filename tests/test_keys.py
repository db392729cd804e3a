"""Selections by literal keys and by key frames, on every lookup operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinesift import operators as ops
from cinesift.functions.keys import INLINE_KEYS, as_column_value, restrict
from tests.conftest import rows

RATINGS = [(u, m, 1.0 + (u + m) % 8 / 2) for u in range(1, 9) for m in range(10, 16) if (u * m) % 3]
MOVIES = [(m, f"Movie, {m} ({1990 + m % 3})", "Drama|Comedy" if m % 2 else "Drama") for m in range(10, 16)]


@pytest.fixture(scope="module")
def data(spark):
    return (
        spark.createDataFrame(RATINGS, "user_id bigint, movie_id bigint, rating double"),
        spark.createDataFrame(MOVIES, "movie_id bigint, title string, genres string"),
    )


LOOKUPS = {
    "user_genres": (lambda r, m, k: ops.user_genres(r, m, k), [2, 5], "bigint", 99),
    "user_genre_lists": (lambda r, m, k: ops.user_genre_lists(r, m, k), [2, 5], "bigint", 99),
    "user_watched_titles": (lambda r, m, k: ops.user_watched_titles(r, m, k), [2, 5], "bigint", 99),
    "user_watch_counts": (lambda r, m, k: ops.user_watch_counts(r, k), [2, 5], "bigint", 99),
    "avg_rating_by_movie_id": (lambda r, m, k: ops.avg_rating_by_movie_id(r, m, k), [10, 13], "bigint", 99),
    "watch_count_by_movie_id": (lambda r, m, k: ops.watch_count_by_movie_id(r, m, k), [10, 13], "bigint", 99),
    "avg_rating_by_title": (lambda r, m, k: ops.avg_rating_by_title(r, m, k), ["Movie, 10 (1991)", "Movie 13 (1991)"], "string", "No"),
    "watch_count_by_title": (lambda r, m, k: ops.watch_count_by_title(r, m, k), ["Movie, 10 (1991)", "Movie 13 (1991)"], "string", "No"),
    "movies_in_genres": (lambda r, m, k: ops.movies_in_genres(m, k), ["Comedy"], "string", "No"),
    "movies_in_year": (lambda r, m, k: ops.movies_in_year(m, k), ["1991"], "string", "1800"),
}


@pytest.mark.parametrize("name", sorted(LOOKUPS))
def test_key_frame_with_duplicates_nulls_and_unknown_keys(spark, data, name):
    build, keys, kind, unknown = LOOKUPS[name]
    frame = spark.createDataFrame([(k,) for k in [*keys, keys[0], None, unknown]], f"k {kind}")
    by_list, by_frame = rows(build(*data, keys)), rows(build(*data, frame))
    everything = {"bigint": list(range(1, 100)), "string": [t for _, t, _ in MOVIES] + ["Drama", "Comedy"] + [str(y) for y in range(1990, 1993)]}[kind]
    assert by_frame == by_list and by_list
    assert len(by_list) < len(rows(build(*data, everything)))


def test_long_lists_equal_key_frames(spark):
    df = spark.range(100_000).selectExpr("id AS user_id")
    keys = list(range(0, 100_000, 2)) + [None, 7, 7]
    assert len(keys) > INLINE_KEYS
    frame = spark.createDataFrame([(k,) for k in keys], "k bigint")
    a, b = restrict(df, "user_id", keys), restrict(df, "user_id", frame)
    assert a.count() == b.count() == 50_001 and a.exceptAll(b).isEmpty()


def test_short_lists_reach_the_scan_as_a_filter(spark):
    plan = restrict(spark.range(10).selectExpr("id AS user_id"), "user_id", [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("n", [2, 201, 50_000])
@pytest.mark.parametrize("kind", ["bigint", "int", "double", "string"])
@pytest.mark.parametrize("given", [str, int, float])
def test_key_lists_of_any_type_and_length_select_alike(spark, n, kind, given):
    df = spark.range(60_000).select(F.col("id").cast(kind).alias("k"), F.col("id").alias("own"))
    if kind == "string":
        df = df.withColumn("k", F.col("own").cast("string"))
    # the first is sure to be found; no value of the column: a fraction, text, null, an id out of range
    keys = [given(i) for i in range(3, 3 + n)] + [3.5, "x", None, "", 10**30]
    got = restrict(df, "k", keys)
    assert got.schema == df.schema
    assert got.agg(F.count("own"), F.min("own"), F.max("own")).first() == (n, 3, 2 + n)


def test_keys_are_read_as_values_of_the_column():
    read = [as_column_value(k, T.LongType()) for k in ("7", " 7 ", "7.0", 7.0, "7.5", "x", None, float("nan"), 2**63, "1e2")]
    assert read == [7, 7, 7, 7, None, None, None, None, None, 100]
    assert [as_column_value(k, T.StringType()) for k in (7, 7.0, 7.5, "7.0", "x")] == ["7", "7", "7.5", "7.0", "x"]
    assert [as_column_value(k, T.DoubleType()) for k in ("7", 7, "x", float("nan"))] == [7.0, 7.0, None, None]
    assert as_column_value(True, T.BooleanType()) is True


def test_no_job_runs_while_a_lookup_is_built(spark):
    from cinesift.plans.queries import QUERIES

    tracker = spark.sparkContext.statusTracker()
    for name in ("user_watched_titles", "user_genres", "watch_count_by_title", "avg_rating_by_movie_id", "movies_in_year", "movies_in_genres", "recommend"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        QUERIES[name](spark, "/root/testdata/sf0.001")
        assert list(tracker.getJobIdsForGroup(f"build-{name}")) == []
    spark.sparkContext.setJobGroup("tests", "tests")
