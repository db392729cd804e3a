"""Plan shape and partition invariance of the registered queries."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from cinesift.plans.queries import QUERIES
from tests.conftest import SF_SMALL, rows

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_and_contract(spark):
    df = entry(spark)
    assert df.columns == ["user_id", "movie_id", "n_votes", "avg_rating", "ratings"]
    assert df.count() > 0
    # the training-data queries beyond SQL have tests of their own
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_cross_product(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def test_top_n_is_take_ordered(spark):
    for name in ("top_rated", "top_watched"):
        assert "TakeOrderedAndProject" in _plan(queries()[name](spark, SF_SMALL))


def test_rank_one_uses_window_group_limit(spark):
    for name in ("favourite_genre", "similar_users"):
        assert "WindowGroupLimit" in _plan(queries()[name](spark, SF_SMALL))


def test_scan_prunes_columns(spark):
    plan = _plan(queries()["user_watch_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan or "struct<l_orderkey:bigint>" in plan
    assert "l_quantity" not in plan


@pytest.mark.parametrize("name", ["user_genre_counts", "favourite_genre", "similar_users", "recommend", "pair_ols"])
def test_partition_invariance(spark, name):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(rows(queries()[name](spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]
    assert results[0]


@pytest.mark.parametrize("op", ["favourite_genre", "similar_users", "recommend"])
def test_input_order_invariance(spark, op):
    from pyspark.sql import functions as F

    from cinesift import operators as ops
    from cinesift.sources import movies_from_tables, ratings_from_tables

    ratings, movies = ratings_from_tables(spark, SF_SMALL), movies_from_tables(spark, SF_SMALL)
    shuffled = ratings.repartition(5).orderBy(F.rand(17))
    fn = getattr(ops, op)
    assert rows(fn(ratings, movies).drop("rating_counts")) == rows(fn(shuffled, movies).drop("rating_counts"))


def test_materialized_neighbours_feed_recommend(spark):
    from cinesift import materialize
    from cinesift import operators as ops
    from cinesift.sources import movies_from_tables, ratings_from_tables

    ratings, movies = ratings_from_tables(spark, SF_SMALL), movies_from_tables(spark, SF_SMALL)
    knn = materialize(ops.similar_users(ratings, movies), "test-knn")
    assert "FileScan parquet" in _plan(knn) and "Window" not in _plan(knn)
    direct = rows(ops.recommend(ratings, movies, users=[1, 2, 3]).drop("rating_counts"))
    reused = rows(ops.recommend(ratings, movies, users=[1, 2, 3], neighbours=knn).drop("rating_counts"))
    assert direct == reused and direct
    pairs = knn.selectExpr("user_id AS user1", "neighbour_id AS user2")
    assert ops.pair_cosine(ratings, pairs).count() > 0


def test_neighbours_need_no_window_over_users(spark):
    plan = _plan(queries()["similar_users"](spark, SF_SMALL))
    windows = [x for x in plan.split("\n") if "Window " in x and "user_id#" in x.split("], [")[1]]
    # the only window that is partitioned by user is favourite_genre's, which orders by score and genre
    assert windows and all("genre#" in x.split("], [", 2)[2] for x in windows)


@pytest.mark.parametrize("name", ["pair_ols", "pair_residual_shape"])
def test_ratings_are_joined_once(spark, name):
    assert "l_orderkey" not in _plan(queries()[name](spark, SF_SMALL))


def test_recommend_shares_one_exchange_of_the_ratings(spark):
    df = queries()["recommend"](spark, SF_SMALL)
    df.toArrow()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("lineitem.parquet") == 1 and final.count("orders.parquet") == 1 and "ReusedExchange" in final


@pytest.mark.parametrize("name", ["recommend", "liked_by_neighbours"])
def test_no_table_is_left_behind(spark, name, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(f"file://{tmp_path}")
    try:
        assert queries()[name](spark, SF_SMALL).count() > 0
        assert not [f for f in tmp_path.rglob("*.parquet")]
    finally:
        if before:
            spark.sparkContext.setCheckpointDir(before)


def test_residual_shape_reads_the_co_ratings_once(spark):
    from cinesift import materialize
    from cinesift import operators as ops
    from cinesift.sources import ratings_from_tables

    ratings = materialize(ratings_from_tables(spark, SF_SMALL).drop("ts"), "ratings")
    pairs = materialize(spark.createDataFrame([(1, 2), (3, 4)], "user1 bigint, user2 bigint"), "pairs")
    assert _plan(ops.pair_residual_shape(ratings, pairs)).count("FileScan parquet") == 3  # pairs, and either rater
