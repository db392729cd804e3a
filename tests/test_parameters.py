"""Operators driven by a selection, on sf0.01, against DuckDB and FIXTURES.md §2 values."""

from __future__ import annotations

import duckdb
import pytest

from cinesift import operators as ops
from cinesift.plans.oracle import _with
from cinesift.sources import movies_from_tables, ratings_from_tables
from tests.conftest import SF_CHECK, rows


@pytest.fixture(scope="module")
def data(spark):
    return ratings_from_tables(spark, SF_CHECK), movies_from_tables(spark, SF_CHECK)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    yield con
    con.close()


def test_selected_user_counts(data):
    ratings, _ = data
    assert rows(ops.user_watch_counts(ratings, [7, 42, 99])) == [(7, 36), (42, 15), (99, 43)]


def test_movie_seven(data):
    _, movies = data
    got = ops.with_title_year(movies).where("movie_id = 7").collect()[0]
    assert (got.title, got.genres, got.year) == ("red bolt, Brand#6 (1979)", "SMALL|red|bolt", "1979")


def test_title_of_two_movies(data):
    ratings, movies = data
    got = ops.avg_rating_by_title(ratings, movies, "blue bolt, Brand#15 (1993)").collect()
    assert len(got) == 2
    counts = ops.watch_count_by_title(ratings, movies, "blue bolt Brand#15 (1993)").collect()
    assert len(counts) == 2


def test_top_three_by_average(data):
    ratings, _ = data
    top = ops.top_rated(ratings, 3).collect()
    assert [r.movie_id for r in top] == [120, 1448, 1021]
    assert [r.n_ratings for r in top] == [34, 24, 27]
    assert top[0].avg_rating == pytest.approx(3.544, abs=1e-3)


def test_pair_277_299(data):
    ratings, _ = data
    ols = ops.pair_ols(ratings, [(277, 299)]).collect()[0]
    cos = ops.pair_cosine(ratings, [(277, 299)]).collect()[0]
    assert ols.n == 10
    assert ols.slope == pytest.approx(0.300640, abs=1e-6)
    assert ols.intercept == pytest.approx(1.683369, abs=1e-6)
    assert ols.r2 == pytest.approx(0.042012, abs=1e-6)
    assert cos.cosine == pytest.approx(0.815939, abs=1e-6)


def test_fixture_pairs_against_duckdb(data, duck):
    ratings, _ = data
    pairs = [(277, 299), (516, 895), (638, 956)]
    got = rows(ops.pair_sums(ratings, pairs))
    values = ", ".join(f"({a}, {b})" for a, b in pairs)
    sql = _with("ratings") + f"""
        SELECT p.u1 AS user1, p.u2 AS user2, count(*) AS n, sum(a.rating), sum(b.rating),
               sum(a.rating * a.rating), sum(b.rating * b.rating), sum(a.rating * b.rating)
        FROM (VALUES {values}) p(u1, u2)
        JOIN ratings a ON a.user_id = p.u1
        JOIN ratings b ON b.user_id = p.u2 AND b.movie_id = a.movie_id
        GROUP BY 1, 2"""
    expected = sorted(tuple(r) for r in duck.execute(sql).fetchall())
    assert got == expected
    assert [r[2] for r in got] == [10, 10, 10]


def test_year_and_genre_selection_against_duckdb(data, duck):
    _, movies = data
    got = rows(ops.movies_in_year(movies, "2000"), "movie_id")
    sql = "SELECT p_partkey FROM part WHERE p_size = 50 ORDER BY 1"
    assert got == [tuple(r) for r in duck.execute(sql).fetchall()]
    assert len(got) == 40
    genre_rows = rows(ops.movies_in_genres(movies, ["SMALL", "bolt"]))
    sql = _with("movie_genres") + "SELECT genre, movie_id FROM movie_genres WHERE genre IN ('SMALL', 'bolt')"
    assert genre_rows == sorted(tuple(r) for r in duck.execute(sql).fetchall())


def test_favourite_and_recommend_for_selected_users(data, spark):
    ratings, movies = data
    users = [7, 42, 99]
    fav_all = {r.user_id: r for r in ops.favourite_genre(ratings, movies).collect()}
    fav_sel = {r.user_id: r for r in ops.favourite_genre(ratings, movies, users).collect()}
    assert set(fav_sel) == set(users)
    for u in users:
        assert (fav_sel[u].genre, fav_sel[u].fav_score) == (fav_all[u].genre, fav_all[u].fav_score)
    rec_all = rows(ops.recommend(ratings, movies).where("user_id IN (7, 42, 99)"))
    rec_sel = rows(ops.recommend(ratings, movies, users))
    assert rec_all == rec_sel and rec_sel
