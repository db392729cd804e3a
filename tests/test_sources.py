"""FIXTURES.md §3: CSV readers, title key and year rule; the benchmark-table mapping."""

from __future__ import annotations

import os
import tempfile

import pytest

from cinesift import operators as ops
from cinesift.sources import (
    movies_from_tables,
    ratings_from_tables,
    read_movies,
    read_ratings,
    write_movies_csv,
    write_ratings_csv,
)
from tests.conftest import SF_SMALL, rows

MOVIES_CSV = '''movieId,title,genres
1,Heat (1995),Action|Crime
2,"American President, The (1995)",Comedy
3,Untitled,(no genres listed)
4,Room 237,Drama
5,"A, B 12",X
6,"Say ""Hi"" (2001)",X|Y
'''

EXPECTED = {
    1: ("Heat (1995)", "Heat (1995)", "1995"),
    2: ("American President, The (1995)", "American President The (1995)", "1995"),
    3: ("Untitled", "Untitled", "0"),
    4: ("Room 237", "Room 237", "7"),
    5: ("A, B 12", "A B 12", "12"),
    6: ('Say "Hi" (2001)', 'Say "Hi" (2001)', "2001"),
}


def _write(folder: str, name: str, text: str) -> str:
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_read_movies_titles_and_years(spark):
    folder = tempfile.mkdtemp(prefix="cinesift-csv-")
    path = _write(folder, "movies.csv", MOVIES_CSV)
    movies = read_movies(spark, path)
    got = {r.movie_id: (r.title, r.title_key, r.year) for r in ops.with_title_year(movies).collect()}
    assert got == EXPECTED
    genres = rows(ops.explode_genres(movies))
    assert (3, "(no genres listed)") in genres and (6, "X") in genres and (6, "Y") in genres


def test_read_movies_directory_with_header_per_file(spark):
    folder = tempfile.mkdtemp(prefix="cinesift-csv-")
    lines = MOVIES_CSV.strip().split("\n")
    _write(folder, "part-a.csv", "\n".join(lines[:4]) + "\n")
    _write(folder, "part-b.csv", "\n".join([lines[0]] + lines[4:]) + "\n")
    movies = read_movies(spark, folder)
    assert sorted(r.movie_id for r in movies.collect()) == [1, 2, 3, 4, 5, 6]


def test_genre_with_digit_is_kept_whole(spark):
    folder = tempfile.mkdtemp(prefix="cinesift-csv-")
    movies = read_movies(spark, _write(folder, "m.csv", "movieId,title,genres\n1,X (2000),Sci-Fi|Film4\n"))
    ratings = read_ratings(spark, _write(folder, "r.csv", "userId,movieId,rating,timestamp\n12,1,4.5,964982703\n"))
    got = rows(ops.user_genre_profile(ratings, movies), "user_id", "genre", "n_rated")
    assert got == [(12, "Film4", 1), (12, "Sci-Fi", 1)]


def test_read_ratings_types_and_pushdown(spark):
    folder = tempfile.mkdtemp(prefix="cinesift-csv-")
    text = "userId,movieId,rating,timestamp\n1,31,2.5,1260759144\n1,1029,3.0,1260759179\n7,31,4.0,1260759185\n"
    ratings = read_ratings(spark, _write(folder, "ratings.csv", text))
    assert [f.dataType.simpleString() for f in ratings.schema.fields] == ["bigint", "bigint", "double", "timestamp_ntz"]
    selected = ratings.where("user_id = 1")
    assert rows(selected, "movie_id", "rating") == [(31, 2.5), (1029, 3.0)]
    plan = selected._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(userId), EqualTo(userId,1)]" in plan


def test_table_mapping_shapes(spark):
    ratings = ratings_from_tables(spark, SF_SMALL)
    movies = movies_from_tables(spark, SF_SMALL)
    assert ratings.count() == 6000
    assert movies.count() == 200
    r = ratings.agg({"rating": "min"}).collect()[0][0], ratings.agg({"rating": "max"}).collect()[0][0]
    assert r == (0.5, 5.0)
    m = movies.where("movie_id = 7").collect()
    assert m and "|" in m[0].genres and m[0].title.endswith(")")


def _year_rule(title: str) -> str:
    # The rule as plain Python: digits of the last comma fragment, then the slice
    # [n-4:n] with Python's negative-index semantics; no digit -> '0'.
    import re

    digits = re.findall("[0-9]", title.split(",")[-1])
    n = len(digits)
    return "0" if n == 0 else "".join(digits[n - 4 : n])


def test_year_rule_matches_python_slice_semantics(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    titles: list[str] = []

    @settings(max_examples=300, database=None)
    @given(st.text(alphabet="ab 0123456789,()", max_size=18))
    def collect(t):
        titles.append(t)

    collect()
    frame = spark.createDataFrame([(i, t, "") for i, t in enumerate(titles)], "movie_id bigint, title string, genres string")
    got = {r.movie_id: r.year for r in ops.with_title_year(frame).collect()}
    for i, t in enumerate(titles):
        assert got[i] == _year_rule(t), t


def test_malformed_rows_fail_by_default(spark):
    folder = tempfile.mkdtemp(prefix="cinesift-csv-")
    text = "userId,movieId,rating,timestamp\n1,31,bad,1\n1,32,3.0,2\nx,31,2.0,3\n"
    path = _write(folder, "r.csv", text)
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_ratings(spark, path).collect()
    assert rows(read_ratings(spark, path, mode="DROPMALFORMED"), "user_id", "movie_id", "rating") == [(1, 32, 3.0)]
    loose = read_ratings(spark, path, mode="PERMISSIVE")
    movies = read_movies(spark, _write(folder, "m.csv", "movieId,title,genres\n31,A (2000),X\n32,B (2000),X\n"))
    # the mean is over the ratings that are there
    assert rows(ops.user_genre_profile(loose.where("user_id = 1"), movies), "genre", "avg_rating", "n_rated") == [("X", 3.0, 1)]


def test_titles_and_times_survive_the_round_trip(spark):
    folder = tempfile.mkdtemp(prefix="cinesift-csv-")
    titles = [" Lead (1990)", "Trail (1991) ", 'Quote "Q", (1992)', "Plain (1993)", "  ", "tab\t(1994)"]
    movies = spark.createDataFrame([(i, t, "A|B") for i, t in enumerate(titles)], "movie_id bigint, title string, genres string")
    write_movies_csv(movies, os.path.join(folder, "movies"))
    assert rows(read_movies(spark, os.path.join(folder, "movies"))) == rows(movies)
    broken = spark.createDataFrame([(1, "Two\nLines (1991)", "A")], "movie_id bigint, title string, genres string")
    with pytest.raises(Exception, match="line break in title"):
        write_movies_csv(broken, os.path.join(folder, "broken"))
    ratings = ratings_from_tables(spark, SF_SMALL)
    for zone in ("UTC", "America/New_York"):
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            write_ratings_csv(ratings, os.path.join(folder, zone))
            assert rows(read_ratings(spark, os.path.join(folder, zone))) == rows(ratings)
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)


def test_written_tables_never_share_a_path(spark):
    from cinesift import materialize, scratch_path

    assert scratch_path(spark, "t") != scratch_path(spark, "t")
    first = materialize(spark.range(3).toDF("a"), "t")
    second = materialize(spark.range(5).toDF("b"), "t")
    assert first.count() == 3 and second.count() == 5
