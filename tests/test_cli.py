"""The command line accepts the reference's task arguments and writes every result."""

from __future__ import annotations

import os
import tempfile

import pytest

from cinesift.cli import main, parse

MOVIES = 'movieId,title,genres\n10,Alpha (1990),Drama\n11,"Beta, The (1991)",Drama|Comedy\n12,Gamma (1992),Comedy\n13,Delta (1993),Drama\n'
RATINGS = (
    "userId,movieId,rating,timestamp\n1,10,4.0,1\n1,11,2.0,2\n2,10,5.0,3\n2,13,1.0,4\n3,13,4.5,5\n"
    "4,11,4.0,6\n4,13,4.0,7\n5,12,5.0,8\n6,11,3.0,9\n7,99,4.0,10\n"
)


@pytest.fixture(scope="module")
def files():
    folder = tempfile.mkdtemp(prefix="cinesift-cli-")
    paths = {}
    for name, text in (("ratings", RATINGS), ("movies", MOVIES)):
        paths[name] = os.path.join(folder, f"{name}.csv")
        with open(paths[name], "w") as f:
            f.write(text)
    return paths


def test_parse_reference_style_arguments():
    ns = parse(["--ratings", "r", "--movies", "m", "--TASK2", "MovieTitle_Rating", "Beta, The (1991)"])
    assert (ns.task, ns.task_args) == ("2", ["MovieTitle_Rating", "Beta, The (1991)"])
    assert parse(["--ratings", "r", "--movies", "m", "--TASK1.1", "116", "650"]).task == "1.1"


@pytest.mark.parametrize(
    "task,expected",
    [
        (["--TASK1", "ALL"], {"user_watch_counts": 7}),
        (["--TASK2", "MovieID_Rating", "11"], {"avg_rating_by_movie_id": 1}),
        (["--TASK2.5", "movie_title_select", "Beta The (1991)"], {"watch_count_by_title": 1}),
        (["--TASK3", "Comedy"], {"genre_movie_counts": 2, "movies_in_genres": 2}),
        (["--TASK5", "3"], {"top_rated": 3}),
        (["--TASK8", "1", "4"], {"pair_cosine": 1, "pair_ols": 1}),
        (["--TASK10", "3"], {"similar_users": 3, "recommend": 2}),
    ],
)
def test_tasks_write_results(spark, files, task, expected):
    out = tempfile.mkdtemp(prefix="cinesift-cli-out-")
    assert main(["--ratings", files["ratings"], "--movies", files["movies"], "--out", out, *task]) == 0
    for name, n in expected.items():
        assert spark.read.parquet(os.path.join(out, name)).count() == n, name


def test_csv_output_with_arrays(spark, files):
    out = tempfile.mkdtemp(prefix="cinesift-cli-out-")
    main(["--ratings", files["ratings"], "--movies", files["movies"], "--out", out, "--format", "csv", "--TASK10", "3"])
    rec = spark.read.option("header", "true").csv(os.path.join(out, "recommend"))
    assert sorted(r.ratings for r in rec.collect()) == ["[4.0, 5.0]", "[4.0]"]


@pytest.mark.parametrize(
    "task",
    [["--TASK2", "10"], ["--TASK2", "ALL", "3"], ["--TASK2.5", "10"], ["--TASK2.5", "movie_ID_select"], ["--TASK2.5", "movie_title_select"],
     ["--TASK5"], ["--TASK5", "-1"], ["--TASK6", "x"], ["--TASK8", "1"], ["--TASK8", "1", "2", "3"], ["--TASK1", "me"]],
)
def test_unknown_modes_and_missing_arguments_are_rejected(spark, files, task, capsys):
    assert main(["--ratings", files["ratings"], "--movies", files["movies"], *task]) == 2
    assert task[0] in capsys.readouterr().err


def test_csv_output_keeps_every_column(spark, files):
    out = tempfile.mkdtemp(prefix="cinesift-cli-out-")
    main(["--ratings", files["ratings"], "--movies", files["movies"], "--out", out, "--format", "csv", "--TASK10", "3"])
    rec = spark.read.option("header", "true").csv(os.path.join(out, "recommend"))
    assert sorted(r.rating_counts for r in rec.collect()) == ["4.0:1", "4.0:1|5.0:1"]


def test_preview_names_the_number_of_rows(spark, files, capsys):
    main(["--ratings", files["ratings"], "--movies", files["movies"], "--show", "2", "--TASK1", "ALL"])
    assert "user_watch_counts: 7 rows" in capsys.readouterr().out
