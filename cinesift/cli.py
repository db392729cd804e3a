"""Command line with the reference's task arguments, backed by the operators.

    python -m cinesift --ratings ratings.csv --movies movies.csv --TASK1 ALL
    python -m cinesift --ratings r.csv --movies m.csv --out results/ --TASK8 671 669

Each task builds one or more DataFrames. With ``--out`` every result is written under
that folder (Parquet, or CSV with ``--format csv``) by the executors; without it, a preview
of each is printed: its number of rows and up to ``--show`` of them. Nothing else is
collected to the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinesift import operators as ops
from cinesift.functions.keys import restrict
from cinesift.session import get_session, materialize
from cinesift.sources.csv import read_movies, read_ratings

TASKS = ["1", "1.1", "1.2", "2", "2.5", "3", "4", "5", "6", "7", "8", "9", "10"]


class UsageError(ValueError):
    """Task arguments that name no task of the reference."""


def _ids(args: list[str], what: str) -> list[int]:
    try:
        return [int(a) for a in args]
    except ValueError:
        raise UsageError(f"{what} must be whole numbers, got {' '.join(args)}") from None


def _users(args: list[str]):
    """``[]`` or ``['ALL']`` -> all users (None); otherwise the listed ids."""
    return None if not args or args == ["ALL"] else _ids(args, "user ids")


def _mode(args: list[str], *modes: str) -> tuple[str, list[str]]:
    """The task's mode and its arguments; no arguments mean ALL."""
    mode, rest = (args[0], args[1:]) if args else ("ALL", [])
    if mode not in ("ALL", *modes) or (mode == "ALL" and rest):
        raise UsageError(f"expected ALL, {' or '.join(modes)}, got {' '.join(args)}")
    return mode, rest


def _some(args: list[str], what: str) -> list[str]:
    if not args:
        raise UsageError(f"{what} expected")
    return args


def _count(args: list[str]) -> int:
    if len(args) != 1 or (n := _ids(args, "the number of movies")[0]) < 0:
        raise UsageError("one number of movies expected, not negative")
    return n


def build(task: str, args: list[str], ratings: DataFrame, movies: DataFrame) -> dict[str, DataFrame]:
    """The result frames of one reference task, by name."""
    if task == "1":
        return {"user_watch_counts": ops.user_watch_counts(ratings, _users(args))}
    if task == "1.1":
        users = _users(args)
        out = {"user_genre_counts": ops.user_genre_counts(ratings, movies, users)}
        if users is not None:
            out["user_genre_lists"] = ops.user_genre_lists(ratings, movies, users)
        return out
    if task == "1.2":
        return {"user_watched_titles": ops.user_watched_titles(ratings, movies, _users(args))}
    if task == "2":
        mode, rest = _mode(args, "MovieID_Rating", "MovieTitle_Rating")  # fixed values
        if mode == "MovieID_Rating":
            if rest:
                return {"avg_rating_by_movie_id": ops.avg_rating_by_movie_id(ratings, movies, _ids(rest, "movie ids"))}
            return {"movie_avg_rating": ops.movie_avg_rating(ratings)}
        if mode == "MovieTitle_Rating":
            if rest:
                return {"avg_rating_by_title": ops.avg_rating_by_title(ratings, movies, rest)}
            return {"title_avg_rating": ops.title_avg_rating(ratings, movies)}
        return {"movie_avg_rating_titled": ops.movie_avg_rating_titled(ratings, movies)}
    if task == "2.5":
        mode, rest = _mode(args, "movie_ID_select", "movie_title_select")  # fixed values
        if mode == "movie_ID_select":
            ids = _ids(_some(rest, "movie ids"), "movie ids")
            return {"watch_count_by_movie_id": ops.watch_count_by_movie_id(ratings, movies, ids)}
        if mode == "movie_title_select":
            return {"watch_count_by_title": ops.watch_count_by_title(ratings, movies, _some(rest, "titles"))}
        return {"movie_watch_counts": ops.movie_watch_counts(ratings)}
    if task == "3":
        out = {"genre_movie_counts": ops.genre_movie_counts(movies)}
        if args:
            out["movies_in_genres"] = ops.movies_in_genres(movies, args)
        return out
    if task == "4":
        if args:
            return {"movies_in_year": ops.movies_in_year(movies, args)}
        return {"movies_by_year": ops.movies_by_year(movies)}
    if task == "5":
        return {"top_rated": ops.top_rated(ratings, _count(args))}
    if task == "6":
        return {"top_watched": ops.top_watched(ratings, _count(args))}
    if task == "7":
        return {"favourite_genre": ops.favourite_genre(ratings, movies, _users(args))}
    if task == "8":
        if len(args) != 2:
            raise UsageError("two user ids expected")
        pair = [tuple(_ids(args, "user ids"))]
        # the two users' ratings are all that the four results need
        ratings = materialize(restrict(ratings, "user_id", list(pair[0])), "pair-ratings")
        return {
            "common_ratings": ops.pair_fitted_points(ratings, pair),
            "pair_cosine": ops.pair_cosine(ratings, pair),
            "pair_ols": ops.pair_ols(ratings, pair),
            "pair_residual_shape": ops.pair_residual_shape(ratings, pair),
        }
    if task == "9":
        out = {
            "taste_clusters": ops.taste_clusters(ratings, movies),
            "taste_cluster_sizes": ops.taste_cluster_sizes(ratings, movies),
        }
        users = _users(args)
        if users is not None:
            out["favourite_genre"] = ops.favourite_genre(ratings, movies, users)
        return out
    if task == "10":
        users = _users(args)
        near = materialize(ops.similar_users(ratings, movies, users), "similar-users")
        return {
            "similar_users": near,
            "recommend": ops.with_rating_list(ops.recommend(ratings, movies, users, neighbours=near)),
        }
    raise ValueError(f"unknown task {task}")


def parse(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cinesift", description=__doc__.split("\n\n")[0])
    parser.add_argument("--ratings", required=True, help="ratings CSV file or folder")
    parser.add_argument("--movies", required=True, help="movies CSV file or folder")
    parser.add_argument("--out", help="write each result under this folder instead of printing a preview")
    parser.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    parser.add_argument("--show", type=int, default=20, help="rows of each preview, without --out")
    parser.add_argument("--master", help="Spark master (default: the environment's)")
    group = parser.add_mutually_exclusive_group(required=True)
    for task in TASKS:
        group.add_argument(f"--TASK{task}", dest=f"task_{task}", nargs="*", metavar="ARG")
    ns = parser.parse_args(argv)
    for task in TASKS:
        value = getattr(ns, f"task_{task}")
        if value is not None:
            ns.task, ns.task_args = task, value
    return ns


def _flat(column: str, kind: str):
    """A column as CSV can hold it: ``a:b|c:d`` for an array of structs, other arrays as text."""
    if kind.startswith("array<struct"):
        fields = [f.split(":")[0] for f in kind[len("array<struct<") : -2].split(",")]
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", *(x[f].cast("string") for f in fields))), "|").alias(column)
    return F.col(column).cast("string").alias(column) if kind.startswith("array") else F.col(column)


def main(argv: list[str] | None = None) -> int:
    ns = parse(sys.argv[1:] if argv is None else argv)
    spark = get_session(master=ns.master)
    ratings, movies = read_ratings(spark, ns.ratings), read_movies(spark, ns.movies)
    try:
        results = build(ns.task, ns.task_args, ratings, movies)
    except UsageError as wrong:
        print(f"--TASK{ns.task}: {wrong}", file=sys.stderr)
        return 2
    for name, frame in results.items():
        if ns.out:
            if ns.format == "csv":
                frame = frame.select(*[_flat(c, kind) for c, kind in frame.dtypes])
            writer = frame.write.mode("overwrite")
            target = f"{ns.out.rstrip('/')}/{name}"
            (writer.option("header", "true").csv(target) if ns.format == "csv" else writer.parquet(target))
            print(f"{name}: written to {target}")
        else:
            print(f"== {name}: {frame.count()} rows, a preview of {ns.show} at most")
            frame.show(ns.show, truncate=False)
    return 0
