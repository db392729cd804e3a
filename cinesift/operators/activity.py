"""Who watched what, and how much (ratings are a bag: a repeated rating counts twice)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinesift.functions.genres import sorted_genre_list
from cinesift.functions.keys import Keys, restrict
from cinesift.operators.catalog import rated_genres, select_titles


def user_watch_counts(ratings: DataFrame, users: Keys = None) -> DataFrame:
    """``(user_id, movies_watched)``: rating rows per user."""
    r = restrict(ratings.select("user_id"), "user_id", users)
    return r.groupBy("user_id").agg(F.count(F.lit(1)).alias("movies_watched"))


def user_genre_counts(ratings: DataFrame, movies: DataFrame, users: Keys = None) -> DataFrame:
    """``(user_id, genres_watched)``: distinct genres among the movies a user rated.

    A rated movie missing from ``movies`` keeps its user (count 0 if nothing else).
    """
    r = restrict(ratings.select("user_id", "movie_id"), "user_id", users)
    rated = rated_genres(r, movies, outer=True)
    # A user's genre set is bounded by the number of genres, so one aggregate with a
    # map-side merged set replaces the two-level plan of count(DISTINCT) (one shuffle
    # instead of two). collect_set skips the NULL genre of an unknown movie.
    return rated.groupBy("user_id").agg(F.size(F.collect_set("genre")).cast("bigint").alias("genres_watched"))


def user_genres(ratings: DataFrame, movies: DataFrame, users: Keys = None) -> DataFrame:
    """``(user_id, genre)``: the distinct genre set of each selected user, as rows."""
    r = restrict(ratings.select("user_id", "movie_id"), "user_id", users)
    return rated_genres(r, movies).distinct()


def user_genre_lists(ratings: DataFrame, movies: DataFrame, users: Keys = None) -> DataFrame:
    """``(user_id, genres)``: the same set as one sorted ``|``-joined string.

    Bounded by the number of genres, so the per-user list is safe to build.
    """
    r = restrict(ratings.select("user_id", "movie_id"), "user_id", users)
    rated = rated_genres(r, movies)
    return rated.groupBy("user_id").agg(sorted_genre_list(F.collect_set("genre")).alias("genres"))


def user_watched_titles(ratings: DataFrame, movies: DataFrame, users: Keys = None) -> DataFrame:
    """``(user_id, movie_id, title)``: one row per rating; unknown movie -> NULL title."""
    r = restrict(ratings.select("user_id", "movie_id"), "user_id", users)
    return r.join(movies.select("movie_id", "title"), on="movie_id", how="left").select(
        "user_id", "movie_id", "title"
    )


def movie_watch_counts(ratings: DataFrame, movie_ids: Keys = None) -> DataFrame:
    """``(movie_id, watch_count)``: rating rows per movie."""
    r = restrict(ratings.select("movie_id"), "movie_id", movie_ids)
    return r.groupBy("movie_id").agg(F.count(F.lit(1)).alias("watch_count"))


def watch_count_by_movie_id(ratings: DataFrame, movies: DataFrame, movie_ids: Keys) -> DataFrame:
    """``(movie_id, watch_count, title)`` for the selected movies; unknown title -> NULL."""
    counts = movie_watch_counts(ratings, movie_ids)
    return counts.join(movies.select("movie_id", "title"), on="movie_id", how="left")


def watch_count_by_title(ratings: DataFrame, movies: DataFrame, titles: Keys) -> DataFrame:
    """``(title, movie_id, watch_count)``: one row per rated movie carrying a selected title.

    A title matches with or without its commas.
    """
    chosen = select_titles(movies, titles).select("movie_id", "title")
    counts = movie_watch_counts(ratings, chosen.select("movie_id"))
    return counts.join(chosen, on="movie_id", how="inner").select("title", "movie_id", "watch_count")
