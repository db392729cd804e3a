"""Average ratings per movie, lookups, and the two top-n charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinesift.functions.keys import Keys, restrict
from cinesift.operators.activity import movie_watch_counts
from cinesift.operators.catalog import select_titles


def movie_avg_rating(ratings: DataFrame, movie_ids: Keys = None) -> DataFrame:
    """``(movie_id, avg_rating)``: sum of ratings / number of rating rows.

    Partial (map-side) aggregation before the shuffle, so a movie holding a large
    share of all ratings costs one small partial row per input partition.
    """
    r = restrict(ratings.select("movie_id", "rating"), "movie_id", movie_ids)
    return r.groupBy("movie_id").agg(F.avg("rating").alias("avg_rating"))


def movie_avg_rating_titled(ratings: DataFrame, movies: DataFrame, movie_ids: Keys = None) -> DataFrame:
    """``(movie_id, avg_rating, title)``; movies absent from ``movies`` are dropped."""
    avg = movie_avg_rating(ratings, movie_ids)
    return avg.join(movies.select("movie_id", "title"), on="movie_id", how="inner")


def title_avg_rating(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``(title, avg_rating)``: one row per movie, labelled by its (not unique) title."""
    return movie_avg_rating_titled(ratings, movies).select("title", "avg_rating")


def avg_rating_by_movie_id(ratings: DataFrame, movies: DataFrame, movie_ids: Keys) -> DataFrame:
    """``(movie_id, avg_rating, title)`` for the selected movie ids.

    The id filter is applied to ``ratings`` before the aggregate, so it reaches the scan.
    """
    return movie_avg_rating_titled(ratings, movies, movie_ids)


def avg_rating_by_title(ratings: DataFrame, movies: DataFrame, titles: Keys) -> DataFrame:
    """``(movie_id, avg_rating, title)`` for every movie carrying a selected title."""
    chosen = select_titles(movies, titles).select("movie_id", "title")
    avg = movie_avg_rating(ratings, chosen.select("movie_id"))
    return avg.join(chosen, on="movie_id", how="inner")


def top_rated(ratings: DataFrame, n: int, min_ratings: int = 1) -> DataFrame:
    """``(movie_id, avg_rating, n_ratings)``: the ``n`` best averages, ties by movie_id.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: every partition keeps
    its own n best and only those reach the final merge; there is no full sort.
    """
    if int(n) < 0:
        raise ValueError(f"n must be non-negative, got {n}")
    agg = ratings.groupBy("movie_id").agg(
        F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("n_ratings")
    )
    if min_ratings > 1:
        agg = agg.where(F.col("n_ratings") >= min_ratings)
    return agg.orderBy(F.col("avg_rating").desc(), F.col("movie_id").asc()).limit(int(n))


def top_watched(ratings: DataFrame, n: int) -> DataFrame:
    """``(movie_id, watch_count)``: the ``n`` most-rated movies, ties by movie_id."""
    return (
        movie_watch_counts(ratings)
        .orderBy(F.col("watch_count").desc(), F.col("movie_id").asc())
        .limit(int(n))
    )
