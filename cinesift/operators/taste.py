"""Genre taste: per-user genre profile, favourite genre, clusters of users.

Favourite-genre score of (user, genre) = mean rating x (ratings in genre / 10), which
is exactly ``sum(rating) / 10``. The sum is kept (``rating_sum``) because for
half-star ratings it is exact and order-independent, so ranking on it is stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinesift.functions.keys import Keys, restrict
from cinesift.operators.catalog import rated_genres

# Fixed value: the favourite-genre score divides the number of ratings by ten.
FAV_SCORE_DIVISOR = 10.0


def user_genre_profile(ratings: DataFrame, movies: DataFrame, users: Keys = None) -> DataFrame:
    """``(user_id, genre, avg_rating, n_rated, fav_score, rating_sum)``.

    A rating counts once for every genre listed on its movie; a movie missing from
    ``movies`` contributes nothing. Dealt out by user (:func:`rated_genres`), then aggregated
    partially before the shuffle on ``(user_id, genre)``, so even a user with a huge share of
    the ratings reaches the exchange as at most (genres x partitions) rows.
    """
    r = restrict(ratings.select("user_id", "movie_id", "rating"), "user_id", users)
    agg = rated_genres(r, movies).groupBy("user_id", "genre").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("n_rated")
    )
    return agg.select(
        "user_id",
        "genre",
        (F.col("rating_sum") / F.nullif(F.col("n_rated"), F.lit(0))).alias("avg_rating"),
        "n_rated",
        (F.col("rating_sum") / FAV_SCORE_DIVISOR).alias("fav_score"),
        "rating_sum",
    )


def favourite_genre(ratings: DataFrame, movies: DataFrame, users: Keys = None) -> DataFrame:
    """``(user_id, genre, fav_score, rating_sum)``: each user's highest-scoring genre.

    Ties go to the alphabetically first genre. ``row_number() = 1`` plans as a
    WindowGroupLimit, which keeps one row per user inside each partition before the
    window sort; the window partition of a user is bounded by the number of genres.
    """
    profile = user_genre_profile(ratings, movies, users)
    w = Window.partitionBy("user_id").orderBy(F.col("rating_sum").desc(), F.col("genre").asc())
    return (
        profile.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select("user_id", "genre", "fav_score", "rating_sum")
    )


def taste_clusters(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``(genre, user_id)``: users clustered by favourite genre, as rows.

    Users are never collected per genre: one genre may hold a third of all users.
    """
    return favourite_genre(ratings, movies).select("genre", "user_id")


def taste_cluster_sizes(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``(genre, n_users)``."""
    return taste_clusters(ratings, movies).groupBy("genre").agg(F.count(F.lit(1)).alias("n_users"))
