"""The movie catalogue: titles, years and genres (independent of ratings).

All results are row form. A per-genre or per-year list would put a whole genre
(possibly a third of the catalogue) into one row and one task, so callers that want
a list build it themselves from these rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinesift.functions.genres import genre_array
from cinesift.functions.keys import Keys, restrict
from cinesift.functions.titles import normalise_title_key, title_key, title_year


def with_title_year(movies: DataFrame) -> DataFrame:
    """``movies`` plus ``title_key`` (commas removed) and ``year`` (string, '0' = unknown)."""
    return movies.withColumn("title_key", title_key("title")).withColumn("year", title_year("title"))


def select_titles(movies: DataFrame, titles: Keys) -> DataFrame:
    """``(movie_id, title, title_key)`` of the movies carrying one of ``titles``.

    A title matches with or without its commas (both sides compared on ``title_key``).
    """
    keyed = movies.select("movie_id", "title", title_key("title").alias("title_key"))
    if isinstance(titles, DataFrame):
        titles = titles.select(title_key(F.col(titles.columns[0])).alias("title_key"))
    return restrict(keyed, "title_key", titles, transform=normalise_title_key)


def explode_genres(movies: DataFrame, columns: Sequence[str] = ("movie_id",), outer: bool = False) -> DataFrame:
    """``(*columns, genre)``: one row per genre listed for a movie (a repeat stays a row).

    A row without genres is left out, or with ``outer`` keeps one row of NULL genre.
    """
    listed = (F.explode_outer if outer else F.explode)(genre_array("genres"))
    return movies.select(*columns, listed.alias("genre"))


def rated_genres(ratings: DataFrame, movies: DataFrame, outer: bool = False) -> DataFrame:
    """``ratings`` with ``genre`` for ``movie_id``: one row per rating and genre of its movie.

    A rating of a movie that is missing from ``movies`` is left out, or with ``outer`` keeps
    one row of NULL genre.

    Before the genres are listed, the ratings are dealt out by user in partitions that adaptive
    execution keeps near its advisory size. A task then aggregates a few users' rows instead of
    a share of every user's, so its table of ``(user, genre)`` groups stays small whatever the
    number of users. They are dealt by a hash of the user, which Spark does not take for the
    distribution of a later aggregate: that one still combines rows before its own exchange, and
    adaptive execution may split a user that holds a huge share of the ratings.
    """
    joined = ratings.join(movies.select("movie_id", "genres"), on="movie_id", how="left" if outer else "inner")
    dealt = joined.withColumn("_deal", F.hash("user_id")).hint("rebalance", "_deal")
    return explode_genres(dealt, [c for c in ratings.columns if c != "movie_id"], outer)


def genre_movie_counts(movies: DataFrame) -> DataFrame:
    """``(genre, n_movies)``: catalogue size per genre, counting (movie, genre) rows."""
    return explode_genres(movies).groupBy("genre").agg(F.count(F.lit(1)).alias("n_movies"))


def movies_in_genres(movies: DataFrame, genres: Keys = None) -> DataFrame:
    """``(genre, movie_id)`` for the selected genres (``None`` = every genre)."""
    return restrict(explode_genres(movies), "genre", genres).select("genre", "movie_id")


def movies_by_year(movies: DataFrame) -> DataFrame:
    """``(year, movie_id, title)`` for the whole catalogue."""
    return with_title_year(movies).select("year", "movie_id", "title")


def movies_in_year(movies: DataFrame, years: Keys) -> DataFrame:
    """``(year, movie_id, title)`` for the selected years (strings; '0' = unknown)."""
    if years is not None and not isinstance(years, DataFrame):
        years = [str(y) for y in ([years] if isinstance(years, (str, int)) else years)]
    return restrict(movies_by_year(movies), "year", years)
