"""Readers (and matching writers) for the two CSV inputs.

``ratings``: ``userId,movieId,rating,timestamp`` (timestamp = epoch seconds).
``movies``:  ``movieId,title,genres``; a title containing a comma is quoted, a quote
inside a quoted title is doubled (``"Say ""Hi"" (2001)"``).

Every file of a directory carries its own header line, which the reader skips.
Explicit schemas mean no inference pass over the data, and a filter or projection
placed on the result is pushed into the CSV scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATINGS_CSV_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

MOVIES_CSV_SCHEMA = T.StructType(
    [
        T.StructField("movieId", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}
# Ratings hold numbers only, so blanks around a field are no part of it; those of a title are.
RATINGS_OPTIONS = {**CSV_OPTIONS, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
WRITE_OPTIONS = {
    **CSV_OPTIONS, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": '""'}


def _from_epoch(seconds: str) -> F.Column:
    """TIMESTAMP_NTZ of epoch seconds, in no session's time zone."""
    return F.expr(f"TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})")


def read_ratings(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """``(user_id BIGINT, movie_id BIGINT, rating DOUBLE, ts TIMESTAMP_NTZ)``.

    A malformed row (a rating that is no number, say) fails the query; with ``mode`` set to
    ``PERMISSIVE`` its bad fields are NULL, with ``DROPMALFORMED`` the row is left out. Only
    the columns that a query reads are parsed.
    """
    raw = spark.read.options(**RATINGS_OPTIONS).option("mode", mode).schema(RATINGS_CSV_SCHEMA).csv(path)
    return raw.select(
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("movie_id"),
        F.col("rating").alias("rating"),
        _from_epoch("timestamp").alias("ts"),
    )


def read_movies(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """``(movie_id BIGINT, title STRING, genres STRING)``; quoted titles unquoted, blanks kept.

    A record is one line, so that large files are split; malformed rows fail the query (see
    :func:`read_ratings`).
    """
    raw = spark.read.options(**CSV_OPTIONS).option("mode", mode).schema(MOVIES_CSV_SCHEMA).csv(path)
    return raw.select(
        F.col("movieId").alias("movie_id"),
        F.col("title").alias("title"),
        F.col("genres").alias("genres"),
    )


def _epoch_seconds(df: DataFrame, column: str) -> F.Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(column))
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(F.col(column))
    return F.col(column).cast("bigint")


def write_ratings_csv(ratings: DataFrame, path: str) -> None:
    """Write ratings in the input layout (one file per partition, each with a header)."""
    out = ratings.select(
        F.col("user_id").alias("userId"),
        F.col("movie_id").alias("movieId"),
        F.col("rating").alias("rating"),
        _epoch_seconds(ratings, "ts").alias("timestamp"),
    )
    out.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)


def _one_line(column: str) -> F.Column:
    """The column; a value with a line break, which the layout cannot hold, fails the write."""
    message = F.concat(F.lit(f"line break in {column}: "), F.col(column))
    return F.when(F.col(column).rlike("[\r\n]"), F.raise_error(message)).otherwise(F.col(column)).alias(column)


def write_movies_csv(movies: DataFrame, path: str) -> None:
    """Write movies in the input layout; titles come back as they are, blanks included."""
    out = movies.select(F.col("movie_id").alias("movieId"), _one_line("title"), _one_line("genres"))
    out.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)
