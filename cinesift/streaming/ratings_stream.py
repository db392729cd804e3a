"""Incremental upkeep of the per-user and per-movie aggregates as rating files arrive.

The reference is batch-only; its aggregate tasks (rows per user, average rating and
rows per movie) are plain ``groupBy`` aggregates, so the batch operators run
unchanged on a streaming DataFrame. This module provides the streaming source (new
CSV files in a folder, same layout as :func:`cinesift.sources.read_ratings`) and a
runner whose state and progress live in the session's shared checkpoint folder, so a
restarted query resumes where it stopped and every file is counted exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cinesift.operators.activity import movie_watch_counts, user_watch_counts
from cinesift.operators.scores import movie_avg_rating
from cinesift.sources.csv import RATINGS_CSV_SCHEMA, RATINGS_OPTIONS, _from_epoch

STREAMED_AGGREGATES = {
    "user_watch_counts": user_watch_counts,
    "movie_watch_counts": movie_watch_counts,
    "movie_avg_rating": movie_avg_rating,
}


def read_ratings_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(user_id, movie_id, rating, ts)`` from CSV files added to ``path``."""
    reader = spark.readStream.options(**RATINGS_OPTIONS).option("mode", "FAILFAST").schema(RATINGS_CSV_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(path)
    return raw.select(
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("movie_id"),
        F.col("rating").alias("rating"),
        _from_epoch("timestamp").alias("ts"),
    )


def start_aggregate(
    ratings_stream: DataFrame,
    name: str,
    target: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep one of :data:`STREAMED_AGGREGATES` as a table under the shared folder ``target``.

    ``available_now`` processes every file present and stops (a scheduled incremental
    run); otherwise the query keeps running. Every trigger writes the aggregate over all
    files seen to a folder of its own (``version=<batch>``), by the executors;
    :func:`latest` reads the newest. State and progress live under ``target`` as well, so
    one target belongs to one aggregate of one input folder.
    """
    build = STREAMED_AGGREGATES[name]
    root = target.rstrip("/")

    def write(frame: DataFrame, batch: int) -> None:
        # a batch that is repeated after a failure overwrites its own version
        frame.write.mode("overwrite").parquet(f"{root}/table/version={batch}")

    writer = (
        build(ratings_stream)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", f"{root}/progress")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def latest(spark: SparkSession, target: str) -> DataFrame:
    """The newest complete version of the table that :func:`start_aggregate` keeps."""
    versions = spark.read.parquet(f"{target.rstrip('/')}/table")
    newest = versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == newest).drop("version")
