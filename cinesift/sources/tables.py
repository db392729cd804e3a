"""The ``ratings`` and ``movies`` inputs derived from the benchmark's Parquet tables.

A customer "rates" a part: every lineitem is one rating by the order's customer of
the line's part, the quantity 1..50 becoming 0.5..5.0 in half stars. A part is a
movie titled ``"<p_name>, <p_brand> (<1950 + p_size>)"`` (a comma, digits before the
year) whose genres are its type plus the words of its name.

Only the columns named here are read (column pruning reaches the Parquet scan), and
filters that operators place on ``user_id``/``movie_id`` are pushed into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# The columns this package reads from the benchmark tables, with their
# Parquet types. A declared schema skips the footer-reading inference job per read.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE, l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_regionkey INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, movie_id, rating, ts)``, one row per lineitem (bag semantics)."""
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner")
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        (F.ceil(F.col("l_quantity") / 5) / 2).alias("rating"),
        F.col("l_shipdate").alias("ts"),
    )


def movies_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(movie_id, title, genres)`` from ``part``."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return part.select(
        F.col("p_partkey").alias("movie_id"),
        F.concat(
            F.col("p_name"),
            F.lit(", "),
            F.col("p_brand"),
            F.lit(" ("),
            (F.lit(1950) + F.col("p_size")).cast("string"),
            F.lit(")"),
        ).alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))).alias(
            "genres"
        ),
    )


def customer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every registered user, rated or not: a key frame for user lookups."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views ``ratings`` and ``movies`` for SQL users."""
    ratings_from_tables(spark, sf_dir).createOrReplaceTempView("ratings")
    movies_from_tables(spark, sf_dir).createOrReplaceTempView("movies")
