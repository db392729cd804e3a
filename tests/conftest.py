from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from cinesift.session import DEFAULT_CONF  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("cinesift-tests")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    # Tests run in local mode, where the session has no shared checkpoint folder.
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cinesift-test-ckpt-"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RATINGS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("movie_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
    ]
)
MOVIES_SCHEMA = T.StructType(
    [
        T.StructField("movie_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)

# FIXTURES.md §4: the micro data set.
MICRO_MOVIES = [
    (10, "Alpha (1990)", "Drama"),
    (11, "Beta, The (1991)", "Drama|Comedy"),
    (12, "Gamma (1992)", "Comedy"),
    (13, "Delta (1993)", "Drama"),
]
MICRO_RATINGS = [
    (1, 10, 4.0),
    (1, 11, 2.0),
    (2, 10, 5.0),
    (2, 13, 1.0),
    (3, 13, 4.5),
    (4, 11, 4.0),
    (4, 13, 4.0),
    (5, 12, 5.0),
    (6, 11, 3.0),
    (7, 99, 4.0),
]


@pytest.fixture(scope="session")
def micro(spark):
    ratings = spark.createDataFrame(MICRO_RATINGS, RATINGS_SCHEMA)
    movies = spark.createDataFrame(MICRO_MOVIES, MOVIES_SCHEMA)
    return ratings, movies


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns if none given)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
