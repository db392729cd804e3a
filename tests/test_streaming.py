"""Streaming upkeep of the aggregates equals the batch operators after each new file."""

from __future__ import annotations

import os
import tempfile

from cinesift import operators as ops
from cinesift.sources import read_ratings
from cinesift.streaming import latest, read_ratings_stream, start_aggregate

FILES = [
    "userId,movieId,rating,timestamp\n1,10,4.0,1\n1,11,2.0,2\n2,10,5.0,3\n",
    "userId,movieId,rating,timestamp\n2,13,1.0,4\n3,13,4.5,5\n4,11,4.0,6\n",
    "userId,movieId,rating,timestamp\n4,13,4.0,7\n5,12,5.0,8\n6,11,3.0,9\n1,10,3.5,10\n",
]


def test_incremental_runs_match_batch(spark):
    folder = tempfile.mkdtemp(prefix="cinesift-stream-in-")
    tables = tempfile.mkdtemp(prefix="cinesift-stream-out-")
    for i, text in enumerate(FILES):
        with open(os.path.join(folder, f"ratings-{i}.csv"), "w") as f:
            f.write(text)
        for name in ("user_watch_counts", "movie_avg_rating"):
            stream = read_ratings_stream(spark, folder, max_files_per_trigger=1)
            query = start_aggregate(stream, name, os.path.join(tables, name))
            query.awaitTermination(120)
            assert query.exception() is None
            batch = getattr(ops, name)(read_ratings(spark, folder))
            got = latest(spark, os.path.join(tables, name))
            assert got.columns == batch.columns
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
