"""Helpers shared by the training-data operators: table reading, written cut points, components."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinesift.session import scratch_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder; no two calls return the same one.
    ``cinesift.drop_scratch`` deletes what was written to such paths."""
    return scratch_path(spark, f"llm/{name}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    This cuts the lineage where every executor can reach it: what follows re-reads the
    files after a lost executor, and the planner knows the table's true size.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


try:
    _LIBC = ctypes.CDLL(None)
except OSError:
    _LIBC = None

# Rows that a Python worker takes up at once: what it makes of a text (words, ids, hashes) is many
# times as large as the text.
ROWS_AT_ONCE = 512


def _give_back() -> None:
    """Spare memory of this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows; at the end the worker's spare memory goes back to the system."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        _give_back()


_SHIPPED: set[str] = set()


def shipped(df: DataFrame) -> DataFrame:
    """``df``, once Spark has been given this package's source for the Python workers.

    Functions that run inside tasks are looked up there by name; so a session works whether or
    not the workers have the package on their own path. Once per application.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        path = os.path.join(tempfile.mkdtemp(prefix="cinesift-source-"), f"{package.name}-{uuid.uuid4().hex}.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, str(source.relative_to(package.parent)))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return df


def _fingerprint_of(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph: ``edges(u, v)`` of longs -> ``(node, component)``.

    Alternating large-star and small-star rounds (every node links its larger, then its
    smaller neighbours to the smallest node it knows). The number of edges never grows, a
    hub is only a join key (which adaptive execution may split), and each round is written
    to the shared folder. Rounds go on until the edge set no longer changes; it is then one
    star per component around its smallest node. Nodes without an edge are not returned;
    self loops and repeated edges are ignored.
    """
    current = written(
        edges.select("u", "v").where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    seen = _fingerprint_of(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        # every edge now points from the larger to the smaller node
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        current = written(small, "edges")
        now = _fingerprint_of(current)
        if now == seen:
            break
        seen = now
    return (
        current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
    )
