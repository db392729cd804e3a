"""Sharding by jump consistent hashing: a stable key and the number of shards decide.

A key walks through the shards it would have lived in as shards were appended one by one, its
own generator saying how far each jump goes; the last place before the number of shards is its
shard. No ring and no table is kept, and one more shard takes about one row in (shards + 1)
and only into itself. The walk is decimal arithmetic modulo 2**64 inside Spark.

Slots number the rows of a shard without gaps, in order of the key. Rows are sorted by shard
and key over all partitions (a random last sort key splits a repeated key), so a shard is as
many tasks as its rows need; a partition's first slot is a sum over the partitions before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinesift.llm.common import written

SHARDS = 8
# Fixed values of the published algorithm: the multiplier of its generator, and the ranges.
_MULTIPLIER = 2862933555777941757
_WORD = 1 << 64
_SHIFT = 1 << 33
_SCALE = float(1 << 31)


def _decimal(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def stable_key(key: Column) -> Column:
    """64 unsigned bits of a key of any type: the head of the MD5 of its text (null: empty text)."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, from 0 on, of a 64-bit key (decimal) among ``shards``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    def jump(walk: Column, _: Column) -> Column:
        state = ((walk["state"] * _decimal(_MULTIPLIER) + _decimal(1)) % _decimal(_WORD)).cast("decimal(20,0)")
        span = F.lit(_SCALE) / (F.floor(state / _decimal(_SHIFT)).cast("double") + 1.0)
        return F.when(walk["next"] < shards, F.struct(
            state.alias("state"), walk["next"].alias("at"),
            F.floor((walk["next"].cast("double") + 1.0) * span).cast("long").alias("next"))).otherwise(walk)

    start = F.struct(key.cast("decimal(20,0)").alias("state"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))
    # every jump goes up by one at least, so there are at most as many as shards
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump)["at"].cast("int")


def assign(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", name: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row in column ``name`` (which replaces one of that name)."""
    return docs.withColumn(name, jump_hash(stable_key(F.col(key)), shards))


def moved(docs: DataFrame, before: int, after: int, key: str = "doc_id") -> DataFrame:
    """``(key, from_shard, to_shard)`` of the rows that another number of shards places elsewhere."""
    own = stable_key(F.col(key))
    return docs.select(F.col(key), jump_hash(own, before).alias("from_shard"), jump_hash(own, after).alias("to_shard")).where(
        "from_shard <> to_shard")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id") -> None:
    """Write ``docs``, texts and all, as Parquet with one folder ``shard=N`` per shard; no shuffle."""
    assign(docs, shards, key).write.partitionBy("shard").parquet(path)


def with_slots(rows: DataFrame, order: list[str], shard: str = "shard") -> DataFrame:
    """``rows`` with ``slot``: the place of each among those of its shard, from 0 on without gaps,
    by the columns ``order``; rows equal in all of them are numbered in any order."""
    keys = [shard, *order, "__split"]
    sorted_rows = rows.withColumn("__split", F.rand(13)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(
        sorted_rows.drop("__split").withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()),
        "placed")
    # one row per partition and shard, and a shard's partitions are neighbours
    parts = placed.groupBy(shard, "__part").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("__from"))
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return placed.join(parts, [shard, "__part"]).withColumn(
        "slot", F.col("__base") + F.col("__at") - F.col("__from")).drop("__part", "__at", "__from", "__base")


def shard_plan(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs``.

    ``size`` is the text's bytes in UTF-8 plus 1 and ``text_crc32`` their unsigned CRC-32; a null
    text counts as empty. The law is ``key``: doc_id and the number of shards decide, so repeated
    rows share a shard, and all rows without doc_id do. ``grown_shard`` is the shard with one more.
    Slots follow doc_id (nulls first), then size and checksum. An empty table gives an empty
    result; further columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = stable_key(F.col("doc_id"))
    # the texts are read once; what is sorted and numbered is this narrow table
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        jump_hash(own, shards).alias("shard"),
        jump_hash(own, shards + 1).alias("grown_shard"),
    ), "keyed")
    return with_slots(rows, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# The checksum byte by byte from a table made by the polynomial's rule, the walk in 128-bit integers.
ORACLE = f"""
WITH steps AS (SELECT b, list_reduce(range(1, 9), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) AS crc
  FROM range(256) t(b)),
by_byte AS (SELECT list(crc ORDER BY b) AS of_byte FROM steps),
texts AS (SELECT text, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes
  FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents)),
sums AS (SELECT text, len(bytes)::BIGINT + 1 AS size,
  xor(list_reduce(bytes, lambda c, x: xor(c // 256, of_byte[1 + xor(c % 256, x)]), 4294967295), 4294967295)::BIGINT AS text_crc32
  FROM texts, by_byte),
keyed AS (SELECT doc_id, size, text_crc32, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT AS k
  FROM documents d JOIN sums s ON coalesce(d.text, '') = s.text),
walked AS (SELECT *, list_reduce(range(0, {SHARDS + 1}), lambda w, i: CASE WHEN w.next <= {SHARDS} THEN {{
    'state': (w.state * {_MULTIPLIER} + 1) % {_WORD}, 'at': w.next, 'was': w.at,
    'next': floor((w.next + 1)::DOUBLE * ({int(_SCALE)}::DOUBLE / (((w.state * {_MULTIPLIER} + 1) % {_WORD}) // {_SHIFT} + 1)::DOUBLE))::BIGINT
  }} ELSE w END, {{'state': k::UHUGEINT, 'at': 0::BIGINT, 'was': 0::BIGINT, 'next': 0::BIGINT}}) AS w FROM keyed),
placed AS (SELECT doc_id, size, text_crc32, (CASE WHEN w.at < {SHARDS} THEN w.at ELSE w.was END)::INTEGER AS shard,
  w.at::INTEGER AS grown_shard FROM walked)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1)::BIGINT AS slot, grown_shard
FROM placed
"""
