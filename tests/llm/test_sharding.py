"""Shards against a plain loop over the published algorithm, slots, growth, written shards."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from cinesift.llm import sharding

SF = "/root/testdata/sf0.001"


def key_of(value) -> int:
    return int(hashlib.md5(("" if value is None else str(value)).encode()).hexdigest()[:16], 16)


def jump(key: int, shards: int) -> int:
    at, after = -1, 0
    while after < shards:
        at = after
        key = (key * 2862933555777941757 + 1) % 2**64
        after = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def check(rows, got):
    assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (i is None, i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        k = key_of(r.doc_id)
        assert (r.law, r.shard, r.grown_shard) == ("key", jump(k, 8), jump(k, 9))
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id))
    for own in slots.values():
        assert sorted(s for s, _, _ in own) == list(range(len(own)))
        ids = [(some, i or 0) for _, some, i in sorted(own, key=lambda x: x[0])]
        assert ids == sorted(ids)


def test_shards_slots_and_sizes(make_docs):
    rng = random.Random(3)
    rows = [(rng.randrange(-500, 500), "ab é 日本 😀"[: rng.randrange(9)]) for _ in range(700)]
    rows += [(None, "x"), (None, None), (7, None), (7, ""), (2**63 - 1, "z" * 400_000), (-(2**63), "\x00")] + [(42, "copy")] * 500
    docs = make_docs(rows).selectExpr("*", "1 AS shard", "2 AS slot", "3 AS size", "4 AS n", "5 AS __part")
    check(rows, sharding.shard_plan(docs).collect())


def test_a_hot_key_and_a_hot_shard_are_many_tasks(spark, make_docs):
    docs = make_docs([(42, "copy")] * 900 + [(i, "own") for i in range(300)]).repartition(6)
    rows = sharding.assign(docs).select("doc_id", "shard")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = sharding.with_slots(rows, ["doc_id"])
        parts = [len(p) for p in rows.selectExpr("*", "rand(1) AS s").repartitionByRange("shard", "doc_id", "s").rdd.glom().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(parts) < 500  # of 1,200 rows in 8 partitions
    own = [r.slot for r in placed.where("doc_id = 42").collect()]
    assert len(own) == len(set(own)) == 901


@pytest.mark.parametrize("shards", [1, 2, 7, 8, 9, 100])
def test_any_number_of_shards(make_docs, shards):
    rows = [(i, "t") for i in range(200)]
    got = sharding.assign(make_docs(rows), shards, name="of").collect()
    assert [r["of"] for r in got] == [jump(key_of(r.doc_id), shards) for r in got]


def test_growth_moves_rows_only_into_the_new_shard(make_docs):
    docs = make_docs([(i, "t") for i in range(4000)])
    got = sharding.moved(docs, 8, 9).collect()
    assert {r.to_shard for r in got} == {8} and 300 < len(got) < 600  # a ninth is 444
    shares = Counter(r.shard for r in sharding.assign(docs).select("shard").collect())
    assert len(shares) == 8 and all(400 < n < 600 for n in shares.values())
    with pytest.raises(ValueError):
        sharding.assign(docs, 0)


def test_text_keys_and_written_shards(spark, make_docs, tmp_path):
    docs = make_docs([(i, f"text {i}", f"src{i % 9}") for i in range(60)])
    path = f"file://{tmp_path}/shards"
    sharding.write_shards(docs, path, 4, key="source")
    back = spark.read.parquet(path).collect()
    assert sorted((r.doc_id, r.text) for r in back) == [(i, f"text {i}") for i in range(60)]
    assert all(r.shard == jump(key_of(r.source), 4) for r in back)


def test_empty_table(make_docs):
    assert sharding.shard_plan(make_docs([])).collect() == []


def test_sql_gives_the_same_rows(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cursor = con.execute(sharding.ORACLE)
    names = [c[0] for c in cursor.description]
    got = sharding.shard_plan(spark.read.parquet(f"{SF}/documents.parquet")).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cursor.fetchall())
