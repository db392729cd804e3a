"""Fingerprints and groups against a brute-force version."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cinesift.llm import simhash
from cinesift.llm.common import connected_components


def brute_fingerprint(text: str) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r " else c for c in lower).split(" ") if w]
    if not words:
        return 0
    n = min(3, len(words))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: dict[int, int], max_bits: int = 3) -> dict[int, int]:
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= max_bits and find(a) != find(b):
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {d: find(d) for d in ids}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abAB éß\t\n\r\x0b\x0c\x1c   日"), max_size=60))
def test_fingerprint_equals_brute_force(text):
    assert simhash.simhash(text.encode()) == brute_fingerprint(text)


def test_fingerprint_of_a_text_longer_than_one_batch_of_hashes():
    text = " ".join(f"w{i % 977}" for i in range(70_000))
    assert simhash.simhash(text.encode()) == brute_fingerprint(text)


def near(rng, base: int, bits: int) -> int:
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


@pytest.mark.parametrize("split_over", [20_000, 4])
def test_groups_of_planted_fingerprints_equal_brute_force(spark, split_over):
    rng = random.Random(4)
    codes = {rng.getrandbits(64) for _ in range(150)}
    for base in list(codes)[:25]:
        chain = base
        for _ in range(rng.randint(1, 12)):  # chains, so that components reach beyond one link
            chain = near(rng, chain, rng.randint(0, 4))
            codes.add(chain)
    dense = rng.getrandbits(64)
    codes |= {near(rng, dense, 2) for _ in range(300)}
    signed = [(c - (1 << 64) if c >> 63 else c, i) for i, c in enumerate(sorted(codes))]
    nodes = spark.createDataFrame(signed, "fp long, node long")
    want = brute_components({i: c & (2**64 - 1) for c, i in signed})
    edges = simhash.links(nodes, split_over=split_over)
    got = {i: i for i in want} | {r.node: r.component for r in connected_components(edges).collect()}
    assert got == want
    assert edges.distinct().count() < 12 * len(codes)  # a spanning set, not all pairs


def test_node_links_span_leaves():
    rng = random.Random(9)
    base = rng.getrandbits(64)
    codes = np.array(sorted({near(rng, base, rng.randint(0, 5)) for _ in range(900)}), np.uint64)
    links = simhash.node_links(codes, 3, leaf=32)
    want = brute_components({i: int(c) for i, c in enumerate(codes)})
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        assert (int(codes[a]) ^ int(codes[b])).bit_count() <= 3
        ra, rb = sorted((find(a), find(b)))
        root[rb] = ra
    assert {i: find(i) for i in range(len(codes))} == want
    assert len(links) == len(codes) - len(set(want.values()))


def test_groups_with_nulls_ties_and_repeats(make_docs):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(5, long), (2, long), (9, long + " tail"), (7, None), (3, ""), (4, " \t\n"), (8, "one two"),
            (8, "one two"), (None, long), (11, "ONE two"), (12, "x" * 200_000)]
    got = sorted(make_docs(rows).transform(simhash.simhash_groups).collect(), key=str)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.fingerprint, r.component_id))
    assert len(got) == len(rows)
    prints = {i: brute_fingerprint(t or "") for i, t, *_ in rows if i is not None}
    want = brute_components(prints)
    for i, found in by_id.items():
        if i is None:
            assert found == [(f"{brute_fingerprint(long):016x}", None)]
        else:
            assert set(found) == {(f"{prints[i]:016x}", want[i])}
    assert by_id[7][0] == by_id[3][0] == by_id[4][0] == ("0" * 16, 3)
    assert len(by_id[8]) == 2


def test_one_of_each_group_stays(make_docs):
    long = " ".join(f"word{i}" for i in range(300))
    docs = make_docs([(5, long), (2, long), (2, long), (7, ""), (8, None), (9, "something else here"), (None, long)])
    kept = simhash.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "7", "9", "None"]


def test_empty_table(make_docs):
    assert simhash.simhash_groups(make_docs([])).collect() == []
    assert simhash.keep_one_of_each_group(make_docs([])).collect() == []


def test_components_of_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 60)]
    edges = spark.createDataFrame(chain + star + [(500, 500), (1, 2), (2, 1)], "u long, v long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}}
