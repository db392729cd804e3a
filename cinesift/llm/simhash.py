"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints: XXH64 (seed 42) of every word shingle of the whole text; a bit is set if it
is set in over half the hashes. Two fingerprints link at ``max_bits`` or fewer differing
bits, and documents are grouped into the connected components of those links.

The index, from the top down:

* *Upper nodes*: the 64 bits are cut into ``max_bits + 2`` blocks. Two fingerprints that
  differ in at most ``max_bits`` bits agree on at least two blocks, so an upper node is a
  masked bit pattern (two blocks with their value) and every link lies inside one. A Spark
  shuffle deals the nodes out.
* An upper node with more than ``split_over`` fingerprints is factored once more by blocks
  of its free bits (one of ``max_bits + 1`` must agree), so no common pattern is one task.
* *Inside a node* the fingerprints are sorted by Gray rank and cut into leaves; each leaf
  knows which bits all its members share. Pairs of leaves whose shared bits already differ
  in more than ``max_bits`` places are pruned whole, as are pairs that one component holds.

A node reports a spanning set of links, never all pairs, so copies cost a line each. Equal
fingerprints are collapsed to their smallest document before the index is built.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinesift.llm.common import connected_components, shipped, small_batches, written

WIDTH = 3
MAX_BITS = 3
SPLIT_OVER = 20_000
LEAF = 256
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_HASHES_AT_ONCE = 1 << 15


def simhash(text: bytes, width: int = WIDTH) -> int:
    """The unsigned fingerprint of a UTF-8 text; zero if it has no words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    width = min(width, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), _HASHES_AT_ONCE):
        part = slice(k, k + _HASHES_AT_ONCE)
        hashes = np.array([digest(line[s:e], 42) for s, e in zip(starts[part], ends[part])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int32)
    over = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(over.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, fp)`` per row of ``docs``; ``fp`` is the fingerprint's 64 bits as a long.

    Null and empty texts, and texts without words, have fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(1).cast(pa.binary())
            out = np.array([simhash(t.as_py() or b"", width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return shipped(narrow).mapInArrow(run, "doc_id long, fp long")


def _blocks(bits: list[int], n: int) -> list[int]:
    """``n`` masks that share out ``bits`` evenly."""
    return [sum(1 << int(b) for b in part) for part in np.array_split(np.array(bits), n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def upper_masks(max_bits: int) -> list[int]:
    return [a | b for a, b in combinations(_blocks(list(range(64)), max_bits + 2), 2)]


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def node_links(codes: np.ndarray, max_bits: int, leaf: int = LEAF) -> list[tuple[int, int]]:
    """A spanning set of the links among one node's distinct codes, as pairs of places.

    Leaves of Gray-sorted codes are compared by the bits that all their members share;
    leaf pairs that differ too much there, or that lie in one component, are left out.
    """
    order = np.argsort(gray_rank(codes), kind="stable")
    codes = codes[order]
    at = np.arange(0, len(codes), leaf)
    some, every = np.bitwise_or.reduceat(codes, at), np.bitwise_and.reduceat(codes, at)
    fixed = ~(some ^ every)
    root, links = np.arange(len(codes)), []
    for i in range(len(at)):
        apart = np.bitwise_count((every[i] ^ every[i:]) & fixed[i] & fixed[i:])
        left = slice(at[i], at[i] + leaf)
        for j in (i + np.flatnonzero(apart <= max_bits)).tolist():
            right = slice(at[j], at[j] + leaf)
            first = root[left][0]
            if i != j and (root[left] == first).all() and (root[right] == first).all():
                continue
            x, y = np.nonzero(np.bitwise_count(codes[left][:, None] ^ codes[right][None, :]) <= max_bits)
            x, y = x + at[i], y + at[j]
            while len(new := np.flatnonzero(root[x] != root[y])):
                a, b = int(x[new[0]]), int(y[new[0]])
                # join the component of b, with all that a links to, in one step
                own = np.unique(root[y[x == a]])
                for r in own[own != root[a]].tolist():
                    b = int(y[(x == a) & (root[y] == r)][0])
                    links.append((int(order[a]), int(order[b])))
                root[np.isin(root, own)] = root[a]
    return links


def _links_in(keys: list[np.ndarray], codes: np.ndarray, nodes: np.ndarray, max_bits: int):
    """Spanning links of whole, sorted groups of rows; small groups are done together."""
    new = np.ones(len(codes), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(codes)))
    u, v = [], []
    small = np.repeat(sizes <= 16, sizes)
    group = np.repeat(np.arange(len(starts)), sizes)
    for lag in range(1, 16):
        i = np.flatnonzero((group[lag:] == group[:-lag]) & small[lag:])
        if not len(i):
            break
        i = i[np.bitwise_count(codes[i] ^ codes[i + lag]) <= max_bits]
        u.append(nodes[i])
        v.append(nodes[i + lag])
    for g in np.flatnonzero(sizes > 16).tolist():
        s = slice(starts[g], starts[g] + sizes[g])
        if links := node_links(codes[s], max_bits):
            i, j = np.array(links).T
            u.append(nodes[s][i])
            v.append(nodes[s][j])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *u]), np.concatenate([none, *v])


def _search(keyed: DataFrame, key_names: list[str], max_bits: int) -> DataFrame:
    """Links inside each node of ``keyed(<key_names>, fp, node)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def emit(cols: list[np.ndarray]) -> pa.RecordBatch:
            u, v = _links_in(cols[:-2], cols[-2].view(np.uint64), cols[-1], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            # all but the last group, which may go on in the next batch
            same = np.logical_and.reduce([k == k[-1:] for k in held[:-2]]) if len(held[0]) else np.zeros(0, bool)
            cut = int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
            if cut:
                yield emit([c[:cut] for c in held])
                held = [c[cut:] for c in held]
        if held is not None and len(held[0]):
            yield emit(held)

    dealt = keyed.select(*key_names, "fp", "node").repartition(*key_names).sortWithinPartitions(*key_names)
    return shipped(dealt).mapInArrow(run, "u long, v long")


def links(nodes: DataFrame, max_bits: int = MAX_BITS, split_over: int = SPLIT_OVER) -> DataFrame:
    """A spanning set of the links among ``nodes(fp, node)``, whose ``fp`` are distinct."""
    masks = upper_masks(max_bits)
    keyed = nodes.select(
        "fp", "node",
        F.explode(F.array(*(
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for t, m in enumerate(masks)
        ))).alias("k"),
    ).select(F.col("k.t").alias("t"), F.col("k.key").alias("key"), "fp", "node")
    large = keyed.groupBy("t", "key").count().where(F.col("count") > split_over).select("t", "key")
    large = written(large, "large-nodes")
    if large.isEmpty():
        return _search(keyed, ["t", "key"], max_bits)
    light = _search(keyed.join(large, ["t", "key"], "left_anti"), ["t", "key"], max_bits)
    heavy = keyed.join(large, ["t", "key"])
    free = [_blocks([b for b in range(64) if not m >> b & 1], max_bits + 1) for m in masks]
    finer = F.array(*(
        F.struct(F.lit(b).alias("b"), F.col("fp").bitwiseAND(F.element_at(
            F.array(*(F.lit(_signed(f[b])) for f in free)), F.col("t") + 1)).alias("sub"))
        for b in range(max_bits + 1)
    ))
    heavy = heavy.select("t", "key", "fp", "node", F.explode(finer).alias("s")).select(
        "t", "key", F.col("s.b").alias("b"), F.col("s.sub").alias("sub"), "fp", "node")
    return light.unionByName(_search(heavy, ["t", "key", "b", "sub"], max_bits))


def simhash_groups(docs: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS,
                   split_over: int = SPLIT_OVER) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest doc_id that
    links reach. Texts that are null, empty or without words share fingerprint zero and
    link like any other. Repeated rows stay repeated. A row without doc_id cannot be named
    by a link: it keeps its fingerprint and has a null component_id. An empty table gives
    an empty result; further columns of ``docs`` are not read.
    """
    prints = written(fingerprints(docs, width), "fingerprints")
    nodes = written(
        prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    found = connected_components(links(nodes, max_bits, split_over))
    named = nodes.join(found, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component"))
    return prints.join(named, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
    )


def keep_one_of_each_group(docs: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, that of the smallest doc_id.

    Of repeated rows with that doc_id the smallest (by all columns) stays. Rows without
    doc_id belong to no group and stay.
    """
    groups = simhash_groups(docs, width, max_bits)
    stay = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    # the join has already dealt rows out by id, so the aggregate needs no shuffle of its own
    kept = (
        docs.join(stay, docs["doc_id"] == stay["__id"]).groupBy("__id")
        .agg(F.min(F.struct(*docs.columns)).alias("__row")).select("__row.*")
    )
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
