"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts are taken as sequences of normalised words (lower case, ASCII punctuation as space),
and a document is contaminated by a benchmark item if some stretch of it is within
``max_edits`` of the item's words in edit distance (insert, delete, replace a word).

* *CGK embedding*: a walk reads the word under its pointer and, by a random bit of the step
  and the word, moves on or stays. Words that are equal after an edit are read alike again
  once the pointers meet, so small edit distance becomes small Hamming distance.
* *Windows* grow with the item: the walk of a window takes the largest power of two of steps within
  1.25 times the item's words, and reads half as many words in the mean. They start at every word of every document, and at every word of
  an item from which a walk stays within it.
* *Bit sampling*: a repetition hashes the words at steps 0 and 1, at two random steps of either
  of 2-7 and 8-15 and at one of every further doubling (16-31, ...), as far as they are below the
  window's steps. One walk thus serves windows of all sizes, and it goes on only while its key so
  far may be the start of some item's. There are as many ``repetitions`` as reach ``TARGET_RECALL``
  if each finds an item with the most edits as often as ``LEAST_HIT`` (simulated, words drawn at random:
  0.47 at 300 words, 0.54 to 0.94 at 13 to 80).
* *Verification*: the exact edit distance of the item to the best stretch of the document
  around the window decides. Nothing but that distance accepts or rejects a pair.

The items' keys are a table that Spark joins with the documents' keys, so one pass over the
documents serves any number of items. What is broadcast is a bit map of fixed size
(``FILTER_BITS``) over the items' keys and their beginnings, which spares the documents' walks: it
lets every key through that some item has, and more of the others as the benchmark grows.
Only documents with a key that passes it are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinesift.llm.common import shipped, small_batches, written

MAX_EDIT_RATIO = 0.2
TARGET_RECALL = 0.99
LEAST_HIT = 0.42
FILTER_BITS = 26
_TEXTS_AT_ONCE = 256
# What is no part of a word is a space: ASCII punctuation and white space.
_SPACES = bytes(c if not (c < 33 or 33 <= c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 128) else 32 for c in range(256))
# Random odd multipliers of the bytes of a word by place (places repeat in words of over 1,024 bytes).
_PLACES = np.random.default_rng(3).integers(1, 2**63, 1024, dtype=np.uint64) | np.uint64(1)


def _normal(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace").translate(_SPACES)


def words(text: str | None) -> list[bytes]:
    return _normal(text).split()


def max_edits(n_words: int) -> int:
    return int(MAX_EDIT_RATIO * n_words)


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``item`` to any stretch of ``text``, and where the first best one ends.

    One row of the table per item word; the run of insertions along a row is a running minimum.
    """
    place = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item.tolist()):
        new = np.empty_like(row)
        new[0] = i + 1
        np.minimum(row[:-1] + (text != word), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - place) + place
    end = int(row.argmin())
    return int(row[end]), end


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word of normalised ``data``, in order."""
    b = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(b != 32)
    if not len(at):
        return np.zeros(0, np.uint64)
    first = np.flatnonzero(np.r_[True, np.diff(at) != 1])
    size = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, size)
    sums = np.add.reduceat((b[at].astype(np.uint64) + np.uint64(1)) * _PLACES[place & 1023], first)
    return _mix(sums ^ (size.astype(np.uint64) << np.uint64(48)))


def repetitions(recall: float = TARGET_RECALL, hit: float = LEAST_HIT) -> int:
    return math.ceil(math.log(1.0 - recall) / math.log(1.0 - hit))


def steps_of(n_words: int) -> int:
    """Steps of the walks of an item of so many words."""
    return 1 << ((5 * n_words // 4).bit_length() - 1)


def rungs(repetition: int, steps: int) -> list[int]:
    """The steps whose words are hashed, below ``steps``; those of fewer steps are the first of these."""
    rng = np.random.default_rng((17, repetition))
    out, low = [0, 1], 2
    while low < steps:
        high = 8 if low == 2 else 2 * low
        out += sorted(rng.choice(np.arange(low, high), 2 if high <= 16 else 1, replace=False).tolist())
        low = high
    return [t for t in out if t < steps]


def _bits(hashes: np.ndarray, repetition: int, block: int) -> np.ndarray:
    """64 random bits of each word: whether the steps ``64 * block`` and on move past it."""
    return _mix(hashes ^ np.uint64((0x9E3779B97F4A7C15 * (1 + repetition + (block << 16))) % 2**64))


def _keys(hashes: np.ndarray, starts: np.ndarray, repetition: int, steps: int, keep=None):
    """Yields ``(steps covered, places, starts, keys)`` at each rung of the walks from ``starts``;
    ``hashes`` end with ``steps`` zeros. Walks whose key ``keep`` rejects end there."""
    at, begun, t = starts, starts, 0
    key = np.full(len(starts), np.uint64(repetition + 1))
    bits = _bits(hashes, repetition, 0)
    for rung in rungs(repetition, steps):
        while t < rung:
            if t and t % 64 == 0:
                bits = None
            move = bits[at] if bits is not None else _bits(hashes[at], repetition, t >> 6)
            at = at + ((move >> np.uint64(t & 63)) & np.uint64(1)).astype(np.int64)
            t += 1
        key = _mix(key ^ hashes[at])
        if keep is not None:
            stay = np.flatnonzero(keep(key))
            at, begun, key = at[stay], begun[stay], key[stay]
        if not len(at):
            return
        yield rung, begun, key


def item_keys(hashes: np.ndarray, repetition: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of one item in one repetition: places and keys of its windows, and all beginnings of keys."""
    steps = steps_of(len(hashes))
    # a walk reads half as many words as it takes steps, in the mean
    starts = np.arange(len(hashes) - steps // 2)
    padded = np.concatenate([hashes, np.zeros(steps, np.uint64)])
    beginnings, last = [], (starts, np.zeros(0, np.uint64))
    for _, begun, key in _keys(padded, starts, repetition, steps):
        beginnings.append(key)
        last = (begun, key)
    return last[0], _sized(last[1], steps), beginnings


def _sized(keys: np.ndarray, steps: int) -> np.ndarray:
    """Keys told apart by the size of their windows."""
    return _mix(keys ^ np.uint64(steps))


def _signed(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.int64)


class Filter:
    """A bit map of fixed size over keys and their beginnings, and the sizes (steps) of windows, one per doubling at most."""

    def __init__(self, slots: np.ndarray, bits: np.ndarray, sizes: list[int]) -> None:
        self.sizes = sizes
        self.map = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        self.map[slots] = bits.view(np.uint64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> np.uint64(64 - FILTER_BITS)
        return (self.map[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)


def found_keys(known: Filter, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the keys (sized) that pass the filter at all their rungs, and where their windows start."""
    own = [word_hashes(_normal(t)) for t in texts]
    ends = np.cumsum([len(h) + 1 for h in own])
    gap = np.zeros(1, np.uint64)
    longest = max(known.sizes, default=1)
    hashes = np.concatenate([x for h in own for x in (h, gap)] + [np.zeros(longest, np.uint64)])
    starts = np.setdiff1d(np.arange(ends[-1] if len(ends) else 0), ends - 1, assume_unique=True)
    places, keys = [], []
    for r in range(repetitions()):
        last = {steps: rungs(r, steps)[-1] for steps in known.sizes}
        for rung, begun, key in _keys(hashes, starts, r, longest, known):
            for steps in known.sizes:
                if last[steps] == rung:
                    # the beginning of a larger item's key may pass up to here
                    sized = _sized(key, steps)
                    whole = np.flatnonzero(known(sized))
                    places.append(begun[whole])
                    keys.append(sized[whole])
    place = np.concatenate([np.zeros(0, np.int64), *places])
    key = np.concatenate([np.zeros(0, np.uint64), *keys])
    order = np.argsort(place, kind="stable")
    place, key = place[order], key[order]
    cut = np.searchsorted(place, np.r_[0, ends])
    return [(key[i:j], place[i:j] - begin) for i, j, begin in zip(cut, cut[1:], np.r_[0, ends])]


# --- on Spark -------------------------------------------------------------------------------

def _items(benchmark: DataFrame) -> DataFrame:
    """``(uid, item_id, text, n)`` of the items with words; rows without item_id or text are left out,
    repeated rows count once, and of an item_id with several texts each is an item."""
    rows = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n = [len(words(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int32())], ["item_id", "text", "n"])

    counted = shipped(rows).mapInArrow(run, "item_id long, text string, n int").where("n > 0")
    return written(counted.withColumn("uid", F.monotonically_increasing_id()), "items")


def _item_keys(items: DataFrame) -> DataFrame:
    """``(key, uid, n, place, steps)`` of all windows of the items, and the beginnings of keys with a null uid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for uid, text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                hashes = word_hashes(_normal(text))
                for r in range(repetitions()):
                    places, keys, beginnings = item_keys(hashes, r)
                    early = np.unique(np.concatenate(beginnings))
                    k, m = len(keys), len(early)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([_signed(keys), _signed(early)])), pa.array([uid] * k + [None] * m, pa.int64()),
                         pa.array([n] * (k + m), pa.int32()), pa.array([*places.tolist(), *[None] * m], pa.int32()),
                         pa.array([steps_of(n)] * (k + m), pa.int32())],
                        ["key", "uid", "n", "place", "steps"])

    return written(shipped(items.select("uid", "text", "n")).mapInArrow(
        run, "key long, uid long, n int, place int, steps int"), "item-keys")


def _filter(keys: DataFrame) -> Filter:
    """The bits of all keys and of their beginnings. At most ``2**(FILTER_BITS - 6)`` rows come to the
    driver, however many items there are."""
    slot = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    bits = keys.select(
        F.shiftright(slot, 6).cast("int").alias("slot"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - FILTER_BITS}) & 63 AS int))").alias("bit"))
    got = bits.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    sizes = sorted(r["steps"] for r in keys.select("steps").distinct().collect())
    return Filter(got["slot"].to_numpy(), got["bits"].to_numpy().astype(np.int64), sizes)


def _with_keys(docs: DataFrame, known: Filter, all_rows: bool) -> DataFrame:
    """``docs`` with a row number and the keys found in ``text``; if not ``all_rows``, only rows with some."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in small_batches(batches, _TEXTS_AT_ONCE):
            found = found_keys(shared.value, batch.column(at).cast(pa.string()).to_pylist())
            rows = pa.array(range(number, number + batch.num_rows), pa.int64())
            number += batch.num_rows
            lists = [pa.array([_signed(f[0]) if len(f[0]) else None for f in found], pa.list_(pa.int64())),
                     pa.array([f[1] if len(f[0]) else None for f in found], pa.list_(pa.int32()))]
            out = pa.RecordBatch.from_arrays([*batch.columns, rows, *lists], [*batch.schema.names, "__row", "__keys", "__places"])
            yield out if all_rows else out.filter(pa.array([len(f[0]) > 0 for f in found], pa.bool_()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return written(shipped(docs).mapInArrow(run, f"{fields}, __row long, __keys array<long>, __places array<int>"), "keyed")


def _stretches(suspects: DataFrame, keys: DataFrame) -> DataFrame:
    """``(row, doc_id, uid, low, stretch)``: of every suspect the words around the windows that it
    shares with an item, overlapping ones as one; ``low`` is the number of words before them."""
    hits = suspects.select("__row", F.explode(F.arrays_zip("__keys", "__places")).alias("hit")).select(
        "__row", F.col("hit.__keys").alias("key"), F.col("hit.__places").alias("at"))
    near = hits.join(keys.where("uid is not null"), "key").select(
        "__row", "uid", "n", (F.col("at") - F.col("place")).alias("begin")).distinct()
    # the windows of one document that are items' windows
    own = near.groupBy("__row").agg(F.collect_list(F.struct("uid", "n", "begin")).alias("near"))
    joined = suspects.select("__row", "doc_id", "text").join(own, "__row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, _TEXTS_AT_ONCE):
            out: list[tuple] = []
            for row in batch.to_pylist():
                text = words(row["text"])
                spans: dict[int, list[list[int]]] = {}
                for x in sorted(row["near"], key=lambda x: x["begin"]):
                    # twice the edits on either side: the window may be off by as many, and so may the stretch
                    slack = 2 * max_edits(x["n"])
                    low, high = max(0, x["begin"] - slack), min(len(text), x["begin"] + x["n"] + slack)
                    own = spans.setdefault(x["uid"], [])
                    if own and low <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], high)
                    else:
                        own.append([low, high])
                out += [(row["__row"], row["doc_id"], uid, low, b" ".join(text[low:high]).decode("utf-8", "replace"))
                        for uid, own in spans.items() for low, high in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, (pa.int64(),) * 4 + (pa.string(),))],
                ["row", "doc_id", "uid", "low", "stretch"])

    # a table of its own, so that no task keeps the Python workers of two steps alive
    return written(shipped(joined).mapInArrow(run, "row long, doc_id long, uid long, low long, stretch string"), "stretches")


def distance_within(item: list[bytes], text: list[bytes]) -> tuple[int, int] | None:
    """:func:`best_stretch` of the words, if it is within the item's most edits."""
    most = max_edits(len(item))
    present = set(text)
    if sum(w not in present for w in item) > most:
        return None  # each missing word is an edit
    number: dict[bytes, int] = {}
    coded = [np.array([number.setdefault(w, len(number)) for w in x], np.int64) for x in (item, text)]
    distance, end = best_stretch(*coded)
    return (distance, end) if distance <= most else None


def _verified(stretches: DataFrame, items: DataFrame) -> DataFrame:
    """``(row, doc_id, uid, item_id, edit_distance, item_words, end_word)`` of the items that are near enough,
    each with its nearest stretch (of several the first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out: list[tuple] = []
            for r in batch.to_pylist():
                best = distance_within(words(r["text"]), r["stretch"].encode().split())
                if best is not None:
                    out.append((r["row"], r["doc_id"], r["uid"], r["item_id"], best[0], r["n"], r["low"] + best[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 7, (pa.int64(),) * 4 + (pa.int32(),) * 3)], names)

    names = ["row", "doc_id", "uid", "item_id", "edit_distance", "item_words", "end_word"]
    schema = "row long, doc_id long, uid long, item_id long, edit_distance int, item_words int, end_word int"
    near = shipped(stretches.join(items, "uid")).mapInArrow(run, schema)
    return near.groupBy("row", "doc_id", "uid", "item_id", "item_words").agg(
        F.min(F.struct("edit_distance", "end_word")).alias("best")).select(
        "row", "doc_id", "uid", "item_id", "best.edit_distance", "item_words", "best.end_word")


SCHEMA = "doc_id long, item_id long, edit_distance int, item_words int, end_word int"


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, edit_distance, item_words, end_word)``: for every row of ``docs`` the
    benchmark items it holds, each with its nearest stretch (which ends before ``end_word``).

    Null and empty texts, and items without words, match nothing; of an item_id with several
    texts each is an item of its own. Rows repeat as those of ``docs`` do; a null doc_id
    stays null. Empty tables on either side give an empty result.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = _items(benchmark)
    keys = _item_keys(items)
    suspects = _with_keys(narrow, _filter(keys), False)
    return _verified(_stretches(suspects, keys), items).select("doc_id", "item_id", "edit_distance", "item_words", "end_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns unchanged. Rows none of
    whose windows passes the filter are not shuffled."""
    items = _items(benchmark)
    keys = _item_keys(items)
    marked = _with_keys(docs, _filter(keys), True)
    clean, suspects = marked.where("__keys is null"), marked.where("__keys is not null")
    slim = suspects.select("__row", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "__keys", "__places")
    bad = written(_verified(_stretches(slim, keys), items).select(F.col("row").alias("__row")).distinct(), "contaminated")
    return clean.unionByName(suspects.join(bad, "__row", "left_anti").select(*marked.columns)).select(*docs.columns)
