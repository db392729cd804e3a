"""Toxicity: a character n-gram linear classifier over naive Bayes log-count ratios.

Features are the character n-grams (3 to 8 characters of the lower-cased text, whatever their
script, hashed to ``2**BUCKET_BITS`` buckets) that occur in a text. Each is scaled by the log ratio of its
smoothed document frequency in toxic and in clean texts; those whose frequencies differ no more
than chance allows are left out. Logistic regression is fitted on the scaled features; a toxic
row weighs more than a clean one, by the square root of their ratio. Whole texts are read, in
training and in scoring.

Training takes at most ``max_rows`` labelled rows (those of the smallest id hash; a
documented bound, so the ids may be broadcast); scoring covers every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinesift.llm.common import shipped

BUCKET_BITS = 20
SIZES = (3, 4, 5, 6, 7, 8)
MAX_ROWS = 8_000
MIN_DOCUMENTS = 4
LEAST_CHI2 = 16.0
THRESHOLD = 0.7
_SEGMENT = 1 << 20
_FEATURES_AT_ONCE = 1 << 18


def _grams(characters: np.ndarray) -> np.ndarray:
    """The buckets of the n-grams of a sequence of code points, at every place."""
    found = []
    for start in range(0, max(1, len(characters)), _SEGMENT):
        c = characters[start : start + _SEGMENT + max(SIZES) - 1]
        h = c.copy()
        for n in range(2, max(SIZES) + 1):
            h = h[:-1] * np.uint32(0x01000193) + c[n - 1 :] if len(c) >= n else h[:0]
            if n in SIZES:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
                found.append(mixed >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(found)


class _Distinct:
    """Distinct buckets without sorting: the last place that writes a bucket keeps it."""

    def __init__(self) -> None:
        self.last = np.zeros(1 << BUCKET_BITS, np.int32)

    def __call__(self, text: str | None) -> np.ndarray:
        # a space on either side lets a word's first and last letters be seen as such
        grams = _grams(np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "replace"), np.uint32))
        place = np.arange(len(grams), dtype=np.int32)
        self.last[grams] = place
        return grams[self.last[grams] == place]


@dataclass
class ToxicityModel:
    """Weight per bucket (ratio times coefficient) and intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, distinct: np.ndarray) -> float:
        z = float(self.weights[distinct].sum()) + self.intercept
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0))))


def _labelled(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """``(text, toxic)`` of at most ``max_rows`` labelled rows; a document with several labels is
    toxic if one says so, rows with a null label or id are left out."""
    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max(F.col("toxic").cast("int")).alias("__toxic"))
        .orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    )
    # bounded by max_rows, 12 bytes a row
    return docs.join(F.broadcast(chosen), F.col("doc_id").cast("long") == F.col("__id")).select(
        F.col("text").cast("string").alias("text"), F.col("__toxic").alias("toxic"))


def _ratios(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Kept buckets and their log-count ratios, from document frequencies counted in Spark."""

    totals = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = totals.get(False, 0), totals.get(True, 0)
    n, share = max(1, clean + toxic), toxic / max(1, clean + toxic)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct, seen = _Distinct(), np.zeros((2, 1 << BUCKET_BITS), np.int32)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                seen[int(label.as_py() > 0)][distinct(text.as_py())] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(seen[0][at], pa.int64()), pa.array(seen[1][at], pa.int64())],
            ["bucket", "clean", "toxic"])

    counted = shipped(rows).mapInArrow(count, "bucket int, clean long, toxic long").groupBy("bucket").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # chi-squared of the two-by-two table: a rare n-gram may have a large ratio by chance
    held = F.col("clean") + F.col("toxic")
    surplus = F.col("toxic") - held * share
    spread = F.greatest(held * (1 - held / n) * share * (1 - share), F.lit(1e-9))
    # what is left of at most 2**BUCKET_BITS buckets
    got = counted.where((held >= MIN_DOCUMENTS) & (surplus * surplus / spread >= LEAST_CHI2)).toPandas().sort_values("bucket")
    ratio = np.log((got.toxic + 0.5) / (toxic + 1.0)) - np.log((got.clean + 0.5) / (clean + 1.0))
    return got.bucket.to_numpy(), ratio.to_numpy().astype(np.float64)


def _regress(starts: np.ndarray, cols: np.ndarray, scale: np.ndarray, y: np.ndarray,
             rounds: int = 250, penalty: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression with an L2 penalty by Adam steps over all rows.

    Features are taken up in blocks of whole rows, so that beside ``cols`` itself no array is
    as long as the features of all rows; sums are added up in the order of the rows.
    """
    n, lengths = len(y), np.diff(starts)
    weight = np.where(y > 0, (y.mean() + 1e-9) ** -0.5, 1.0) / n
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, starts[-1] + 1, _FEATURES_AT_ONCE)), n))
    blocks = [(int(r), int(q), slice(int(starts[r]), int(starts[q]))) for r, q in zip(cuts[:-1], cuts[1:])]
    if cuts[0]:
        blocks.insert(0, (0, int(cuts[0]), slice(0, int(starts[cuts[0]]))))
    w, m, v = (np.zeros(len(scale) + 1) for _ in range(3))
    for t in range(1, rounds + 1):
        grad, total = np.zeros(len(scale) + 1), np.empty(n)
        for r, q, part in blocks:
            c, rows = cols[part], np.repeat(np.arange(q - r), lengths[r:q])
            x = scale[c]
            z = np.bincount(rows, x * w[c], minlength=q - r) + w[-1]
            total[r:q] = error = weight[r:q] * (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - y[r:q])
            np.add.at(grad, c, x * error[rows])
        grad[-1] = total.sum()
        grad[:-1] += penalty / n * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> ToxicityModel:
    """Fit on ``docs(doc_id, text)`` with ``labels(doc_id, toxic)``.

    With no labelled row, or labels of one class alone, the model knows nothing and scores
    every text 0.5 (below the threshold of 0.7, so no document is rejected).
    """
    rows = _labelled(docs, labels, max_rows)
    buckets, ratios = _ratios(rows)
    weights = np.zeros(1 << BUCKET_BITS)
    place = np.full(1 << BUCKET_BITS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))
    at = docs.sparkSession.sparkContext.broadcast(place)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct = _Distinct()
        for batch in batches:
            found = [at.value[distinct(t.as_py())] for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[f >= 0] for f in found], pa.list_(pa.int32())), batch.column(1)], ["cols", "toxic"])

    sample: pa.Table = shipped(rows).mapInArrow(kept, "cols array<int>, toxic int").toArrow()
    at.unpersist()
    y = (sample["toxic"].to_numpy() > 0).astype(np.float64)
    if not len(buckets) or y.min(initial=1) == y.max(initial=0):
        return ToxicityModel(weights, 0.0)
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(sample["cols"]).to_numpy())])
    cols = pc.list_flatten(sample["cols"]).to_numpy()
    del sample
    coefficients, intercept = _regress(starts, cols, ratios, y)
    weights[buckets] = coefficients * ratios
    return ToxicityModel(weights, intercept)


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id") -> DataFrame:
    """``docs`` with a column ``score``; null and empty texts get the score of the empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct = _Distinct()
        for batch in batches:
            out = [shared.value.score(distinct(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], [key, "score"])

    narrow = docs.select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text"))
    return shipped(narrow).mapInArrow(run, f"`{key}` long, score double")


def reject_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with their columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct = _Distinct()
        for batch in batches:
            texts = batch.column(at)
            stays = [shared.value.score(distinct(t.as_py())) < threshold for t in texts]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return shipped(docs).mapInArrow(run, docs.schema)


def training_rows(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out fold, which is crc32 of the decimal doc_id, mod 3, equal to 1."""
    return labels.where(F.crc32(F.col("doc_id").cast("long").cast("string")) % 3 != 1)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Labels, lang, source and doc_id are no inputs of a score. Equal texts get equal scores,
    repeated rows stay repeated; a null doc_id is not held out. An empty table of documents
    gives an empty result; further columns are not read.
    """
    model = fit(docs, training_rows(labels))
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    return score(docs, model).select(
        "doc_id",
        F.coalesce(fold == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
