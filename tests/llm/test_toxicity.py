"""The classifier on held-out labels, and its defined results for odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from cinesift.llm import toxicity

SF_BENCH = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def planted(make_docs, spark):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(400):
        words = ["".join(rng.choice("aeiourstlnd") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(1, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(1, len(words) // 30)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["gromble", "Zokkish", "vexxard"]))
        docs.append((i, " ".join(words)))
        labels.append((i, 0, int(toxic)))
    docs += [(1000, "such a Zokkisher"), (1001, ""), (1002, None), (1002, None), (None, "a gromble"), (1003, "so " * 400_000)]
    labels += [(1, 0, None), (None, 0, 1), (5000, 0, 1)]
    return make_docs(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs


def test_held_out_rows(planted):
    docs, labels, rows = planted
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == len(rows)
    wrong = 0
    for r in got:
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id is not None and r.doc_id < 400 and r.held_out:
            wrong += r.predicted != (r.doc_id % 4 == 0)
    assert wrong <= 3
    by_id = {r.doc_id: r for r in got}
    assert by_id[1000].predicted == 1 and by_id[None].predicted == 1
    assert by_id[1001].score == by_id[1002].score < 0.7 and by_id[1003].predicted == 0


def test_held_out_labels_have_no_influence(planted, spark):
    docs, labels, _ = planted
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity_scores(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_rejection_keeps_columns_and_agrees_with_scores(planted):
    docs, labels, rows = planted
    model = toxicity.fit(docs, toxicity.training_rows(labels))
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns
    low = [str(r.doc_id) for r in toxicity.score(docs, model).collect() if r.score < 0.7]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(low)


def test_without_labels_nothing_is_rejected(make_docs, spark):
    docs = make_docs([(1, "a"), (2, None)])
    for rows in ([], [(1, 0, 1)], [(1, 0, 0), (2, 0, 0)], [(9, 0, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        assert [r.predicted for r in toxicity.toxicity_scores(docs, labels).collect()] == [0, 0]
    assert toxicity.toxicity_scores(make_docs([]), labels).collect() == []


def test_distinct_grams_are_distinct_across_segments(monkeypatch):
    monkeypatch.setattr(toxicity, "_SEGMENT", 50)
    text = "some text that goes on " * 30
    short = toxicity._Distinct()(text)
    monkeypatch.setattr(toxicity, "_SEGMENT", 1 << 20)
    assert sorted(short) == sorted(toxicity._Distinct()(text)) == sorted(np.unique(short))


def brute_buckets(text):
    """Buckets of the 3 to 8 character n-grams, one by one."""
    chars, out = [ord(c) for c in f" {(text or '').lower()} "], set()
    for n in range(3, 9):
        for i in range(len(chars) - n + 1):
            h = 0
            for c in chars[i : i + n]:
                h = (h * 0x01000193 + c) % 2**32
            out.add(((h ^ h >> 15) * (0x85EBCA6B + 2 * n) % 2**32) >> 32 - toxicity.BUCKET_BITS)
    return out


@pytest.mark.parametrize("text", ["", None, "a", "ab", "Ab c", "ÄÖ日本語 ñandú", "😀😀 x😀", "x" * 40])
def test_buckets_are_of_characters(text):
    assert set(toxicity._Distinct()(text).tolist()) == brute_buckets(text)


def test_ratios_and_scores_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(160):
        words = [rng.choice(["année", "日本語", "über", "plain", "word", "ñandú"]) for _ in range(rng.randint(3, 12))]
        toxic = i % 3 == 0
        rows.append((" ".join(words + ["vexxárd"] * (toxic and rng.random() < .9) + ["clean"] * (not toxic and rng.random() < .5)), int(toxic)))
    frame = spark.createDataFrame(rows, "text string, toxic int").repartition(3)
    buckets, ratios = toxicity._ratios(frame)
    held = [brute_buckets(t) for t, _ in rows]
    n, ones = len(rows), sum(y for _, y in rows)
    want = {}
    for bucket in set().union(*held):
        own = [y for h, (_, y) in zip(held, rows) if bucket in h]
        a, both = sum(own), len(own)
        # Pearson's chi-squared over the four cells
        cells = [(a, both * ones / n), (both - a, both * (n - ones) / n), (ones - a, (n - both) * ones / n), (n - ones - both + a, (n - both) * (n - ones) / n)]
        chi2 = sum((x - e) ** 2 / e for x, e in cells if e)
        if both >= toxicity.MIN_DOCUMENTS and chi2 >= toxicity.LEAST_CHI2:
            want[bucket] = np.log((a + .5) / (ones + 1)) - np.log((both - a + .5) / (n - ones + 1))
    assert dict(zip(buckets.tolist(), ratios.tolist())) == pytest.approx(want) and len(want) > 20
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert set(np.flatnonzero(model.weights)) <= set(want)
    for r in toxicity.score(docs, model).collect():
        z = sum(model.weights[b] for b in held[r.doc_id]) + model.intercept
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-9)


def test_benchmark_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_BENCH}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_scores(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.98 * len(got)
    assert sum(r.predicted for r in got if not r.toxic) <= 0.005 * len(got)
