"""Contaminations against exact edit distance over all stretches."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cinesift.llm import decontam

WORDS = [f"w{i}" for i in range(400)]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def brute_distance(item: list, text: list) -> int:
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at, kind = rng.randrange(len(words)), rng.random()
        if kind < 0.4:
            words[at] = "changed"
        elif kind < 0.7:
            del words[at]
        else:
            words.insert(at, rng.choice(WORDS))
    return words


def test_best_stretch_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(200):
        item, text = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 15))
        assert decontam.best_stretch(item, text)[0] == brute_distance(item.tolist(), text.tolist())


@pytest.mark.parametrize("n", [5, 13, 25, 27, 37, 52, 60, 300])
def test_recall_at_the_most_edits_allowed(n):
    rng = random.Random(n)
    tried, found = 120 if n < 100 else 40, 0
    for _ in range(tried):
        item = text_of(rng, n)
        own = edited(rng, item.split(), decontam.max_edits(n))
        text = f"{text_of(rng, 80)} {' '.join(own)} {text_of(rng, 80)}"
        hashes = decontam.word_hashes(decontam._normal(item))
        keys = set().union(*(set(decontam.item_keys(hashes, r)[1].tolist()) for r in range(decontam.repetitions())))
        early = np.unique(np.concatenate([x for r in range(decontam.repetitions()) for x in decontam.item_keys(hashes, r)[2]]))
        early = np.append(early, np.array(sorted(keys), np.uint64))
        known = lambda k, early=early: np.isin(k, early)
        known.sizes = [decontam.steps_of(n)]
        ((got, places),) = decontam.found_keys(known, [text])
        found += any(k in keys and 80 <= p <= 80 + 2 * n for k, p in zip(got.tolist(), places.tolist()))
    assert found >= 0.95 * tried


def test_hashes_are_of_the_words():
    rng = random.Random(1)
    texts = ["", None, " .,- ", "One, two;THREE", "a" * 3000 + " b", "é日本 Ünï\x00x\x7f", "tab\tnew\nline\x0bvt\u00a0nbsp"]
    texts += [" ".join(rng.choice(["x", "yy", "zzz", "é"]) for _ in range(30)) for _ in range(5)]
    known: dict = {}
    for text in texts:
        own = decontam.words(text)
        hashes = decontam.word_hashes(decontam._normal(text)).tolist()
        assert len(hashes) == len(own)
        for w, h in zip(own, hashes):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_the_filter_lets_every_key_of_an_item_through(spark):
    items = decontam._items(spark.createDataFrame([(i, text_of(random.Random(i), 10 + i)) for i in range(30)], "item_id long, text string"))
    keys = decontam._item_keys(items)
    known = decontam._filter(keys)
    early = np.array([r.key for r in keys.collect()], np.int64).view(np.uint64)
    assert known(early).all() and known.sizes == [8, 16, 32]
    assert known(np.random.default_rng(1).integers(0, 2**64, 10_000, dtype=np.uint64)).mean() < 0.01


def test_pairs_equal_brute_force(spark, make_docs):
    rng = random.Random(3)
    items = [(i, text_of(rng, 20)) for i in range(20)] + [(20, ""), (21, None), (None, "w1 w2"), (3, "w5 w6 w7 w8 w9")]
    docs = []
    for d in range(120):
        words = text_of(rng, rng.randrange(0, 60)).split()
        for _ in range(rng.randrange(0, 3)):
            own = edited(rng, items[rng.randrange(20)][1].split(), rng.randrange(0, 7))
            at = rng.randrange(len(words) + 1)
            words[at:at] = own
        docs.append((d, " ".join(words).title() if d % 2 else ", ".join(words)))
    docs += [(200, None), (201, ""), (202, items[0][1]), (202, items[0][1]), (None, items[1][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "'z' AS score")
    want = []
    for d, text in docs:
        own = [w.decode() for w in decontam.words(text)]
        for i, item in items:
            item = (item or "").split()
            if i is not None and item and (x := brute_distance(item, own)) <= decontam.max_edits(len(item)):
                want.append((d, i, x, len(item)))
    got = [tuple(r)[:4] for r in decontam.contaminations(make_docs(docs), benchmark).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    bad = {d for d, *_ in want}
    left = decontam.drop_contaminated(make_docs(docs), benchmark)
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, _ in docs if d not in bad)
    assert left.columns == make_docs(docs).columns


def test_many_items_take_one_pass_over_the_documents(spark, make_docs, monkeypatch):
    rng = random.Random(5)
    items = [(i, text_of(rng, rng.randrange(14, 60))) for i in range(3000)]
    docs = make_docs([(i, f"{text_of(rng, 10)} {t} {text_of(rng, 10)}") for i, t in items[::100]] + [(9999, text_of(rng, 300))])
    passes = []
    monkeypatch.setattr(decontam, "_with_keys", lambda *a, f=decontam._with_keys: passes.append(1) or f(*a))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminations(docs, benchmark).collect() if r.edit_distance == 0}
    assert got == {(i, i) for i, _ in items[::100]} and len(passes) == 1
    left = decontam.drop_contaminated(docs, benchmark).collect()
    assert [r.doc_id for r in left] == [9999]


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.contaminations(make_docs([(1, "a b")]), none).collect() == []
    assert decontam.contaminations(make_docs([]), some).collect() == []
    assert decontam.drop_contaminated(make_docs([(1, "a b")]), none).count() == 1


def test_very_long_text(make_docs, spark):
    rng = random.Random(6)
    item = text_of(rng, 30)
    text = f"{text_of(rng, 150_000)} {item} {text_of(rng, 1_000)}"
    got = decontam.contaminations(make_docs([(1, text)]), spark.createDataFrame([(4, item)], "item_id long, text string")).collect()
    assert [tuple(r)[:3] for r in got] == [(1, 4, 0)]
