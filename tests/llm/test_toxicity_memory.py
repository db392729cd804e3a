"""The regression holds no array as long as the features of all rows, and blocks change no result."""

from __future__ import annotations

import tracemalloc

import numpy as np

from cinesift.llm import toxicity


def _features(mean: int, n: int):
    rnd = np.random.default_rng(3)
    lengths = rnd.integers(0, 2 * mean, n)
    lengths[[0, n // 2, n - 1]] = 0
    starts = np.concatenate([[0], np.cumsum(lengths)])
    y = (rnd.random(n) < 0.3).astype(np.float64)
    y[:2] = 0, 1
    return starts, rnd.integers(0, 500, starts[-1]).astype(np.int32), rnd.normal(size=500), y


def test_memory_of_the_regression_does_not_follow_the_features():
    starts, cols, scale, y = _features(1000, 3000)
    tracemalloc.start()
    try:
        toxicity._regress(starts, cols, scale, y, rounds=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8 * len(cols)


def test_blocks_change_no_result(monkeypatch):
    starts, cols, scale, y = _features(30, 200)
    results = []
    for size in (1, 7, 100, 1 << 30):
        monkeypatch.setattr(toxicity, "_FEATURES_AT_ONCE", size)
        results.append(toxicity._regress(starts, cols, scale, y, rounds=20))
    weights, intercept = results[0]
    assert np.abs(weights).max() > 0
    assert all((w == weights).all() and b == intercept for w, b in results)
