"""Regression statistics off the half-star grid, and the tails of Student's t."""

from __future__ import annotations

import math
import time

import numpy as np
import pytest

from cinesift import operators as ops
from cinesift.functions.regression import with_t_p_value, with_t_quantile

PERFECT_FITS = {1: [0.1, 0.2, 0.3], 2: [0.1, 0.2, 0.4, 0.7], 3: [1.1, 2.3, 3.7, 4.9], 4: [0.7, 1.4, 2.9, 3.3, 4.7]}


def _ratings(spark, series):
    rows = []
    for k, (x, y) in series.items():
        rows += [(2 * k, m, float(v)) for m, v in enumerate(x)] + [(2 * k + 1, m, float(v)) for m, v in enumerate(y)]
    return spark.createDataFrame(rows, "user_id bigint, movie_id bigint, rating double"), [(2 * k, 2 * k + 1) for k in series]


def test_perfect_fits_off_the_grid(spark):
    ratings, pairs = _ratings(spark, {k: (x, [2 * v + 0.3 for v in x]) for k, x in PERFECT_FITS.items()})
    for r in ops.pair_ols(ratings, pairs).collect():
        assert r.slope == pytest.approx(2.0, abs=1e-12) and r.intercept == pytest.approx(0.3, abs=1e-12)
        assert r.r2 == r.r2_adj == 1.0 and r.se_slope == r.se_intercept == 0.0
        assert r.t_slope is None and r.f_stat is None and r.p_slope is None and r.log_lik is None
    for r in ops.pair_residual_shape(ratings, pairs).collect():
        assert (r.skew, r.kurtosis, r.jarque_bera, r.omnibus) == (None,) * 4


def test_general_series_equal_numpy(spark):
    rng = np.random.default_rng(1)
    series = {}
    for k in range(1, 9):
        x = np.round(rng.uniform(0.5, 5, 6 + 3 * k), 2)
        series[k] = (x, np.round(0.4 * x + rng.normal(scale=0.8, size=len(x)) + 1, 2))
    ratings, pairs = _ratings(spark, series)
    ols = {r.user1 // 2: r for r in ops.pair_ols(ratings, pairs).collect()}
    shape = {r.user1 // 2: r for r in ops.pair_residual_shape(ratings, pairs).collect()}
    for k, (x, y) in series.items():
        slope, intercept = np.polyfit(x, y, 1)
        e = y - slope * x - intercept
        m2 = (e**2).mean()
        assert ols[k].slope == pytest.approx(slope, rel=1e-9) and ols[k].r2 == pytest.approx(1 - m2 / y.var(), rel=1e-9)
        assert ols[k].f_stat == pytest.approx(ols[k].t_slope ** 2, rel=1e-9)
        assert shape[k].skew == pytest.approx((e**3).mean() / m2**1.5, abs=1e-9)
        assert shape[k].kurtosis == pytest.approx((e**4).mean() / m2**2, abs=1e-9)


def _tail(t: float, df: int) -> float:
    """P(|T| >= t) by adaptive steps over the density relative to its value at t."""
    log_c = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
    scale = min(1.0, df / (t * (df + 1) + 1e-9)) if t else 1.0
    edges = scale * np.concatenate([[0], np.geomspace(1e-3, 60 if df > 30 else 1e9, 4000)])
    at, w = np.polynomial.legendre.leggauss(12)
    u = t + ((edges[1:, None] + edges[:-1, None]) + (edges[1:, None] - edges[:-1, None]) * at) / 2
    f = np.exp(log_c - (df + 1) / 2 * np.log1p(u * u / df))
    return float(2 * ((edges[1:, None] - edges[:-1, None]) / 2 * w * f).sum())


CASES = [(0.0, 5), (1e-9, 1), (0.3, 3), (1.0, 4), (2.5, 7), (9.0, 200), (30.0, 50), (40.0, 100), (1.96, 1000), (6.0, 100_000), (0.01, 100_000), (12.0, 4)]


def test_p_values_keep_their_tail(spark):
    frame = spark.createDataFrame(CASES, "t double, df bigint")
    for r in with_t_p_value(frame, "t", "df", "p").collect():
        assert 0.0 <= r.p <= 1.0
        assert r.p == pytest.approx(1.0 if r.t < 1e-6 else _tail(r.t, r.df), rel=1e-9), (r.t, r.df)
    # values known in closed form
    known = spark.createDataFrame([(1.0, 1), (math.sqrt(2), 2), (1e8, 1)], "t double, df bigint")
    got = [r.p for r in with_t_p_value(known, "t", "df", "p").collect()]
    assert got == pytest.approx([0.5, 1 - math.sqrt(0.5), 2 / math.pi * 1e-8], rel=1e-9)


def test_null_arguments(spark):
    frame = spark.createDataFrame([(None, 3), (1.0, None), (1.0, 0)], "t double, df bigint")
    assert [r.p for r in with_t_p_value(frame, "t", "df", "p").collect()] == [None] * 3


def test_cost_does_not_grow_with_the_degrees_of_freedom(spark):
    def seconds(df):
        frame = spark.range(200).selectExpr(f"CAST({df} + id AS BIGINT) AS df")
        begun = time.perf_counter()
        got = [r.q for r in with_t_quantile(frame, "df", "q").collect()]
        assert all(1.9599 < q < 2.0 for q in got)
        return time.perf_counter() - begun

    seconds(100)
    assert seconds(100_000) < 3 * seconds(100) + 1
