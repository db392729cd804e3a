"""Closed-form least squares and cosine similarity from mergeable sums.

A pair of users is summarised over the movies both rated (x = first user's rating, y =
second user's) by aggregates that merge before the shuffle. The cosine needs the raw sums
``n, sum_x, sum_y, sum_xx, sum_yy, sum_xy``. Least squares uses the centred ones, so that
ratings off the half-star grid lose no digits to cancellation:

    sxx, syy, sxy  = centred sums of squares and products;  mean_x, mean_y
    slope     = sxy / sxx
    intercept = mean_y - slope * mean_x
    SSE       = syy - sxy^2 / sxx
    r2        = 1 - SSE / syy
    s2        = SSE / (n-2)
    se_slope  = sqrt(s2 / sxx)
    se_icept  = sqrt(s2 * (1/n + mean_x^2 / sxx))
    F         = (syy - SSE) / s2
    log_lik   = -n/2 * (ln(2*pi) + ln(SSE/n) + 1)
    aic       = 2*2 - 2*log_lik,  bic = 2*ln(n) - 2*log_lik

One rule decides for all operators whether a fit is perfect: an SSE of at most
``PERFECT`` times ``syy`` is rounding and counts as zero (:func:`sse`). Division by zero is
turned into NULL (``nullif``), as Spark runs ANSI mode by default. Statistics that need
residual degrees of freedom are NULL for n <= 2.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Share of the total sum of squares below which a residual sum of squares is rounding.
PERFECT = 1e-12


def pair_sums(x: str, y: str) -> list[Column]:
    """Aggregate expressions producing the raw sums of a pair."""
    cx, cy = F.col(x), F.col(y)
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(cx).alias("sum_x"),
        F.sum(cy).alias("sum_y"),
        F.sum(cx * cx).alias("sum_xx"),
        F.sum(cy * cy).alias("sum_yy"),
        F.sum(cx * cy).alias("sum_xy"),
    ]


def centred_sums(x: str, y: str) -> list[Column]:
    """Aggregate expressions producing the centred sums of a pair."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.regr_avgx(y, x).alias("mean_x"),
        F.regr_avgy(y, x).alias("mean_y"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
    ]


def _nz(c: Column) -> Column:
    return F.nullif(c, F.lit(0.0))


def cosine() -> Column:
    return F.col("sum_xy") / _nz(F.sqrt(F.col("sum_xx")) * F.sqrt(F.col("sum_yy")))


def slope() -> Column:
    return F.col("sxy") / _nz(F.col("sxx"))


def intercept(slope_col: Column | None = None) -> Column:
    s = slope() if slope_col is None else slope_col
    return F.col("mean_y") - s * F.col("mean_x")


def sse() -> Column:
    """Residual sum of squares, 0 for a perfect fit; NULL when x is constant (no fit)."""
    raw = F.col("syy") - F.col("sxy") * F.col("sxy") / _nz(F.col("sxx"))
    return F.when(raw <= PERFECT * F.col("syy"), 0.0).otherwise(raw)


def _df_ok() -> Column:
    return F.col("n") > 2


def ols_columns() -> list[Column]:
    """OLS summary columns for ``y ~ x``; expects the centred sums and ``sse`` in scope."""
    n, sse_c = F.col("n"), F.col("sse")
    s = slope()
    b = intercept(s)
    s2 = F.when(_df_ok(), sse_c / (n - 2))
    se_slope = F.sqrt(s2 / _nz(F.col("sxx")))
    se_intercept = F.sqrt(s2 * (1.0 / n + F.col("mean_x") * F.col("mean_x") / _nz(F.col("sxx"))))
    r2_c = 1.0 - sse_c / _nz(F.col("syy"))
    log_lik = F.when(_df_ok(), -n / 2.0 * (F.lit(math.log(2.0 * math.pi)) + F.log(_nz(sse_c) / n) + 1.0))
    return [
        s.alias("slope"),
        b.alias("intercept"),
        r2_c.alias("r2"),
        F.when(_df_ok(), 1.0 - (1.0 - r2_c) * (n - 1) / (n - 2)).alias("r2_adj"),
        se_slope.alias("se_slope"),
        se_intercept.alias("se_intercept"),
        (s / _nz(se_slope)).alias("t_slope"),
        (b / _nz(se_intercept)).alias("t_intercept"),
        ((F.col("syy") - sse_c) / _nz(s2)).alias("f_stat"),
        (n - 2).alias("df_resid"),
        log_lik.alias("log_lik"),
        (4.0 - 2.0 * log_lik).alias("aic"),
        (2.0 * F.log(n) - 2.0 * log_lik).alias("bic"),
    ]


# Student's t: with phi = atan(sqrt(df) / |t|), P(|T| >= |t|) is the integral of
# sin(u)^(df-1) from 0 to phi over that from 0 to pi/2. Both are taken by Gauss-Legendre
# quadrature with a fixed number of nodes over the part where the integrand is above
# exp(-DROP) of its largest value, so the cost does not depend on df, and relative to its
# value at phi, so that the far tail keeps its digits.
NODES = 64
DROP = 45.0


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Lambda bodies run interpreted, without common-subexpression elimination, so a
    sub-expression used several times (or inside an inner loop) would be recomputed
    at every use; a one-element ``transform`` computes it once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _quadrature() -> Column:
    """Nodes and weights on [0, 1]."""
    at, weight = np.polynomial.legendre.leggauss(NODES)
    return F.array(*(F.struct(F.lit(float(a)).alias("a"), F.lit(float(w)).alias("w"))
                     for a, w in zip((at + 1) / 2, weight / 2)))


def _sine_power(phi: Column, sin_phi: Column, d: Column) -> Column:
    """Integral of (sin(u) / sin(phi))^(d-1) over u from 0 to phi."""
    power = d.cast("double") - 1.0
    low = F.when(power > 0, F.asin(sin_phi * F.exp(-DROP / F.greatest(power, F.lit(1e-300))))).otherwise(F.lit(0.0))

    def integral(v):
        def term(total, x):
            u = v["low"] + (v["phi"] - v["low"]) * x["a"]
            return total + x["w"] * F.exp(v["power"] * F.log(F.greatest(F.sin(u), F.lit(1e-300)) / v["top"]))

        return (v["phi"] - v["low"]) * F.aggregate(_quadrature(), F.lit(0.0), term)

    return _bind(F.struct(low.alias("low"), phi.alias("phi"), sin_phi.alias("top"), power.alias("power")), integral)


def _t_p_expr(t: Column, d: Column, whole: Column) -> Column:
    """Two-sided p-value; ``whole`` is the integral up to pi/2 for the same ``d``."""
    def p(v):
        tail = F.exp((d.cast("double") - 1.0) * F.log(v["s"])) * _sine_power(v["phi"], v["s"], d) / whole
        return F.least(F.lit(1.0), tail)

    angle = F.struct(
        F.atan2(F.sqrt(d.cast("double")), F.abs(t)).alias("phi"),
        (1.0 / F.sqrt(1.0 + t * t / d)).alias("s"),
    )
    return F.when(t.isNotNull() & (d >= 1), _bind(angle, p))


# The integral of sin(u)^(d-1) up to pi/2 is sqrt(pi)/2 * gamma(d/2) / gamma((d+1)/2): from a list for
# few degrees of freedom, else by the asymptotic series of that ratio in 1/x with x = d/2. The
# coefficients are fixed values (of gamma(x + 1/2) / (gamma(x) sqrt(x))).
LISTED_DF = 40
RATIO_SERIES = (1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304)


def _whole(d: Column) -> Column:
    listed = F.array(*(F.lit(math.sqrt(math.pi) / 2 * math.gamma(i / 2) / math.gamma((i + 1) / 2)) for i in range(1, LISTED_DF + 1)))
    x = d.cast("double") / 2.0
    ratio = F.lit(0.0)
    for c in reversed(RATIO_SERIES):
        ratio = ratio / x + c
    far = math.sqrt(math.pi) / 2 / (ratio * F.sqrt(x))
    return F.when(d > LISTED_DF, far).when(d >= 1, F.element_at(listed, F.least(d, F.lit(LISTED_DF)).cast("int")))


def with_t_p_value(frame: DataFrame, t: str, df: str, out: str) -> DataFrame:
    """Add ``out`` = two-sided p-value ``P(|T| >= |t|)`` of Student's t with ``df >= 1``.

    Built-in expressions only, in a constant number of steps. NULL when ``t`` or ``df`` is
    NULL or ``df`` is below 1; never outside [0, 1].
    """
    staged = frame.withColumn("_whole", _whole(F.col(df)))
    return staged.withColumn(out, _t_p_expr(F.col(t), F.col(df), F.col("_whole"))).drop("_whole")


def condition_number() -> Column:
    """sqrt(lambda_max / lambda_min) of X'X = [[n, sum_x], [sum_x, sum_xx]] (design with intercept).

    With tr = n + sum_xx and det = n * sxx: lambda_max = (tr + sqrt(tr^2 - 4 det)) / 2 and,
    as lambda_max * lambda_min = det, the ratio's root is lambda_max / sqrt(det).
    """
    n = F.col("n")
    tr = n + F.col("sxx") + n * F.col("mean_x") * F.col("mean_x")
    det = n * F.col("sxx")
    lam_max = (tr + F.sqrt(F.greatest(F.lit(0.0), tr * tr - 4.0 * det))) / 2.0
    return lam_max / _nz(F.sqrt(det))


def omnibus(skew: Column, kurt: Column, n: Column) -> Column:
    """D'Agostino-Pearson K^2 from the (biased) skewness and Pearson kurtosis of n values.

    K^2 = Z_skew^2 + Z_kurt^2 with the skewness and kurtosis tests' normalising
    transforms; defined for n >= 8 (the skewness test's minimum), else NULL.
    """
    nn = n.cast("double")
    # Skewness test.
    y = skew * F.sqrt((nn + 1.0) * (nn + 3.0) / (6.0 * (nn - 2.0)))
    beta2 = 3.0 * (nn * nn + 27.0 * nn - 70.0) * (nn + 1.0) * (nn + 3.0) / (
        (nn - 2.0) * (nn + 5.0) * (nn + 7.0) * (nn + 9.0)
    )
    w2 = -1.0 + F.sqrt(2.0 * (beta2 - 1.0))
    delta = 1.0 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2.0 / (w2 - 1.0))
    # The transform is asinh(y / alpha), continuous at y = 0 (no special case there,
    # so skewness noise of 1e-17 around an exactly symmetric sample changes nothing).
    ya = y / alpha
    z_skew = delta * F.log(ya + F.sqrt(ya * ya + 1.0))
    # Kurtosis test.
    e = 3.0 * (nn - 1.0) / (nn + 1.0)
    varb2 = 24.0 * nn * (nn - 2.0) * (nn - 3.0) / ((nn + 1.0) * (nn + 1.0) * (nn + 3.0) * (nn + 5.0))
    x = (kurt - e) / F.sqrt(varb2)
    sb1 = 6.0 * (nn * nn - 5.0 * nn + 2.0) / ((nn + 7.0) * (nn + 9.0)) * F.sqrt(
        6.0 * (nn + 3.0) * (nn + 5.0) / (nn * (nn - 2.0) * (nn - 3.0))
    )
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + F.sqrt(1.0 + 4.0 / (sb1 * sb1)))
    term1 = 1.0 - 2.0 / (9.0 * a)
    denom = 1.0 + x * F.sqrt(2.0 / (a - 4.0))
    ratio = (1.0 - 2.0 / a) / F.abs(_nz(denom))
    term2 = F.signum(denom) * F.pow(ratio, 1.0 / 3.0)
    z_kurt = (term1 - term2) / F.sqrt(2.0 / (9.0 * a))
    return F.when(n >= 8, z_skew * z_skew + z_kurt * z_kurt)


def power_sums(x: str, y: str, shift: float = 2.75) -> list[Column]:
    """Aggregate expressions ``s_ij`` = sum of x^i y^j for i + j <= 4, both less a constant near
    the middle of the rating scale (which changes no central moment, but keeps the sums small)."""
    cx, cy = F.col(x) - shift, F.col(y) - shift
    out = []
    for i in range(5):
        for j in range(5 - i):
            if i + j:
                factors = [cx] * i + [cy] * j
                term = factors[0]
                for f in factors[1:]:
                    term = term * f
                out.append(F.sum(term).alias(f"s_{i}{j}"))
    return out


def _central(i: int, j: int) -> Column:
    """Sum of (x - mean_x)^i (y - mean_y)^j from the power sums, with ``dx``, ``dy`` the means of the shifted values."""
    total = F.lit(0.0)
    for p in range(i + 1):
        for q in range(j + 1):
            raw = F.col(f"s_{p}{q}") if p + q else F.col("n").cast("double")
            sign = math.comb(i, p) * math.comb(j, q) * (-1) ** (i - p + j - q)
            for _ in range(i - p):
                raw = raw * F.col("dx")
            for _ in range(j - q):
                raw = raw * F.col("dy")
            total = total + sign * raw
    return total


def residual_moments(sums: DataFrame) -> DataFrame:
    """Add ``m3`` and ``m4``, the sums of the third and fourth powers of the residuals of ``y ~ x``,
    to a frame with the power sums and the centred sums."""
    centred = sums.withColumns({"dx": F.col("s_10") / F.col("n"), "dy": F.col("s_01") / F.col("n")}).select(
        *sums.columns, *(_central(i, j).alias(f"c_{i}{j}") for i in range(5) for j in range(5 - i) if i + j >= 3))
    sloped = centred.withColumn("b", slope())
    b = F.col("b")

    def power(order: int) -> Column:
        total = F.lit(0.0)
        for i in range(order + 1):
            term = math.comb(order, i) * (-1) ** i * F.col(f"c_{i}{order - i}")
            for _ in range(i):
                term = term * b
            total = total + term
        return total

    return sloped.withColumns({"m3": power(3), "m4": power(4)})


# 95% two-sided intervals. Z_975 is the standard normal 0.975 quantile;
# the t quantile has closed forms for df = 1 (tan(0.475 pi)) and df = 2, and for
# df >= 3 starts from the Cornish-Fisher expansion in 1/df and is refined by Halley
# steps on the exact p-value, whose derivatives are those of the density.
CI_ALPHA = 0.05
Z_975 = 1.959963984540054
HALLEY_STEPS = 2


def with_t_quantile(frame: DataFrame, df: str, out: str) -> DataFrame:
    """Add ``out`` = the two-sided ``1 - CI_ALPHA`` critical value of Student's t with ``df``.

    df = 1: tan(pi (1 - alpha) / 2); df = 2: sqrt(2 / (alpha (2 - alpha)) - 2).
    df >= 3: Cornish-Fisher start q0 = z + g1/df + g2/df^2 + g3/df^3 + g4/df^4, then
    Halley iterations on p(q) - alpha with p from :func:`_t_p_expr`, as a built-in ``aggregate``:
    p' = -2 f(q) and p''/p' = -q (df + 1) / (df + q^2), with the density f in terms of the
    integral that p is divided by. The error is cubed by every step, from under 0.004.
    NULL when ``df`` is NULL or below 1.
    """
    d = F.col(df).cast("double")
    z = Z_975
    g1 = (z**3 + z) / 4.0
    g2 = (5 * z**5 + 16 * z**3 + 3 * z) / 96.0
    g3 = (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384.0
    g4 = (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160.0
    start = F.lit(z) + g1 / d + g2 / (d * d) + g3 / (d * d * d) + g4 / (d * d * d * d)

    def halley(q: Column, _: Column) -> Column:
        # 2 f(q) = (1 + q^2 / df)^(-(df + 1) / 2) / (sqrt(df) * whole)
        slope_ = -F.exp(-(d + 1.0) / 2.0 * F.log(1.0 + q * q / d)) / (F.sqrt(d) * F.col("_whole"))
        off = (_t_p_expr(q, F.col(df), F.col("_whole")) - CI_ALPHA) / slope_
        return _bind(off, lambda e: q - e / (1.0 + e * q * (d + 1.0) / (2.0 * (d + q * q))))

    refined = F.aggregate(F.sequence(F.lit(1), F.lit(HALLEY_STEPS)), start, halley)
    one = math.tan(math.pi * (1.0 - CI_ALPHA) / 2.0)
    two = math.sqrt(2.0 / (CI_ALPHA * (2.0 - CI_ALPHA)) - 2.0)
    q = F.when(d == 1, F.lit(one)).when(d == 2, F.lit(two)).when(d >= 3, refined)
    return frame.withColumn("_whole", _whole(F.col(df))).withColumn(out, q).drop("_whole")
