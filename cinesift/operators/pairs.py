"""Comparing the tastes of user pairs over the movies both rated.

``pairs`` is a DataFrame ``(user1, user2)`` of any size (or a small list of tuples).
Co-ratings are an equi-join, so work is linear in the co-rating rows of the pairs asked
for; no pair table is ever generated from all users. Per-pair statistics come from
mergeable sums (see :mod:`cinesift.functions.regression`), aggregated partially before
the shuffle on ``(user1, user2)``.

With repeated (user, movie) ratings the co-ratings multiply (bag join).
A pair without a common movie gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinesift.functions import regression as R

PAIR_KEYS = ["user1", "user2"]


def _pair_frame(ratings: DataFrame, pairs: DataFrame | Iterable[tuple[int, int]]) -> DataFrame:
    if isinstance(pairs, DataFrame):
        frame = pairs.select(F.col("user1").cast("bigint"), F.col("user2").cast("bigint"))
    else:
        schema = T.StructType(
            [T.StructField("user1", T.LongType()), T.StructField("user2", T.LongType())]
        )
        frame = ratings.sparkSession.createDataFrame([(int(a), int(b)) for a, b in pairs], schema)
    return frame.distinct()


def common_ratings(ratings: DataFrame, pairs) -> DataFrame:
    """``(user1, user2, movie_id, rating1, rating2)`` for every movie both users rated."""
    p = _pair_frame(ratings, pairs)
    r1 = ratings.select(F.col("user_id").alias("user1"), "movie_id", F.col("rating").alias("rating1"))
    r2 = ratings.select(F.col("user_id").alias("user2"), "movie_id", F.col("rating").alias("rating2"))
    first = p.join(r1, on="user1", how="inner")
    both = first.join(r2, on=["user2", "movie_id"], how="inner")
    return both.select("user1", "user2", "movie_id", "rating1", "rating2")


def pair_sums(ratings: DataFrame, pairs) -> DataFrame:
    """``(user1, user2, n, sum_x, sum_y, sum_xx, sum_yy, sum_xy)``; x = rating1, y = rating2."""
    common = common_ratings(ratings, pairs)
    return common.groupBy(*PAIR_KEYS).agg(*R.pair_sums("rating1", "rating2"))


def pair_cosine(ratings: DataFrame, pairs) -> DataFrame:
    """``(user1, user2, n_common, sum_xx, sum_yy, sum_xy, cosine)``.

    cosine = sum_xy / (sqrt(sum_xx) * sqrt(sum_yy)); higher means more alike. The
    three sums are output so other normalisations can be derived from them.
    """
    sums = pair_sums(ratings, pairs)
    return sums.select(
        *PAIR_KEYS,
        F.col("n").alias("n_common"),
        "sum_xx",
        "sum_yy",
        "sum_xy",
        R.cosine().alias("cosine"),
    )


def _centred(ratings: DataFrame, pairs) -> DataFrame:
    common = common_ratings(ratings, pairs)
    return common.groupBy(*PAIR_KEYS).agg(*R.centred_sums("rating1", "rating2"))


def pair_linear_fit(ratings: DataFrame, pairs) -> DataFrame:
    """``(user1, user2, n, slope, intercept)`` of the degree-1 least-squares fit rating2 ~ rating1.

    NULL slope/intercept when the first user's ratings are constant (incl. n = 1).
    """
    s = R.slope()
    return _centred(ratings, pairs).select(*PAIR_KEYS, "n", s.alias("slope"), R.intercept(s).alias("intercept"))


def pair_fitted_points(ratings: DataFrame, pairs) -> DataFrame:
    """Co-ratings plus ``fitted = slope * rating1 + intercept`` and ``residual``.

    The fit is joined back on the pair key; both sides are hash-partitioned on
    ``(user1, user2)`` by the same exchange, which Spark reuses.
    """
    common = common_ratings(ratings, pairs)
    sums = common.groupBy(*PAIR_KEYS).agg(*R.centred_sums("rating1", "rating2"))
    s = R.slope()
    fit = sums.select(*PAIR_KEYS, s.alias("slope"), R.intercept(s).alias("intercept"))
    joined = common.join(fit, on=PAIR_KEYS, how="inner")
    fitted = F.col("slope") * F.col("rating1") + F.col("intercept")
    return joined.select(
        *PAIR_KEYS,
        "movie_id",
        "rating1",
        "rating2",
        fitted.alias("fitted"),
        (F.col("rating2") - fitted).alias("residual"),
    )


def pair_ols(ratings: DataFrame, pairs) -> DataFrame:
    """OLS ``rating2 ~ rating1`` per pair: the numbers of a regression summary.

    Fit, r2, r2_adj, standard errors, t statistics with two-sided p-values and 95%
    confidence intervals, F and its p-value, log-likelihood, AIC, BIC and the
    condition number of the design.
    """
    sums = _centred(ratings, pairs).withColumn("sse", R.sse())
    out = sums.select(*PAIR_KEYS, "n", *R.ols_columns(), R.condition_number().alias("cond_no"))
    out = R.with_t_p_value(out, "t_slope", "df_resid", "p_slope")
    out = R.with_t_p_value(out, "t_intercept", "df_resid", "p_intercept")
    # With one regressor F = t_slope^2,
    # so the F test's p-value is the slope's two-sided t p-value.
    out = out.withColumn("f_pvalue", F.when(F.col("f_stat").isNotNull(), F.col("p_slope")))
    # 95% intervals: coefficient -/+ t_{0.975, df} * standard error.
    out = R.with_t_quantile(out, "df_resid", "_t_crit")
    bounds = []
    for coef in ("slope", "intercept"):
        half = F.col("_t_crit") * F.col(f"se_{coef}")
        bounds += [(F.col(coef) - half).alias(f"{coef}_ci_low"), (F.col(coef) + half).alias(f"{coef}_ci_high")]
    columns = [*PAIR_KEYS, "n", "slope", "intercept", "r2", "r2_adj", "se_slope", "se_intercept", "t_slope",
               "t_intercept", "f_stat", "df_resid", "log_lik", "aic", "bic", "cond_no", "p_slope",
               "p_intercept", "f_pvalue"]
    return out.select(*columns, *bounds)


def pair_residual_shape(ratings: DataFrame, pairs) -> DataFrame:
    """``(user1, user2, n, skew, kurtosis, jarque_bera, jb_pvalue, omnibus, omnibus_pvalue)``.

    Shape of the OLS residuals: ``kurtosis`` is the plain (not excess) fourth
    standardised moment, JB = n/6 * (skew^2 + (kurtosis - 3)^2 / 4), and ``omnibus``
    is D'Agostino's K^2 (n >= 8). Both tests are chi-square with 2 degrees of
    freedom, whose survival function is exp(-x / 2). NULL when there is no fit,
    n <= 2, or the fit is perfect (the rule of :func:`cinesift.functions.regression.sse`).
    The moments follow from power sums, so one aggregate of the co-ratings is enough.
    """
    common = common_ratings(ratings, pairs)
    sums = common.groupBy(*PAIR_KEYS).agg(*R.centred_sums("rating1", "rating2"), *R.power_sums("rating1", "rating2"))
    moments = R.residual_moments(sums).withColumn("sse", R.sse())
    defined = (F.col("n") > 2) & (F.col("sse") > 0)
    m2 = F.col("sse") / F.col("n")
    moments = moments.select(
        *PAIR_KEYS, "n",
        F.when(defined, F.col("m3") / F.col("n") / (m2 * F.sqrt(m2))).alias("skew"),
        F.when(defined, F.col("m4") / F.col("n") / (m2 * m2)).alias("kurtosis"),
    )
    skew, kurt = F.col("skew"), F.col("kurtosis")
    jb = F.col("n") / 6.0 * (skew * skew + (kurt - 3.0) * (kurt - 3.0) / 4.0)
    shape = moments.select(
        *PAIR_KEYS, "n", "skew", "kurtosis", jb.alias("jarque_bera")
    )
    k2 = R.omnibus(F.col("skew"), F.col("kurtosis"), F.col("n"))
    return shape.select(
        "*",
        F.exp(-F.col("jarque_bera") / 2.0).alias("jb_pvalue"),
        k2.alias("omnibus"),
    ).withColumn("omnibus_pvalue", F.exp(-F.col("omnibus") / 2.0))
