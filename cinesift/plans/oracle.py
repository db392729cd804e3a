"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code as plain SQL over the benchmark's tables
(``lineitem orders part customer nation`` are views in the checker). Least squares uses
DuckDB's own centred ``regr_*`` aggregates, residual moments a second pass over the
residuals, p-values a finite series; all are compared rounded. The neighbour table is
a brute-force quadratic ranking, the definition the Spark plan must match.
"""

from __future__ import annotations

import math

ROUND_DIGITS = 6
TEST_DIGITS = 4
LN_2PI = repr(math.log(2.0 * math.pi))

# name -> (dependencies, body)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ratings": (
        (),
        """SELECT o_custkey AS user_id, l_partkey AS movie_id,
                  ceil(l_quantity / 5) / 2 AS rating, l_shipdate AS ts
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "movies": (
        (),
        """SELECT p_partkey AS movie_id,
                  concat(p_name, ', ', p_brand, ' (', CAST(1950 + p_size AS VARCHAR), ')') AS title,
                  concat(p_type, '|', replace(p_name, ' ', '|')) AS genres
           FROM part""",
    ),
    "movie_genres": (
        ("movies",),
        "SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM movies",
    ),
    "titled": (
        ("movies",),
        """SELECT movie_id, title, genres, replace(title, ',', '') AS title_key,
                  CASE WHEN length(d) = 0 THEN '0'
                       WHEN length(d) = 3 THEN substring(d, 3, 1)
                       ELSE right(d, 4) END AS year
           FROM (SELECT *, regexp_replace(regexp_extract(title, '([^,]*)$', 1), '[^0-9]', '', 'g') AS d
                 FROM movies)""",
    ),
    "movie_stats": (
        ("ratings",),
        """SELECT movie_id, avg(rating) AS avg_rating, count(*) AS watch_count
           FROM ratings GROUP BY movie_id""",
    ),
    "profile": (
        ("ratings", "movie_genres"),
        """SELECT r.user_id, g.genre, sum(r.rating) AS rating_sum, count(r.rating) AS n_rated
           FROM ratings r JOIN movie_genres g ON r.movie_id = g.movie_id
           GROUP BY r.user_id, g.genre""",
    ),
    "fav": (
        ("profile",),
        """SELECT user_id, genre, rating_sum FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating_sum DESC, genre ASC) AS rn
             FROM profile) WHERE rn = 1""",
    ),
    "knn": (
        ("fav",),
        """SELECT user_id, neighbour_id, genre, diff / 10.0 AS distance, rk AS rank FROM (
             SELECT a.user_id, b.user_id AS neighbour_id, a.genre,
                    abs(a.rating_sum - b.rating_sum) AS diff,
                    row_number() OVER (PARTITION BY a.user_id
                                       ORDER BY abs(a.rating_sum - b.rating_sum), b.user_id) AS rk
             FROM fav a JOIN fav b ON a.genre = b.genre AND a.user_id <> b.user_id)
           WHERE rk <= 3""",
    ),
    "pairs": (
        ("knn",),
        "SELECT DISTINCT user_id AS user1, neighbour_id AS user2 FROM knn",
    ),
    "common": (
        ("pairs", "ratings"),
        """SELECT p.user1, p.user2, r1.movie_id, r1.rating AS rating1, r2.rating AS rating2
           FROM pairs p
           JOIN ratings r1 ON r1.user_id = p.user1
           JOIN ratings r2 ON r2.user_id = p.user2 AND r2.movie_id = r1.movie_id""",
    ),
    "sums": (
        ("common",),
        """SELECT user1, user2, count(*) AS n,
                  sum(rating1) AS sum_x, sum(rating2) AS sum_y,
                  sum(rating1 * rating1) AS sum_xx, sum(rating2 * rating2) AS sum_yy,
                  sum(rating1 * rating2) AS sum_xy
           FROM common GROUP BY user1, user2""",
    ),
    "csums": (
        ("common",),
        """SELECT *, CASE WHEN raw_sse <= 1e-12 * syy THEN 0 ELSE raw_sse END AS sse FROM (
             SELECT *, syy - sxy * sxy / nullif(sxx, 0) AS raw_sse FROM (
               SELECT user1, user2, count(*) AS n,
                      regr_avgx(rating2, rating1) AS mx, regr_avgy(rating2, rating1) AS my,
                      regr_sxx(rating2, rating1) AS sxx, regr_syy(rating2, rating1) AS syy,
                      regr_sxy(rating2, rating1) AS sxy
               FROM common GROUP BY user1, user2))""",
    ),
    "fit": (
        ("csums",),
        """SELECT *, my - slope * mx AS intercept FROM (
             SELECT *, sxy / nullif(sxx, 0) AS slope FROM csums)""",
    ),
    "points": (
        ("common", "fit"),
        """SELECT c.user1, c.user2, c.movie_id, c.rating1, c.rating2,
                  f.slope * c.rating1 + f.intercept AS fitted,
                  c.rating2 - (f.slope * c.rating1 + f.intercept) AS residual
           FROM common c JOIN fit f ON c.user1 = f.user1 AND c.user2 = f.user2""",
    ),
    "busy_users": (
        ("ratings",),
        """SELECT user_id FROM ratings GROUP BY user_id
           HAVING count(*) > (SELECT avg(n) FROM (SELECT count(*) AS n FROM ratings GROUP BY user_id))""",
    ),
    "popular_movies": (
        ("ratings",),
        """SELECT movie_id FROM ratings GROUP BY movie_id
           HAVING count(*) >= (SELECT avg(n) FROM (SELECT count(*) AS n FROM ratings GROUP BY movie_id))""",
    ),
    "popular_titles": (
        ("movies", "popular_movies"),
        """SELECT DISTINCT replace(title, ',', '') AS title_key FROM movies
           WHERE movie_id IN (SELECT movie_id FROM popular_movies)""",
    ),
    "large_genres": (
        ("movie_genres",),
        """SELECT genre FROM movie_genres GROUP BY genre
           HAVING count(*) > (SELECT avg(n) FROM (SELECT count(*) AS n FROM movie_genres GROUP BY genre))""",
    ),
    "large_years": (
        ("titled",),
        """SELECT year FROM titled GROUP BY year
           HAVING count(*) > (SELECT avg(n) FROM (SELECT count(*) AS n FROM titled GROUP BY year))""",
    ),
    "nation_common": (
        ("ratings",),
        """SELECT a.n_nationkey::BIGINT AS user1, b.n_nationkey::BIGINT AS user2, r1.movie_id,
                  r1.rating AS rating1, r2.rating AS rating2
           FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey
           JOIN (SELECT c_nationkey, movie_id, rating FROM ratings JOIN customer ON user_id = c_custkey) r1
             ON r1.c_nationkey = a.n_nationkey
           JOIN (SELECT c_nationkey, movie_id, rating FROM ratings JOIN customer ON user_id = c_custkey) r2
             ON r2.c_nationkey = b.n_nationkey AND r2.movie_id = r1.movie_id""",
    ),
    "liked": (
        ("knn", "ratings"),
        """SELECT k.user_id, k.neighbour_id, r.movie_id, r.rating
           FROM knn k JOIN ratings r ON r.user_id = k.neighbour_id
           WHERE r.rating >= 4.0""",
    ),
}


# The same statistics over the pairs of nations.
for _name in ("csums", "fit", "points"):
    _deps, _body = _CTES[_name]
    for _dep in _deps:
        _body = _body.replace(f"FROM {_dep}", f"FROM nation_{_dep}").replace(f"JOIN {_dep} ", f"JOIN nation_{_dep} ")
    _CTES[f"nation_{_name}"] = (tuple(f"nation_{d}" for d in _deps), _body)


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _CTES[name][0]:
            visit(dep)
        order.append(name)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in order) + "\n"


def _rnd(expr: str, alias: str, digits: int = ROUND_DIGITS) -> str:
    # Same boundary-safe rounding as the Spark side (see plans/queries.py).
    return f"round(({expr}) + 1e-9, {digits}) + 0.0 AS {alias}"


def _t_pvalue(t: str, df: str) -> str:
    """Two-sided Student-t p-value for integer df, as SQL.

    Independent of the Spark recurrence: the series coefficients come from lgamma,
    (2k)!/(4^k k!^2) for even df and 4^k k!^2/(2k+1)! for odd df.
    """
    th = f"atan(abs({t}) / sqrt({df}))"
    c2 = f"(cos({th}) * cos({th}))"
    even_sum = (
        f"coalesce(list_sum(list_transform(range(1, ({df} - 2) // 2 + 1), lambda k: "
        f"exp(lgamma(2 * k + 1) - 2 * lgamma(k + 1) - k * ln(4)) * pow({c2}, k))), 0)"
    )
    odd_sum = (
        f"coalesce(list_sum(list_transform(range(1, ({df} - 3) // 2 + 1), lambda k: "
        f"exp(k * ln(4) + 2 * lgamma(k + 1) - lgamma(2 * k + 2)) * pow({c2}, k))), 0)"
    )
    return (
        f"(CASE WHEN {t} IS NULL OR {df} IS NULL THEN NULL "
        f"WHEN {df} % 2 = 0 THEN 1 - sin({th}) * (1 + {even_sum}) "
        f"WHEN {df} = 1 THEN 1 - 2 * {th} / pi() "
        f"ELSE 1 - 2 / pi() * ({th} + sin({th}) * cos({th}) * (1 + {odd_sum})) END)"
    )


def _t_crit(df: str) -> str:
    """Two-sided 95% critical value of Student's t, by 60 halvings of [0, 13], as SQL."""
    p_mid = _t_pvalue("((acc.lo + acc.hi) / 2.0)", "d")
    reduce = (
        f"list_reduce(range(60), lambda acc, i: CASE WHEN {p_mid} > 0.05 "
        "THEN struct_pack(lo := (acc.lo + acc.hi) / 2.0, hi := acc.hi) "
        "ELSE struct_pack(lo := acc.lo, hi := (acc.lo + acc.hi) / 2.0) END, "
        "struct_pack(lo := 0.0::DOUBLE, hi := 13.0::DOUBLE))"
    )
    # The lambda sees the degrees of freedom through a one-element list bound to d.
    return f"(CASE WHEN {df} >= 1 THEN list_transform([{df}], lambda d: ({reduce}).lo / 2.0 + ({reduce}).hi / 2.0)[1] END)"


def _omnibus(skew: str, kurt: str, n: str) -> str:
    """D'Agostino-Pearson K^2 (skewness test + kurtosis test), as SQL; NULL for n < 8."""
    nn = f"CAST({n} AS DOUBLE)"
    y = f"({skew} * sqrt(({nn} + 1) * ({nn} + 3) / (6.0 * ({nn} - 2))))"
    beta2 = f"(3.0 * ({nn} * {nn} + 27 * {nn} - 70) * ({nn} + 1) * ({nn} + 3) / (({nn} - 2) * ({nn} + 5) * ({nn} + 7) * ({nn} + 9)))"
    w2 = f"(-1 + sqrt(2 * ({beta2} - 1)))"
    delta = f"(1 / sqrt(0.5 * ln({w2})))"
    alpha = f"sqrt(2.0 / ({w2} - 1))"
    zs = f"({delta} * ln({y} / {alpha} + sqrt(({y} / {alpha}) * ({y} / {alpha}) + 1)))"
    e = f"(3.0 * ({nn} - 1) / ({nn} + 1))"
    varb2 = f"(24.0 * {nn} * ({nn} - 2) * ({nn} - 3) / (({nn} + 1) * ({nn} + 1) * ({nn} + 3) * ({nn} + 5)))"
    x = f"(({kurt} - {e}) / sqrt({varb2}))"
    sb1 = f"(6.0 * ({nn} * {nn} - 5 * {nn} + 2) / (({nn} + 7) * ({nn} + 9)) * sqrt(6.0 * ({nn} + 3) * ({nn} + 5) / ({nn} * ({nn} - 2) * ({nn} - 3))))"
    a = f"(6.0 + 8.0 / {sb1} * (2.0 / {sb1} + sqrt(1 + 4.0 / ({sb1} * {sb1}))))"
    denom = f"(1 + {x} * sqrt(2 / ({a} - 4.0)))"
    term2 = f"(sign({denom}) * pow((1 - 2.0 / {a}) / abs(nullif({denom}, 0)), 1.0 / 3))"
    zk = f"((1 - 2 / (9.0 * {a}) - {term2}) / sqrt(2 / (9.0 * {a})))"
    return f"(CASE WHEN {n} >= 8 THEN {zs} * {zs} + {zk} * {zk} END)"


_S2 = "(CASE WHEN n > 2 THEN sse / (n - 2) END)"
_SE_SLOPE = f"sqrt({_S2} / nullif(sxx, 0))"
_SE_ICEPT = f"sqrt({_S2} * (1.0 / n + mx * mx / nullif(sxx, 0)))"
_R2 = "(1.0 - sse / nullif(syy, 0))"
_LOGLIK = f"(CASE WHEN n > 2 THEN (-n) / 2.0 * ({LN_2PI} + ln(nullif(sse, 0) / n) + 1.0) END)"
_TRACE = "(n + sxx + n * mx * mx)"


def _ols(prefix: str = "") -> str:
    """The regression summary over ``<prefix>fit``."""
    t_slope, t_icept = f"(slope / nullif({_SE_SLOPE}, 0))", f"(intercept / nullif({_SE_ICEPT}, 0))"
    f_stat = f"((syy - sse) / nullif({_S2}, 0))"
    return _with(f"{prefix}fit") + f"""
        SELECT user1, user2, n, df_resid,
               {_rnd("slope", "slope")}, {_rnd("intercept", "intercept")},
               {_rnd(_R2, "r2")},
               {_rnd(f"CASE WHEN n > 2 THEN 1.0 - (1.0 - {_R2}) * (n - 1) / (n - 2) END", "r2_adj")},
               {_rnd("se_s", "se_slope")}, {_rnd("se_i", "se_intercept")},
               {_rnd("t_s", "t_slope", TEST_DIGITS)}, {_rnd("t_i", "t_intercept", TEST_DIGITS)},
               {_rnd("f", "f_stat", TEST_DIGITS)},
               {_rnd(_LOGLIK, "log_lik")}, {_rnd(f"4.0 - 2.0 * {_LOGLIK}", "aic")},
               {_rnd(f"2.0 * ln(n) - 2.0 * {_LOGLIK}", "bic")},
               {_rnd(f"({_TRACE} + sqrt(greatest(0, {_TRACE} * {_TRACE} - 4.0 * n * sxx))) / 2.0 / nullif(sqrt(n * sxx), 0)", "cond_no")},
               {_rnd(_t_pvalue("t_s", "df_resid"), "p_slope")},
               {_rnd(_t_pvalue("t_i", "df_resid"), "p_intercept")},
               {_rnd(_t_pvalue("sqrt(f)", "df_resid"), "f_pvalue")},
               {_rnd("slope - tc * se_s", "slope_ci_low")}, {_rnd("slope + tc * se_s", "slope_ci_high")},
               {_rnd("intercept - tc * se_i", "intercept_ci_low")}, {_rnd("intercept + tc * se_i", "intercept_ci_high")}
        FROM (SELECT *, n - 2 AS df_resid, {_SE_SLOPE} AS se_s, {_SE_ICEPT} AS se_i, {t_slope} AS t_s,
                     {t_icept} AS t_i, {f_stat} AS f FROM {prefix}fit)
        JOIN (SELECT df, {_t_crit("df")} AS tc FROM (SELECT DISTINCT n - 2 AS df FROM {prefix}fit)) ON df = df_resid"""


def _shape(prefix: str = "") -> str:
    """Shape of the residuals, from a second pass over ``<prefix>points``."""
    return _with(f"{prefix}points", f"{prefix}csums") + f"""
        SELECT user1, user2, n, {_rnd("sk", "skew")}, {_rnd("ku", "kurtosis")}, {_rnd("jb", "jarque_bera")},
               {_rnd("exp(-jb / 2)", "jb_pvalue")},
               {_rnd(_omnibus("sk", "ku", "n"), "omnibus")},
               {_rnd("exp(-" + _omnibus("sk", "ku", "n") + " / 2)", "omnibus_pvalue")}
        FROM (
          SELECT *, n / 6.0 * (sk * sk + (ku - 3.0) * (ku - 3.0) / 4.0) AS jb FROM (
            SELECT s.user1, s.user2, s.n,
                   CASE WHEN n > 2 AND sse > 0 THEN m3 / pow(m2, 1.5) END AS sk,
                   CASE WHEN n > 2 AND sse > 0 THEN m4 / (m2 * m2) END AS ku
            FROM {prefix}csums s JOIN (
              SELECT user1, user2, avg(d * d) AS m2, avg(d * d * d) AS m3, avg(d * d * d * d) AS m4 FROM (
                SELECT user1, user2, residual - avg(residual) OVER (PARTITION BY user1, user2) AS d
                FROM {prefix}points)
              GROUP BY user1, user2) m
            ON s.user1 = m.user1 AND s.user2 = m.user2))"""


_USERS = "(SELECT user_id FROM busy_users)"
_TITLE_KEYS = "(SELECT title_key FROM popular_titles)"

ORACLE_SQL: dict[str, str] = {
    "read_ratings_csv": _with("ratings")
    + "SELECT user_id, movie_id, rating, CAST(epoch(ts) AS BIGINT) AS ts_seconds FROM ratings",
    "read_movies_csv": _with("movies") + "SELECT movie_id, title, genres FROM movies",
    "with_title_year": _with("titled") + "SELECT movie_id, title, genres, title_key, year FROM titled",
    "explode_genres": _with("movie_genres") + "SELECT movie_id, genre FROM movie_genres",
    "user_watch_counts": _with("ratings")
    + "SELECT user_id, count(*) AS movies_watched FROM ratings GROUP BY user_id",
    "user_genre_counts": _with("ratings", "movie_genres")
    + """SELECT r.user_id, count(DISTINCT g.genre) AS genres_watched
         FROM ratings r LEFT JOIN movie_genres g ON r.movie_id = g.movie_id
         GROUP BY r.user_id""",
    "user_genres": _with("ratings", "movie_genres", "busy_users")
    + f"""SELECT DISTINCT r.user_id, g.genre
          FROM ratings r JOIN movie_genres g ON r.movie_id = g.movie_id
          WHERE r.user_id IN {_USERS}""",
    "user_genre_lists": _with("ratings", "movie_genres", "busy_users")
    + f"""SELECT user_id, array_to_string(list_sort(list(genre)), '|') AS genres FROM (
            SELECT DISTINCT r.user_id, g.genre
            FROM ratings r JOIN movie_genres g ON r.movie_id = g.movie_id
            WHERE r.user_id IN {_USERS})
          GROUP BY user_id""",
    "user_watched_titles": _with("ratings", "movies", "busy_users")
    + f"""SELECT r.user_id, r.movie_id, m.title
          FROM ratings r LEFT JOIN movies m ON r.movie_id = m.movie_id
          WHERE r.user_id IN {_USERS}""",
    "movie_avg_rating": _with("movie_stats") + "SELECT movie_id, avg_rating FROM movie_stats",
    "movie_avg_rating_titled": _with("movie_stats", "movies")
    + "SELECT s.movie_id, s.avg_rating, m.title FROM movie_stats s JOIN movies m ON s.movie_id = m.movie_id",
    "title_avg_rating": _with("movie_stats", "movies")
    + "SELECT m.title, s.avg_rating FROM movie_stats s JOIN movies m ON s.movie_id = m.movie_id",
    "avg_rating_by_movie_id": _with("movie_stats", "movies", "popular_movies")
    + """SELECT s.movie_id, s.avg_rating, m.title
         FROM movie_stats s JOIN movies m ON s.movie_id = m.movie_id
         WHERE s.movie_id IN (SELECT movie_id FROM popular_movies)""",
    "avg_rating_by_title": _with("movie_stats", "movies", "popular_titles")
    + f"""SELECT s.movie_id, s.avg_rating, m.title
          FROM movie_stats s JOIN movies m ON s.movie_id = m.movie_id
          WHERE replace(m.title, ',', '') IN {_TITLE_KEYS}""",
    "movie_watch_counts": _with("movie_stats") + "SELECT movie_id, watch_count FROM movie_stats",
    "watch_count_by_movie_id": _with("movie_stats", "movies", "popular_movies")
    + """SELECT s.movie_id, s.watch_count, m.title
         FROM movie_stats s LEFT JOIN movies m ON s.movie_id = m.movie_id
         WHERE s.movie_id IN (SELECT movie_id FROM popular_movies)""",
    "watch_count_by_title": _with("movie_stats", "movies", "popular_titles")
    + f"""SELECT m.title, s.movie_id, s.watch_count
          FROM movie_stats s JOIN movies m ON s.movie_id = m.movie_id
          WHERE replace(m.title, ',', '') IN {_TITLE_KEYS}""",
    "genre_movie_counts": _with("movie_genres")
    + "SELECT genre, count(*) AS n_movies FROM movie_genres GROUP BY genre",
    "movies_in_genres": _with("movie_genres", "large_genres")
    + "SELECT genre, movie_id FROM movie_genres WHERE genre IN (SELECT genre FROM large_genres)",
    "movies_by_year": _with("titled") + "SELECT year, movie_id, title FROM titled",
    "movies_in_year": _with("titled", "large_years")
    + "SELECT year, movie_id, title FROM titled WHERE year IN (SELECT year FROM large_years)",
    "top_rated": _with("movie_stats")
    + "SELECT movie_id, avg_rating FROM movie_stats ORDER BY avg_rating DESC, movie_id ASC LIMIT 40",
    "top_watched": _with("movie_stats")
    + "SELECT movie_id, watch_count FROM movie_stats ORDER BY watch_count DESC, movie_id ASC LIMIT 10",
    "user_genre_profile": _with("profile")
    + """SELECT user_id, genre, rating_sum / nullif(n_rated, 0) AS avg_rating, n_rated, rating_sum / 10.0 AS fav_score
         FROM profile""",
    "favourite_genre": _with("fav") + "SELECT user_id, genre, rating_sum / 10.0 AS fav_score FROM fav",
    "taste_clusters": _with("fav") + "SELECT genre, user_id FROM fav",
    "taste_cluster_sizes": _with("fav") + "SELECT genre, count(*) AS n_users FROM fav GROUP BY genre",
    "common_ratings": _with("common") + "SELECT user1, user2, movie_id, rating1, rating2 FROM common",
    "pair_cosine": _with("sums")
    + """SELECT user1, user2, n AS n_common, sum_xx, sum_yy, sum_xy,
                sum_xy / nullif(sqrt(sum_xx) * sqrt(sum_yy), 0) AS cosine
         FROM sums""",
    "pair_linear_fit": _with("fit")
    + f'SELECT user1, user2, n, {_rnd("slope", "slope")}, {_rnd("intercept", "intercept")} FROM fit',
    "pair_fitted_points": _with("points")
    + f"""SELECT user1, user2, movie_id, rating1, rating2, {_rnd("fitted", "fitted")}, {_rnd("residual", "residual")}
          FROM points""",
    "pair_ols": _ols(),
    "pair_residual_shape": _shape(),
    "nation_pair_ols": _ols("nation_"),
    "nation_pair_residual_shape": _shape("nation_"),
    "similar_users": _with("knn") + "SELECT user_id, neighbour_id, genre, distance, rank FROM knn",
    "liked_by_neighbours": _with("liked") + "SELECT user_id, neighbour_id, movie_id, rating FROM liked",
    "recommend": _with("liked")
    + """SELECT user_id, movie_id, count(*) AS n_votes, avg(rating) AS avg_rating,
                array_to_string(list_sort(list(rating)), '|') AS ratings
         FROM liked l
         WHERE NOT EXISTS (SELECT 1 FROM ratings s WHERE s.user_id = l.user_id AND s.movie_id = l.movie_id)
         GROUP BY user_id, movie_id""",
}
