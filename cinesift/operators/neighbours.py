"""Nearest neighbours in taste and recommendations, for all users in one plan.

Two users are neighbours when they share a favourite genre; their distance is the
difference of their favourite-genre scores. Each user gets its ``k`` nearest other
users (ties by neighbour id), and is recommended what those neighbours rated at
least ``min_rating`` and the user has not rated.

kNN without a self-join
-----------------------
Pairing all users of a genre is quadratic, and one genre may hold a third of all
users. The distance is one-dimensional, so a small candidate set is exact:

1. per ``(genre, score)`` keep the ``k + 1`` lowest user ids (a WindowGroupLimit
   that runs before the shuffle; ``k + 1`` because one of them may be the user);
2. one row per distinct ``(genre, score)`` with that id array (<= k + 1 ids);
3. for every distinct score, the ``k`` distinct scores on either side (by score
   order, within the genre) and their id arrays: <= (2k + 1)(k + 1) candidates. The
   distinct scores are range-partitioned, so no task ever holds a whole genre
   (see :func:`_score_neighbourhoods`);
4. they are sorted by ``(|diff|, id)`` once per distinct score and cut to ``k + 1``; users are
   equi-joined to their own ``(genre, score)`` row, drop themselves and keep the first ``k``.

Any user left out is preceded by at least ``k`` others: either ``k`` distinct scores
lie strictly closer on its side, or ``k + 1`` equally distant users have lower ids.

Every step is partitioned by a key finer than the genre, so a
genre holding a third of all users (and, with continuous ratings, nearly as many
distinct scores) is still spread over all tasks. The ``(genre, score)`` join of
step 4 can be skewed (many users share a score); AQE either broadcasts the
distinct-score side after measuring it or splits the skewed partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinesift.functions.keys import Keys, restrict
from cinesift.operators.taste import FAV_SCORE_DIVISOR, favourite_genre

# Fixed values of the reference recommender: three neighbours, ratings of 4.0 and up.
DEFAULT_K = 3
DEFAULT_MIN_RATING = 4.0


def similar_users(ratings: DataFrame, movies: DataFrame, users: Keys = None, k: int = DEFAULT_K) -> DataFrame:
    """``(user_id, neighbour_id, genre, distance, rank)``: up to ``k`` rows per user.

    ``users`` selects whose neighbours are returned; neighbours come from all users.
    A user alone in its genre has no row; one with fewer than ``k`` genre-mates has fewer.
    """
    k = int(k)
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    # Both branches below read ``fav``. Stating the not-null user filter (which the
    # self-exclusion predicate would otherwise infer for one branch only) keeps the
    # two subplans identical, so Spark computes the favourite genres once and
    # reuses that exchange.
    fav = (
        favourite_genre(ratings, movies)
        .where(F.col("user_id").isNotNull())
        .select("user_id", "genre", "rating_sum")
    )

    slot = Window.partitionBy("genre", "rating_sum").orderBy("user_id")
    per_score = (
        fav.withColumn("_slot", F.row_number().over(slot))
        .where(F.col("_slot") <= k + 1)
        .groupBy("genre", "rating_sum")
        .agg(F.array_sort(F.collect_list("user_id")).alias("ids"))
    )

    # All users of one (genre, score) see the same candidates in the same order, so they are
    # sorted once per score; k + 1 are enough, as the user itself is one of them at most.
    order = F.flatten(F.transform("cands", lambda c: F.transform(
        c["n_ids"], lambda i: F.struct(F.abs(F.col("rating_sum") - c["n_sum"]).alias("diff"), i.alias("id")))))
    nearby = _score_neighbourhoods(per_score, k).select(
        "genre", "rating_sum", F.slice(F.array_sort(order), 1, k + 1).alias("cands"))

    targets = restrict(fav, "user_id", users)
    joined = targets.join(nearby, on=["genre", "rating_sum"], how="inner")
    nearest = F.slice(F.filter("cands", lambda c: c["id"] != F.col("user_id")), 1, k)
    return joined.select("user_id", "genre", F.posexplode(nearest).alias("pos", "near")).select(
        "user_id",
        F.col("near.id").alias("neighbour_id"),
        "genre",
        (F.col("near.diff") / FAV_SCORE_DIVISOR).alias("distance"),
        (F.col("pos") + 1).cast("bigint").alias("rank"),
    )


def _score_neighbourhoods(per_score: DataFrame, k: int) -> DataFrame:
    """``(genre, rating_sum, cands)``: for every distinct score of a genre, the ``k``
    distinct scores on either side and its own, each as ``(n_sum, n_ids)``.

    A window partitioned by genre alone would sort all distinct scores of a genre in
    one task. Instead the distinct scores are range-partitioned on
    ``(genre, rating_sum)`` (balanced by sampling, whatever the score distribution),
    and each partition's first ``k`` and last ``k`` scores of a genre are copied, as
    "ghost" rows, to the ``k`` partitions before and after it. One window over
    ``(genre, target partition)`` in score order then gives every real row its
    ``k`` predecessors and successors, wherever they live.

    Exactness rests on one property of range partitioning over distinct keys: every
    partition but the last holds its own bound key, so the partitions holding a
    genre's scores are consecutive. The ``k`` nearest scores on one side therefore
    lie in the row's own partition or in the edge rows of the ``k`` partitions next
    to it. Everything flows through one lineage (no branch joined back on partition
    ids), so the result does not depend on Spark reusing an exchange.
    """
    entry = F.struct(F.col("rating_sum").alias("n_sum"), F.col("ids").alias("n_ids"))
    ranged = per_score.repartitionByRange("genre", "rating_sum").withColumn("_part", F.spark_partition_id())

    in_part = Window.partitionBy("genre", "_part")
    placed = ranged.select(
        "genre",
        "rating_sum",
        "ids",
        "_part",
        F.row_number().over(in_part.orderBy("rating_sum")).alias("_pos"),
        F.count(F.lit(1)).over(in_part).alias("_size"),
    )

    none = F.array().cast("array<int>")
    offsets = F.concat(
        F.array(F.lit(0)),
        F.when(F.col("_pos") <= k, F.array(*[F.lit(-j) for j in range(1, k + 1)])).otherwise(none),
        F.when(F.col("_pos") > F.col("_size") - k, F.array(*[F.lit(j) for j in range(1, k + 1)])).otherwise(none),
    )
    routed = placed.select("genre", "rating_sum", "ids", "_part", F.explode(offsets).alias("_off"))
    routed = routed.withColumn("_target", F.col("_part") + F.col("_off"))

    around = Window.partitionBy("genre", "_target").orderBy("rating_sum").rowsBetween(-k, k)
    windowed = routed.select(
        "genre",
        "rating_sum",
        (F.col("_off") == 0).alias("_real"),
        F.collect_list(entry).over(around).alias("cands"),
    )
    return windowed.where(F.col("_real")).select("genre", "rating_sum", "cands")


def liked_by_neighbours(
    ratings: DataFrame,
    movies: DataFrame,
    users: Keys = None,
    k: int = DEFAULT_K,
    min_rating: float = DEFAULT_MIN_RATING,
    neighbours: DataFrame | None = None,
) -> DataFrame:
    """``(user_id, neighbour_id, movie_id, rating)``: neighbours' ratings >= ``min_rating``.

    ``neighbours`` may be a precomputed (e.g. materialized) :func:`similar_users`
    table; otherwise it is computed here with ``users`` and ``k``.
    """
    if neighbours is None:
        neighbours = similar_users(ratings, movies, users, k)
    else:
        neighbours = restrict(neighbours, "user_id", users)
    neighbours = neighbours.select("user_id", "neighbour_id")
    liked = ratings.where(F.col("rating") >= F.lit(float(min_rating))).select(
        F.col("user_id").alias("neighbour_id"), "movie_id", "rating"
    )
    return neighbours.join(liked, on="neighbour_id", how="inner").select(
        "user_id", "neighbour_id", "movie_id", "rating"
    )


def recommend(
    ratings: DataFrame,
    movies: DataFrame,
    users: Keys = None,
    k: int = DEFAULT_K,
    min_rating: float = DEFAULT_MIN_RATING,
    neighbours: DataFrame | None = None,
) -> DataFrame:
    """``(user_id, movie_id, n_votes, avg_rating, rating_counts)`` for every selected user.

    Ratings go out once: a user counts as a neighbour of its own (``own``), so one join brings the
    neighbours' ratings and what the user has rated, and one aggregate per ``(user, movie)``
    drops the movies that hold an own rating. Before that, ratings are counted per value (a
    partial aggregate, so even a pathological pile of repeated ratings shrinks before the
    shuffle); ``rating_counts`` is a sorted array of ``(rating, n)`` structs: its length is bounded
    by the number of distinct rating values, never by the number of rating rows.
    :func:`with_rating_list` expands it into the flat list of ratings the reference prints.

    The ratings are dealt out evenly once (by no key, so no hot one), with the same columns and
    filters for both uses (favourite genres and liked movies), so that Spark reuses that exchange
    and whatever the ratings are computed from is computed once, without a written table.
    Ratings without a user or a movie take no part.
    """
    ratings = ratings.select("user_id", "movie_id", "rating").where(
        F.col("user_id").isNotNull() & F.col("movie_id").isNotNull()).hint("rebalance")
    if neighbours is None:
        neighbours = similar_users(ratings, movies, users, k)
    else:
        neighbours = restrict(neighbours, "user_id", users)
    told_by = F.struct(F.col("neighbour_id").alias("id"), F.lit(False).alias("own"))
    own = F.struct(F.col("user_id").alias("id"), F.lit(True).alias("own"))
    # a user is its own rater once, beside its first neighbour
    first = F.col("rank") == 1 if "rank" in neighbours.columns else F.lit(True)
    rater = F.explode(F.when(first, F.array(told_by, own)).otherwise(F.array(told_by)))
    near = neighbours.select("user_id", rater.alias("rater")).select(
        "user_id", F.col("rater.id").alias("rater_id"), F.col("rater.own").alias("own"))
    rated = ratings.select(F.col("user_id").alias("rater_id"), "movie_id", "rating")
    told = near.join(rated, "rater_id").where(F.col("own") | (F.col("rating") >= F.lit(float(min_rating))))
    # the join multiplies ratings by the users that hear of them, so they are dealt out again
    votes = told.withColumn("vote", F.when(~F.col("own"), F.col("rating"))).select(
        "user_id", "movie_id", "vote", "own", F.hash("user_id", "movie_id").alias("_deal")).hint("rebalance", "_deal")
    per_value = votes.groupBy("user_id", "movie_id", "vote").agg(
        F.count("vote").alias("n"), F.max("own").alias("own"))
    per_movie = per_value.groupBy("user_id", "movie_id").agg(
        F.max("own").alias("own"),
        F.sum("n").alias("n_votes"),
        (F.sum(F.col("vote") * F.col("n")) / F.nullif(F.sum("n"), F.lit(0))).alias("avg_rating"),
        F.array_sort(F.collect_list(F.when(F.col("vote").isNotNull(), F.struct(F.col("vote").alias("rating"), "n")))).alias("rating_counts"),
    )
    return per_movie.where(~F.col("own")).drop("own")


def with_rating_list(recommendations: DataFrame) -> DataFrame:
    """Add ``ratings``: the neighbours' ratings as one sorted flat array (``n_votes`` long)."""
    expanded = F.flatten(F.transform("rating_counts", lambda c: F.array_repeat(c["rating"], c["n"].cast("int"))))
    return recommendations.withColumn("ratings", expanded)
