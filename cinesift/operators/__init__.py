from cinesift.operators.activity import (
    movie_watch_counts,
    user_genre_counts,
    user_genre_lists,
    user_genres,
    user_watch_counts,
    user_watched_titles,
    watch_count_by_movie_id,
    watch_count_by_title,
)
from cinesift.operators.catalog import (
    explode_genres,
    genre_movie_counts,
    movies_by_year,
    movies_in_genres,
    movies_in_year,
    select_titles,
    with_title_year,
)
from cinesift.operators.pairs import (
    common_ratings,
    pair_cosine,
    pair_fitted_points,
    pair_linear_fit,
    pair_ols,
    pair_residual_shape,
    pair_sums,
)
from cinesift.operators.neighbours import (
    liked_by_neighbours,
    recommend,
    similar_users,
    with_rating_list,
)
from cinesift.operators.scores import (
    avg_rating_by_movie_id,
    avg_rating_by_title,
    movie_avg_rating,
    movie_avg_rating_titled,
    title_avg_rating,
    top_rated,
    top_watched,
)
from cinesift.operators.taste import (
    favourite_genre,
    taste_cluster_sizes,
    taste_clusters,
    user_genre_profile,
)

__all__ = [
    "avg_rating_by_movie_id",
    "avg_rating_by_title",
    "common_ratings",
    "explode_genres",
    "favourite_genre",
    "genre_movie_counts",
    "liked_by_neighbours",
    "movie_avg_rating",
    "movie_avg_rating_titled",
    "movie_watch_counts",
    "movies_by_year",
    "movies_in_genres",
    "movies_in_year",
    "pair_cosine",
    "pair_fitted_points",
    "pair_linear_fit",
    "pair_ols",
    "pair_residual_shape",
    "pair_sums",
    "recommend",
    "select_titles",
    "similar_users",
    "taste_cluster_sizes",
    "taste_clusters",
    "title_avg_rating",
    "top_rated",
    "top_watched",
    "user_genre_counts",
    "user_genre_lists",
    "user_genre_profile",
    "user_genres",
    "user_watch_counts",
    "user_watched_titles",
    "watch_count_by_movie_id",
    "watch_count_by_title",
    "with_rating_list",
    "with_title_year",
]
