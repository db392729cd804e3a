from cinesift.sources.csv import (
    read_movies,
    read_ratings,
    write_movies_csv,
    write_ratings_csv,
)
from cinesift.sources.tables import (
    customer_ids,
    movies_from_tables,
    ratings_from_tables,
    register_views,
    table,
)

__all__ = [
    "customer_ids",
    "movies_from_tables",
    "ratings_from_tables",
    "read_movies",
    "read_ratings",
    "register_views",
    "table",
    "write_movies_csv",
    "write_ratings_csv",
]
