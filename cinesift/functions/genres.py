"""Column expressions for the pipe-separated ``genres`` field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: genres are separated by a vertical bar, e.g. ``Crime|Drama|Mystery``.
GENRE_SEPARATOR = "|"


def genre_array(genres: str | Column) -> Column:
    """``ARRAY<STRING>`` of the genres, in the order written; duplicates are kept.

    An empty string gives ``['']`` and NULL gives NULL.
    """
    c = F.col(genres) if isinstance(genres, str) else genres
    return F.split(c, r"\|")


def sorted_genre_list(genres: Column) -> Column:
    """A bounded array of genre names as one ``|``-joined, sorted string."""
    return F.array_join(F.array_sort(genres), GENRE_SEPARATOR)
