"""cinesift: ratings analytics and neighbour-based recommendation as Spark DataFrame plans.

Inputs are two DataFrames, ``ratings (user_id, movie_id, rating, ts)`` and
``movies (movie_id, title, genres)``; every operator returns a DataFrame and runs as
one Spark job for all users, without driver round-trips or Python UDFs.
"""

from cinesift import functions, operators, sources
from cinesift.session import drop_scratch, ensure_checkpoint_dir, get_session, materialize, scratch_mark, scratch_path

__all__ = [
    "drop_scratch",
    "ensure_checkpoint_dir",
    "functions",
    "get_session",
    "materialize",
    "operators",
    "scratch_mark",
    "scratch_path",
    "sources",
]
