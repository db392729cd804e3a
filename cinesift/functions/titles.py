"""Column expressions for movie titles: lookup key and release year.

All of these are built-in Catalyst expressions, so they run inside whole-stage
codegen next to the scan; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_key(title: str | Column) -> Column:
    """The title with every comma removed.

    Titles are matched on this key, so a lookup may spell a title either with its
    commas (``American President, The (1995)``) or without them.
    """
    return F.replace(_col(title), F.lit(","), F.lit(""))


def title_year(title: str | Column) -> Column:
    """Release year as a string, read from the digits of the title.

    Rule: take the part of the title after its last comma, keep its digits; no digit
    gives ``'0'`` (unknown year), three digits give only the last one, otherwise the
    last (up to) four digits are the year. ``Heat (1995)`` -> ``1995``,
    ``Room 237`` -> ``7``, ``Untitled`` -> ``0``.

    One regex replacement picks the digits to keep (exactly three digits -> the last;
    four or more -> the last four; one or two match neither alternative and stay), so
    the digit string is computed once per row rather than once per CASE branch.
    """
    digits = F.regexp_replace(F.regexp_extract(_col(title), r"([^,]*)$", 1), r"[^0-9]", "")
    picked = F.regexp_replace(digits, r"^[0-9]{2}([0-9])$|^[0-9]*([0-9]{4})$", "$1$2")
    return F.when(picked == "", F.lit("0")).otherwise(picked)


def normalise_title_key(value: str) -> str:
    """Driver-side twin of :func:`title_key` for a literal lookup value."""
    return value.replace(",", "")
