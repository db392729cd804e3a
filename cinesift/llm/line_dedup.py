"""Site-relative line frequency: drop the lines that many pages of one host carry.

For every host the pages that contain a line are divided by the pages of the host; lines
above the ratio are boilerplate there and are dropped from all its pages. Pages of one text
count as one, above and below the line: copies of a document are no evidence that its lines
belong to the site. Only DataFrame functions are used. Lines and texts are told apart by 128-bit
digests; partial counts are combined before the shuffles, which are by host, line *and* text
and then by host and line, so a host with a third of all pages, or a text with a third of all
copies, is no hot key.

On the given tables the frequency of a line among a host's texts is spread as follows: all but a
few hundred lines of a host stand on under 0.5 % of its texts, and the recurring ones (notices,
licences, menus) on 1 to 13 %. ``MAX_RATIO`` is the low end of those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinesift.llm.common import written

MAX_RATIO = 0.01
MIN_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, drop array<binary>)``: the digests of each host's boilerplate lines.

    ``pages(host, text)``; blank lines are never boilerplate. As each text counts a line once,
    a host has at most (mean lines a text) / ``max_ratio`` such lines, however large it is.
    """
    texts = pages.withColumn("page", _digest(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    lines = texts.select(
        "host", "page", F.explode(F.array_distinct(F.transform(
            F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""), _digest))).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= min_pages)
    totals = texts.groupBy("host").agg(F.count_distinct("page").alias("total"))
    return (
        counts.join(totals, "host").where(F.col("n") > max_ratio * F.col("total"))
        .groupBy("host").agg(F.collect_list("line").alias("drop"))
    )


def _split_off(docs: DataFrame, host: str, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """``docs`` with ``__lines`` and ``__kept``, the lines of each text before and after."""
    # a null host, and any value of it, is told apart by its prefix
    key = F.when(F.col(host).isNull(), F.lit("n")).otherwise(F.concat(F.lit("h"), F.col(host).cast("string")))
    found = written(
        boilerplate(docs.select(key.alias("host"), F.col(text).alias("text")), max_ratio, min_pages), "boilerplate")
    marked = docs.withColumn("__host", key).join(
        found.select(F.col("host").alias("__host"), F.col("drop").alias("__drop")), "__host", "left")
    return marked.withColumn("__lines", _lines(F.col(text))).withColumn("__kept", F.when(
        F.col("__drop").isNull(), F.col("__lines")).otherwise(
        F.filter("__lines", lambda x: ~F.array_contains(F.col("__drop"), _digest(x)))))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text",
                     max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, all other columns unchanged.

    A line is dropped if more than ``max_ratio`` of the host's different texts carry it, and at
    least ``min_pages`` of them do (on a host of a few pages a single copy is no evidence). Lines
    are what stands between line feeds, compared exactly; blank lines stay. Rows with a null host
    form one host of their own. A null text stays null (and counts as the empty one) and an empty
    one empty; a text of which all lines go becomes empty. Repeated rows count once and each stay.
    Should the table be empty, so is the result.
    """
    done = _split_off(docs, host, text, max_ratio, min_pages)
    left = F.when(F.col(text).isNotNull(), F.array_join("__kept", "\n")).alias(text)
    return done.select(*(left if c == text else F.col(c) for c in docs.columns))


def line_dedup(docs: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(doc_id, text, n_lines, n_dropped)`` for every row of ``docs``, with ``source`` as host.

    ``n_lines`` counts the lines before, ``n_dropped`` those taken out; a null text has no
    lines, an empty one a single empty line.
    """
    done = _split_off(docs.select("doc_id", "source", "text"), "source", "text", max_ratio, min_pages)
    some = F.col("text").isNotNull()
    return done.select(
        "doc_id",
        F.when(some, F.array_join("__kept", "\n")).alias("text"),
        F.when(some, F.size("__lines")).otherwise(0).cast("long").alias("n_lines"),
        F.when(some, F.size("__lines") - F.size("__kept")).otherwise(0).cast("long").alias("n_dropped"),
    )


ORACLE = f"""
WITH pages AS (SELECT doc_id, coalesce('h' || source, 'n') AS host, text FROM documents),
texts AS (SELECT DISTINCT host, coalesce(text, '') AS text FROM pages),
lines AS (SELECT DISTINCT rid, host, line FROM (
    SELECT row_number() OVER () AS rid, host, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE trim(line) <> ''),
totals AS (SELECT host, count(*) AS total FROM texts GROUP BY host),
bad AS (SELECT l.host, l.line FROM lines l JOIN totals t ON l.host = t.host
  GROUP BY l.host, l.line, t.total HAVING count(*) >= {MIN_PAGES} AND count(*) > {MAX_RATIO} * t.total),
drops AS (SELECT host, list(line) AS gone FROM bad GROUP BY host)
SELECT p.doc_id,
  CASE WHEN p.text IS NULL THEN NULL
    ELSE array_to_string(list_filter(string_split(p.text, chr(10)),
      lambda x: NOT list_contains(coalesce(d.gone, []), x)), chr(10)) END AS text,
  CASE WHEN p.text IS NULL THEN 0 ELSE len(string_split(p.text, chr(10))) END::BIGINT AS n_lines,
  CASE WHEN p.text IS NULL THEN 0 ELSE len(list_filter(string_split(p.text, chr(10)),
      lambda x: list_contains(coalesce(d.gone, []), x))) END::BIGINT AS n_dropped
FROM pages p LEFT JOIN drops d ON p.host = d.host
"""
