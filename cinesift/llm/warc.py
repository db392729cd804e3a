"""WARC archives: writing with revisit records, reading by boundary-chain verification.

*Writing.* A record is one row of Spark's text writer whose line separator is the blank line
that ends every WARC record, so the files are archives as they stand. Of equal payloads the
one with the largest page_id is stored; the others become revisit records.

*Reading.* Archives are read as text cut at every ``CRLF CRLF WARC/1.``, wherever it stands:
each piece is a *candidate* record, found by whichever task holds that part of the file. A
candidate's header names its length, hence the offset of its successor. From the file's
start the chain of successors is followed by pointer jumping; candidates that it does not
reach are magic inside payloads and are dropped, their bytes going to the record that holds
them. Runs of candidates that follow each other without a gap are one node of the chain, so
the number of rounds is the logarithm of the irregular places in a file, not of its records.

Only narrow rows (offsets and header fields) are shuffled; payloads are digested where they
are read, except those that hold the magic themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinesift.llm.common import shared_path, written

RECORDS_PER_FILE = 5_000
MIN_REVISIT_BYTES = 0
# Fixed values of the format.
_BLANK = "\r\n\r\n"
_MAGIC = "WARC/1."
_CUT = _BLANK + _MAGIC
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits at a time are four base32 digits."""
    digest, parts = F.sha1(payload), []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            parts.append(F.substring(F.lit(_BASE32), place, F.lit(1)))
    return F.concat(*parts)


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``(page_id, url, payload, digest, bytes, refers_to)``: ``refers_to`` is set for revisits.

    Payloads are the html, a null one counting as empty. Equal payloads shorter than
    ``min_bytes`` are all stored. Rows that repeat the largest page_id are all stored, and so
    are rows without page_id whose payload no row with one has.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.encode("payload", "UTF-8"))).withColumn(
        "bytes", F.octet_length("payload").cast("long"))
    # payload digests held by several rows; a table of them, so that its size is known to the join
    several = written(
        rows.where(F.col("bytes") >= min_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1 and keeper is not null")
        .select("digest", "keeper"),
        "equal-payloads",
    )
    revisit = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return rows.join(several, "digest", "left").select(
        "page_id", "url", "payload", "digest", "bytes", revisit.alias("refers_to"))


def _id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z",
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write a record per row of ``pages(page_id, url, html)`` to WARC files under ``path``."""
    rows = with_revisits(pages)
    revisit = F.col("refers_to").isNotNull()
    # a line break in a URL would end its header line
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat_ws(
        "\r\n",
        F.lit(_MAGIC + "1"),
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: "), _id(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _id(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {_REVISIT_PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, 0).otherwise(F.col("bytes")).cast("string")),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    rows.select(F.concat(header, F.lit(_BLANK), body).alias("value")).write.option("lineSep", _BLANK).option(
        "maxRecordsPerFile", records_per_file).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between cuts, with the file, the read block and the order within it."""
    return (
        spark.read.option("lineSep", _CUT).text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        .withColumn("seq", F.monotonically_increasing_id())
    )


def _field(name: str) -> Column:
    # (?d): only a line feed ends a line; other line separators of Unicode may stand in a URL
    return F.regexp_extract("head", rf"(?imd)^{name}:[ \t]*([^\r\n]*)", 1)


def _content(value: Column) -> Column:
    """What tells a piece from pieces of other content; equal pieces are interchangeable."""
    return F.unhex(F.sha2(value, 256))


def _part(length: Column) -> Column:
    """A length as far as one string can go."""
    return F.least(length, F.lit(2**31 - 1)).cast("int")


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One narrow row per candidate record: ``start`` and ``next`` offsets in the file, header
    fields, and the digest and length of the payload as far as the candidate's own piece goes.

    A piece without a blank line is all header: what follows its header is the magic of the
    next piece, with which its payload begins (``own`` is then below zero). A header without a
    length has no ``next``.
    """
    at = F.instr("value", _BLANK)
    data = F.col("value").cast("binary")
    number = F.regexp_extract("head", r"(?imd)^Content-Length:[ \t]*([0-9]{1,18})[ \t]*\r?$", 1)
    narrow = (
        _pieces(spark, path)
        .withColumn("head", F.when(at > 0, F.substring_index("value", _BLANK, 1)).otherwise(F.col("value")))
        .withColumn("length", F.when(number != "", number).cast("long"))
        .select(
            "file", "block", "seq",
            F.octet_length("value").cast("long").alias("size"), F.octet_length("head").cast("long").alias("head_size"),
            "length", "head", _content(F.col("value")).alias("content"),
            base32_sha1(F.substring(data, F.octet_length("head") + 5, _part(F.coalesce("length", F.lit(0))))).alias("digest"),
        )
    )
    cut = len(_CUT)
    # offsets: sums over the pieces of a block, then over the blocks of a file
    blocks = narrow.groupBy("file", "block").agg(F.sum(F.col("size") + cut).alias("total"))
    blocks = blocks.withColumn("base", F.sum("total").over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("total"))
    order = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.col("base") + F.sum(F.col("size") + cut).over(order) - F.col("size") - cut
    placed = narrow.join(blocks.select("file", "block", "base"), ["file", "block"]).withColumn("place", place)
    # the magic of the first piece is its own, that of the others belongs to the cut before them
    start = F.when(F.col("place") == 0, F.col("place")).otherwise(F.col("place") - len(_MAGIC))
    body = F.col("place") + F.col("head_size") + len(_BLANK)
    return placed.select(
        "file", "head", "digest", "content", start.alias("start"), body.alias("body"), "length",
        (body + F.col("length") + len(_BLANK)).alias("next"),
        (F.col("size") - F.col("head_size") - len(_BLANK)).alias("own"),
    )


def reachable(found: DataFrame) -> DataFrame:
    """``(file, start)`` of the records on the chain that leads from offset 0 of each file,
    given ``found(file, start, next)``; a candidate without ``next`` ends its chain."""
    order = Window.partitionBy("file").orderBy("start")
    links = found.select("file", "start", "next", F.lead("start").over(order).alias("lead"))
    jumps = links.where("next is not null and not (next <=> lead)").select(
        "file", F.col("next").alias("start"), F.lit(True).alias("landed")).distinct()
    # a run begins where the piece before does not lead, or where some jump lands
    head = F.col("landed").isNotNull() | ~F.lag("next").over(order).eqNullSafe(F.col("start"))
    runs = links.join(jumps, ["file", "start"], "left").withColumn("head", head).withColumn(
        "run", F.max(F.when(F.col("head"), F.col("start"))).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    members = written(runs.select("file", "start", "run", "next"), "chain-members")
    state = members.groupBy("file", "run").agg(F.max_by("next", "start").alias("ptr")).withColumn(
        "reached", F.col("run") == 0)
    while True:
        # a pointer to no run (the end of the file, or a broken length) is no pointer
        heads = state.select("file", F.col("run").alias("ptr"), F.lit(True).alias("known"))
        state = written(state.join(heads, ["file", "ptr"], "left").select(
            "file", "run", F.when(F.col("known"), F.col("ptr")).alias("ptr"), "reached"), "chain")
        if state.where("reached and ptr is not null").isEmpty():
            break
        hit = state.where("reached and ptr is not null").select(
            "file", F.col("ptr").alias("run"), F.lit(True).alias("hit")).distinct()
        far = state.select("file", F.col("run").alias("ptr"), F.col("ptr").alias("far"))
        state = state.join(far, ["file", "ptr"], "left").join(hit, ["file", "run"], "left").select(
            "file", "run", F.col("far").alias("ptr"), (F.col("reached") | F.col("hit").isNotNull()).alias("reached"))
    return members.join(state.where("reached").select("file", "run"), ["file", "run"], "left_semi").select("file", "start")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all WARC files under ``path``: ``file, start, type, page_id, refers_to, url,
    payload_bytes, payload_digest`` (length and digest of the payload as stored in the archive for
    responses, as its header names them for revisits)."""
    found = written(candidates(spark, path), "candidates")
    true = reachable(found.select("file", "start", "next")).withColumn("true", F.lit(True))
    order = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = written(
        found.join(true, ["file", "start"], "left").withColumn(
            "owner", F.max(F.when(F.col("true"), F.col("start"))).over(order)), "marked")
    records = marked.where(F.col("true"))
    # payloads that hold the magic: their pieces are put together again, found by their content in a
    # second read (which may split the files otherwise than the first)
    broken = records.where("length > own").select("file", F.col("start").alias("owner"), "length")
    parts = written(
        marked.join(broken.withColumnRenamed("length", "bytes"), ["file", "owner"])
        .select("file", "owner", "start", "bytes", "content", F.octet_length("head").alias("head_size")),
        "split-payloads")
    wanted = parts.select("content").distinct()
    texts = (
        _pieces(spark, path).select("value", _content(F.col("value")).alias("content")).join(wanted, "content", "left_semi")
        .groupBy("content").agg(F.any_value("value").alias("value"))
    )
    whole = (
        parts.join(texts, "content", "left").groupBy("file", F.col("owner").alias("start")).agg(
            F.array_sort(F.collect_list(F.struct("start", "value"))).alias("pieces"),
            F.max("bytes").alias("bytes"),
            F.max(F.when(F.col("start") == F.col("owner"), F.col("head_size"))).alias("skip"))
        .withColumn("data", F.array_join(F.transform("pieces", lambda x: F.coalesce(x["value"], F.raise_error(
            F.concat(F.lit("a piece of a split payload is missing in "), F.col("file"))).cast("string"))), _CUT).cast("binary"))
        .select("file", "start", base32_sha1(F.substring("data", F.col("skip") + 5, _part(F.col("bytes")))).alias("joined"))
    )
    joined = F.when(F.col("length") <= F.col("own"), F.col("digest")).otherwise(F.col("joined"))
    kind = F.lower(_field("WARC-Type"))
    revisit = kind == "revisit"
    page = F.regexp_extract(_field("WARC-Record-ID"), r"<urn:x-page:(-?[0-9]+)>", 1)
    to = F.regexp_extract(_field("WARC-Refers-To"), r"<urn:x-page:(-?[0-9]+)>", 1)
    number = lambda c: F.when(c != "", c).cast("long")
    return records.join(whole, ["file", "start"], "left").select(
        "file", "start", kind.alias("type"), number(page).alias("page_id"), number(to).alias("refers_to"),
        _field("WARC-Target-URI").alias("url"),
        F.when(revisit, _field("X-Payload-Length").cast("long")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", ""))
        .otherwise(joined).alias("payload_digest"),
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` for every row of
    ``pages(page_id, url, html)``, from archives written to the shared folder and read back.

    A null html is an empty payload, and so equal to other empty ones; a null url has no header
    line, line breaks of a url are escaped; a null page_id stays null. A payload may hold, begin
    or end with the magic, with or without a header behind it. Repeated rows are records of their own. An empty table
    gives archives without records and an empty result; further columns are not read.
    """
    spark = pages.sparkSession
    path = shared_path(spark, "archives")
    write_archives(pages, path)
    return read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT html, max(page_id) AS keeper FROM p GROUP BY html),
h AS (SELECT p.page_id, octet_length(encode(p.html))::BIGINT AS payload_bytes, k.keeper,
    sha1(p.html) AS hex FROM p JOIN k ON p.html = k.html)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
      (('0x' || substr(hex, (1 + 5 * (i // 4))::BIGINT, 5))::BIGINT >> (5 * (3 - i % 4))::BIGINT) & 31)::BIGINT, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM h
"""
