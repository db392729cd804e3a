"""Archives: round trips, revisits, magic inside payloads, broken chains, many read blocks."""

from __future__ import annotations

import base64
import hashlib

import pytest

from cinesift.llm import warc
from cinesift.llm.common import shared_path

SCHEMA = "page_id long, url string, html string"
NESTED = "before\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\nabc"


def digest(html: str | None) -> str:
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows):
    keeper: dict[str, int | None] = {}
    for i, _, html in rows:
        html = html or ""
        known = keeper.get(html)
        keeper[html] = i if known is None else known if i is None else max(known, i)
    out = []
    for i, _, html in rows:
        k = keeper[html or ""]
        again = k is not None and i != k
        out.append((i, len((html or "").encode()), digest(html), "revisit" if again else "response", k if again else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (9, "http://a/9", "<p>one</p>"), (9, "http://a/9", "<p>one</p>"),
    (3, None, None), (4, "http://b\r\nX: y", ""), (5, "http://c", NESTED), (6, "http://c", NESTED + "\r\n\r\n"), (None, "http://d", "é日本"),
    (7, "http://e", "\r\n\r\nWARC/1.1\r\nContent-Length: 100000\r\n\r\n"), (8, "http://f", "x" * 300_000), (10, "http://g", "\r\n\r\n"),
    (None, "http://h", "<p>one</p>"), (11, "http://i", "WARC/1.1\r\nContent-Length: 2\r\n\r\nab"), (-5, "http://j", "Content-Length: 7"),
]


def run(spark, rows):
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS digest", "2 AS file", "3 AS bytes", "4 AS keeper")
    return sorted((tuple(r) for r in warc.archive_round_trip(pages).collect()), key=str)


def test_round_trip(spark):
    assert run(spark, ROWS) == expected(ROWS)


def test_one_record_a_file_and_small_read_blocks(spark, monkeypatch):
    many = [(i, f"http://x/{i}", f"{i % 7} " + (NESTED if i % 5 == 0 else "text ") * (i % 4)) for i in range(120)]
    monkeypatch.setattr(warc.write_archives, "__defaults__", ("1970-01-01T00:00:00Z", 1))
    assert run(spark, many[:20]) == expected(many[:20])
    monkeypatch.undo()
    for size in ("700", "3000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            assert run(spark, many) == expected(many)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


HEADER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:77>\r\nContent-Length: 2\r\n\r\nab"


MAGIC_PAYLOADS = [
    HEADER, "WARC/1.1\r\nhello", "WARC/1.", "WARC/1.0 Content-Length: x", "\r\n\r\nWARC/1.1\r\nhello", HEADER + "\r\n\r\n" + HEADER,
    "WARC/1.1\r\nContent-Length: 999999999999999999\r\n\r\n", "WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\nWARC/1.1"]


def test_payloads_that_begin_with_the_magic(spark):
    rows, files = [], None
    for n, (payload, at) in enumerate((p, a) for p in MAGIC_PAYLOADS for a in ([0], [3, 6], [0, 1, 2])):
        own = [(1000 * n + i, f"http://p/{i}", f"page {n} {i}") for i in range(6)]
        for k, place in enumerate(at):
            own.insert(place, (1000 * n + 100 + k, "http://m", f"{payload}{n} {k}"))
        rows += own
        one = spark.createDataFrame(own, SCHEMA).coalesce(1)  # a file of its own
        files = one if files is None else files.unionByName(one)
    assert sorted((tuple(r) for r in warc.archive_round_trip(files).collect()), key=str) == expected(rows)


def test_other_line_separators_in_urls_are_no_header_lines(spark):
    rows = [(i, f"http://a{c}Content-Length: 3{c}WARC-Type: revisit", f"0123456789 {i}") for i, c in enumerate("\u2028\u2029\x85\x0b\x0c")]
    assert run(spark, [*rows, (50, "http://b", "behind")]) == expected([*rows, (50, "http://b", "behind")])


def test_missing_pieces_of_a_split_payload_raise(spark, monkeypatch):
    path = shared_path(spark, "missing")
    warc.write_archives(spark.createDataFrame([(1, "u", NESTED), (2, "v", "plain")], SCHEMA), path)
    real, calls = warc._pieces, []

    def pieces(*args):
        calls.append(args)
        return real(*args) if len(calls) == 1 else real(*args).where("value not like '%hello%'")

    monkeypatch.setattr(warc, "_pieces", pieces)
    with pytest.raises(Exception, match="a piece of a split payload is missing"):
        warc.read_archives(spark, path).collect()


def test_copies_of_a_split_payload_in_several_files(spark, monkeypatch):
    rows = [(i, f"http://x/{i}", NESTED + str(i % 3)) for i in range(12)]
    monkeypatch.setattr(warc, "with_revisits", lambda pages, f=warc.with_revisits: f(pages, 10**9))
    monkeypatch.setattr(warc.write_archives, "__defaults__", ("1970-01-01T00:00:00Z", 2))
    assert [r[1:4] for r in run(spark, rows)] == [(len(h), digest(h), "response") for _, _, h in sorted(rows, key=lambda r: str(r[0]))]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_files_are_archives(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.write_archives(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), path)
    records = 0
    for file in sorted((tmp_path / "w").glob("part-*")):
        data, at = file.read_bytes(), 0
        while at < len(data):  # an ordinary sequential reader
            assert data.startswith(b"WARC/1.1\r\n", at)
            end = data.index(b"\r\n\r\n", at)
            length = int([h for h in data[at:end].split(b"\r\n") if h.startswith(b"Content-Length: ")][0][16:])
            assert data[end + 4 + length : end + 8 + length] == b"\r\n\r\n"
            at, records = end + 8 + length, records + 1
    assert records == len(ROWS)


def test_a_broken_length_ends_the_chain(spark, tmp_path):
    good = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{}>\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    (tmp_path / "a.warc").write_bytes((good.format(1, 2, "ab") + good.format(2, 9, "abc") + good.format(3, 2, "cd")).encode())
    (tmp_path / "b.warc").write_bytes(good.format(4, 1, "z").encode())
    got = warc.read_archives(spark, f"file://{tmp_path}").collect()
    assert sorted(r.page_id for r in got) == [1, 2, 4]


@pytest.mark.parametrize("links", [
    [(0, 10), (10, 20), (20, 30)],
    [(0, 30), (10, 20), (20, 30), (30, 40), (35, 40), (40, 70), (50, 60), (60, 70), (70, 80)],
    [(0, None), (10, 20), (20, 30)],
    [(0, 20), (10, 30), (20, 40), (30, 50), (40, 60), (50, 60), (60, 99)],
])
def test_reachable_equals_following_the_chain(spark, links):
    want, at = set(), 0
    known = dict(links)
    while at in known:
        want.add(at)
        at = known[at]
    found = spark.createDataFrame([(f, s, n) for f in ("a", "b") for s, n in links], "file string, start long, next long")
    got = {(r.file, r.start) for r in warc.reachable(found).collect()}
    assert got == {(f, s) for f in ("a", "b") for s in want}


def test_paths_are_never_shared(spark):
    assert shared_path(spark, "x") != shared_path(spark, "x")
