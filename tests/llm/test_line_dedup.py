"""Dropped lines against a brute-force version, and the plan's freedom from Python."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from cinesift.llm import line_dedup


def brute(rows, ratio=line_dedup.MAX_RATIO, least=line_dedup.MIN_PAGES):
    pages, carry = Counter(), defaultdict(Counter)
    for host, text in {(host, text or "") for _, text, host in rows}:  # equal texts count once
        pages[host] += 1
        carry[host].update({x for x in text.split("\n") if x.strip(" ")})
    out = []
    for i, text, host in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if not (carry[host][x] >= least and carry[host][x] > ratio * pages[host])]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def rows_of(rng, n):
    common = [f"menu {i}" for i in range(6)]
    rows = []
    for i in range(n):
        host = rng.choice(["hot", "hot", "hot", "a", "b", None, "", "n", "hhot"])
        lines = [rng.choice(common) if rng.random() < 0.3 else f"line {rng.randrange(n)}" for _ in range(rng.randrange(0, 8))]
        if rng.random() < 0.3:
            lines += ["", "  ", lines[0] if lines else ""]
        rows.append((i, "\n".join(lines), host))
    return rows


def test_rows_equal_brute_force(make_docs):
    rng = random.Random(1)
    rows = rows_of(rng, 400) + [(900, None, "a"), (901, "", "a"), (902, "menu 1", "a"), (902, "menu 1", "a"),
                                (None, "menu 1\nmenu 2\n", "hot"), (903, "x" * 300_000 + "\nmenu 1", "hot"), (904, "\r\nmenu 1\r", "a")]
    got = line_dedup.line_dedup(make_docs(rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_columns_and_rows_stay(make_docs):
    rows = rows_of(random.Random(2), 60)
    docs = make_docs(rows)
    done = line_dedup.drop_boilerplate(docs)
    assert done.columns == docs.columns and done.schema["text"].dataType == docs.schema["text"].dataType
    assert sorted((r.doc_id, r.text) for r in done.collect()) == sorted((r[0], r[1]) for r in brute(rows))


def test_small_hosts_and_copies(make_docs):
    rows = [(i, "same\nother", "tiny") for i in range(4)] + [(10 + i, "foot\nown %d" % i, "five") for i in range(5)]
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.line_dedup(make_docs(rows)).collect()}
    assert got[0] == ("same\nother", 0) and got[12] == ("own 2", 1)


def test_copies_keep_their_text(make_docs):
    rows = [(i, f"first {i}\nsecond {i}\nfooter", "h") for i in range(70)] + [(100 + i, "the copied\ntext\nfooter", "h") for i in range(30)]
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.line_dedup(make_docs(rows)).collect()}
    assert all(got[100 + i] == ("the copied\ntext", 1) for i in range(30))
    assert all(got[i] == (f"first {i}\nsecond {i}", 1) for i in range(70))


def test_recurring_lines_of_the_given_tables_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = line_dedup.line_dedup(docs)
    spread = Counter((r.source, x) for r in docs.dropDuplicates(["source", "text"]).collect() for x in set((r.text or "").split("\n")))
    texts = Counter(s for s, _ in {(r.source, r.text) for r in docs.collect()})
    by_id = {r.doc_id: r for r in docs.collect()}
    for r in found.collect():
        source, lines = by_id[r.doc_id].source, (by_id[r.doc_id].text or "").split("\n")
        kept = set((r.text or "").split("\n"))
        for x in lines:
            often = spread[source, x] >= 5 and spread[source, x] > 0.01 * texts[source] and x.strip(" ") != ""
            assert (x not in kept) == often


def test_empty_table(make_docs):
    assert line_dedup.line_dedup(make_docs([])).collect() == []


def test_no_python_in_the_plan(make_docs):
    plan = line_dedup.line_dedup(make_docs([(1, "a\nb", "h")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
