"""Conversation repair against a forward search over all edits, the DP's parts, cut conversations, SQL."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from cinesift.llm import turns

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 4:
            role = "user"
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out.append((conv, turn, role, text, 0 if draw == 0 else 2 if draw == 3 else 1))
    return out


def brute(rows):
    """One row per conversation of ``(conv_id, turn, role, text, copies)``."""
    by_conv = defaultdict(list)
    for conv, turn, role, text, copies in rows:
        by_conv[conv] += [(turn is not None, turn or 0, role, text)] * copies
    return sorted((conv, *brute_one(sorted(own))) for conv, own in by_conv.items() if conv is not None) + [
        (None, *brute_one(sorted(by_conv[None])))] * (None in by_conv)


def brute_one(rows):
    known = [t for some, t, _, _ in rows if some]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.rstrip(WHITE)
        faults.append("blank" if not bare.strip(WHITE) else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[:1] for _, _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    # (cost, audit, lines) of the cheapest way to each output so far: "", s, ...u or ...a
    best = {"": (0, "", ())}

    def put(table, key, value):
        if key not in table or value[:2] < table[key][:2]:
            table[key] = value

    def following(state):
        return "a" if state == "u" else "u"

    names = {"u": "user", "a": "assistant"}

    def insertions(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                put(table, following(state), (cost + 2, audit + "I", (*lines, names[following(state)] + ":")))
        return table

    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, lines) in insertions(best).items():
            put(after, state, (cost + 3, audit + "D", lines))
            if fault in ("", "truncated"):
                more, to = int(fault == "truncated"), following(state)
                put(after, to, (cost + 2 + more, audit + "R", (*lines, f"{names[to]}:{text}")))
                if role[:1] and (role[:1] == to or role[:1] == "s" and state == ""):
                    put(after, role[:1], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
        best = after
    cost, audit, lines = min(insertions(best)[s][:3] for s in ("", "a") if s in best)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0))


def random_rows(rng, n, convs, turns_most=9):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "User", "u", None]
    texts = ["Yes.", "No!", "what", "so on?", "", " \n", "end. ", "end. x", None, "é…", "two\nlines.", "\x0b\x0c", "\xa0"]
    return [(rng.choice(convs), rng.choice([None, *range(turns_most)]), rng.choice(roles), rng.choice(texts) if rng.random() < .6 else f"t{rng.randrange(40)}.")
            for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS copies", "'f' AS fault", "2 AS piece", "true AS whole", "'s' AS __split")


@pytest.mark.parametrize("seed", range(400))
def test_runs_of_symbols_equal_all_edits(seed):
    rng = random.Random(seed)
    piece = {"roles": [], "texts": [], "copies": [], "faults": [], "turns": []}
    rows = []
    for turn in range(rng.randrange(0, 14)):
        role, text = rng.choice(["user", "user", "assistant", "system", "x"]), rng.choice(["a.", "b.", f"c{turn}.", f"d{turn}", "", " "])
        for _ in range(rng.choice([1, 1, 1, 3])):  # runs of equal symbols
            copies = rng.choice([0, 1, 1, 1, 2])
            text = text + "." if text and text[-1] == "." and rng.random() < .8 else text
            fault = turns._BLANK if not text.strip() else turns._FINE if text[-1] == "." else turns._CUT_OFF
            for column, value in zip(("roles", "texts", "copies", "faults", "turns"), (role, text, copies, fault, turn)):
                piece[column].append(value)
            rows += [(True, turn, role, text)] * copies
    runs, walk = turns._runs(piece), turns.Walk()
    got = walk.take(piece, runs, walk.count(piece, runs), turns.END, True)
    lines = "\n".join(f"{r}:{t}" for r, t in zip(*got["repaired"]))
    # the brute version takes rows of a turn as they come here
    want = brute_one(rows)
    assert (got["gaps"], got["blank"], got["duplicate"], got["truncated"], got["illegal"], got["cost"], got["audit"],
            hashlib.sha256(lines.encode()).hexdigest()) == want
    assert got["cost"] == turns._apply(turns.matrix(runs), turns.END)[0]


def test_powers_equal_repeated_products():
    for symbol in itertools.product(range(4), range(4)):
        one = turns.power(symbol, 0)
        step = turns.END
        for n in range(1, 40):
            step = turns._apply(one, step)
            assert turns.before(symbol, n, turns.END) == step
    assert turns.before((turns._USER, turns._FINE), 10**12, turns.END)[0] == 10**12  # every second one is given the other role


@pytest.mark.parametrize("role", ["user", "system", "x"])
def test_long_runs_unroll(role):
    n = 3000
    rows = [(True, i, role, f"t{i}.") for i in range(n)]
    piece = {"roles": [role] * n, "texts": [r[3] for r in rows], "copies": [1] * n, "faults": [0] * n, "turns": list(range(n))}
    runs, walk = turns._runs(piece), turns.Walk()
    got = walk.take(piece, runs, walk.count(piece, runs), turns.END, True)
    assert len(runs) == 1
    want = brute_one(rows[:30])
    assert (got["cost"], got["audit"][:20]) == (turns._apply(turns.matrix(runs), turns.END)[0], want[6][:20])


def test_rows_equal_brute_force(spark):
    rng = random.Random(4)
    rows = random_rows(rng, 900, [None, *range(120)]) + [(500, None, None, None), (501, 3, "user", "x" * 300_000 + "."), (-7, -(2**40), "user", "a."),
                                                         (-7, 5, "assistant", "b.")] + [(600, 1, "user", "same.")] * 50
    dropped = [(700 + i, 0, "user", "gone") for i in range(200)]  # some of them lose their only row
    got = turns.damage_and_repair(frame(spark, rows + dropped)).collect()
    assert by_id(got) == by_id(brute(brute_damage(rows + dropped)))
    assert any(r.audit == "" and r.cost == 0 for r in got)


@pytest.mark.parametrize("piece_rows", [1, 3, 40])
def test_cut_conversations(spark, piece_rows):
    rng = random.Random(piece_rows)
    rows = random_rows(rng, 500, [1, 1, 1, 1, 2, 3, None], 300) + random_rows(rng, 60, list(range(10, 20)))
    got = turns.damage_and_repair(frame(spark, rows).repartition(5), piece_rows).collect()
    assert by_id(got) == by_id(brute(brute_damage(rows)))
    repaired = turns.repair(turns.damaged(frame(spark, rows)), piece_rows)
    assert repaired.where("not whole").groupBy("conv_id").count().where("count > 1").count() >= 3
    text = [(r.conv_id, x.role) for r in repaired.orderBy("conv_id", "piece").collect() for x in r.repaired]
    for conv in {c for c, _ in text}:
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for c, r in text if c == conv))


def test_empty_table(spark):
    assert turns.damage_and_repair(frame(spark, [])).collect() == []


def test_sql_gives_the_same_rows(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    cursor = con.execute(turns.ORACLE)
    names = [c[0] for c in cursor.description]
    got = turns.damage_and_repair(spark.read.parquet(f"{SF}/conversations.parquet")).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cursor.fetchall())


def test_sql_equals_brute_force():
    rng = random.Random(9)
    rows = random_rows(rng, 400, [None, *range(60)])
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert by_id(con.execute(turns.ORACLE).fetchall()) == by_id(brute(brute_damage(rows)))
