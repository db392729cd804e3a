"""Conversation structure repair: cheapest edits to the order system? (user assistant)+, by a run-length DP.

A conversation's rows, in order of turn, become symbols: the class of the role and the fault of
the row. Each symbol has a min-plus matrix over the four states of the wanted order (nothing
yet, after system, after user, after assistant) that holds the cheapest way to take a row of that
kind, insertions before it included. Equal consecutive symbols are one *run*, and a run is
advanced by the binary powers of its matrix, which each worker computes once per symbol and
exponent. The costs to go at the ends of the runs then let the choices be unrolled from the
front, the least letter first, which gives the ASCII-least audit among the cheapest.

Rows are range-partitioned by conversation and turn (and a random number, so that repeated rows
are no hot key) and cut into *pieces* of at most ``PIECE_ROWS``. Nearly all conversations are one
piece and are solved where they lie. One that is cut, at a partition's edge or by its size, is
put together from its pieces' 4x4 matrices: a sweep from the back over those gives each piece its
costs to go, a sweep from the front unrolls it. Both stream, holding one piece at a time; only
what is one value by contract (audit and digest of a conversation) is made by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinesift.llm.common import shipped, small_batches, written

PIECE_ROWS = 4_096
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
_WHITE = " \t\n\x0b\x0c\r"
_ENDS = ".!?"
# States: nothing yet, after system, after user, after assistant.
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLES = (None, "system", "user", "assistant")
_FAR = 1 << 60
_CLASSES = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}
_FINE, _CUT_OFF, _BLANK, _AGAIN = range(4)
_LEGAL = {(_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER)}
Matrix = tuple[tuple[int, ...], ...]
Costs = tuple[int, ...]


# --- the DP ---------------------------------------------------------------------------------

def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def _apply(a: Matrix, costs: Costs) -> Costs:
    return tuple(min(min(row[k] + costs[k] for k in range(4)), _FAR) for row in a)


def _kept(state: int, role: int) -> int | None:
    """The state behind a row kept as it is, if it may stand there."""
    if role == _SYSTEM:
        return _SYSTEM if state == _EMPTY else None
    return role if role and _NEXT[state] == role else None


_IDENTITY: Matrix = tuple(tuple(0 if i == j else _FAR for j in range(4)) for i in range(4))
_ONE_INSERTED: Matrix = tuple(tuple(0 if i == j else INSERT if _NEXT[i] == j else _FAR for j in range(4)) for i in range(4))
_INSERTED = _times(_ONE_INSERTED, _ONE_INSERTED)  # two insertions lead from any state to any that can be reached
#: Costs to go behind the last row: complete the last pair.
END: Costs = _apply(_INSERTED, (0, _FAR, _FAR, 0))


@lru_cache(maxsize=None)
def power(symbol: tuple[int, int], exponent: int) -> Matrix:
    """The matrix of ``2**exponent`` rows of one symbol ``(role class, fault)``."""
    if exponent:
        half = power(symbol, exponent - 1)
        return _times(half, half)
    role, fault = symbol
    taken = [[_FAR] * 4 for _ in range(4)]
    for state in range(4):
        taken[state][state] = DELETE
        if fault in (_FINE, _CUT_OFF):
            more = TRUNCATED * (fault == _CUT_OFF)
            taken[state][_NEXT[state]] = min(taken[state][_NEXT[state]], REROLE + more)
            kept = _kept(state, role)
            if kept is not None:
                taken[state][kept] = min(taken[state][kept], more)
    return _times(_INSERTED, tuple(map(tuple, taken)))


def _bits(n: int) -> Iterator[int]:
    exponent = 0
    while n:
        if n & 1:
            yield exponent
        n, exponent = n >> 1, exponent + 1


def before(symbol: tuple[int, int], length: int, costs: Costs) -> Costs:
    """The costs to go before a run, from those behind it."""
    for exponent in _bits(length):
        costs = _apply(power(symbol, exponent), costs)
    return costs


def matrix(runs: list) -> Matrix:
    """The product of all runs of a piece."""
    out = _IDENTITY
    for symbol, length, _ in runs:
        for exponent in _bits(length):
            out = _times(out, power(symbol, exponent))
    return tuple(tuple(min(x, _FAR) for x in row) for row in out)


def _insertion(state: int, costs: Costs) -> bool:
    return INSERT + costs[_NEXT[state]] == costs[state]


def _unroll(symbol: tuple[int, int], length: int, costs: Costs, state: int, out: list[tuple[str, int]]) -> int:
    """Append the choices ``(letter, state behind it)`` for a run and return the state behind it;
    ``costs`` are those behind the run. Long runs are halved, so few costs are held at once."""
    role, fault = symbol
    if fault in (_BLANK, _AGAIN):  # deletions commute with insertions and come first
        out.extend([("D", state)] * length)
        return state
    if length > 16:
        exponent = (length - 1).bit_length() - 1
        tail = 1 << exponent
        state = _unroll(symbol, length - tail, _apply(power(symbol, exponent), costs), state, out)
        return _unroll(symbol, tail, costs, state, out)
    ahead = [costs]
    for _ in range(length):
        ahead.append(_apply(power(symbol, 0), ahead[-1]))
    more = TRUNCATED * (fault == _CUT_OFF)
    for here, then in zip(ahead[:0:-1], ahead[-2::-1]):
        while here[state] != DELETE + then[state] and _insertion(state, here):
            state = _NEXT[state]
            out.append(("I", state))
        if here[state] == DELETE + then[state]:
            out.append(("D", state))
            continue
        kept = _kept(state, role)
        if kept is not None and here[state] == more + then[kept]:
            state = kept
            out.append(("K", state))
        else:
            state = _NEXT[state]
            out.append(("R", state))
    return state


class Walk:
    """The front sweep over the pieces of one conversation."""

    def __init__(self) -> None:
        self.state = _EMPTY
        self.role: int | None = None  # class of the last row
        self.turn: int | None = None

    def take(self, piece: dict, runs: list, counts: dict, after: Costs, last: bool) -> dict:
        """The piece's share of the counts, its audit and its repaired rows."""
        ahead = [after]
        for symbol, length, _ in reversed(runs):
            ahead.append(before(symbol, length, ahead[-1]))
        start = ahead[-1][self.state]
        audit: list[str] = []
        roles: list[str] = []
        texts: list[str] = []
        for (symbol, length, rows), costs in zip(runs, ahead[-2::-1]):
            out: list[tuple[str, int]] = []
            self.state = _unroll(symbol, length, costs, self.state, out)
            row = iter(rows)
            for letter, state in out:
                at = None if letter == "I" or not rows else next(row)
                if letter != "D":
                    roles.append(piece["roles"][at] if letter == "K" else _ROLES[state])
                    texts.append("" if at is None else piece["texts"][at])
                audit.append(letter)
        cost = start - after[self.state]
        while last and _insertion(self.state, END):
            self.state = _NEXT[self.state]
            cost += INSERT
            audit.append("I")
            roles.append(_ROLES[self.state])
            texts.append("")
        return counts | {"cost": cost, "audit": "".join(audit), "repaired": (roles, texts)}

    def count(self, piece: dict, runs: list) -> dict:
        """The piece's share of the counts of faults, of illegal neighbours and of missing turns."""
        n = [0] * 4
        illegal = 0
        for (role, fault), length, _ in runs:
            n[fault] += length
            if self.role is not None and (self.role, role) not in _LEGAL:
                illegal += 1
            illegal += length - 1  # a role beside itself
            self.role = role
        gaps = 0
        for turn, copies in zip(piece["turns"], piece["copies"]):
            if copies and turn is not None and turn != self.turn:
                gaps += 0 if self.turn is None else turn - self.turn - 1
                self.turn = turn
        return {"gaps": gaps, "blank": n[_BLANK], "duplicate": n[_AGAIN], "truncated": n[_CUT_OFF], "illegal": illegal}


def _runs(piece: dict, firsts: set[int] | None = None) -> list:
    """``[symbol, length, rows]`` of each run; ``rows`` are empty where all rows must go. The rows in
    ``firsts`` are the first of their role and text; if None, the piece itself tells."""
    runs: list = []
    seen: set[tuple[str, str]] = set()

    def add(symbol: tuple[int, int], length: int, rows: list[int]) -> None:
        if runs and runs[-1][0] == symbol:
            runs[-1][1] += length
            runs[-1][2] += rows
        else:
            runs.append([symbol, length, rows])

    for i, (role, text, copies, fault) in enumerate(zip(piece["roles"], piece["texts"], piece["copies"], piece["faults"])):
        if not copies:
            continue
        kind = _CLASSES.get(role[:1], 0)
        if fault == _BLANK:
            add((kind, _BLANK), copies, [])
            continue
        if (role, text) not in seen if firsts is None else i in firsts:
            seen.add((role, text))
            add((kind, fault), 1, [i])
            copies -= 1
        if copies:
            add((kind, _AGAIN), copies, [])
    return runs


# --- on Spark -------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: rows with planted faults, drawn by a checksum of
    ``conv_id:turn``. ``copies`` says how often a row occurs: 0 dropped, 2 repeated. Nulls in role
    and text are one space, as are those of conv_id and turn in the checksum."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    draw = F.crc32(F.encode(key, "UTF-8")) % 20
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(draw == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(draw == 1, F.lit("")).when(draw == 2, F.translate(text, _ENDS, "")).otherwise(text).alias("text"),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).alias("copies"),
    )


_LISTS = ("turns", "roles", "texts", "copies", "faults")
_PIECES = ("conv_id long, piece long, whole boolean, turns array<long>, roles array<string>, texts array<string>, "
           "copies array<int>, faults array<int>")
_REPAIRED = ("conv_id long, piece long, whole boolean, gaps long, blank long, duplicate long, truncated long, illegal long, "
             "cost long, audit string, repaired array<struct<role:string,text:string>>")
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _faults(text: Column) -> Column:
    bare = F.rtrim(text, F.lit(_WHITE))
    return F.when(bare == "", _BLANK).when(F.substring(bare, -1, 1).isin(*_ENDS), _FINE).otherwise(_CUT_OFF)


def pieces_of(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Rows ``(conv_id, turn, role, text, copies)`` as pieces in order: one row per conversation, or
    several with ascending ``piece``; ``whole`` if it is surely all of its conversation."""
    keys = ["conv_id", "turn", "__role", "__text", "__hash", "__split"]
    ordered = (
        rows.withColumn("fault", _faults(F.col("text")))
        .withColumns({"__role": F.substring("role", 1, 32), "__text": F.substring("text", 1, 64),
                      "__hash": F.xxhash64("role", "text"), "__split": F.rand(3)})
        .repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "turn", "role", "text", "copies", "fault")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        left: pa.Table | None = None
        open_before = True  # the first conversation may have begun in the partition before

        def out(table: pa.Table, segments: list[tuple[int, int, bool]]) -> pa.RecordBatch:
            nonlocal number
            # segments follow each other without gaps
            low = segments[0][0]
            offsets = pa.array([i - low for i, _, _ in segments] + [segments[-1][1] - low], pa.int32())
            part = table.slice(low, segments[-1][1] - low)
            columns = [part.column(c).combine_chunks() for c in range(6)]
            names = pa.array(range(number, number + len(segments)), pa.int64())
            number += len(segments)
            return pa.RecordBatch.from_arrays(
                [columns[0].take(offsets[:-1]), names, pa.array([w for _, _, w in segments]),
                 *(pa.ListArray.from_arrays(offsets, c) for c in columns[1:])],
                ["conv_id", "piece", "whole", *_LISTS])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*(left.to_batches() if left is not None else []), batch])
            ids = table.column(0).combine_chunks()
            plain, null = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero((np.diff(plain) != 0) | (np.diff(null.astype(np.int8)) != 0)) + 1).tolist()]
            segments: list[tuple[int, int, bool]] = []
            for i, j in zip(starts, starts[1:]):
                whole = not open_before and j - i <= piece_rows
                segments += [(k, min(k + piece_rows, j), whole) for k in range(i, j, piece_rows)]
                open_before = False
            # of the last conversation only full pieces, of which more rows may follow
            i = starts[-1]
            full = (table.num_rows - i) // piece_rows * piece_rows
            segments += [(k, k + piece_rows, False) for k in range(i, i + full, piece_rows)]
            open_before = open_before or full > 0
            if segments:
                yield out(table, segments)
            left = table.slice(i + full)
        if left is not None and left.num_rows:
            yield out(left, [(0, left.num_rows, False)])

    return written(shipped(ordered).mapInArrow(run, _PIECES), "pieces")


def _as_dicts(batch: pa.RecordBatch) -> Iterator[dict]:
    for start in range(0, batch.num_rows, 64):
        yield from batch.slice(start, 64).to_pylist()


def _repaired(rows: list[dict]) -> pa.RecordBatch:
    ends = np.cumsum([0, *(len(r["repaired"][0]) for r in rows)]).astype(np.int32)
    lines = pa.StructArray.from_arrays(
        [pa.array([x for r in rows for x in r["repaired"][i]], pa.string()) for i in (0, 1)], ["role", "text"])
    return pa.RecordBatch.from_arrays(
        [pa.array([r["conv_id"] for r in rows], pa.int64()), pa.array([r["piece"] for r in rows], pa.int64()),
         pa.array([r["whole"] for r in rows], pa.bool_()), *(pa.array([r[c] for r in rows], pa.int64()) for c in _COUNTS),
         pa.array([r["audit"] for r in rows], pa.string()), pa.ListArray.from_arrays(pa.array(ends), lines)],
        ["conv_id", "piece", "whole", *_COUNTS, "audit", "repaired"])


def _solve_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in small_batches(batches, 256):
        out = []
        for piece in _as_dicts(part):
            runs, walk = _runs(piece), Walk()
            out.append({k: piece[k] for k in ("conv_id", "piece", "whole")} | walk.take(
                piece, runs, walk.count(piece, runs), END, True))
        yield _repaired(out)


def _solve_cut(pieces: DataFrame) -> DataFrame:
    """The pieces of conversations that have, or may have, several."""
    lines = pieces.select("conv_id", "piece", F.posexplode(F.arrays_zip("roles", "texts", "copies", "faults")).alias("pos", "row"))
    digest = F.sha2(F.concat(F.length("row.roles").cast("string"), F.lit(":"), "row.roles", "row.texts"), 256)
    firsts = written(
        lines.where((F.col("row.copies") > 0) & (F.col("row.faults") != _BLANK))
        .groupBy("conv_id", digest.alias("digest")).agg(F.min(F.struct("piece", "pos")).alias("first"))
        .groupBy(F.col("first.piece").alias("piece")).agg(F.collect_list("first.pos").alias("firsts")),
        "firsts")
    known = shipped(pieces.join(firsts, "piece", "left").select(*pieces.columns, "firsts"))

    def runs_of(piece: dict) -> list:
        return _runs(piece, set(piece["firsts"] or ()))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _as_dicts(batch):
                flat = [x for row in matrix(runs_of(piece)) for x in row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([piece["conv_id"]], pa.int64()), pa.array([piece["piece"]], pa.int64()),
                     pa.array([flat], pa.list_(pa.int64()))], ["conv_id", "piece", "matrix"])

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: tuple | None = None
        costs = END
        for batch in batches:
            afters, lasts = [], []
            for conv_id, flat in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                lasts.append(conv != (conv_id,))
                if lasts[-1]:
                    conv, costs = (conv_id,), END
                afters.append(costs)
                costs = _apply(tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4)), costs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(afters, pa.list_(pa.int64())), pa.array(lasts, pa.bool_())], ["piece", "after", "last"])

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk()
        for batch in batches:
            for piece in _as_dicts(batch):
                runs = runs_of(piece)
                yield _repaired([{k: piece[k] for k in ("conv_id", "piece", "whole")} | walk.take(
                    piece, runs, walk.count(piece, runs), tuple(piece["after"]), piece["last"])])
                if piece["last"]:
                    walk = Walk()

    narrow = known.mapInArrow(matrices, "conv_id long, piece long, matrix array<long>")
    after = written(
        narrow.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("piece"))
        .mapInArrow(backward, "piece long, after array<long>, last boolean"), "costs-to-go")
    return known.join(after, "piece").repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(forward, _REPAIRED)


def _parts(rows: DataFrame, piece_rows: int) -> tuple[DataFrame, DataFrame]:
    """The repaired pieces that are whole conversations, and the others."""
    pieces = pieces_of(rows, piece_rows)
    return shipped(pieces.where("whole")).mapInArrow(_solve_whole, _REPAIRED), _solve_cut(pieces.where("not whole"))


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The repaired conversations of ``rows(conv_id, turn, role, text, copies)`` (as from
    :func:`damaged`), one row per piece: ``(conv_id, piece, whole, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired array<struct<role, text>>)``, the counts being the piece's share.

    Rows come by turn (nulls first); those of one turn by role, then text (the first 32 and 64
    characters of them, then a hash). A row whose role does not begin with s, u or a (an empty one
    included) can be given another role or be deleted, not kept. A conversation all of whose rows
    have 0 copies has an empty audit and no repaired rows; null conv_ids are one conversation.
    An empty table gives an empty result.
    """
    whole, cut = _parts(rows, piece_rows)
    return whole.unionByName(cut)


def _summed(whole: DataFrame) -> DataFrame:
    line = F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    return whole.select("conv_id", *_COUNTS, "audit", F.sha2(F.array_join(line, "\n"), 256).alias("repaired_sha256"))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of conversation and place -> one row per conversation."""
    conv: tuple | None = None
    counts, audit, digest, begun = [0] * len(_COUNTS), [], hashlib.sha256(), False

    def out() -> pa.RecordBatch:
        values = [conv[0], *counts, "".join(audit), digest.hexdigest()]
        kinds = [pa.int64()] * (1 + len(_COUNTS)) + [pa.string()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds)], ["conv_id", *_COUNTS, "audit", "repaired_sha256"])

    for batch in batches:
        for row in _as_dicts(batch):
            if conv != (row["conv_id"],):
                if conv is not None:
                    yield out()
                conv = (row["conv_id"],)
                counts, audit, digest, begun = [0] * len(_COUNTS), [], hashlib.sha256(), False
            counts = [a + row[c] for a, c in zip(counts, _COUNTS)]
            audit.append(row["audit"])
            for x in row["repaired"]:
                digest.update((b"\n" if begun else b"") + f"{x['role']}:{x['text']}".encode())
                begun = True
    if conv is not None:
        yield out()


def damage_and_repair(conversations: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of the
    repaired :func:`damaged` rows, for every conv_id of ``conversations``; further columns are not
    read. Where a conversation is in several pieces, one task digests them one after another."""
    whole, cut = _parts(damaged(conversations), piece_rows)
    schema = "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    folded = shipped(cut).repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(_fold, schema)
    return _summed(whole).unionByName(folded)


def _oracle() -> str:
    """DuckDB SQL for the same rows: a fold over each conversation's rows that carries, for every
    state of the wanted order, the least (cost, audit)."""
    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def more(of: str, cost: str, letter: str) -> str:
        return f"{{'c': {of}.c + {cost}, 'a': {of}.a || '{letter}'}}"

    def inserted(of: str) -> str:
        user = least(f"{of}.u", *(more(f"{of}.{q}", str(INSERT), "I") for q in "esa"))
        return f"{{'e': {of}.e, 's': {of}.s, 'u': {user}, 'a': {least(f'{of}.a', more(f'({user})', str(INSERT), 'I'))}}}"

    def taken(of: str) -> str:
        none = "{'c': 1000000000, 'a': ''}"
        kept = lambda q, initial: f"CASE WHEN r.i = '{initial}' AND r.f < 2 THEN {more(f'{of}.{q}', 'r.f', 'K')} ELSE {none} END"
        given = lambda q: f"CASE WHEN r.f < 2 THEN {more(f'{of}.{q}', f'{REROLE} + r.f', 'R')} ELSE {none} END"
        gone = lambda q: more(f"{of}.{q}", str(DELETE), "D")
        return (f"{{'e': {gone('e')}, 's': {least(gone('s'), kept('e', 's'))}, "
                f"'u': {least(gone('u'), *(f(q, *x) for q in 'esa' for f, x in ((kept, 'u'), (given, ''))))}, "
                f"'a': {least(gone('a'), kept('u', 'a'), given('u'))}}}")

    start = "{" + ", ".join(f"'{q}': {{'c': {0 if q == 'e' else 10**9}::BIGINT, 'a': ''}}" for q in "esua") + "}"
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH steps AS (SELECT b, list_reduce(range(1, 9), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) AS crc
  FROM range(256) t(b)),
by_byte AS (SELECT list(crc ORDER BY b) AS of_byte FROM steps),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT) AS bytes
  FROM conversations),
drawn AS (SELECT *, xor(list_reduce(bytes, lambda c, x: xor(c // 256, of_byte[1 + xor(c % 256, x)]), 4294967295), 4294967295) % 20 AS draw
  FROM keyed, by_byte),
damaged AS (SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
  CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE draw WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM drawn),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
  rtrim(text, {white}) AS bare, left(role, 1) AS i FROM damaged),
judged AS (SELECT *, CASE WHEN bare = '' THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 3
  WHEN right(bare, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS f,
  lag(i) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM placed),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 2) AS blank,
  count(*) FILTER (f = 3) AS duplicate, count(*) FILTER (f = 1) AS truncated,
  count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal,
  list({{'i': i, 'f': f}} ORDER BY n) AS rows FROM judged GROUP BY conv_id),
walked AS (SELECT * EXCLUDE (rows), list_reduce(rows, lambda q, r: list_transform([{{'t': {taken('q')}}}], lambda z: {inserted('z.t')})[1],
  {inserted(start)}) AS q FROM counts),
best AS (SELECT * EXCLUDE (q), {least('q.e', 'q.a')} AS b FROM walked),
letters AS (SELECT conv_id, unnest(string_split(b.a, '')) AS letter, generate_subscripts(string_split(b.a, ''), 1) AS pos FROM best WHERE b.a <> ''),
matched AS (SELECT *, sum(CASE WHEN letter <> 'I' THEN 1 END) OVER w AS n, count(CASE WHEN letter <> 'D' THEN 1 END) OVER w AS place
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
lines AS (SELECT m.conv_id, m.pos, m.place, m.letter, j.role, j.text, j.i FROM matched m
  LEFT JOIN judged j ON m.conv_id IS NOT DISTINCT FROM j.conv_id AND m.n = j.n AND m.letter <> 'I' WHERE m.letter <> 'D'),
spoken AS (SELECT conv_id, pos, CASE WHEN letter = 'K' THEN role
    WHEN (place - max(CASE WHEN place = 1 AND letter = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id)) % 2 = 1 THEN 'user'
    ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line FROM lines),
texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY pos) AS whole FROM spoken GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
  coalesce(b.a, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv_id
  LEFT JOIN texts ON o.conv_id IS NOT DISTINCT FROM texts.conv_id
"""


ORACLE = _oracle()
