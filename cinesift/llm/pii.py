"""Personal data: checked patterns, and a semi-Markov conditional random field that adds spans.

*Base.* E-mail addresses, IP addresses, card numbers (Luhn) and phone numbers by pattern, over
whole texts; these spans always stay.

*Semi-Markov CRF.* A text is a sequence of tokens (runs of ASCII letters and digits; any other
character that is no white space). A labelling cuts it into segments: entities of at most
``MAX_TOKENS`` tokens, each with a type, and single tokens outside. Each candidate segment is
scored by features of the *whole span* (digits, groups, separators, ``@`` and dots, octet and
Luhn checks, what stands before and after). A dynamic programme over segment ends, bounded by
``MAX_TOKENS``, jointly chooses boundaries and types. The weights maximise the conditional
likelihood (forward and backward sums over all segmentations) of the base spans in a bounded
sample of texts. Decoded entities that overlap no base span are added.

A candidate entity must hold a digit or ``@``, so only the tokens within ``MAX_TOKENS`` of one
matter and the rest of a text, however long, is outside; that leaves the best labelling unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinesift.llm.common import shipped, small_batches

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 16
TRAINING_TEXTS = 6_000
TRAINING_ZONES = 240
ZONE_TOKENS = 48
_PIECE = 2_048

# The base patterns (fixed values). Runs are possessive, and start where a run starts: the
# leftmost match is the same and long runs are read once.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SEED = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Base spans ``(kind, start, end)`` in code points, by kind as listed, then start."""
    spans: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            spans.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_octet, m.groups()))]
        for m in _CARD.finditer(text):
            if len(m[0]) >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", m.start(), m.end()))
        if "+" in text:
            spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                      if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return spans


@dataclass
class Zone:
    """A stretch of tokens that may hold entities: their places in the text, and the text around."""

    starts: np.ndarray
    ends: np.ndarray
    text: str
    offset: int  # of ``text`` in the whole text


def zones(text: str) -> list[Zone]:
    """All stretches of tokens within ``MAX_TOKENS`` tokens of a digit or ``@``."""
    seeds = np.fromiter((m.start() for m in _SEED.finditer(text)), np.int64)
    if not len(seeds):
        return []
    places = np.fromiter((x for m in _TOKEN.finditer(text) for x in m.span()), np.int64).reshape(-1, 2)
    near = np.zeros(len(places) + 1, np.int64)
    seeded = np.unique(np.searchsorted(places[:, 0], seeds, "right") - 1)
    np.add.at(near, np.maximum(seeded - MAX_TOKENS, 0), 1)
    np.add.at(near, np.minimum(seeded + MAX_TOKENS + 1, len(places)), -1)
    inside = np.concatenate([[False], np.cumsum(near)[:-1] > 0, [False]])
    begins, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
    out = []
    for b, e in zip(begins.tolist(), ends.tolist()):
        low, high = max(0, int(places[b, 0]) - 1), min(len(text), int(places[e - 1, 1]) + 1)
        out.append(Zone(places[b:e, 0], places[b:e, 1], text[low:high], low))
    return out


FEATURES = 40


def features(zone: Zone, first: int, last: int) -> np.ndarray:
    """Whole-span features ``[start, length - 1, feature]`` of the segments that start at the tokens
    ``first`` to ``last``; segments that may not be entities are all NaN."""
    n, text, off = len(zone.starts), zone.text, zone.offset
    high = min(n, last + MAX_TOKENS)
    tokens = [text[s - off : e - off] for s, e in zip(zone.starts[first:high].tolist(), zone.ends[first:high].tolist())]

    def sums(values: list) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(np.array(values, np.int64))])

    i = np.arange(last - first)[:, None]
    j = i + np.arange(1, MAX_TOKENS + 1)[None, :]  # token after the segment
    inside = j <= len(tokens)
    j = np.minimum(j, len(tokens))
    span = lambda c: c[j] - c[i]
    digits = span(sums([sum(c.isdigit() and c.isascii() for c in t) for t in tokens]))
    letters = span(sums([sum(c.isalpha() and c.isascii() for c in t) for t in tokens]))
    numbers = span(sums([t.isascii() and t.isdigit() for t in tokens]))
    at_signs, dots = span(sums([t == "@" for t in tokens])), span(sums([t == "." for t in tokens]))
    pluses, dashes = span(sums([t == "+" for t in tokens])), span(sums([t == "-" for t in tokens]))
    brackets = span(sums([t in "()" for t in tokens]))
    odd = span(sums([not t[0].isalnum() and t not in "@.+-()_%" or not t.isascii() for t in tokens]))
    gap = [0] + [int(a < b) for a, b in zip(zone.ends[first : high - 1].tolist(), zone.starts[first + 1 : high].tolist())]
    gaps = sums(gap)
    gaps = gaps[j] - gaps[i + 1]
    length = j - i
    word = np.array([t[0].isascii() and t[0].isalnum() for t in tokens] + [False])
    plus = np.array([t == "+" for t in tokens] + [False])
    bracket = np.array([t == "(" for t in tokens] + [False])
    glued_before = np.array([
        s > off and not text[s - off - 1].isspace() for s in zone.starts[first:high].tolist()] + [False])
    glued_after = np.array([
        e - off < len(text) and text[e - off].isalnum() or e - off < len(text) and text[e - off] in "@+-_%"
        for e in zone.ends[first:high].tolist()] + [False])
    ends_in_word = word[np.minimum(j - 1, len(tokens) - 1)]
    allowed = inside & ((digits > 0) | (at_signs > 0)) & ends_in_word & (word[i] | plus[i] | bracket[i]) & (odd == 0)
    checked_ip, checked_card = np.zeros(j.shape, bool), np.zeros(j.shape, bool)
    for a, b in zip(*np.nonzero(allowed & (length == 7) & (numbers == 4) & (dots == 3) & (gaps == 0))):
        checked_ip[a, b] = all(map(_octet, tokens[a : a + 7 : 2]))
    for a, b in zip(*np.nonzero(allowed & (digits >= 13) & (digits <= 19) & (letters == 0))):
        checked_card[a, b] = luhn("".join(t for t in tokens[a : j[a, b]] if t.isdigit()))
    plain = letters == 0
    columns = [
        np.ones(j.shape), length / MAX_TOKENS, plain, letters > 0, digits == 0, (digits > 0) & (digits < 5),
        (digits >= 5) & (digits < 9), (digits >= 9) & (digits < 13) & plain, (digits >= 13) & (digits <= 15) & plain,
        (digits >= 16) & (digits <= 19) & plain, digits > 19, at_signs == 1, at_signs > 1, (at_signs == 0) & (letters > 0),
        (at_signs == 1) & (dots > 0), (at_signs == 1) & (gaps > 0), dots == 0, (dots == 3) & plain, dots == 1, dots > 3,
        gaps == 0, gaps == 1, gaps == 2, gaps > 2, gaps > 4, plus[i] & (j > 0), (pluses > 0) & ~plus[i], bracket[i] & (j > 0),
        brackets == 2, brackets % 2 == 1, dashes > 0, dashes > 3, glued_before[i] & (j > 0),
        glued_after[np.minimum(j - 1, len(tokens) - 1)], checked_ip, checked_card, plain & (length == 1),
        plus[i] & plain & (digits >= 9) & (digits <= 15), (at_signs == 1) & (digits > 0), checked_card & (gaps + dashes <= 4),
    ]
    out = np.stack([c.astype(np.float32) for c in columns], axis=2)
    out[~allowed] = np.nan
    return out


def _scores(zone: Zone, weights: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Entity scores ``[start, length - 1, kind]``, some starts at a time; minus infinity where none may be."""
    for first in range(0, len(zone.starts), _PIECE):
        f = features(zone, first, min(len(zone.starts), first + _PIECE))
        s = np.nan_to_num(f) @ weights.T
        s[np.isnan(f[:, :, 0])] = -np.inf
        yield first, s


def decode(zone: Zone, weights: np.ndarray) -> list[Span]:
    """The best segmentation's entities. Tokens outside score zero."""
    n = len(zone.starts)
    best = np.full(n + 1, -np.inf)
    best[0] = 0.0
    back: list[tuple[int, int] | None] = [None] * (n + 1)  # length and kind of the entity that ends here
    for first, s in _scores(zone, weights):
        kind = s.argmax(axis=2)
        top = np.take_along_axis(s, kind[:, :, None], 2)[:, :, 0]
        live = np.isfinite(top).any(axis=1)
        for i in range(len(s)):
            t = first + i
            if best[t] > best[t + 1]:
                best[t + 1], back[t + 1] = best[t], None
            if live[i]:
                for length in np.flatnonzero(top[i] > 0).tolist():
                    if best[t] + top[i, length] > best[t + length + 1]:
                        best[t + length + 1] = best[t] + top[i, length]
                        back[t + length + 1] = (length + 1, int(kind[i, length]))
    spans, t = [], n
    while t > 0:
        if back[t] is None:
            t -= 1
        else:
            length, kind = back[t]
            spans.append((KINDS[kind], int(zone.starts[t - length]), int(zone.ends[t - 1])))
            t -= length
    return spans[::-1]


def _sum_log(values: np.ndarray, axis) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def _expected(f: np.ndarray, allowed: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Expected features under the model, and the sum of the zones' log partition functions.

    ``f[zone, start, length - 1, feature]``; all zones are padded to one number of tokens.
    """
    b, n = allowed.shape[:2]
    with np.errstate(divide="ignore", invalid="ignore"):
        s = np.where(allowed[..., None], f @ weights.T, -np.inf)  # zone, start, length, kind
        merged = _sum_log(s, 3)
        ahead = np.full((b, n + MAX_TOKENS + 1), -np.inf)
        ahead[:, 0] = 0.0
        for t in range(n):
            ahead[:, t + 1] = np.logaddexp(ahead[:, t + 1], ahead[:, t])
            reach = slice(t + 1, t + 1 + MAX_TOKENS)
            ahead[:, reach] = np.logaddexp(ahead[:, reach], ahead[:, t, None] + merged[:, t])
        behind = np.full((b, n + MAX_TOKENS + 1), -np.inf)
        behind[np.arange(b), ends] = 0.0
        for t in range(n - 1, -1, -1):
            via = _sum_log(np.concatenate(
                [behind[:, t + 1, None], merged[:, t] + behind[:, t + 1 : t + 1 + MAX_TOKENS]], axis=1), 1)
            behind[:, t] = np.logaddexp(behind[:, t], np.where(t < ends, via, -np.inf))
        total = behind[:, 0]
        windows = np.lib.stride_tricks.sliding_window_view(behind[:, 1:], MAX_TOKENS, axis=1)[:, :n]
        log_p = s + (ahead[:, :n, None] + windows - total[:, None, None])[..., None]
        p = np.where(np.isfinite(log_p), np.exp(np.minimum(log_p, 0.0)), 0.0)
    return np.einsum("btlk,btlf->kf", p, f, optimize=True), float(total.sum())


def train(examples: list[tuple[Zone, list[Span]]], rounds: int = 40, penalty: float = 0.5) -> np.ndarray:
    """Weights ``[kind, feature]`` of the largest penalised conditional likelihood, by Adam steps.
    Without examples all weights are such that nothing is found."""
    weights = np.zeros((len(KINDS), FEATURES))
    if not examples:
        weights[:, 0] = -10.0
        return weights
    n = max(len(z.starts) for z, _ in examples)
    f = np.zeros((len(examples), n, MAX_TOKENS, FEATURES), np.float32)
    allowed = np.zeros(f.shape[:3], bool)
    seen = np.zeros_like(weights)
    for x, (zone, spans) in enumerate(examples):
        own = features(zone, 0, len(zone.starts))
        allowed[x, : len(own)] = ~np.isnan(own[:, :, 0])
        f[x, : len(own)] = np.nan_to_num(own)
        begin = {int(s): i for i, s in enumerate(zone.starts)}
        end = {int(e): i for i, e in enumerate(zone.ends)}
        for kind, s, e in spans:
            if s in begin and e in end and end[e] - begin[s] < MAX_TOKENS and allowed[x, begin[s], end[e] - begin[s]]:
                seen[KINDS.index(kind)] += f[x, begin[s], end[e] - begin[s]]
    ends = np.array([len(z.starts) for z, _ in examples])
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        expected, _ = _expected(f, allowed, ends, weights)
        grad = (expected - seen + penalty * weights) / len(examples)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        weights -= 0.25 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
    return weights


def _disjoint(spans: list[Span]) -> list[Span]:
    """Spans that a segmentation can hold: leftmost first, the longer of two that start alike."""
    out: list[Span] = []
    for span in sorted(spans, key=lambda x: (x[1], -x[2])):
        if not out or span[1] >= out[-1][2]:
            out.append(span)
    return out


def fit(docs: DataFrame, max_texts: int = TRAINING_TEXTS, max_zones: int = TRAINING_ZONES) -> np.ndarray:
    """Weights learnt from the zones of at most ``max_texts`` texts (those of the smallest id hash)
    and at most ``max_zones`` zones; both bounds hold whatever the size of ``docs``."""
    ids = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("__id")).distinct().orderBy(
        F.xxhash64("__id"), "__id").limit(max_texts)
    chosen = docs.join(F.broadcast(ids), F.col("doc_id").cast("long") == F.col("__id")).select(
        "__id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows: list[tuple[int, str]] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for zone in zones(text or ""):
                    if len(zone.starts) <= ZONE_TOKENS and len(zone.text) <= 50 * ZONE_TOKENS:
                        rows.append((doc_id, zone.text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["doc_id", "zone"])

    taken = shipped(chosen).mapInArrow(run, "doc_id long, zone string").distinct().orderBy(
        F.xxhash64("zone", "doc_id"), "zone", "doc_id").limit(max_zones).toPandas()
    examples = []
    for text in taken.zone:
        own = zones(text)
        if len(own) == 1 and len(own[0].starts) <= ZONE_TOKENS:
            examples.append((own[0], _disjoint(base_spans(text))))
    return train(examples)


def _passes(kind: str, span: str) -> bool:
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "email":
        return "." in span.rpartition("@")[2]
    if kind == "ip":
        return all(map(_octet, re.findall(r"[0-9]+", span)))
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def find(text: str | None, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: the base ones and the decoded entities that overlap none of them
    and pass the check of their kind."""
    text = text or ""
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    added: list[Span] = []
    for zone in zones(text):
        for kind, s, e in decode(zone, weights):
            if _passes(kind, text[s:e]) and not any(a < e and s < b for a, b in taken):
                added.append((kind, s, e))
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted([*base, *added], key=lambda x: (order[x[0]], x[1], x[2]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def personal_data(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` for every row of ``docs``.

    The counts and the digest are of the base spans; ``spans`` also has those that the model adds.
    Places are code points of the whole text. Null and empty texts hold none (the digest is that
    of the empty string). Repeated rows stay repeated, a null doc_id stays null, an empty table
    gives an empty result; further columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs) if weights is None else weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            counts, base_text, all_text = [[] for _ in KINDS], [], []
            for text in batch.column(1).to_pylist():
                base, spans = find(text, shared.value)
                for c, kind in zip(counts, KINDS):
                    c.append(sum(k == kind for k, _, _ in base))
                base_text.append(_joined(base))
                all_text.append(_joined(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(base_text, pa.string()),
                 pa.array(all_text, pa.string())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    found = shipped(docs).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base", 256).alias("base_sha256"), "spans")
