"""Base spans against plain regular expressions; decoding against all segmentations; odd rows."""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cinesift.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PIECES = ["1", "23", "255", "999", "0", ".", "..", "@", "a", "b-", "+", "_", " ", "(", ")", "-", "4876179267539117", "%", "é", "\n",
          "4111 1111 1111 1111", "+1 (319) 555-5132", "x@y.z", "10.0.0.1"]


def brute_base(text: str):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])]
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=16).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == brute_base(text)


def test_long_runs_take_linear_time():
    for text in ("9" * 300_000, "a" * 300_000 + "@", "+" * 100_000, "1." * 100_000, "a@" * 50_000, "1 " * 200_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def trained():
    rng = np.random.default_rng(1)
    texts = []
    for _ in range(120):
        d = rng.integers(0, 10, 20).astype(str).tolist()
        card = "4876179267539117"
        texts += [
            f"write to user{d[0]}.x{d[1]}@mail{d[2]}.example.com about it", f"host 10.{d[0]}.{d[1]}{d[2]}.7 is down",
            f"call +1 ({d[0]}1{d[1]}) 555-{''.join(d[2:6])} now", f"paid with {card} today", f"version 3.{d[0]} of {d[1]} parts",
        ]
    examples = []
    for t in texts[:200]:
        (zone,) = pii.zones(t)
        examples.append((zone, pii._disjoint(pii.base_spans(t))))
    return pii.train(examples), texts


def test_model_finds_the_base_spans_by_itself(trained):
    weights, texts = trained
    for t in texts[200:]:
        found = [s for z in pii.zones(t) for s in pii.decode(z, weights)]
        assert found == brute_base(t)


def test_decoding_equals_the_best_of_all_segmentations(monkeypatch):
    rng = np.random.default_rng(5)
    weights = rng.normal(size=(len(pii.KINDS), pii.FEATURES))
    for text in ("a 1 (2) b", "x@y.z 5", "+1 2-3", "1.2.3.4 a", "7"):
        (zone,) = pii.zones(text)
        n = len(zone.starts)
        f = pii.features(zone, 0, n)
        best = 0.0
        for cuts in itertools.product([0, 1], repeat=n - 1):
            bounds = [0, *(i + 1 for i, c in enumerate(cuts) if c), n]
            total = 0.0
            for a, b in itertools.pairwise(bounds):
                options = [0.0] if b - a == 1 else []
                if b - a <= pii.MAX_TOKENS and not np.isnan(f[a, b - a - 1, 0]):
                    options.append(float((weights @ f[a, b - a - 1]).max()))
                total += max(options, default=-np.inf)
            best = max(best, total)
        begin, end = zone.starts.tolist(), zone.ends.tolist()
        got = 0.0
        for kind, s, e in pii.decode(zone, weights):
            a, b = begin.index(s), end.index(e) + 1
            got += float(weights[pii.KINDS.index(kind)] @ f[a, b - a - 1])
        assert got == pytest.approx(best, abs=1e-5)
    # pieces of a long zone give the same
    text = "1 a2 +3 (4) 5@6.7 " * 40
    (zone,) = pii.zones(text)
    whole = pii.decode(zone, weights)
    monkeypatch.setattr(pii, "_PIECE", 7)
    assert pii.decode(zone, weights) == whole


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    (zone,) = pii.zones("a 1 (2) b@c.d")
    own = pii.features(zone, 0, len(zone.starts))
    allowed, f = ~np.isnan(own[None, :, :, 0]), np.nan_to_num(own)[None]
    w = rng.normal(scale=0.3, size=(len(pii.KINDS), pii.FEATURES))
    ends = np.array([len(zone.starts)])
    expected, _ = pii._expected(f, allowed, ends, w)
    for k, j in ((0, 0), (1, 3), (2, 5), (3, 11)):
        up, down = w.copy(), w.copy()
        up[k, j] += 1e-5
        down[k, j] -= 1e-5
        slope = (pii._expected(f, allowed, ends, up)[1] - pii._expected(f, allowed, ends, down)[1]) / 2e-5
        assert expected[k, j] == pytest.approx(slope, abs=1e-5)


def test_added_spans_overlap_no_base_span(trained):
    weights, texts = trained
    text = "; ".join(texts[:40]) + " 4 4451718024887799"
    base, spans = pii.find(text, weights)
    assert set(base) <= set(spans)
    for kind, s, e in set(spans) - set(base):
        assert not any(a < e and s < b for _, a, b in base)
    assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), x[1], x[2]))


def test_rows(make_docs):
    long = "word " * 100_000 + "a@b.cd"
    texts = {1: "mail a.b@c.de, 10.0.0.1", 2: "", 3: None, 4: long, 5: "日本 4876179267539117"}
    docs = make_docs([*texts.items(), (5, texts[5]), (None, "+49 30 1234567")])
    got = pii.personal_data(docs).collect()
    assert len(got) == 7
    for r in got:
        base = brute_base(("+49 30 1234567" if r.doc_id is None else texts[r.doc_id]) or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    assert pii.personal_data(make_docs([])).collect() == []
