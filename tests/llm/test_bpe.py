"""Ids and decoded texts against the tokenizers library on whole texts."""

from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cinesift.llm import bpe

PATH = bpe.default_tokenizer()
OWN, LIBRARY = bpe.encoder(PATH), Tokenizer.from_file(PATH)
PIECES = ["a", "b ", "'", "'s", "'ll", " '", "\n", "\r\n", "\t", " ", "  ", ".", ",x", "!?", "é", "ß", "日本", "　",
          "\xa0", "\x85", " ", "\x1c", "0", "12", "<", "|", ">", "<|endoftext|>", "<|endoftext", "😀", "́", "\x00", "The", "qzq"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_same_ids_and_decoding_as_the_library(text):
    ids = OWN.encode(text)
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    assert OWN.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_no_vocabulary_token_holds_a_cut():
    for token in OWN.tokens[:50256]:
        assert OWN.fragments(token) in ([token], [])


def test_texts_are_cut():
    assert len(OWN.fragments(b"one two, three\nfour")) >= 4


def test_round_trip_rows(make_docs):
    long = "thndedti onbleen's  " * 20_000
    texts = ["Hello there", "", None, long, "x<|endoftext|>y", "Hello there"]
    got = bpe.round_trip(make_docs([*enumerate(texts), (None, "a b")])).collect()
    assert len(got) == 7
    for r in got:
        text = ("a b" if r.doc_id is None else texts[r.doc_id]) or ""
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_null_ids(make_docs, spark):
    assert bpe.round_trip(make_docs([])).collect() == []
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bpe.decode(none).first().decoded == ""
