"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A pair of adjacent bytes that occurs inside no vocabulary token can never be joined by a
merge, so a cut between them is certain. Texts are cut there, the fragments are encoded
independently (each distinct one once per task while the cache lasts) and their ids are
concatenated; the result equals encoding the whole text.

The tokenizer also splits texts into words by a pattern before it merges, and a fragment
must be split as it would be in place. That holds where the byte before the cut is no white
space (the pattern looks ahead only behind white space) and the byte after it is neither an
apostrophe (which may open a contraction) nor a continuation byte. Other forced boundaries
are not used.

A worker encodes the unknown fragments of a slice of rows by few calls, without threads of the
library's own (a task has one core), and keeps ids of short fragments in two generations of
bounded size: when the young one is full it becomes the old one, whose entries live on if used.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinesift.llm.common import shipped, small_batches
from tokenizers import Tokenizer

# Code points outside ASCII that the word pattern takes for white space (fixed values).
_WIDE_SPACES = re.compile("[\x85\xa0  -     　]")
_ASCII_SPACES = b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
# Bytes that one generation of a worker's fragment cache may take up, and what an entry takes
# besides its fragment and ids.
CACHE_BYTES = 24_000_000
_ENTRY_BYTES = 180
_ROWS_AT_ONCE = 128
# Fragments that one call encodes: what the library returns for each is far larger than its ids.
_FRAGMENTS_AT_ONCE = 2_048
_LONGEST_CACHED = 64


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: printable Latin-1
    characters stand for themselves, the others are numbered from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class FragmentEncoder:
    """Encodes and decodes whole texts with one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        vocab = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in self.special}
        self.tokens = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        inside = np.zeros((256, 256), bool)
        for token, i in vocab.items():
            self.tokens[i] = token
            inside[list(token[:-1]), list(token[1:])] = True
        for content, i in self.special.items():
            self.tokens[i] = content.encode()
        self.cut = ~inside
        self.cut[list(_ASCII_SPACES), :] = False
        self.cut[:, 0x80:0xC0] = False
        self.cut[:, ord("'")] = False
        # behind a character that may end a wide space no cut is made, where a text has such spaces
        self.careful = self.cut.copy()
        self.careful[0x80:0xC0, :] = False
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        # the tasks of an executor are its parallelism; a thread pool per worker only adds CPU time
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.bytes_of = pa.array(self.tokens, pa.binary())
        self.young: dict[bytes, bytes] = {}  # fragment -> its ids as int32
        self.old: dict[bytes, bytes] = {}
        self.room = CACHE_BYTES

    def fragments(self, data: bytes, careful: bool = False) -> list[bytes]:
        b = np.frombuffer(data, np.uint8)
        if len(b) < 2:
            return [data] if data else []
        at = (np.flatnonzero((self.careful if careful else self.cut)[b[:-1], b[1:]]) + 1).tolist()
        return [data[i:j] for i, j in zip([0, *at], [*at, len(data)])]

    def pieces(self, text: str) -> list[bytes]:
        """The fragments of a text; the string of a special token is one of its own."""
        if not self.split or not self.split.search(text):
            return self.fragments(text.encode(), bool(_WIDE_SPACES.search(text)))
        out: list[bytes] = []
        for part in self.split.split(text):
            out += [part.encode()] if part in self.special else self.fragments(part.encode(), bool(_WIDE_SPACES.search(part)))
        return out

    def _keep(self, fragment: bytes, ids: bytes) -> None:
        self.young[fragment] = ids
        self.room -= len(fragment) + len(ids) + _ENTRY_BYTES
        if self.room < 0:
            self.old, self.young, self.room = self.young, {}, CACHE_BYTES

    def _ids_of(self, wanted: set[bytes]) -> dict[bytes, bytes]:
        """The ids of every wanted fragment, unknown ones by the library."""
        known: dict[bytes, bytes] = {}
        unknown: list[bytes] = []
        for fragment in wanted:
            ids = self.young.get(fragment)
            if ids is None:
                ids = self.old.get(fragment)
                if ids is None:
                    unknown.append(fragment)
                    continue
                self._keep(fragment, ids)
            known[fragment] = ids
        for start in range(0, len(unknown), _FRAGMENTS_AT_ONCE):
            part = unknown[start : start + _FRAGMENTS_AT_ONCE]
            found = self.tokenizer.encode_batch_fast([f.decode() for f in part], add_special_tokens=False)
            for fragment, encoding in zip(part, found):
                ids = array("i", encoding.ids).tobytes()
                known[fragment] = ids
                if len(fragment) <= _LONGEST_CACHED:
                    self._keep(fragment, ids)
        return known

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as int32."""
        parts = [self.pieces(t) for t in texts]
        known = self._ids_of({f for own in parts for f in own})
        return [np.frombuffer(b"".join([known[f] for f in own]), np.int32) for own in parts]

    def decode_all(self, ids: list[np.ndarray]) -> list[str]:
        """The text of each row of ids: its tokens' bytes one after another, as UTF-8."""
        if not ids:
            return []
        taken = self.bytes_of.take(pa.array(np.concatenate(ids)))
        _, offsets, data = taken.buffers()
        ends = np.frombuffer(offsets, np.int32)[taken.offset:][np.cumsum([0, *map(len, ids)])].tolist()
        view = memoryview(data) if data is not None else memoryview(b"")
        return [str(view[i:j], "utf-8", "replace") for i, j in zip(ends, ends[1:])]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decode_all([np.array(ids, np.int32)])[0]


@lru_cache(maxsize=2)
def encoder(path: str) -> FragmentEncoder:
    """One encoder per Python worker and file."""
    return FragmentEncoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _narrow(docs: DataFrame, key: str) -> tuple[DataFrame, str]:
    narrow = docs.select(F.col(key), F.col("text").cast("string").alias("text"))
    return shipped(narrow), f"`{key}` {narrow.schema[0].dataType.simpleString()}, ids array<int>"


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """``(key, ids array<int>)`` for every row; a null or empty text gives an empty array.

    Special tokens' strings in a text become their ids, as the library does by default.
    """
    path = path or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in small_batches(batches, _ROWS_AT_ONCE):
            ids = own.encode_all(_texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids)], [key, "ids"])

    narrow, schema = _narrow(docs, key)
    return narrow.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """``(key, ids, decoded)``: the text of each row's ids; null ids count as none."""
    path = path or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in small_batches(batches, _ROWS_AT_ONCE):
            ids = [i.values.to_numpy(zero_copy_only=False) if i.is_valid else np.zeros(0, np.int32) for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own.decode_all(ids), pa.string())], [key, "ids", "decoded"])

    narrow = encoded.select(key, "ids")
    return shipped(narrow).mapInArrow(
        run, f"`{key}` {narrow.schema[0].dataType.simpleString()}, ids array<int>, decoded string")


def encode_and_decode(docs: DataFrame, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """``(key, ids, decoded)`` as :func:`decode` gives for :func:`encode`, by one Python worker a task."""
    path = path or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in small_batches(batches, _ROWS_AT_ONCE):
            ids = own.encode_all(_texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(ids), pa.array(own.decode_all(ids), pa.string())], [key, "ids", "decoded"])

    narrow, schema = _narrow(docs, key)
    return narrow.mapInArrow(run, f"{schema}, decoded string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every row of ``docs``.

    Texts are encoded whole and decoded from their ids. Null and empty texts have no
    tokens and the digests of the empty string. Repeated rows stay repeated, a null doc_id
    stays null, an empty table gives an empty result; further columns are not read.
    """
    back = encode_and_decode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
