"""Byte-level BPE of a whole corpus as a bounded-lookahead streaming transducer.

The encoder reads the bytes of one pre-token from left to right and keeps, for each prefix, the last token
of that prefix's encoding: the longest vocabulary entry ending there that may follow the last token of the
shorter prefix (two tokens may stand together if the merge list leaves their joined bytes as just these
two). Every extension of the text goes through a prefix that ends within one longest token of the read
position, so a token is stable as soon as all prefixes of that window share it; it is emitted then and
forgotten, and memory stays constant for a pre-token of any length. The window, the sufficient lookahead,
is computed from the merge list.

Pre-tokens are short and repeat, so the ids of those of up to 64 bytes are kept per worker (bounded, a
cache only: what is not found is encoded by the same transducer).

Defined results: the empty and the null text give an empty list; every other text is taken as it stands
(no normalisation, special tokens are ordinary text).
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable
import codecs
import struct
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public vocabulary files; a parameter everywhere.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def shipped(df: DataFrame, path: str) -> Callable[[], str]:
    """Send the vocabulary file to all executors; gives the function by which a task finds its copy."""
    df.sparkSession.sparkContext.addFile(path)
    name = os.path.basename(path)

    def here() -> str:
        own = SparkFiles.get(name)
        return own if os.path.exists(own) else path

    return here


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id; the id of a merged token is also its merge priority."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """Streaming encoder of one vocabulary. ``feed`` bytes of a pre-token, then ``finish``; each returns the ids that became stable."""

    KEPT_PAIRS = 1_000_000

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.lookahead = max(map(len, ranks))
        ends: dict[bytes, set[int]] = {}
        for t in ranks:
            ends.setdefault(t[-2:], set()).add(len(t))
        self.lengths = {k: sorted(v, reverse=True) for k, v in ends.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.tail = b""  # the bytes from the last emitted boundary on
        self.last: list[int] = []  # of each prefix of the tail, the id of its last token

    def merged(self, data: bytes) -> list[int]:
        """The merge list applied to a few bytes, lowest rank first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def may_follow(self, a: int, b: int) -> bool:
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= self.KEPT_PAIRS:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merged(self.token[a] + self.token[b]) == [a, b]
        return got

    def step(self, end: int) -> None:
        """Find the last token of the prefix of ``end`` bytes."""
        tail, last, ranks = self.tail, self.last, self.ranks
        for n in (*self.lengths.get(tail[max(0, end - 2) : end], ()), 1):
            if n > end:
                continue
            t = ranks.get(tail[end - n : end])
            if t is not None and (n == end and self.first_ok(t) or n < end and self.may_follow(last[end - n - 1], t)):
                last.append(t)
                return
        raise AssertionError("a byte is missing in the vocabulary")

    before = -1  # the token before the tail

    def first_ok(self, t: int) -> bool:
        return self.before < 0 or self.may_follow(self.before, t)

    def path(self, end: int) -> list[int]:
        """Ends of the tokens of the prefix of ``end`` bytes, last first."""
        out = []
        while end > 0:
            out.append(end)
            end -= len(self.token[self.last[end - 1]])
        return out

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for at in range(0, len(data), 4096):
            start = len(self.tail)
            self.tail += data[at : at + 4096]
            for end in range(start + 1, len(self.tail) + 1):
                self.step(end)
            out += self.settle()
        return out

    def settle(self) -> list[int]:
        """Emit what all prefixes ending within the lookahead share."""
        n = len(self.tail)
        if n <= 2 * self.lookahead:
            return []
        shared = set(self.path(n))
        for end in range(n - 1, n - self.lookahead, -1):
            shared.intersection_update(self.path(end))
        cut = max(shared, default=0)
        out = self.ids(cut)
        if out:
            self.before = out[-1]
            self.tail, self.last = self.tail[cut:], self.last[cut:]
        return out

    def ids(self, end: int) -> list[int]:
        return [self.last[e - 1] for e in reversed(self.path(end))]

    def finish(self) -> list[int]:
        out = self.ids(len(self.tail))
        self.reset()
        self.before = -1
        return out

    def encode(self, data: bytes) -> list[int]:
        """One pre-token."""
        return self.feed(data) + self.finish()


class Decoder:
    """Incremental byte-to-text state machine: ids in, text out as soon as its bytes are complete."""

    def __init__(self, encoder: Encoder):
        self.token, self.machine = encoder.token, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self.machine.decode(b"".join(map(self.token.__getitem__, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


class Ids(dict):
    """Pre-token to its ids as int32 bytes."""

    KEPT = 400_000

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, pre: str) -> bytes:
        data = pre.encode()
        ids = self.encoder.encode(data)
        packed = struct.pack(f"={len(ids)}i", *ids)
        if len(data) <= 64:
            if len(self) >= self.KEPT:
                self.clear()
            self[pre] = packed
        return packed


@lru_cache
def ids_of(path: str) -> tuple[Ids, regex.Pattern]:
    return Ids(Encoder(load_ranks(path))), regex.compile(PATTERN)


def encode_text(text: str | None, path: str) -> bytes:
    """int32 bytes of a text's ids. Long texts are split lazily, so no list of all their pre-tokens is held."""
    if not text:
        return b""
    ids, pattern = ids_of(path)
    if len(text) <= 1 << 20:
        return b"".join(map(ids.__getitem__, pattern.findall(text)))
    return b"".join(ids[m[0]] for m in pattern.finditer(text))


def encode_corpus(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """``key, ids`` of each row, repeated keys each. Narrow: no shuffle, nothing is collected; other columns are not read."""

    here = shipped(df, path)

    def run(batches):
        own = here()
        for b in batches:
            parts = [encode_text(x.as_py(), own) for x in b.column(1)]
            offsets, at = [0], 0
            for p in parts:
                at += len(p) // 4
                offsets.append(at)
            values = pa.Array.from_buffers(pa.int32(), at, [None, pa.py_buffer(b"".join(parts))])
            yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names=["k", "ids"])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def decode_corpus(df: DataFrame, key: str, ids: str, path: str) -> DataFrame:
    """``key, text``: the inverse of :func:`encode_corpus` (a null list gives null)."""

    here = shipped(df, path)

    def run(batches):
        encoder = ids_of(here())[0].encoder
        for b in batches:
            out = []
            for x in b.column(1):
                d = Decoder(encoder)
                out.append(None if not x.is_valid else d.feed(x.as_py()) + d.finish())
            yield pa.record_batch([b.column(0), pa.array(out, pa.string())], names=["k", "text"])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{ids}`").alias("t")).mapInArrow(run, f"k {kind}, text string").withColumnRenamed("k", key)
