"""The streaming encoder against the reference implementation of the vocabulary, and round trips."""

import random
import struct

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import bpe

PATH = f"{bpe.TOKENIZERS}/{bpe.VOCABULARY}"
TOY = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"aa": 259, b"aaaa": 260, b"ca": 261}


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def unpack(b: bytes) -> list[int]:
    return list(struct.unpack(f"={len(b) // 4}i", b))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_reference(reference, text):
    assert unpack(bpe.encode_text(text, PATH)) == reference.encode_ordinary(text)


@pytest.mark.parametrize("alphabet", ["а", "абвієґ", "the quick", "0123", " \n\t", "é𝟕ž"])
def test_long_pre_tokens_stream(reference, alphabet):
    r = random.Random(alphabet)
    text = "".join(r.choice(alphabet) for _ in range(9000))
    assert unpack(bpe.encode_text(text, PATH)) == reference.encode_ordinary(text)


def test_memory_stays_bounded():
    e = bpe.Encoder(bpe.load_ranks(PATH))
    for _ in range(40):
        e.feed("абвг".encode() * 300)
        assert len(e.tail) <= 4096 + 4 * e.lookahead


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=40), st.integers(1, 7))
def test_toy_vocabulary_fed_in_pieces(text, step):
    e = bpe.Encoder(TOY)
    data, got = text.encode(), []
    for i in range(0, len(data), step):
        got += e.feed(data[i : i + step])
    assert got + e.finish() == (e.merged(data) if data else [])


def test_decoder_waits_for_whole_characters():
    e = bpe.ids_of(PATH)[0].encoder
    d = bpe.Decoder(e)
    ids = e.encode("ї".encode()[:1]) + e.encode("ї".encode()[1:])
    assert d.feed(ids[:1]) == "" and d.feed(ids[1:]) == "ї" and d.finish() == ""


def test_operator(spark):
    rows = [(1, "Рішення № 5", "x"), (2, None, None), (3, "", "y"), (3, "", "y"), (4, "а" * 5000 + " <|endoftext|>", "z"), (None, "t", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode_corpus(df, "doc_id", "text", PATH)
    got = out.collect()
    assert len(got) == 6 and {tuple(r.ids) for r in got if r.doc_id in (2, 3)} == {()}
    back = {r.doc_id: r.text for r in bpe.decode_corpus(out, "doc_id", "ids", PATH).collect()}
    assert back == {1: rows[0][1], 2: "", 3: "", 4: rows[4][1], None: "t"}
    assert bpe.encode_corpus(df.limit(0), "doc_id", "text", PATH).count() == 0
