"""Ids cut at white space equal the ids of whole texts."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from keypanel.llm.tokens import Encoder, byte_alphabet, slices

from conftest_llm import BYTES, ROWS, WORDS

ENCODERS = {path: (Encoder(path, spaced), Tokenizer.from_file(path)) for path, spaced in ((BYTES, True), (WORDS, False))}


def whole(path, text):
    return np.array(ENCODERS[path][1].encode(text, add_special_tokens=False).ids, ENCODERS[path][0].dtype).tobytes()


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_odd_texts(path):
    texts = [t or "" for _, t in ROWS]
    assert ENCODERS[path][0].encode(texts) == [whole(path, t) for t in texts]


@pytest.mark.parametrize("path", [BYTES, WORDS])
@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r\x0b\x1c\x1f\x85\xa0 　́'sΣς|<>İß1٣"), st.characters(codec="utf-8"))))
def test_any_text(path, text):
    assert ENCODERS[path][0].encode([text]) == [whole(path, text)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from(list("aZbé ßİſıKǅ.,!?'\n\t\r0²µªº×÷Ȁɏ-")), max_size=30), max_size=5))
def test_latin_texts(path, texts):
    assert ENCODERS[path][0].encode(texts) == [whole(path, t) for t in texts]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_every_letter_taken_for_simple(path):
    words = [chr(c) for c in range(0x24F + 50)] + ["a" + chr(c) + "b" for c in range(0x24F + 50)]
    texts = [w + " " + w + "." for w in words]
    assert ENCODERS[path][0].encode(texts) == [whole(path, t) for t in texts]


def test_real_texts(documents):
    texts = [r["text"] for r in documents.select("text").collect()]
    for path in (BYTES, WORDS):
        assert ENCODERS[path][0].encode(texts) == [whole(path, t) for t in texts]


def test_alphabet():
    assert len(set(byte_alphabet().values())) == 256 and byte_alphabet()[32] == "\u0120"


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr("keypanel.llm.tokens.REMEMBERED", 3)
    encoder = Encoder(WORDS, spaced=False)
    for text in ("a b c d", "e f", "g a"):
        assert encoder.encode([text]) == [whole(WORDS, text)]
    assert len(encoder.pieces) <= 6


def test_slices_cover_every_row():
    texts = ["x" * n for n in (0, 7_000_000, 5, 5_999_999, 1, 1)]
    got = list(slices(texts))
    assert [i for a, b in got for i in range(a, b)] == list(range(6))
    assert zlib.crc32(b"") == 0
