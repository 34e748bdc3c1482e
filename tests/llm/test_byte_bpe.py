"""Encoding equals the tiktoken library's; decoding gives the texts back."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from keypanel.llm import byte_bpe
from keypanel.llm.queries import QUERIES

from conftest_llm import SF

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
CODER = byte_bpe.Coder(byte_bpe.read_ranks(PATH), byte_bpe.class_ranges())
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODER.ranks, special_tokens={})


def ids(text):
    return LIBRARY.encode_ordinary(text or "")


def digest(text):
    return hashlib.sha256(np.array(ids(text), "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def held(rows, expected):
    found = sorted(tuple(map(str, r)) for r in rows)
    assert found == sorted((str(d), str(len(ids(t))), *digest(t)) for d, t in expected)


def test_query(spark, documents):
    held(QUERIES["op11_byte_bpe"](spark, SF).collect(), documents.select("doc_id", "text").collect())


def through(df):
    from pyspark.sql import functions as F

    encoded = byte_bpe.encode(df, PATH)
    return byte_bpe.decode(encoded.withColumn("h", F.sha2("ids", 256)), PATH).select(
        "doc_id", "n_tokens", "h", F.sha2("decoded", 256))


def test_odd_rows(spark, odd, empty):
    held(through(odd).collect(), odd.select("doc_id", "text").collect())
    assert through(empty).collect() == []


def test_clashing_names(spark, odd):
    from pyspark.sql import functions as F

    renamed = odd.select(F.col("doc_id").alias("ids"), "text", F.lit(1).alias("ends"), F.lit(2).alias("n_tokens"))
    with pytest.raises(ValueError, match="clash"):
        byte_bpe.encode(renamed, PATH, key="ids")


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r'stmdrevl1\x85\u3000"), st.characters(codec="utf-8"))), max_size=6))
def test_any_texts(texts):
    found = CODER.encode([t.encode() for t in texts])
    assert [f.tolist() for f in found] == [ids(t) for t in texts]
    assert [CODER.decode(f, CODER.ends(f)).decode() for f in found] == texts


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet=" \n'strea1!é🙂", min_size=60, max_size=900))
def test_long_texts_in_windows(text):
    before, byte_bpe.WINDOW = byte_bpe.WINDOW, 50
    try:
        assert CODER.encode([text.encode()])[0].tolist() == ids(text)
    finally:
        byte_bpe.WINDOW = before


@pytest.mark.parametrize("text", ["a" * 200_000, " " * 200_000, "ab!" * 50_000, "é" * 50_000])
def test_one_slice_longer_than_a_window(text, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WINDOW", 1000)
    assert CODER.encode([text.encode()])[0].tolist() == ids(text)


@settings(max_examples=200, deadline=None)
@given(piece=st.binary(min_size=2, max_size=80))
def test_both_ways_to_merge(piece):
    assert CODER._merged_short(piece) == CODER._merged_long(piece)


def test_classes_agree_with_another_library():
    told = CODER.classes
    for pattern, kind in ((r"\p{L}", byte_bpe.LETTER), (r"\p{N}", byte_bpe.NUMBER)):
        # Code points that only one of the two Unicode versions knows may differ.
        odd = [c for c in range(0x3000) if (regex.match(pattern, chr(c)) is not None) != (told[c] == kind)]
        assert len(odd) < 50


def test_composition_is_associative():
    rows = byte_bpe.FUNCTIONS
    for f in range(0, len(rows), 7):
        for c in range(2 * byte_bpe.CLASSES):
            assert (rows[byte_bpe.THEN[f, c]] == byte_bpe.NEXT[rows[f], c]).all()


def test_parts_without_the_rest():
    text = "Grüße, it's 12 o'clock   🙂\n\n" * 5
    found = CODER.encode([text.encode()])[0]
    ends = CODER.ends(found)
    for first in range(0, len(found), 3):
        assert CODER.part(found, ends, first, first + 4) == LIBRARY.decode_bytes(found[first:first + 4].tolist())
    with pytest.raises(ValueError, match="offsets"):
        CODER.decode(found, ends + 1)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    for text in ("one two three four five", "six seven one"):
        assert CODER.encode([text.encode()])[0].tolist() == ids(text)


def test_bytes_that_are_no_text(spark):
    df = spark.sql("SELECT 1L doc_id, CAST(X'61FF62' AS STRING) text")
    assert byte_bpe.encode(df, PATH).first()["n_tokens"] == len(ids("a\ufffdb"))


def test_groups_cover_every_row():
    sizes = [0, byte_bpe.WINDOW * 2, 5, byte_bpe.WINDOW - 1, 1, 1]
    assert [i for a, b in byte_bpe.groups(sizes) for i in range(a, b)] == list(range(6))
