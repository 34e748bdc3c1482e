"""Runs equal those found by comparing all words at all lags."""

import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keypanel.llm.periodic_runs import LEAST, find_runs, kept_words, periodic_runs, runs_of_texts
from keypanel.llm.queries import QUERIES

from conftest_llm import SF


def plain_runs(w, least=LEAST):
    found = []
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            begin = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            start, length = begin - q, i - begin + q
            if length >= max(least, 2 * q) and not any(all(w[x] == w[x - p] for x in range(start + p, start + length)) for p in range(1, q)):
                found.append((start, length, q))
            i += i == begin
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_kept(w, runs):
    return [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]


def plain_words(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    w = plain_words(doc_id, text)
    runs = [(s, n, q) for s, n, q in runs_of_texts([[x.encode() for x in w]])[0]] if len(w) > 400 else plain_runs(w)
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), start, length, period, length and 1000 * length // period,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(plain_kept(w, runs) if len(w) <= 400 else
                [x.decode() for x in kept_words([x.encode() for x in w], runs)])))


def test_query(spark, documents):
    found = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()]
    assert sorted(found) == sorted(expected(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect())
    assert sum(r[1] > 0 for r in found) > len(found) / 20


def test_odd_rows(spark, odd, empty):
    found = sorted(map(str, ((r["doc_id"], r["n_words"], len(r["runs"]), r["collapsed"]) for r in periodic_runs(odd).collect())))
    plain = []
    for r in odd.select("doc_id", "text").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        runs = [(0, 30_000, 1)] if r["doc_id"] == 7 else plain_runs(w)
        plain.append((r["doc_id"], len(w), len(runs), "word" if r["doc_id"] == 7 else " ".join(plain_kept(w, runs))))
    assert found == sorted(map(str, plain))
    assert periodic_runs(empty).collect() == []


def test_clashing_name(spark, odd):
    with pytest.raises(ValueError, match="clash"):
        periodic_runs(odd.withColumnRenamed("doc_id", "runs"), key="runs")


BLOCKS = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=25), st.integers(1, 9)), max_size=6)


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(BLOCKS, min_size=1, max_size=4))
def test_repeated_blocks(texts):
    flat = [[c for block, times in blocks for c in block * times][:300] for blocks in texts]
    assert runs_of_texts([[c.encode() for c in t] for t in flat]) == [plain_runs(t) for t in flat]


NESTED = st.lists(st.tuples(st.sampled_from(["a", "ab", "aab", "abb", "b", "c"]), st.integers(1, 25)), min_size=1, max_size=5)


@settings(max_examples=400, deadline=None)
@given(inner=NESTED, times=st.integers(1, 4), tail=st.integers(0, 40))
def test_runs_inside_runs(inner, times, tail):
    text = ("".join(s * n for s, n in inner) * times)[:350]
    text += text[:tail]
    assert runs_of_texts([[c.encode() for c in text]])[0] == plain_runs(text)


@pytest.mark.parametrize("least", [2, 5, 12])
def test_fibonacci_words(least):
    a, b = "a", "ab"
    while len(b) < 300:
        a, b = b, b + a
    import numpy as np

    assert sorted(find_runs(np.array([ord(c) for c in b]), len(b), least)) == sorted(plain_runs(b, least))


def test_work_stays_near_the_length_of_a_text():
    """Texts in which every word has many earlier occurrences."""
    lines = [w for i in range(20_000) for w in [b"the", b"same", b"ten", b"words", b"of", b"a", b"log", b"line", b"every", b"time", b"%d" % i]]
    for text, n in (([b"a"] * 200_000, 1), ([b"%d" % (i % 33) for i in range(200_000)], 1), (([b"a"] * 999 + [b"b"]) * 100, 101), (lines, 0)):
        assert len(runs_of_texts([text])[0]) == n
