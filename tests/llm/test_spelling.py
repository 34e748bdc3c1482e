"""Near words, forms and roots equal those found by comparing all words with their own edits."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keypanel.llm.queries import QUERIES, counted_words
from keypanel.llm.spelling import near_in_list, near_words, spelling_variants

from conftest_llm import SF

UPPER = {c: c + 32 for c in range(65, 91)}


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_near(words):
    """Pairs that have a word or a word less one letter in common, then looked at."""
    by_shorter = defaultdict(set)
    for w in words:
        for shorter in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            by_shorter[shorter].add(w)
    near = defaultdict(set)
    for group in by_shorter.values():
        for a in group:
            for b in group:
                if a != b and edits(a, b) == 1:
                    near[a].add(b)
    return near


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j - 1] + (x != y), before[j] + 1, row[-1] + 1))
    return row[-1]


def plain_variants(counts):
    near, form = plain_near(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    found = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(found)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def held(df, counts):
    assert sorted(tuple(r) for r in df.select(*COLUMNS).collect()) == plain_variants(counts)


def test_query(spark, documents):
    counts = plain_counts((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect())
    df = QUERIES["op13_spelling_variants"](spark, SF)
    assert [t for _, t in df.select(*COLUMNS).dtypes] == ["string"] * 3 + ["bigint"] * 3
    held(df, counts)
    assert any(form for _, form, *_ in plain_variants(counts))


def test_odd_rows(spark, odd, empty):
    from collections import Counter as C

    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert C({r["word"]: r["n"] for r in counted_words(odd).collect()}) == C(plain_counts(rows))
    assert spelling_variants(counted_words(empty)).collect() == []


CHAIN = {"wordlike": 100, "wordlke": 40, "wrdlke": 20, "wrdlk": 10, "xwordlike": 50, "wordlikes": 50, "wordlikf": 60, "wordlikg": 60,
         "aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "éèàçô": 5, "éèàço": 9, "éèàç🙂": 10}


@pytest.mark.parametrize("longest_list", [1, 2, 1000])
def test_chains_ties_and_divided_lists(spark, longest_list):
    rows = [(w, n, "x") for w, n in CHAIN.items()] + [(None, 4, "x"), ("wrdl", 90, "x")]
    df = spark.createDataFrame(rows, "word string, n bigint, form string")
    held(spelling_variants(df, longest_list=longest_list), CHAIN)


def test_repeated_words_add_up(spark):
    df = spark.createDataFrame([("abcde", 1), ("abcde", 3), ("abcdef", 2)], "word string, n bigint")
    held(spelling_variants(df), {"abcde": 4, "abcdef": 2})


def test_every_pair_once(spark):
    """A crowded neighbourhood, so that most lists are divided."""
    words = sorted({a + b + c + d + e for a in "ab" for b in "abc" for c in "ab" for d in "abc" for e in ("a", "b", "ab", "ba")})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    near = plain_near(words)
    for longest_list in (1, 7, 1000):
        found = [(r["word"], r["near"]) for r in near_words(df, longest_list).collect()]
        assert sorted(found) == sorted((a, b) for a in words for b in near[a])


WORDS = st.lists(st.text(alphabet="abé", max_size=7), max_size=25, unique=True)


@settings(max_examples=500, deadline=None)
@given(words=WORDS)
def test_scan_of_a_list(words):
    words = sorted(words)
    every = [(i, j) for j in range(len(words)) for i in range(j) if edits(words[i], words[j]) == 1]
    assert sorted(near_in_list(words)) == sorted(every)
    apart = [(i, j) for i, j in every if words[i][:2] != words[j][:2] or min(len(words[i]), len(words[j])) < 2]
    assert sorted(near_in_list(words, 0, 2)) == sorted(apart)


def test_short_words_are_refused(spark):
    with pytest.raises(ValueError, match="fewer than four"):
        spelling_variants(spark.createDataFrame([("a", 1)], "word string, n bigint"), least=2)
