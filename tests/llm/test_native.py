"""Awkward rows for the operators without user functions, against plain Python."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keypanel.llm.chat_format import rotate
from keypanel.llm.decontamination import decontaminate
from keypanel.llm.license_scan import scan_licenses
from keypanel.llm.quality_rules import judge_quality, measured
from keypanel.llm.revisits import canonical_url, resolve_revisits
from keypanel.llm.queries import QUERIES
from keypanel.llm.url_filters import filter_urls
from keypanel.llm.words import apart, nought

from conftest_llm import ROWS, SF, plain

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr", "allow"), ("a.org", "/", "block"),
         ("x.org", "/", "allow"), ("x.org", "/", "block"), ("", "/", "block"), (None, "/", "block")]


def python_plan(df):
    return re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


# ------------------------------------------------------------------------- URLs

URLS = [None, "", "no scheme", "http://", "http://A.Example.NET", "http://a.example.net/", "x://a.example.net/en/1?q#f",
        "http://notexample.net/en/", "http://net/", "http://net", "http://b.org/french", "http://a.org/fr", "http://x.org/",
        "http://h/a://net/", "http://a.net:80/", "HTTP://É.org/fr?x=http://net/", "http://net/", "http://.net/", "http://a..net/\n"]


def judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in RULES
           if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_urls(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(0, URLS[5])], "page_id long, url string").withColumns(
        {"rule": F.lit("x"), "host": F.lit("x"), "digest": F.lit("x"), "prefix": F.lit("x"), "labels": F.lit(1)})
    out = filter_urls(pages, rules)
    found = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect())
    assert found == Counter([(i, *judge(u)) for i, u in enumerate(URLS)] + [(0, *judge(URLS[5]))])
    assert filter_urls(pages.limit(0), rules).collect() == []
    assert {r["rule"] for r in filter_urls(pages, rules.limit(0)).collect()} == {None}


# ---------------------------------------------------------------- decontamination

def test_rows_without_a_partner_are_dealt_to_all_tasks(spark):
    """A third of the URLs missing: their second join key differs by row; known places and the rules' side have 0."""
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, null, concat('http://a.net/', id % 3)) as url", "map('k', id) as extra")
    keyed = df.withColumn("key", apart(df, F.col("url").isNotNull()))
    missing = keyed.where("url is null").groupBy("key").count()
    assert missing.count() > 900 and keyed.where("url is not null and key <> 0").isEmpty()
    assert df.withColumn("key", nought("url")).where("key <> 0 or key is null").isEmpty()


@pytest.mark.parametrize("name", ["op1_url_filters", "op10_revisits"])
def test_hot_partitions_can_be_split(spark, name):
    """Without broadcasts an exchange, not an aggregate, feeds both sides of the joins that a hot key reaches."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if before is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning\([^\n]*apart", plan)) >= 2


def contamination(text, items):
    words, hit, found = plain(text), set(), set()
    for item, body in items:
        w = plain(body)
        n = min(len(w), 10)
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for at in range(len(words)):
            if n and tuple(words[at:at + n]) in windows:
                hit |= set(range(at, at + n))
                found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


ITEMS = [(1, "one TWO three"), (1, "word " * 12), (2, "x"), (10, None), (None, "five six"), (3, ""), (4, "a b c d e f g h i j k l"),
         (20, "another text of the same id and more words than any text has")]


def test_decontamination(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("item", F.lit(1))
    extra = spark.createDataFrame([(50, "z a b c d e f g h i j k l z b c d e f g h i j k")], "doc_id long, text string")
    docs = odd.unionByName(extra, allowMissingColumns=True)
    out = decontaminate(docs, items)
    found = Counter((r["doc_id"], r["text"], r["n_words"], r["n_hit"], tuple(r["items"]), r["n_items"], r["contaminated"])
                    for r in out.collect())
    want = Counter()
    for r in docs.collect():
        n, hit, ids = contamination(r["text"], ITEMS)
        want[(r["doc_id"], r["text"], n, hit, tuple(ids), len(ids), hit > 0)] += 1
    assert found == want
    assert not python_plan(out)
    assert decontaminate(docs.limit(0), items).collect() == []
    assert not any(r["contaminated"] for r in decontaminate(docs, items.limit(0)).collect())


# ------------------------------------------------------------------ quality rules

def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:]))
    twice = Counter(grams)
    covered = {j for i, g in enumerate(grams) if twice[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("bits", [24, 4, 60])
def test_quality_measures(spark, odd, monkeypatch, bits):
    """Packed positions, a field too short for the texts, and hash bits that collide."""
    monkeypatch.setattr("keypanel.llm.quality_rules.POSITION_BITS", bits)
    more = [(60, "a b a b a b c"), (61, "a a a"), (62, "a b c x a b c y b c x"), (63, "l\nl\r\nl\n\n \nm\nl"), (64, " ".join(map(str, range(300))) + " 1 2 3 4")]
    docs = odd.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = Counter((r["doc_id"], r["text"], *(r[n] for n in names)) for r in measured(docs).collect())
    assert found == Counter((r["doc_id"], r["text"], *counts(r["text"])) for r in docs.collect())


def test_quality_verdict(spark, odd, empty):
    out = judge_quality(odd)
    assert not python_plan(out) and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        n, _, _, _, repeated = counts(r["text"])
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n) and (not r["kept"] or not r["base_failed"])
    assert judge_quality(empty).collect() == []
    assert out.where("kept").count() == sum(r["kept"] for r in out.collect())


# ------------------------------------------------------------------------ licenses

def test_licenses(spark, odd, empty):
    texts = [
        (70, "Under the MIT License, or under the mit license"), (71, "apache license version 2 cc-by-nc CC BY NC"),
        (72, "This program is free software: you can redistribute it and/or modify it under some terms of the GNU General "
             "Public License as published by the Free Software Foundation"),
        (73, "this program is free software for everybody"), (74, "cc by")]
    docs = odd.unionByName(spark.createDataFrame(texts, "doc_id long, text string"), allowMissingColumns=True)
    out = scan_licenses(docs)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == docs.count() and not python_plan(out)
    assert (rows[70]["n_base"], rows[70]["first_word"], rows[70]["last_word"], rows[70]["labels"]) == (2, 0, 5, ["mit"])
    assert (rows[71]["n_base"], rows[71]["first_word"], rows[71]["last_word"]) == (3, 0, 7)
    assert rows[71]["base_labels"] == ["apache-2", "cc-by-nc"] and rows[71]["score"] == 1.0
    assert rows[72]["labels"] == ["gpl", "gpl-notice"] and rows[72]["base_labels"] == [] and 0.6 <= rows[72]["score"] < 1
    span = next(s for s in rows[72]["spans"] if s["label"] == "gpl-notice")
    assert (span["first"], span["last"]) == (0, len(plain(texts[2][1])) - 1)
    for doc in (73, 74, 2, 3, 7):
        assert rows[doc]["labels"] == [] and rows[doc]["score"] == 0.0 and rows[doc]["first_word"] is None
    assert scan_licenses(empty).collect() == []


# ---------------------------------------------------------------------------- chat

TURNS = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 1, "ann", "a tie"),
         (1, None, "bob", "first"), (1, 3, None, "who?"), (1, 4, "", "?"), (2, 0, "system", "alone"), (None, 5, "cy", "lost"), (3, 0, "é", "ü🙂")]


def render(turns, speaker):
    out, mask = "", []
    for role, text in turns:
        text = text.replace("<|", "<\\|")
        out += "<|assistant|>\n" if role == speaker else "<|system|>\n" if role == "system" else f"<|user name={role}|>\n"
        start = len(out)
        out += text + "<|end|>\n"
        if role == speaker:
            mask.append((start, len(out)))
    return out, mask


def test_perspectives(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumns(
        {"speaker": F.lit("x"), "block": F.lit("x"), "c": F.lit(1)})
    out = rotate(df)
    found = {(r["conv_id"], r["speaker"]): (r["text"], [(m["start"], m["stop"]) for m in r["mask"]]) for r in out.collect()}
    want = {}
    for conv in {t[0] for t in TURNS}:
        own = sorted(((t[1] is not None, t[1] or 0, t[2] or "unknown", t[3] or "") for t in TURNS if t[0] == conv))
        for speaker in {t[2] for t in TURNS if t[0] == conv and t[2]} - {"system"}:
            want[(conv, speaker)] = render([(r, x) for _, _, r, x in own], speaker)
    assert found == want and not python_plan(out)
    assert rotate(df.limit(0)).collect() == []


def test_crowded_conversation_is_dealt_to_bounded_parts(spark):
    df = spark.range(3000).select(F.lit(None).cast("long").alias("conv_id"), F.lit(0).alias("turn"),
                                  F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("role"), F.lit("same").alias("text"))
    rows = rotate(df).collect()
    assert sum(r["n_turns"] for r in rows) == 2 * 3000 and max(r["n_turns"] for r in rows) <= 600


def test_parts_of_a_crowded_conversation_join_to_the_whole(spark):
    """Hot, null and repeated conversations and turns: parts in order are the whole rendering, in any file layout."""
    turns = [(None, i % 3, "ab"[i % 2], f"text {i}") for i in range(1500)] + [(1, 0, "a", "same")] * 700
    turns += [(2, i - 300, "ab"[i % 2], str(i)) for i in range(900)] + [(2, None, "b", f"none {i}") for i in range(300)]
    turns += [(3, 0, "a", "one"), (3, 1, "b", "two")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    want = {}
    for conv in (None, 1, 2, 3):
        own = sorted(((t[1] is not None, t[1] or 0, t[2], t[3]) for t in turns if t[0] == conv))
        for speaker in {t[2] for t in turns if t[0] == conv}:
            want[(conv, speaker)] = render([(r, x) for _, _, r, x in own], speaker)
    results = []
    for layout in (df, df.repartition(7, "text")):
        rows = sorted(rotate(layout).collect(), key=lambda r: (str(r["conv_id"]), r["speaker"], r["block"], r["lot"]))
        found = {}
        for r in rows:
            assert r["n_turns"] <= 256
            text, mask = found.get((r["conv_id"], r["speaker"]), ("", []))
            found[(r["conv_id"], r["speaker"])] = (
                text + r["text"], mask + [(m["start"] + len(text), m["stop"] + len(text)) for m in r["mask"]])
        assert found == want
        results.append([tuple(r) for r in rows])
    assert results[0] == results[1]


# ------------------------------------------------------------------------ revisits

RECORDS = "record_id long, type string, uri string, date timestamp, status int, headers array<struct<name:string,value:string>>, payload string, url string"


def record(i, kind, uri, minute, headers=(), status=None, payload=None):
    from datetime import datetime, timedelta

    date = None if minute is None else datetime(2024, 1, 1) + timedelta(minutes=minute)
    return (i, kind, uri, date, status if status is not None else (200 if kind == "response" else 304), list(headers), payload, "extra")


def test_revisits(spark):
    old, new = ("ETag", '"1"'), ("ETag", '"2"')
    rows = [
        record(1, "response", "http://H.org:80/a?b&a#f", 0, [old, ("Content-Type", "t"), ("Age", "1"), ("Set-Cookie", "x")], payload="one"),
        record(2, "response", "http://h.org/a?a&b", 200, [new, ("Last-Modified", "m")], payload="two"),
        record(3, "revisit", "http://h.org/a?a&b", 100, [("etag", 'W/"1"'), ("AGE", "9"), ("Content-Length", "0"), ("Connection", "Foo, bar"), ("foo", "1")]),
        record(4, "revisit", "http://h.org/a?a&b", 200, [old]),            # the newer one is not earlier
        record(5, "revisit", "http://h.org/a?a&b", 201, [old]),            # tag of the older one
        record(6, "revisit", "http://h.org/a?a&b", 500, [("last-modified", "m")]),
        record(7, "revisit", "http://h.org/a?a&b", 500, []),
        record(8, "revisit", "http://h.org/", 500, [old]), record(9, "revisit", None, 500, [old]), record(10, "revisit", "http://h.org/a?a&b", None, [old]),
        record(11, "response", "http://h.org/a?a&b", 450, [old], status=206, payload="part"),
        record(3, "revisit", "http://h.org/a?a&b", 100, [("etag", 'W/"1"')]), record(12, "response", None, 1, payload="x"),
        record(13, "revisit", "not a url", 500, None or []),
    ]
    df = spark.createDataFrame(rows, RECORDS)
    found = resolve_revisits(df).collect()
    states = Counter((r["record_id"], r["response_id"], r["state"], r["payload"]) for r in found)
    assert states == Counter([
        (3, 1, "resolved", "one"), (3, 1, "resolved", "one"), (4, 1, "resolved", "one"), (5, 2, "mismatch", None), (6, 2, "resolved", "two"),
        (7, 2, "unvalidated", None), (8, None, "no-response", None), (9, None, "no-response", None), (10, None, "no-response", None),
        (13, None, "no-response", None)])
    merged = max((r["headers"] for r in found if r["record_id"] == 3), key=len)
    assert [tuple(h) for h in merged] == [("Content-Type", "t"), ("Set-Cookie", "x"), ("etag", 'W/"1"'), ("AGE", "9")]
    assert resolve_revisits(df.limit(0)).collect() == []


def test_revisits_across_blocks_equal_brute_force(spark):
    import random

    draw = random.Random(3)
    rows = [record(i, draw.choice(["response", "revisit"]), f"http://h/{draw.choice('aaab')}", draw.randint(0, 400), [("ETag", "1")]) for i in range(400)]
    found = {r["record_id"]: r["response_id"] for r in resolve_revisits(spark.createDataFrame(rows, RECORDS)).collect()}
    for r in rows:
        if r[1] == "revisit":
            earlier = [(x[3], x[0]) for x in rows if x[1] == "response" and x[2] == r[2] and x[3] < r[3]]
            assert found[r[0]] == (max(earlier)[1] if earlier else None)


def test_canonical_urls(spark):
    urls = {"HTTP://A.b:80": "http://a.b/", "https://a:443/X?z=1&a=2#q": "https://a/X?a=2&z=1", "http://a:8080/": "http://a:8080/",
            "mailto:x": None, "http://a?": "http://a/"}
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", canonical_url(F.col("u")).alias("c")).collect()
    assert {r["u"]: r["c"] for r in rows} == urls


def test_rows_are_defined():
    assert len(ROWS) == 14 and hashlib.sha256(b"").hexdigest().startswith("e3b0")
