import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from keypanel.llm.queries import QUERIES
from keypanel.llm.sharding import shard_rows

from conftest_llm import SF


def check(rows, texts, shards, key="doc_id"):
    assert Counter((r[key], r["text"]) for r in rows) == Counter(texts)
    slots, weights = defaultdict(list), Counter()
    for r in rows:
        assert 0 <= r["shard"] < shards and r["size"] == len((r["text"] or "").encode()) + 16
        slots[r["shard"]].append((r["slot"], r[key]))
        weights[r["shard"]] += r["size"]
    for held in slots.values():
        assert sorted(s for s, _ in held) == list(range(len(held)))
    flat = [k for s in sorted(slots) for _, k in sorted(slots[s], key=lambda x: x[0])]
    assert flat == sorted(flat, key=lambda k: (k is not None, k or 0))
    if rows:
        total, largest = sum(weights.values()), max(r["size"] for r in rows)
        slack = largest + 0.002 * total / shards
        assert all(abs(weights[s] - total / shards) <= slack for s in range(shards))


def test_query(spark, documents):
    rows = QUERIES["op2_sharding"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) and r["law"] == "bytes" for r in rows)
    check([r.asDict() | {"text": texts[r["doc_id"]]} for r in rows], list(texts.items()), 40)


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_odd_rows(spark, odd, shards):
    rows = shard_rows(odd, shards).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in odd.collect()], shards)


def test_many_equal_rows_are_cut(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("doc_id"),
                                    F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("same").alias("text"))
    rows = shard_rows(docs, 10).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 10)


def test_small_ranges(spark, documents, monkeypatch):
    monkeypatch.setattr("keypanel.llm.sharding.RANGE_BYTES", 20_000)
    docs = documents.select("doc_id", "text")
    check(shard_rows(docs, 7).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 7)


def test_two_level_search(spark, documents, monkeypatch):
    monkeypatch.setattr("keypanel.llm.sharding.SEARCHED", 5)
    docs = documents.select("doc_id", "text")
    check(shard_rows(docs, 23).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 23)


def test_empty(spark, empty):
    assert shard_rows(empty, 4).collect() == []
