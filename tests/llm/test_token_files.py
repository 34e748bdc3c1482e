import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keypanel.llm.queries import QUERIES
from keypanel.llm.token_files import build_mph, find_slots, lookup, read_documents, read_keys, shard_key, write_shards, write_token_files

from conftest_llm import SF, WORDS

TOKENIZER = Tokenizer.from_file(WORDS)


def ids(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def read_all(spark, docs, folder, shard_bytes=1 << 24):
    buckets = write_token_files(docs, folder, WORDS, 2, shard_bytes=shard_bytes)
    keys = docs.select(shard_key(F.col("doc_id")).alias("key")).distinct()
    return buckets, read_documents(spark, keys, folder, buckets, 2)


def test_query(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op5_token_files"](spark, SF).collect()}
    start = 0
    texts = sorted((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    for doc, text in texts:
        want = ids(text)
        assert (rows[doc]["start"], rows[doc]["n_tokens"], rows[doc]["ids_crc32"]) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


@pytest.mark.parametrize("shard_bytes", [1 << 24, 2000])
def test_odd_rows(spark, odd, tmp_path, shard_bytes):
    _, found = read_all(spark, odd, str(tmp_path / "t"), shard_bytes)
    rows = sorted(found.collect(), key=lambda r: r["start"])
    want = sorted(((r["doc_id"], ids(r["text"]).tobytes()) for r in odd.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    got = sorted(((r["key"], bytes(r["ids"])) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert got == want
    assert [r["start"] for r in rows] == list(np.cumsum([0] + [r["n"] for r in rows])[:-1])
    assert [r["key"] is not None for r in rows] == sorted(r["key"] is not None for r in rows)
    named = [r["key"] for r in rows if r["key"] is not None]
    assert named == sorted(named)


def test_unknown_keys_are_not_found(spark, documents, tmp_path):
    buckets, _ = read_all(spark, documents.select("doc_id", "text"), str(tmp_path / "t"))
    wanted = spark.range(-500, 1000).withColumnRenamed("id", "key")
    found = lookup(wanted, spark.read.parquet(str(tmp_path / "t/index")), buckets)
    assert sorted(r["key"] for r in found.collect()) == sorted(r["doc_id"] for r in documents.select("doc_id").collect())


def test_keys_are_read_by_the_index_alone(spark, odd, documents, tmp_path):
    """Same documents as by reading all; of a single key one index row and one shard file are read."""
    for number, (docs, keys) in enumerate([(odd, [1, None, 2, 7, 99, 1]), (documents, [3, 40, 10**9])]):
        folder = str(tmp_path / str(number))
        buckets, whole = read_all(spark, docs, folder, 2000)
        want = sorted((tuple(r) for r in whole.collect() if r["key"] in keys), key=lambda r: r[1])
        assert sorted((tuple(r) for r in read_keys(spark, keys, folder, buckets, 2).collect()), key=lambda r: r[1]) == want and want
    one = read_keys(spark, [40], folder, buckets, 2)
    assert one.count() == 1
    assert [f.rsplit("/", 1)[1].startswith("part-") for f in one.inputFiles() if "/shards/" in f] == [True]
    assert read_keys(spark, [10**9], folder, buckets, 2).collect() == []
    with pytest.raises(ValueError, match="as a table"):
        read_keys(spark, list(range(1001)), folder, buckets, 2)


def test_end_ids_that_cannot_be_written_are_refused(spark, odd, tmp_path):
    for end_id in (200, 40000):
        with pytest.raises(ValueError, match="end id"):
            write_shards(odd, str(tmp_path / "t"), WORDS, end_id)


def test_empty(spark, empty, tmp_path):
    _, found = read_all(spark, empty, str(tmp_path / "t"))
    assert found.collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 100, 1024, 3000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).choice(1 << 62, n, replace=False).astype(np.uint64)
    seed, displacements, slots = build_mph(keys)
    assert sorted(slots) == list(range(n))
    assert list(find_slots(keys, seed, displacements, n)) == list(slots)
