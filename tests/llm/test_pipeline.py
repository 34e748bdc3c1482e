"""The pipeline against a plain version of every stage."""

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from keypanel.llm.packing import cut
from keypanel.llm.quality_rules import RULES, STOP_WORDS

from conftest_llm import SF
from test_jaccard_join import brute
from test_native import contamination, counts
from test_packing import TOKENIZER, check_layout

STOPS = {w for line in STOP_WORDS.values() for w in line.split()}


def passes(text):
    n, chars, symbols, dup, repeated = counts(text)
    if n < 50 or 100 * repeated > 50 * n:
        return False
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    stops = sum(w.lower() in STOPS for w in re.findall(r"[^\x20\x09-\x0D]+", text))
    value = {"n_words": n, "mean_word_chars": chars / n, "symbol_ratio": symbols / n, "stop_word_ratio": stops / n,
             "dup_line_ratio": dup / len(lines), "repeat_word_ratio": repeated / n}
    return all((low is None or value[m] >= low) and (high is None or value[m] <= high) for m, low, high in RULES)


def plain_run(rows, items):
    """(doc_id, text) of the documents that reach packing."""
    rows = [r for r in rows if r[1] is not None and passes(r[1])]
    rows = [r for r, (least, _) in zip(rows, brute(rows)) if r[0] == least]
    rows = list(dict.fromkeys(rows))
    return [r for r in rows if contamination(r[1], items)[1] == 0]


def check(found, texts):
    want = Counter()
    for doc, text in texts:
        ids = TOKENIZER.encode(text, add_special_tokens=False).ids + [0]
        for piece, (start, length) in enumerate(cut(len(ids), 2048)):
            want[(doc, piece, start, length, zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    return check_layout(found)


def test_run(spark, documents):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = plain_run([(r["doc_id"], r["text"]) for r in documents.collect()], items)
    assert 0 < len(texts) < documents.count()
    check(corpus_pipeline.run(spark, SF).collect(), texts)


def test_stages_keep_the_columns_and_take_awkward_rows(spark, documents, odd, tmp_path):
    """Repeated rows, nulls and clashing columns next to real documents; each stage written and read again."""
    extra = documents.columns
    docs = odd.unionByName(documents.limit(60), allowMissingColumns=True).unionByName(documents.limit(60), allowMissingColumns=True)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = plain_run([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert i == 3 or out.columns == columns, name
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    check(docs.withColumn("ids_crc32", F.crc32("ids")).collect(), want)
    assert set(extra) <= set(columns)


def test_empty(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_stages_are_those_ordered():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
