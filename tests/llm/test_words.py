"""Places of word k-grams, by broadcast and by shuffle."""

import pytest
from pyspark.sql import functions as F

from keypanel.llm import words

from conftest_llm import plain


@pytest.fixture
def grams(spark):
    rows = [(5, "one two three four five"), (5, "two three four five six"), (5, "word word word word word"), (2, "1 2"), (2, "not there")]
    return spark.createDataFrame(rows, "size int, gram string")


def expected(rows, grams):
    found = set()
    for text in {r["text"] for r in rows if r["text"] is not None}:
        w = plain(text)
        for size, gram in grams:
            found |= {(len(w), size, pos, gram) for pos in range(len(w) - size + 1) if w[pos:pos + size] == gram.split(" ")}
    return found


@pytest.mark.parametrize("most", [words.BROADCAST_BYTES, 0])
def test_places(spark, odd, grams, monkeypatch, most):
    monkeypatch.setattr(words, "BROADCAST_BYTES", most)
    docs = odd.unionByName(spark.createDataFrame([(77, "x 1 2 1 2")], "doc_id long, text string"), allowMissingColumns=True)
    found = words.gram_occurrences(docs, grams)
    assert {(r["n_words"], r["size"], r["pos"], r["gram"]) for r in found.collect()} == expected(docs.select("text").collect(), grams.collect())


def test_no_array_of_words_is_shuffled(spark, documents, grams, monkeypatch):
    """What goes into the exchanges grows with the words of a text and not with their square."""
    monkeypatch.setattr(words, "BROADCAST_BYTES", 0)
    grams = grams.unionByName(spark.createDataFrame([(5, "w1 w2 w3 w4 w5")], "size int, gram string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")

    def written(n):
        found = []

        def walk(node):
            kind = node.getClass().getSimpleName()
            if kind == "AdaptiveSparkPlanExec":
                return walk(node.executedPlan())
            if kind == "ShuffleExchangeExec":
                found.append(node.metrics().apply("dataSize").value())
            if kind.endswith("QueryStageExec"):
                return walk(node.plan())
            for i in range(node.children().size()):
                walk(node.children().apply(i))

        text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("w"), (i % 97).cast("string"))), " ")
        df = words.gram_occurrences(spark.range(1).select(text.alias("text")), grams)
        df.collect()
        walk(df._jdf.queryExecution().executedPlan())
        return sum(found)

    try:
        small, large = written(20_000), written(200_000)
        assert small > 20_000 and large < 12 * small and large < 200 * 200_000
        docs = words.gram_occurrences(documents, grams)
        plan = docs._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" in plan and "broadcast" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
