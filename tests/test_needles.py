"""Rules held in a table give what testing every needle on every text gives."""

import random

import pytest
from pyspark.sql import functions as F

from keypanel.functions import rules as R
from keypanel.functions.text import WHITESPACE
from keypanel.operators import needles
from keypanel.operators.bitmaps import MOST_BITS, bit_array, bits_for, count_array, may_hold, place_of
from keypanel.operators.needles import classify_by_table, rules_table

RULES = "needle string, rank bigint, result string"


def plain(text, rules, default, missing):
    if text is None:
        return missing
    text = text.lower().strip(WHITESPACE)
    return next((result for needle, _, result in sorted(rules, key=lambda r: (r[1], r[0])) if needle in text), default)


def held(spark, texts, rules, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
    table = spark.createDataFrame([*rules, (None, 0, "never")], RULES)
    found = classify_by_table(df, "t", table, default="other", missing="unknown", **options).orderBy("id").collect()
    assert [r["category"] for r in found] == [plain(t, rules, "other", "unknown") for t in texts]


TEXTS = ["the cat sat on the mat", " THE END ", "", None, "abc", "x" * 300 + "needle" + "y" * 300, "🙂a🙂b🙂 and more🙂", "the cat sat on the mat",
         "a", "line\nbreak", "aaaaaaaaab", "abababababab"]
LIST = [("cat sat", 5, "cat"), ("the", 9, "the"), ("end", 3, "end"), ("needley", 2, "y"), ("xneedle", 2, "x"), ("🙂b🙂 and", 1, "smile"),
        ("b", 50, "b"), ("e\nb", 4, "line"), ("aaaab", 6, None), ("babab", 6, "bab"), ("absent from all", 0, "no")]


@pytest.mark.parametrize("piece", [7, 200])
def test_cases(spark, piece):
    held(spark, TEXTS, LIST, piece=piece)


def test_an_empty_needle_matches_every_text(spark):
    held(spark, TEXTS, [*LIST, ("", 4, "any")])
    held(spark, TEXTS, [("", 4, "any")])
    held(spark, TEXTS, [])


def test_random_texts(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcé ") for _ in range(rng.randint(1, n)))
    texts = [word(120) for _ in range(300)]
    rules = {word(9).strip() or "a": None for _ in range(150)}
    held(spark, texts, [(needle, rng.randint(0, 60), f"r{i}") for i, needle in enumerate(rules)], piece=25)


def test_needles_of_every_length_at_every_place(spark):
    text = "".join(random.Random(8).choice("abc") for _ in range(90))
    cut = [text[i:i + n] for n in range(1, 24) for i in (0, 1, 2, 3, 40, 90 - n)]
    held(spark, [" " * i + "z" * i + c + "z" * (7 - i) for i in range(8) for c in cut[i::8]], [(c, rank, f"r{rank}") for rank, c in enumerate(reversed(cut))], piece=30)


@pytest.mark.parametrize("rules", [R.BREATH_TEST, R.LOOKBACK_WORDS, R.OFFENSE_THRESHOLD])
def test_equal_to_the_column_form(spark, rules):
    texts = ["All offenders", "Seventy five years", "repeat", "no felony for a third", "second", "statute permits", "not explicitly", "", None, "permitted or prohibited"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = classify_by_table(df, "t", rules_table(spark, rules), default=rules.default, missing=rules.missing)
    both = both.withColumn("column_form", R.classify(F.col("t"), rules))
    assert both.where(~F.col("category").eqNullSafe(F.col("column_form"))).collect() == []


def test_plan_does_not_grow_with_the_list(spark):
    df = spark.createDataFrame([("some text with needle 00007 inside",)], "t string")

    def nodes(n):
        rules = spark.range(7, n).select(F.format_string("needle %05d", "id").alias("needle"), F.col("id").alias("rank"), F.col("id").cast("string").alias("result"))
        plan = classify_by_table(df, "t", rules)
        assert plan.collect()[0]["category"] == "7"
        return len(plan._jdf.queryExecution().optimizedPlan().toString().split("\n"))

    assert nodes(10) == nodes(10_000)


def test_texts_are_not_shuffled(spark):
    df = spark.createDataFrame([("a long text",)], "t string").withColumn("id", F.lit(1))
    rules = spark.createDataFrame([("long t", 1, "x")], RULES)
    plan = classify_by_table(df, "t", rules).select("id", "category")._jdf.queryExecution().optimizedPlan().toString()
    joined = [line for line in plan.split("\n") if "Project" in line and "_text" in line and " t#" in line.split("AS")[0]]
    assert joined == []


@pytest.fixture
def short_rounds(monkeypatch):
    """Rounds of few rules; gives the rows that each round indexed, and the texts that it looked up."""
    seen = []
    rarest, near = needles._rarest, needles._near
    monkeypatch.setattr(needles, "FIRST_ROUND", 4)
    monkeypatch.setattr(needles, "GROWTH", 2)
    monkeypatch.setattr(needles, "_rarest", lambda rows, n: seen.append([n]) or rarest(rows, n))
    monkeypatch.setattr(needles, "_near", lambda texts, *rest: seen[-1].append(texts.count()) or near(texts, *rest))
    return seen


def test_a_matched_text_is_not_searched_for_later_rules(spark, short_rounds, monkeypatch):
    monkeypatch.setattr(needles, "NEAR_EACH", 0)
    texts = [f"first rule wins here {i}" for i in range(40)] + ["only this has the last one", "nothing of all", None, ""]
    rules = [("rule wins", 0, "a")] + [(f"wins here {i}", 1 + i, f"late {i}") for i in range(40)] + [("the last one", 99, "z"), ("this has the", None, "null rank")]
    held_rules = [(n, r, x) for n, r, x in rules if r is not None]
    held(spark, texts, held_rules)
    assert len(short_rounds) > 2 and sum(n for n, _ in short_rounds) == len(held_rules)
    assert short_rounds[0][1] == 44 and all(searched <= 6 for _, searched in short_rounds[1:])
    df = spark.createDataFrame([(t,) for t in texts[-4:]], "t string")
    found = classify_by_table(df, "t", spark.createDataFrame(rules, RULES), default="other").collect()
    assert [r["category"] for r in found] == ["null rank", "other", None, "other"]


def test_rounds_give_what_all_rules_at_once_give(spark, short_rounds):
    rng = random.Random(11)
    word = lambda a, b: "".join(rng.choice("abcé ") for _ in range(rng.randint(a, b)))
    texts = [word(0, 90).upper() for _ in range(150)] + ["zzz", "Zzz ", None]
    rules = [(word(2, 20), rng.randint(0, 25), f"r{i}") for i in range(60)]
    held(spark, texts, [(n, r, x) for n, (r, x) in {n: (r, x) for n, r, x in rules}.items()])
    held(spark, texts, [("no such text in here %02d" % i, i, "never") for i in range(30)])
    assert len(short_rounds) > 2


def test_pairs_do_not_grow_with_texts_times_needles(spark):
    """All needles occur in all texts; the pieces shuffled are those that meet the first rules."""
    texts = spark.range(200).select(F.concat(F.lit("aa bb cc dd ee "), F.expr("array_join(transform(sequence(0, 299), i -> lpad(i, 9, 'q')), ' ')"), F.col("id").cast("string")).alias("t"))
    rules = spark.range(300).select(F.expr("lpad(id, 9, 'q')").alias("needle"), (F.col("id") + 1).alias("rank"), F.col("id").cast("string").alias("result"))
    kept, rows = needles.stored, []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(needles, "FIRST_ROUND", 4)
        patch.setattr(needles, "stored", lambda df: rows.append(kept(df)) or rows[-1])
        found = classify_by_table(texts, "t", rules).select("category").distinct().collect()
    assert [r["category"] for r in found] == ["0"]
    index = max(r.count() for r in rows if "gram" in r.columns)
    assert index < 50  # of 600 in all


def test_rows_are_not_shuffled_to_choose_a_gram(spark):
    listed = needles._with_classes(spark.createDataFrame([(f"https://one.two/{i:04d}/index.html", i, "x") for i in range(500)], RULES))
    index = needles._rarest(listed, 500)
    assert index.groupBy("gram").count().agg(F.max("count")).first()[0] <= 60  # not the 500 of a shared beginning
    assert index.groupBy("needle").count().where("count > 4").count() == 0


def test_counts_by_hash(spark):
    rows = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [("c",)], "k string")
    counts = count_array(rows, ["k"], 1 << 12)
    found = rows.distinct().select("k", F.get(counts, place_of(1 << 12, F.col("k")).cast("int")).alias("n"))
    assert {r["k"]: r["n"] for r in found.collect()} == {"a": 5, "b": 2, "c": 1}


def test_a_text_is_not_needed_after_its_digest(spark):
    df = spark.range(9).select("id", F.format_string("text %s", "id").alias("t"))
    rules = spark.createDataFrame([("text 1", 1, "x")], RULES)
    plan = classify_by_table(df, "t", rules).select("id", "category")._jdf.queryExecution().optimizedPlan().toString()
    _, below = plan.split("Join LeftOuter")
    left = next(line for line in below.split("\n") if "Project" in line)
    assert "AS _text" in left and "AS t#" not in left and ", t#" not in left


def test_a_column_of_that_name_is_refused(spark):
    with pytest.raises(ValueError, match="already"):
        classify_by_table(spark.createDataFrame([("a",)], "t string"), "t", spark.createDataFrame([], RULES), name="t")


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_bit_arrays_never_miss_a_key(spark, n):
    keys, bits = spark.range(n), bits_for(n)
    words = bit_array(keys, ["id"], bits)
    hits = spark.range(20_000).where(may_hold(words, bits, F.col("id")))
    found = {r["id"] for r in hits.collect()}
    assert set(range(n)) <= found and len(found) < n + 2500
    assert bits_for(1 << 40) == MOST_BITS
