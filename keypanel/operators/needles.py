"""First-match substring rules held in a table: thousands of needles, one plan.

``functions.rules.classify`` tests every needle on every row and its plan grows with the
list.  Here a needle is found by a q-gram of its own.  Texts give a q-gram at every
``step``-th letter; a needle at least ``size + step - 1`` letters long has one of these
wherever it begins, so it is indexed once for each remainder of its place, of its q-grams
by one that few needles hold.  Q-grams of texts that a bit array rules out go on the map
side, the others meet the needles in an equi-join, the needle itself is looked for in the
piece of text around, and the first rule by rank stays.

A common needle occurs in most texts, so what all needles meet grows with the product of
texts and needles.  Only the first rule counts: rules are taken by rank in a few rounds,
each several times as many as all before, and a text that a round has matched is not
searched again.  A text that n rules have missed is met by few of the next ones, so what
is shuffled follows the texts.  Texts without any match are searched once in each round.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keypanel.functions.rules import RuleSet
from keypanel.functions.text import normalized
from keypanel.operators.bitmaps import bit_array, bits_for, count_array, has_bit, may_hold, place_of
from keypanel.session import stored

# Needles by their letters: (least letters, size of a q-gram, step); shorter ones are a q-gram themselves.
CLASSES = ((16, 12, 4), (9, 8, 2), (5, 5, 1))
# Letters of the pieces that texts are cut into, besides those around; a letter of a piece is found by
# counting from its start, so pieces are short.
PIECE = 32
# Rules of the first round, about, how many times as many each further one has at least, and for each
# text the pieces that meet a needle in a round for which it may take more than that.
FIRST_ROUND = 4096
GROWTH = 8
NEAR_EACH = 32
# Times the usual number of bits: a text or q-gram wrongly taken for a likely one is searched or shuffled.
SURE = 16
# Places of a needle that are tried for each remainder (all of a needle up to 15 letters), and counters of q-grams, at most.
TRIED = 4
MOST_COUNTERS = 1 << 18


def rules_table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    """The rules of a rule set as rows (needle, rank, result)."""
    rows = [(needle, rank, result) for rank, (needles, result) in enumerate(rules.rules) for needle in needles]
    return spark.createDataFrame(rows, f"needle string, rank bigint, result {rules.type_name}")


def classify_by_table(df: DataFrame, column: str, rules: DataFrame, name: str = "category", default: Any = None,
                      missing: Any = None, piece: int = PIECE) -> DataFrame:
    """Add the result of the first rule (by rank, then needle) whose needle occurs in the normalized text.

    ``rules`` has rows (needle, rank, result) in any number.  Without a match the result is
    ``default``, for NULL text ``missing``.  NULL needles match nothing, an empty one
    matches every text.  Texts are told apart by digest, so a text of many rows is
    answered once, and of a text only the short pieces around q-grams that may belong to a
    needle are shuffled, whatever its length.  The texts are searched when this is called;
    the returned table joins what was found.  Of ``df`` only columns that are used later
    are shuffled: select away a long text that is not.
    """
    if name in df.columns:
        raise ValueError(f"the table already has a column {name!r}")
    kind = rules.schema["result"].dataType
    first_rule = rules.where("needle IS NOT NULL").groupBy("needle").agg(F.min(F.struct(F.col("rank").cast("bigint").alias("rank"), "result")).alias("r"))
    listed = stored(_with_classes(first_rule.select("needle", "r.*")))
    first = _first_matches(df.select(F.col(f"`{column}`").alias("raw")), listed, piece).groupBy("_text").agg(F.min("best").alias("_best"))

    anywhere = listed.where("needle = ''").agg(F.min(F.struct("rank", "needle", "result")).alias("best")).scalar()
    best = F.least(F.col("_best"), anywhere)
    result = (F.when(F.col("_text").isNull(), F.lit(missing).cast(kind))  # the text itself is not asked for, so a join need not move it
              .when(best.isNull(), F.lit(default).cast(kind)).otherwise(best["result"]))
    return df.withColumn("_text", _digest(f"`{column}`")).join(first, "_text", "left").select(*[F.col(f"`{c}`") for c in df.columns], result.alias(name))


def _first_matches(texts: DataFrame, listed: DataFrame, piece: int) -> DataFrame:
    """(_text, best) for texts (``raw``) in which a needle occurs; a text's least ``best`` is its first rule.

    Rounds take the rules by rank.  A later rule cannot win a text that a round has matched, so the next
    one searches only the others, and a text meets few needles however many occur in it.
    """
    listed = listed.where("needle <> ''")
    after = [F.coalesce((F.col("rank") > cut).cast("int"), F.lit(0)) for cut in _cuts(listed)]
    listed = listed.withColumn("level", reduce(Column.__add__, after, F.lit(0)))
    held = listed.groupBy("level", "size", "step").agg(F.max("letters").alias("letters"), F.count("*").alias("n")).collect()  # at most seven rows for each level
    levels, searched, left, parts = sorted({r["level"] for r in held}), texts, None, []
    now = levels[:1]
    while now:
        own = [r for r in held if r["level"] in now]
        n = sum(r["n"] for r in own)
        index, pairs = _rarest(listed.where(F.col("level").between(now[0], now[-1])), n), Observation()
        met = _near(searched, own, index, piece).join(index, "gram").observe(pairs, F.count(F.lit(1)).alias("n"))
        parts.append(stored(met.where(F.col("piece").contains(F.col("needle"))).groupBy("_text").agg(F.min(F.struct("rank", "needle", "result")).alias("best"))))
        later = levels[levels.index(now[-1]) + 1:]
        if not later:
            break
        if left is None:
            left = stored(texts.where("raw <> ''").select(F.xxhash64("raw").alias("hash"), _digest("raw").alias("_text")).distinct())
            every = left.count()
        were, left = left.count(), stored(left.join(parts[-1], "_text", "left_anti"))
        if not (rows := left.count()):
            break
        bits = bits_for(rows * SURE)
        searched = texts.where(may_hold(bit_array(left, ["hash"], bits), bits, F.xxhash64("raw")))
        most = n * NEAR_EACH * every / max(pairs.get["n"] * rows / were, 1)  # rules that will meet so many pieces
        more = accumulate(sum(r["n"] for r in held if r["level"] == k) for k in later)
        now = later[:max(1, sum(n <= most for n in more))]
    best = T.StructType([T.StructField("rank", T.LongType()), T.StructField("needle", T.StringType()), listed.schema["result"]])
    return reduce(DataFrame.unionByName, parts) if parts else texts.sparkSession.createDataFrame([], T.StructType([T.StructField("_text", T.BinaryType()), T.StructField("best", best)]))


def _cuts(listed: DataFrame) -> list[int]:
    """Ranks at which rounds end: the first has ``FIRST_ROUND`` rules, about, each further one ``GROWTH`` times as many as before it."""
    ends, n = [FIRST_ROUND], listed.count()
    while 2 * ends[-1] * GROWTH < n:
        ends.append(ends[-1] * GROWTH)
    if 2 * FIRST_ROUND >= n:
        return []
    return sorted(set(listed.agg(F.percentile_approx("rank", [end / n for end in ends])).first()[0] or []))


def _digest(column: str) -> Column:
    """128 bits of a SHA-256 digest."""
    return F.substring(F.unhex(F.sha2(F.col(column), 256)), 1, 16)


def _near(texts: DataFrame, classes: list[Row], index: DataFrame, piece: int) -> DataFrame:
    """(_text, piece, gram) for q-grams that may be in the index; classes whose needles fit into a piece share one pass."""
    texts = texts.select(_digest("raw").alias("_text"), normalized(F.col("raw")).alias("t")).where("t <> ''")
    bits = bits_for(index.count() * SURE)
    words = bit_array(index, ["gram"], bits)
    letters: dict[tuple[int, int], int] = {}
    for r in classes:
        letters[r["size"], r["step"]] = max(r["letters"], letters.get((r["size"], r["step"]), 0))
    passes: dict[int, list[tuple[int, int, int]]] = {}
    for (size, step), longest in sorted(letters.items()):
        passes.setdefault(max(piece, longest), []).append((size, step, longest))
    return reduce(DataFrame.unionByName, [_occurrences(texts, kinds, _even(length), words, bits) for length, kinds in sorted(passes.items())])


def _pieces(texts: DataFrame, letters: int, needle: int, gram: int) -> DataFrame:
    """Texts in short pieces; linear in the text.

    ``core`` has ``n`` letters of its own, each letter of a text in one core, and those of a q-gram that
    begins in the last of them; ``piece`` has the letters around them that a needle may reach, ``skip`` before.
    """
    around = _even(needle - 1)
    ahead = F.lit(f"(?s)(?=(.{{1,{around + letters + needle - 1}}})).{{1,{letters}}}")
    cut = texts.select("_text", F.posexplode(F.regexp_extract_all("t", ahead, F.lit(1))).alias("i", "piece"))
    first = F.col("i") == 0
    return cut.select("_text", "piece", F.when(first, 0).otherwise(around).alias("skip"), F.when(first, around + letters).otherwise(letters).alias("n"),
                      F.when(first, F.left("piece", F.lit(around + letters + gram - 1)))
                      .otherwise(F.substring("piece", around + 1, letters + gram - 1)).alias("core"))


def _even(letters: int) -> int:
    """At least so many letters; q-grams keep their distance across pieces that are multiples of every step."""
    steps = max(step for _, _, step in CLASSES)
    return -(-letters // steps) * steps


def _with_classes(needles: DataFrame) -> DataFrame:
    """Needles with their letters, the size of their q-grams and the step that they are long enough for."""
    letters = F.char_length("needle")
    size, step = letters, F.lit(1)
    for least, own_size, own_step in reversed(CLASSES):
        size = F.when(letters >= least, own_size).otherwise(size)
        step = F.when(letters >= least, own_step).otherwise(step)
    return needles.select("*", letters.alias("letters"), size.alias("size"), step.alias("step"))


def _occurrences(texts: DataFrame, kinds: list[tuple[int, int, int]], letters: int, words: Column, bits: int) -> DataFrame:
    """(_text, piece, gram) for q-grams (size, step, letters of the longest needle) of the texts that may be wanted ones.

    The others go before any shuffle; a piece has the letters that a needle with this q-gram may have.
    """
    most, least, every = max(kinds)[0], min(kinds)[0], min(step for _, step, _ in kinds)
    pieces = _pieces(texts, letters, max(longest for _, _, longest in kinds), most)
    starts = F.sequence(F.lit(1), F.least(F.char_length("core") - (least - 1), F.col("n")), F.lit(every))
    at = pieces.where(F.char_length("core") >= least).select("*", F.explode(starts).alias("at"))
    # A generated column is computed once, an expression in a filter as often as it is named.
    hashes = []
    for size, step, _ in kinds:
        place = place_of(bits, F.substring("core", F.col("at"), F.lit(size)))
        hashes.append(place if step == every else F.when(F.col("at") % step == 1, place))
    likely = at.select("*", F.posexplode(F.array(*hashes)).alias("kind", "place")).where(has_bit(words, F.col("place")))
    size, longest = (F.get(F.array(*[F.lit(k[i]) for k in kinds]), F.col("kind")) for i in (0, 2))
    begin = F.greatest(F.lit(1), F.col("skip") + F.col("at") - (longest - size))
    return likely.select("_text", F.substring("piece", begin, 2 * longest - size).alias("piece"), F.substring("core", F.col("at"), size).alias("gram"))


def _rarest(needles: DataFrame, n: int) -> DataFrame:
    """Each needle with a q-gram for every remainder of its place: of some spread over it, that which the fewest needles hold.

    Needles are counted by the hash of a q-gram, so no row leaves its task for the choice.
    """
    last = F.col("letters") - (F.col("size") - 1)
    held = needles.select("needle", "size", F.explode(F.sequence(F.lit(1), last)).alias("at")).select(F.substring("needle", F.col("at"), F.col("size")).alias("gram"))
    counters = min(bits_for(n), MOST_COUNTERS)
    counts = count_array(held, ["gram"], counters)

    each = needles.select("needle", "rank", "result", "size", "step", last.alias("last"), F.explode(F.sequence(F.lit(1), F.col("step"))).alias("at"))
    more = F.floor((F.col("last") - F.col("at")) / F.col("step"))  # places of this remainder after the first one
    tried = []
    for i in range(TRIED):
        gram = F.substring("needle", (F.col("at") + F.col("step") * F.floor(more * i / (TRIED - 1))).cast("int"), F.col("size"))
        tried.append(F.struct(F.get(counts, place_of(counters, gram).cast("int")).alias("n"), gram.alias("gram")))
    return stored(each.select("needle", "rank", "result", F.array_min(F.array(*tried))["gram"].alias("gram")))
