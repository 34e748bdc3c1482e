"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a column expression over one row: no shuffle, no user function.
``RULES`` names a measure with its least and its greatest value; ``compile_rules``
turns the table into one boolean column.

Defined cases: a missing text counts as one without words, which fails.  Rows are
judged one by one, so repeated rows get equal verdicts.  Extra columns pass
through; columns named like a measure are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent words of the corpus languages.
STOP_WORDS = {
    "en": "the of and to in that is with for as on this be at",
    "de": "der die das und in zu den von mit ist auf im",
    "fr": "le la les de des et en un une que pour dans",
    "es": "el la los las de que y en un se por con",
}

# measure, least value, greatest value (None: open)
RULES = (
    ("n_words", 50, None),
    ("mean_word_chars", 2.0, 15.0),
    ("symbol_ratio", None, 0.5),
    ("stop_word_ratio", 0.01, None),
    ("dup_line_ratio", None, 0.5),
    ("repeat_word_ratio", None, 0.5),
)

# In-text positions packed next to a hash prefix; longer texts compare structs instead.
POSITION_BITS = 24


def text_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def _clean(text: Column, characters: str) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), characters, "")


def word_chars(text: Column) -> Column:
    return F.char_length(_clean(text, SPACE)).cast("long")


def symbol_count(text: Column) -> Column:
    return (F.char_length(F.coalesce(text, F.lit(""))) - F.char_length(_clean(text, SYMBOLS))).cast("long")


def duplicate_lines(text: Column) -> Column:
    """(lines with a word, those of them equal to an earlier one)."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(F.size(lines).cast("long").alias("n_lines"),
                    (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))


def _covered(positions: Column) -> Column:
    """Words covered by three-word windows at ascending distinct positions."""
    last = F.size(positions) - 1
    return F.when(last < 0, F.lit(0)).otherwise(3 + F.aggregate(
        F.slice(positions, 2, F.greatest(last, F.lit(0))),
        F.struct(F.lit(0).alias("n"), F.get(positions, F.lit(0)).cast("int").alias("at")),
        lambda acc, p: F.struct((acc["n"] + F.least(p.cast("int") - acc["at"], F.lit(3))).alias("n"), p.cast("int").alias("at")),
        lambda acc: acc["n"]))


def with_repeated_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words in windows of ``_grams`` that occur twice or more.

    Positions are sorted next to the leading bits of their hash, so equal windows
    become neighbours.  If different hashes share those bits, or the text is longer
    than the position field, whole hashes are sorted instead.  Steps are columns of
    their own because an expression inside a lambda is computed for every element.
    """
    grams, low = F.col("_llm_grams"), F.lit((1 << POSITION_BITS) - 1).cast("long")
    no_longs = F.array().cast("array<bigint>")

    def hits(order: Column, position, value) -> Column:
        """Sorted positions whose neighbour in ``order`` holds the same window."""
        def same(x, other):
            return F.coalesce(value(x) == value(other), F.lit(False))
        return F.sort_array(F.filter(
            F.transform(order, lambda x, i: F.when(
                same(x, F.get(order, i - 1)) | same(x, F.get(order, i + 1)), position(x).cast("int"))),
            lambda p: p.isNotNull()))

    df = df.withColumn("_llm_distinct", F.size(F.array_distinct(grams)))
    df = df.withColumn("_llm_repeats", F.col("_llm_distinct") < F.size(grams))
    df = df.withColumn("_llm_packs", F.col("_llm_repeats") & (F.size(grams) < (1 << POSITION_BITS)) & (F.col("_llm_distinct") == F.size(
        F.array_distinct(F.transform(grams, lambda h: F.shiftright(h, POSITION_BITS))))))
    df = df.withColumn("_llm_order", F.when(F.col("_llm_packs"), F.sort_array(F.transform(
        grams, lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))))).otherwise(no_longs))
    df = df.withColumn("_llm_whole", F.when(F.col("_llm_repeats") & ~F.col("_llm_packs"), F.sort_array(F.transform(
        grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("_llm_hits", F.when(F.col("_llm_whole").isNull(), hits(
        F.col("_llm_order"), lambda x: x.bitwiseAND(low), lambda x: F.shiftright(x, POSITION_BITS))).otherwise(
        hits(F.col("_llm_whole"), lambda x: x["i"], lambda x: x["h"])))
    # The row number is always there.  It keeps a later filter on the result above these
    # steps; pushed below them, it would hold every step's expression many times over.
    numbered = F.monotonically_increasing_id() >= 0
    return df.withColumn("n_repeat_words", F.when(numbered, _covered(F.col("_llm_hits"))).cast("long")).drop(
        "_llm_distinct", "_llm_repeats", "_llm_packs", "_llm_order", "_llm_whole", "_llm_hits")


def window_hashes(array: Column) -> Column:
    n = F.size(array)
    return F.when(n < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.slice(array, 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(array, i + 1), F.get(array, i + 2))))


def stop_word_count(array: Column) -> Column:
    stops = sorted({w for line in STOP_WORDS.values() for w in line.split()})
    return F.size(F.filter(array, lambda w: F.lower(w).isin(stops))).cast("long")


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows with the measures the rules name."""
    t = F.col(text)
    df = df.withColumn("_llm_words", text_words(t))
    df = df.withColumns({"_llm_grams": window_hashes(F.col("_llm_words")), "_llm_lines": duplicate_lines(t)})
    df = with_repeated_words(df).withColumns({
        "n_words": F.size("_llm_words").cast("long"), "word_chars": word_chars(t), "n_symbols": symbol_count(t),
        "n_dup_lines": F.col("_llm_lines.n_dup_lines"),
        "n_stop_words": stop_word_count(F.col("_llm_words")), "n_lines": F.col("_llm_lines.n_lines")}).drop("_llm_words", "_llm_grams", "_llm_lines")
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    return df.withColumns({
        "mean_word_chars": F.col("word_chars") / per_word, "symbol_ratio": F.col("n_symbols") / per_word,
        "stop_word_ratio": F.col("n_stop_words") / per_word, "repeat_word_ratio": F.col("n_repeat_words") / per_word,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))})


def compile_rules(rules=RULES) -> Column:
    """One boolean column: every measure lies within its bounds."""
    holds = F.lit(True)
    for measure, least, greatest in rules:
        if least is not None:
            holds = holds & (F.col(measure) >= F.lit(least))
        if greatest is not None:
            holds = holds & (F.col(measure) <= F.lit(greatest))
    return holds


def judge_quality(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Rows with all measures, ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured(df, text).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & compile_rules(rules))
