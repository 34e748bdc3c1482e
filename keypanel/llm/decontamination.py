"""Benchmark decontamination: exact item windows in documents, by a prefix-filtered set join.

An item is cut into windows of ten consecutive words (an item of fewer is one
window).  A window is a set of word shingles, and it is in a document only if all
of them are.  So one necessary shingle per window is enough to find candidates:
its rarest, counted over all documents.  Candidates pass position and length
bounds and are verified word by word over the window.

Texts are read once for the places of benchmark shingles (one generate and one
hash join in one stage); that small table is written to the checkpoint folder,
gives the counts, and serves the prefix join and the verification.  A text that
many rows hold is handled once.

Defined cases: missing and empty texts have no words and no hits.  Items with the
same id are one item with the windows of all its rows; a missing item id counts
as the id ''.  Repeated document rows get equal results, each on its own row.
Extra columns pass through; result columns replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keypanel.llm.words import broadcast_if_bounded, digest, gram_occurrences, words
from keypanel.session import stored

WINDOW = 10
SHINGLE = 5


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, window text, length): each distinct window of each item."""
    split = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                         words(F.col("text")).alias("w")).where(F.size("w") > 0)
    return split.select(
        "item", F.least(F.size("w"), F.lit(window)).alias("length"), "w",
        F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("at")).select(
        "item", "length", F.array_join(F.slice("w", F.col("at") + 1, F.col("length")), " ").alias("window")).distinct()


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(window, length, size, at, gram): the shingles of each distinct window."""
    split = windows.select("window", "length").distinct().select(
        "window", "length", F.split("window", " ").alias("w"), F.least("length", F.lit(shingle)).alias("size"))
    return split.select("window", "length", "size", "w", F.explode(
        F.sequence(F.lit(0), F.col("length") - F.col("size"))).alias("at")).select(
        "window", "length", "size", "at", F.array_join(F.slice("w", F.col("at") + 1, F.col("size")), " ").alias("gram"))


def window_hits(docs: DataFrame, windows: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(digest, start, length, window): every place in every distinct text that holds a window."""
    shingles = stored(window_shingles(windows, shingle))
    places = stored(gram_occurrences(docs, shingles.select("size", "gram").distinct(), text))

    # Rarity over all documents; a shingle that never occurs rules its window out.
    rarity = places.groupBy("gram").agg(F.count("*").alias("frequency"))
    ranked = shingles.join(rarity, "gram", "left").groupBy("window", "length", "size").agg(
        F.min(F.struct(F.coalesce("frequency", F.lit(0)).alias("frequency"), "gram", "at")).alias("rarest"))
    prefixes = ranked.where("rarest.frequency > 0").select(
        "window", "length", "size", F.col("rarest.gram").alias("gram"), F.col("rarest.at").alias("at"))
    candidates = places.select("digest", "pos", "n_words", "gram").join(
        broadcast_if_bounded(prefixes, 300), "gram").select(
        "digest", "window", "length", "size", "n_words", (F.col("pos") - F.col("at")).alias("start"))
    candidates = candidates.where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))

    # Verification: shingles that together cover the window, each at its place.
    cover = F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.ceil(F.col("length") / F.col("size")).cast("int") - 1),
        lambda k: F.least(k * F.col("size"), F.col("length") - F.col("size"))))
    needed = candidates.withColumn("cover", cover).select(
        "digest", "window", "length", "start", F.size("cover").alias("needed"), F.explode("cover").alias("at"),
        F.split("window", " ").alias("w"), "size").select(
        "digest", "window", "length", "start", "needed", (F.col("start") + F.col("at")).alias("pos"),
        F.array_join(F.slice("w", F.col("at") + 1, F.col("size")), " ").alias("gram"))
    return needed.join(places.select("digest", "pos", "gram"), ["digest", "pos", "gram"]).groupBy(
        "digest", "start", "length", "window", "needed").agg(F.count("*").alias("found")).where(
        "found = needed").select("digest", "start", "length", "window")


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text",
                  window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """All documents with ``n_words``, ``n_hit``, ``items`` (sorted ids), ``n_items`` and ``contaminated``."""
    windows = stored(item_windows(items, window))
    hits = stored(window_hits(docs, windows, text, shingle))
    covered = hits.select("digest", "start", "length").distinct().select(
        "digest", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("at")).distinct()
    counts = covered.groupBy("digest").agg(F.count("*").alias("n_hit"))
    held = hits.select("digest", "window").distinct().join(
        broadcast_if_bounded(windows.select("window", "item"), 200), "window").select("digest", "item").distinct()
    held = held.groupBy("digest").agg(F.sort_array(F.collect_list("item")).alias("items"))
    results = stored(counts.join(held, "digest").withColumnRenamed("digest", "_llm_digest"))
    out = docs.drop("n_words", "n_hit", "items", "n_items", "contaminated").withColumns({
        "_llm_key": digest(F.col(text)), "n_words": F.size(words(F.col(text))).cast("long")})
    return out.join(broadcast_if_bounded(results, 400), F.col("_llm_key") == F.col("_llm_digest"), "left").drop("_llm_key", "_llm_digest").withColumns({
        "n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"),
        "items": F.coalesce("items", F.array().cast("array<string>")),
        "n_items": F.coalesce(F.size("items"), F.lit(0)).cast("long"),
        "contaminated": F.coalesce(F.col("n_hit") > 0, F.lit(False))})
