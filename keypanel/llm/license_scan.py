"""License scans by diagonal voting.

Rolling word 3-grams of all texts meet the 3-grams of license templates in an
equi-join.  A match at word ``p`` of a text and word ``t`` of a template votes for
the diagonal ``p - t``.  Votes are counted per text, template and diagonal;
neighbouring diagonals, which inserted or missing words make, are merged into one
span; and a span is verified by the share of the template's words that its matches
cover.  A short phrase must stand in full on a single diagonal.

Defined cases: a missing or empty text has no words, no labels and score 0.
Repeated rows get equal results, each on its own row; a text that many rows hold
is scanned once.  Extra columns pass through; result columns replace columns of
the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keypanel.llm.words import broadcast_if_bounded, digest, gram_occurrences, words
from keypanel.session import stored

K = 3
GAP_WORDS = 6      # diagonals this near belong to one span
LEAST_SHARE = 0.6  # of a template's words, for a span to hold

# Phrases that name a license, and the label of each.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Public license notices, in lower case without punctuation.
TEMPLATES = (
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction"),
    ("apache-2-notice", "licensed under the apache license version 2 0 the license you may not use this file except "
                        "in compliance with the license"),
    ("gpl", "licensed under the gnu general public license version"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the "
                   "gnu general public license as published by the free software foundation"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted "
                   "provided that the following conditions are met"),
    ("cc-by-notice", "this work is licensed under a creative commons attribution"),
)


def template_table(spark, templates) -> DataFrame:
    """(label, n, tpos, gram) of each 3-gram; as small as the list it comes from."""
    rows = [(label, len(text.split()), i, " ".join(text.split()[i:i + K]))
            for label, text in templates for i in range(len(text.split()) - K + 1)]
    return spark.createDataFrame(rows, "label string, n int, tpos int, gram string")


def scan_votes(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, text: str = "text") -> DataFrame:
    """(digest, kind, label, n, diagonal, tpos, pos): one row per vote."""
    table = template_table(docs.sparkSession, phrases).withColumn("kind", F.lit("phrase")).unionByName(
        template_table(docs.sparkSession, templates).withColumn("kind", F.lit("notice")))
    places = gram_occurrences(docs, table.select(F.lit(K).alias("size"), "gram").distinct(), text)
    return places.select("digest", "pos", "gram").join(F.broadcast(table), "gram").select(
        "digest", "kind", "label", "n", (F.col("pos") - F.col("tpos")).alias("diagonal"), "tpos", "pos")


def phrase_places(votes: DataFrame) -> DataFrame:
    """(digest, label, start): diagonals on which every 3-gram of a phrase votes."""
    return votes.where("kind = 'phrase'").groupBy("digest", "label", "n", "diagonal").agg(
        F.count("*").alias("votes")).where(F.col("votes") == F.col("n") - K + 1).select(
        "digest", "label", F.col("diagonal").alias("start"))


def notice_spans(votes: DataFrame, gap: int = GAP_WORDS, least_share: float = LEAST_SHARE) -> DataFrame:
    """(digest, label, first, last, share): verified spans of merged diagonals."""
    votes = votes.where("kind = 'notice'")
    diagonals = votes.groupBy("digest", "label", "n", "diagonal").agg(F.count("*").alias("votes"))
    order = Window.partitionBy("digest", "label").orderBy("diagonal")
    merged = diagonals.withColumn("new", F.coalesce(
        F.col("diagonal") - F.lag("diagonal").over(order) > gap, F.lit(True)).cast("int"))
    merged = merged.withColumn("span", F.sum("new").over(order)).select("digest", "label", "diagonal", "span")
    words_of = votes.join(merged, ["digest", "label", "diagonal"]).select(
        "digest", "label", "n", "span", "pos", F.explode(F.sequence(F.col("tpos"), F.col("tpos") + K - 1)).alias("t"))
    spans = words_of.groupBy("digest", "label", "n", "span").agg(
        F.min("pos").alias("first"), (F.max("pos") + K - 1).alias("last"), F.count_distinct("t").alias("covered"))
    return spans.withColumn("share", F.col("covered") / F.col("n")).where(
        (F.col("share") >= least_share) & (F.col("last") - F.col("first") < F.col("n") + 2 * gap)).select(
        "digest", "label", "first", "last", "share")


def scan_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, text: str = "text") -> DataFrame:
    """All documents with ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``
    (arrays), ``spans`` and ``score`` (share of the best span; 1 for a full phrase; 0 without either)."""
    votes = stored(scan_votes(docs, phrases, templates, text))
    places = phrase_places(votes).select("digest", "label", F.col("start").alias("first"), F.lit(1.0).alias("share"),
                                         F.col("start"), F.lit(None).cast("int").alias("last"))
    spans = notice_spans(votes).select("digest", "label", "first", "share", F.lit(None).cast("int").alias("start"), "last")
    base = F.col("start").isNotNull()
    results = stored(places.unionByName(spans).groupBy(F.col("digest").alias("_llm_digest")).agg(
        F.count("start").alias("n_base"), F.min("start").cast("long").alias("first_word"),
        F.max("start").cast("long").alias("last_word"),
        F.sort_array(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"),
        F.sort_array(F.collect_set(F.when(~base, F.struct("label", "first", "last", "share")))).alias("spans"),
        F.max("share").alias("score")))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "spans", "score"]
    out = docs.drop(*names).withColumns({
        "_llm_key": digest(F.col(text)), "n_words": F.size(words(F.col(text))).cast("long")})
    none = F.array().cast("array<string>")
    return out.join(broadcast_if_bounded(results, 400), F.col("_llm_key") == F.col("_llm_digest"), "left").drop("_llm_key", "_llm_digest").withColumns({
        "n_base": F.coalesce("n_base", F.lit(0)).cast("long"), "base_labels": F.coalesce("base_labels", none),
        "labels": F.coalesce("labels", none), "score": F.coalesce("score", F.lit(0.0))})
