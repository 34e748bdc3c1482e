"""URL filters: host and path rules, found by hash-prefix joins of URL expressions.

A URL is expanded into the expressions ``host suffix + path prefix`` that a rule
could consist of.  Expressions and rules meet on the first four bytes of their
SHA-256 digests; the full digests are compared after the join, and of several
rules that fit one URL the longest decides (the one with the longer host, then
``block``, on equal length).

Hosts and paths that many rows share are judged once.  Rows meet the verdicts in
a left join with an exchange on both sides, in which Spark splits partitions that a
hot URL makes large; rows without a host are dealt to all tasks.

Defined cases: a missing URL and one without ``://`` have an empty host and path
and no rule; the default verdict holds.  Repeated rows are judged alike and stay.
Rules with a missing or empty host or a missing path never fit.  A long URL gives one
expression per label of its host and length of a rule's path, no more.  An empty table
gives no rows; other columns stay, those named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keypanel.llm.words import LOWER, UPPER, apart, broadcast_if_bounded, nought

PREFIX_HEX = 8  # four bytes


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _suffixes(host: Column) -> Column:
    """(labels, host suffix) for the host and every domain above it."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n),
                       lambda k: F.struct(k.alias("labels"), F.array_join(F.slice(labels, n - k + 1, k), ".").alias("suffix")))


def filter_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All rows with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    ``rules`` has (host, path, verdict).  Columns of these names in ``df`` are replaced.
    """
    rules = rules.where("host <> '' and path is not null").select(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"),
        F.col("verdict").alias("rule_verdict"))
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
    rules = rules.select(
        F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("chars"),
        F.concat("rule_host", "rule_path").alias("rule"), F.length("rule_host").alias("host_chars"), "rule_verdict")
    rules = rules.withColumn("digest", F.sha2("rule", 256)).withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))

    # The shapes of rules: a host has at most 127 labels and a path as many prefixes as
    # characters, so these lists stay short however many rules there are.
    shapes = rules.groupBy("labels").agg(F.sort_array(F.collect_set("chars")).alias("lengths"))

    judged = df.drop("host", "path", "rule", "verdict").withColumns(
        {"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    places = judged.select("host", "path").where("host <> ''").distinct()
    suffixes = places.select("host", "path", F.inline(_suffixes(F.col("host"))))
    expressions = (suffixes.join(F.broadcast(shapes), "labels")
                   .select("host", "path", "suffix", F.explode("lengths").alias("chars"))
                   .where(F.col("chars") <= F.length("path"))
                   .select("host", "path", F.sha2(F.concat("suffix", F.substring(F.col("path"), F.lit(1), F.col("chars"))), 256).alias("full")))
    expressions = expressions.withColumn("prefix", F.substring("full", 1, PREFIX_HEX))
    fitting = (expressions.join(broadcast_if_bounded(rules, 400), "prefix")
               .where(F.col("full") == F.col("digest")))
    best = fitting.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("chars"), "host_chars", "rule_verdict", "rule")).alias("best")).select(
        "host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("verdict"))
    best = best.withColumn("_llm_apart", nought("host", "path"))
    return (judged.withColumn("_llm_apart", apart(judged, F.col("host") != "")).join(best, ["host", "path", "_llm_apart"], "left")
            .drop("_llm_apart").withColumn("verdict", F.coalesce("verdict", F.lit(default))))
