"""Cleans a document table and packs what is left into training sequences.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before kept,
and returns a DataFrame.  All but the last return the columns of ``documents``.
Whoever runs the stages writes each result as Parquet and reads it as the next docs;
``run`` does so in the checkpoint folder.

Missing texts fail the quality rules, so later stages see none; repeated rows are
copies and one of them stays; an empty table passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keypanel.llm.decontamination import decontaminate
from keypanel.llm.jaccard_join import one_of_each
from keypanel.llm.packing import pack
from keypanel.llm.quality_rules import judge_quality
from keypanel.session import stored

VOCABULARY = "byte_bpe_50k.json"


def _kept(docs: DataFrame, rule: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Documents that a rule keeps, with all their columns, whatever these are named."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    carried = docs.select("doc_id", "text", F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("_llm_rest"))
    return rule(carried).select(*[F.col(f"_llm_rest.`{c}`") if c in others else F.col(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return _kept(docs, lambda d: judge_quality(d).where("kept"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of every group of near copies."""
    return _kept(docs, one_of_each)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _kept(docs, lambda d: decontaminate(d, items).where("not contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, ids as little-endian 32-bit integers."""
    return pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", jaccard_join),
          ("benchmark decontamination", decontamination), ("best-fit packing", packing)]

# MinHash, tokenizers and the packing plan have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``, without their ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs)
    return docs.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
