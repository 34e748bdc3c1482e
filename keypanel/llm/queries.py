"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keypanel.llm import byte_bpe, oracles
from keypanel.llm.chat_format import rotate
from keypanel.llm.decontamination import decontaminate
from keypanel.llm.jaccard_join import jaccard_join
from keypanel.llm.license_scan import scan_licenses
from keypanel.llm.packing import pack
from keypanel.llm.periodic_runs import periodic_runs
from keypanel.llm.quality_rules import judge_quality
from keypanel.llm.revisits import resolve_revisits
from keypanel.llm.sharding import shard_rows
from keypanel.llm.spelling import spelling_variants
from keypanel.llm.token_files import read_documents, shard_key, write_token_files
from keypanel.llm.tokens import vocabulary_type
from keypanel.llm.url_filters import filter_urls
from keypanel.llm.words import lower_ascii
from keypanel.session import ensure_checkpoint_dir, removed_at_exit

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(oracles.URLS)
def op1_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


@query()
def op2_sharding(spark, sf_dir):
    rows = shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return rows.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                       F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query()
def op3_packing(spark, sf_dir):
    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query(oracles.CONTAMINATION)
def op4_decontamination(spark, sf_dir):
    judged = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                           table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query()
def op5_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid4().hex}"
    buckets = write_token_files(docs, folder, vocabulary, 2)
    removed_at_exit(spark, folder)
    keys = docs.select(shard_key(F.col("doc_id")).alias("key")).distinct()
    return read_documents(spark, keys, folder, buckets, vocabulary_type(vocabulary).itemsize).select(
        F.col("key").alias("doc_id"), "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query(oracles.PERSPECTIVES)
def op6_chat_format(spark, sf_dir):
    """Rendered dialogues of every participant; the mask as ``start-stop`` ranges."""
    return rotate(table(spark, sf_dir, "conversations")).select(
        "conv_id", "speaker", "block", "lot", "n_turns", "text",
        F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["stop"].cast("string"))), ",").alias("mask"))


@query()
def op7_jaccard_join(spark, sf_dir):
    return jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "n_links")


@query(oracles.QUALITY)
def op8_quality_rules(spark, sf_dir):
    return judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query(oracles.LICENSES)
def op9_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


def web_records(pages: DataFrame) -> DataFrame:
    """Archive records that the pages stand for: captures of a site's sections, a minute apart.

    Every third capture is a full response; the others are 304 answers, whose tags
    and dates agree with the stored ones for some and not for others.
    """
    page = F.col("page_id")
    full = page % 3 == 0
    header = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    version = (page / 12).cast("long").cast("string")
    tag = F.concat(F.lit('"'), version, F.lit('"'))
    modified = F.concat(F.lit("day "), version)
    response = F.array(header("Content-Type", F.lit("text/html")), header("Content-Length", F.octet_length("html").cast("string")),
                       header("ETag", tag), header("Last-Modified", modified), header("Cache-Control", F.lit("max-age=60")))
    unchanged = F.concat(
        F.when(page % 5 != 0, F.array(header("etag", F.concat(F.lit("W/"), tag)))).otherwise(
            F.when(page % 2 == 0, F.array(header("Last-Modified", modified))).otherwise(
                F.array().cast("array<struct<name:string,value:string>>"))),
        F.array(header("Content-Length", F.lit("0")), header("cache-control", F.lit("max-age=90")),
                header("Connection", F.lit("X-Hop")), header("X-Hop", page.cast("string")), header("Age", page.cast("string"))))
    return pages.select(
        page.alias("record_id"), F.when(full, "response").otherwise("revisit").alias("type"),
        F.regexp_extract("url", r"^[^:]+://[^/]+/[^/]+/", 0).alias("uri"), F.timestamp_seconds(page * 60).alias("date"),
        F.when(full, 200).otherwise(304).alias("status"), F.when(full, response).otherwise(unchanged).alias("headers"),
        F.when(full, F.col("html")).alias("payload"))


@query(oracles.REVISITS)
def op10_revisits(spark, sf_dir):
    """Every revisit with its response; headers as lines in order, the payload by digest."""
    found = resolve_revisits(web_records(table(spark, sf_dir, "pages")))
    return found.select(
        F.col("record_id").alias("page_id"), "url", "response_id", "state",
        F.array_join(F.transform("headers", lambda h: F.concat_ws(": ", h["name"], h["value"])), "\n").alias("headers"),
        F.md5("payload").alias("payload_md5"))


@query()
def op11_byte_bpe(spark, sf_dir):
    rows = byte_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), decoded=True)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Documents, one in ten of which goes on from one of its words with a period that its id decides."""
    number = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", F.expr("crc32(CAST(doc_id AS STRING)) DIV 10").alias("g"),
                         F.when(number % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).alias("w"))
    placed = chosen.withColumn("n", F.size("w")).withColumn("a", F.expr("IF(n > 0, g % n, null)")).withColumn(
        "p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    tail = F.expr("slice(flatten(array_repeat(slice(w, int(a + 1), int(p)), int((n - a + p - 1) DIV p))), 1, int(n - a))")
    changed = F.array_join(F.concat(F.expr("slice(w, 1, int(a))"), tail), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.s")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.p")).alias("period"), F.expr("1000 * longest.length DIV -longest.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def counted_words(docs: DataFrame) -> DataFrame:
    """(word, n) of at least 5 letters and 3 occurrences; a hash of document and word takes a letter out of some."""
    found = docs.select(F.col("doc_id").cast("string").alias("doc"), F.explode(F.regexp_extract_all(
        lower_ascii(F.col("text")), F.lit("[a-z\u00C0-\u00FF]{5,}"), F.lit(0))).alias("run"))
    hashed = found.withColumn("h", F.crc32(F.concat_ws(":", "doc", "run")))
    less = F.expr("concat(left(run, int(h % length(run))), substring(run, int(h % length(run)) + 2))")
    word = F.when(F.col("doc").isNotNull() & (F.col("h") % 97 == 0), less).otherwise(F.col("run"))
    counts = hashed.select(word.alias("word")).where(F.char_length("word") >= 5).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where("n >= 3")


@query()
def op13_spelling_variants(spark, sf_dir):
    return spelling_variants(counted_words(table(spark, sf_dir, "documents"))).select("word", "form", "root", "n", "n_near", "form_n")
