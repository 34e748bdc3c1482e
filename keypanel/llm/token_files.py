"""Token ids in binary shard files, with a minimal perfect hash index over document keys.

Format.  A shard file is the raw little-endian ids of its documents one after the
other, each document closed by the end id, and after them a footer: a table of
24-byte entries (key, first id, ids), the number of entries with a magic number,
and the end id once more.  Spark's own text writer makes the files: its line
separator is the end id, so writing works on any file system Spark writes to, and
a task that is repeated commits once.  Shards hold ascending key ranges.

Index.  Keys are dealt by hash to buckets of about a thousand.  In each a hash and
displace scheme gives every key its own slot of exactly as many slots as keys; a
slot stores a 32-bit fingerprint of its key and the runs of documents with that
key (shard, first entry, first id, ids, documents).  A lookup reads one bucket,
one displacement and one slot, whatever the size of the corpus.  ``read_keys`` goes that
way for a list of keys: index rows of their buckets, then of the shard files named there
the ids from the named offset on.  ``read_documents`` takes a table of keys of any size
and reads all shards in one pass.

Defined cases: a missing text is an empty one (the end id alone).  A missing key
sorts first and is stored as a key of its own.  Rows that share a key are all
stored, next to each other, in the order of their text's hash, and the key's slot
names them all.  A key that was never written is not found (its fingerprint
differs, but for one in four billion, and readers compare the stored key).  An empty table gives
no shard and an empty index; a very long text is one document of its shard; columns other than key and
text are left out.  An end id with a byte of 128 or more is refused.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keypanel.llm.tokens import encoder, slices, vocabulary_type
from keypanel.llm.words import arrow_rows, broadcast_if_bounded, is_bounded
from keypanel.session import stored

# Executors get these functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = 0x4B505349  # closes a footer
SHARD_BYTES = 16 * 1024 * 1024  # of text, about
TEXTS = 2000  # that a worker gets at a time
BUCKET_KEYS = 1024
GROUP_KEYS = 4
NO_KEY = -(1 << 63)  # stands for a missing key
MOST_KEYS = 1000  # that are read one by one; a run of documents with one key in one shard is one entry

ENTRY = np.dtype([("key", "<i8"), ("first", "<i8"), ("ids", "<i8")])


def shard_key(column: Column) -> Column:
    return F.coalesce(column.cast("long"), F.lit(NO_KEY))


# ---------------------------------------------------------------- shard files

def write_shards(docs: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id", text: str = "text",
                 shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every text and write shard files of about ``shard_bytes`` of text into ``folder``."""
    rows = docs.select(shard_key(F.col(key)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    closing = np.array([end_id], dtype=vocabulary_type(path)).tobytes()
    if max(closing) >= 0x80:
        raise ValueError(f"end id {end_id} has a byte of 128 or more, which the text writer would not write as it is")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("b")).first()["b"]
    order = ["key", F.xxhash64("text")]
    rows = rows.repartitionByRange(max(1, -(-size // shard_bytes)), *order, F.monotonically_increasing_id())
    rows = rows.sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, spaced=False)
        width, entries, at = encode.dtype.itemsize, [], 0
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for begin, stop in slices(texts):
                payload = encode.encode(texts[begin:stop])
                for k, ids in zip(keys[begin:stop], payload):
                    n = len(ids) // width + 1
                    entries.append((k, at, n))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(payload, pa.binary())], names=["line"])
        if entries:
            tail = np.array(entries, dtype=ENTRY).tobytes() + np.array([len(entries), MAGIC], dtype="<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([tail], pa.binary())], names=["line"])

    lines = rows.mapInArrow(run, "line binary").select(F.col("line").cast("string"))
    with arrow_rows(docs.sparkSession, TEXTS):
        lines.write.option("lineSep", closing.decode("latin-1")).text(folder)


def read_shards(spark: SparkSession, folder: str, width: int, ids: bool = True) -> DataFrame:
    """(shard, entry, key, first, n, ids) of every document; ``ids`` as 32-bit integers, or without them."""
    names = ["shard", "entry", "key", "first", "n"] + ["ids"] * ids
    schema = "shard int, entry int, key bigint, first bigint, n bigint" + ", ids binary" * ids
    dtype = np.dtype("<u2") if width == 2 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = memoryview(content.as_buffer())
                close = len(data) - width
                count, magic = np.frombuffer(data[close - 16:close], "<i8")
                if magic != MAGIC:
                    raise ValueError(f"shard {shard} has no footer")
                table = np.frombuffer(data[close - 16 - count * ENTRY.itemsize:close - 16], ENTRY)
                for at in range(0, count, 4096):
                    part = table[at:at + 4096]
                    columns = [pa.array(np.full(len(part), shard, np.int32)), pa.array(np.arange(at, at + len(part), dtype=np.int32)),
                               *(pa.array(np.ascontiguousarray(part[c])) for c in ENTRY.names)]
                    if ids:
                        columns.append(pa.array([np.frombuffer(data[a * width:(a + n) * width], dtype).astype("<u4").tobytes()
                                                 for a, n in zip(part["first"].tolist(), part["ids"].tolist())], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    files = files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"), "content")
    return files.mapInArrow(run, schema)


def shard_bases(entries: DataFrame) -> DataFrame:
    """(shard, base): the ids in all earlier shards; one row per shard."""
    totals = entries.groupBy("shard").agg(F.sum("n").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))


# ---------------------------------------------------------------------- index

def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finalizer of a splitmix generator."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hashes(keys: np.ndarray, seed: int, groups: int, slots: int):
    """Group, place and step of each key under a seed."""
    return (mixed(keys, 3 * seed + 1) % np.uint64(groups), mixed(keys, 3 * seed + 2) % np.uint64(slots),
            mixed(keys, 3 * seed + 3) % np.uint64(slots))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 0xF1) >> np.uint64(32)).astype(np.uint32)


def build_mph(keys: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, displacements, slot of each key) of a minimal perfect hash of distinct keys."""
    n = len(keys)
    groups = max(1, n // GROUP_KEYS)
    for seed in range(1 << 20):
        group, place, step = (x.astype(np.int64) for x in hashes(keys, seed, groups, n))
        members = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[members], np.arange(groups + 1))
        taken, slots = np.zeros(2 * n, dtype=bool), np.empty(n, np.int64)
        displacements = np.zeros(groups, np.int64)
        for g in sorted(range(groups), key=lambda g: bounds[g] - bounds[g + 1]):
            own = members[bounds[g]:bounds[g + 1]]
            if not len(own):
                break
            for turn in range(64 if len(own) > 1 else 1):
                at = (place[own] + turn * step[own]) % n
                if len(np.unique(at)) < len(at):
                    continue
                clash = taken[at[0]:at[0] + n].copy()
                for a in at[1:]:
                    clash |= taken[a:a + n]
                shift = int(np.argmin(clash))
                if not clash[shift]:
                    break
            else:
                break
            displacements[g] = turn * n + shift
            slots[own] = (at + shift) % n
            taken[slots[own]] = taken[slots[own] + n] = True
        else:
            return seed, displacements, slots
        if not len(own):
            return seed, displacements, slots
    raise ValueError("keys are not distinct")


def find_slots(keys: np.ndarray, seed: int, displacements: np.ndarray, n: int) -> np.ndarray:
    group, place, step = (x.astype(np.int64) for x in hashes(keys, seed, len(displacements), n))
    turn, shift = displacements[group] // n, displacements[group] % n
    return (place + turn * step + shift) % n


RUNS = "array<struct<shard:int,entry:int,first:bigint,ids:bigint,documents:int>>"
FOUND = pa.list_(pa.field("element", pa.struct([
    ("shard", pa.int32()), ("entry", pa.int32()), ("first", pa.int64()), ("ids", pa.int64()), ("documents", pa.int32())])))
HELD = pa.list_(pa.field("element", FOUND))
INDEX = f"bucket bigint, seed int, displacements binary, fingerprints binary, runs array<{RUNS}>"


def key_bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def write_index(entries: DataFrame, folder: str) -> int:
    """Index every key of the stored table ``entries``, one Parquet row per bucket; returns the number of buckets."""
    runs = entries.groupBy("key", "shard").agg(
        F.min("entry").alias("entry"), F.min("first").alias("first"), F.sum("n").alias("ids"),
        F.count("*").cast("int").alias("documents"))
    keys = runs.groupBy("key").agg(F.sort_array(F.collect_list(
        F.struct("shard", "entry", "first", "ids", "documents"))).alias("runs"))
    buckets = max(1, -(-entries.agg(F.approx_count_distinct("key")).first()[0] // BUCKET_KEYS))

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        own = group.column("key").to_numpy().view(np.uint64)
        seed, displacements, slots = build_mph(own)
        order = np.argsort(slots)
        placed = group.column("runs").combine_chunks().take(pa.array(order))
        return pa.table({
            "bucket": group.column("bucket").slice(0, 1), "seed": pa.array([seed], pa.int32()),
            "displacements": pa.array([displacements.astype("<i8").tobytes()], pa.binary()),
            "fingerprints": pa.array([fingerprints(own[order]).astype("<u4").tobytes()], pa.binary()),
            "runs": pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), placed.cast(FOUND)).cast(HELD)})

    keys.withColumn("bucket", key_bucket(F.col("key"), buckets)).groupBy("bucket").applyInArrow(
        build, INDEX).write.parquet(folder)
    return buckets


def lookup(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """(key, runs) of every wanted key that the index holds; ``keys`` has distinct (key)."""

    def find(wanted: pa.Table, bucket: pa.Table) -> pa.Table:
        if not wanted.num_rows or not bucket.num_rows:
            return pa.table({"key": pa.array([], pa.int64()), "runs": pa.array([], FOUND)})
        row = bucket.combine_chunks()
        own = wanted.column("key").to_numpy()
        stored_prints = np.frombuffer(row["fingerprints"][0].as_buffer(), "<u4")
        slots = find_slots(own.view(np.uint64), row["seed"][0].as_py(),
                           np.frombuffer(row["displacements"][0].as_buffer(), "<i8"), len(stored_prints))
        hit = stored_prints[slots] == fingerprints(own.view(np.uint64))
        return pa.table({"key": pa.array(own[hit]), "runs": row["runs"].combine_chunks().flatten().take(pa.array(slots[hit])).cast(FOUND)})

    wanted = keys.withColumn("bucket", key_bucket(F.col("key"), buckets))
    return wanted.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, f"key bigint, runs {RUNS}")


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id", text: str = "text",
                      shard_bytes: int = SHARD_BYTES) -> int:
    """Shards, the index over them and the shards' first ids, in one folder; returns the index's buckets."""
    write_shards(docs, f"{folder}/shards", path, end_id, key, text, shard_bytes)
    width = vocabulary_type(path).itemsize
    entries = stored(read_shards(docs.sparkSession, f"{folder}/shards", width, ids=False))
    shard_bases(entries).write.parquet(f"{folder}/bases")
    return write_index(entries, f"{folder}/index")


def read_documents(spark: SparkSession, keys: DataFrame, folder: str, buckets: int, width: int) -> DataFrame:
    """(key, start, n, ids) of the wanted keys: addresses from the index, ids from the shard files.

    ``keys`` has distinct (key).  ``start`` counts the ids of all documents before.
    Addresses are broadcast while their counted size allows, so ids are not shuffled.
    """
    found = stored(lookup(keys, spark.read.parquet(f"{folder}/index"), buckets)).select(
        F.col("key").alias("wanted"), F.inline("runs"))
    addresses = found.select("wanted", "shard", F.explode(
        F.sequence(F.col("entry"), F.col("entry") + F.col("documents") - 1)).alias("entry"))
    bases = spark.read.parquet(f"{folder}/bases")
    return read_shards(spark, f"{folder}/shards", width).join(
        broadcast_if_bounded(addresses, 32), ["shard", "entry"]).where("wanted = key").join(bases, "shard").select(
        F.when(F.col("key") != NO_KEY, F.col("key")).alias("key"), (F.col("base") + F.col("first")).alias("start"), "n", "ids")


def read_keys(spark: SparkSession, keys: list[int | None], folder: str, buckets: int, width: int) -> DataFrame:
    """(key, start, n, ids) of the documents with the listed keys, by the index alone.

    Of the index only rows of the keys' buckets are read, and only the shard files that hold a key
    are opened, in which the ids lie at the offset that the index gives.  ``keys`` (at most
    ``MOST_KEYS``, each once) is a list of the driver; more keys are a table for ``read_documents``.
    """
    stored_keys = list(dict.fromkeys(NO_KEY if k is None else k for k in keys))
    if len(stored_keys) > MOST_KEYS:
        raise ValueError(f"{len(stored_keys)} keys; give more than {MOST_KEYS} as a table to read_documents")
    wanted = spark.createDataFrame([(k,) for k in stored_keys], "key bigint")
    own = [r["b"] for r in wanted.select(key_bucket(F.col("key"), buckets).alias("b")).distinct().collect()]
    index = spark.read.parquet(f"{folder}/index").where(F.col("bucket").isin(own))
    runs = stored(lookup(wanted, index, buckets).select("key", F.inline("runs")))
    shards = [r["shard"] for r in runs.select("shard").distinct().limit(MOST_KEYS + 1).collect()]
    return _sliced(spark, runs, shards, folder, width).join(spark.read.parquet(f"{folder}/bases"), "shard").select(
        F.when(F.col("key") != NO_KEY, F.col("key")).alias("key"), (F.col("base") + F.col("first")).alias("start"), "n", "ids")


def _sliced(spark: SparkSession, runs: DataFrame, shards: list[int], folder: str, width: int) -> DataFrame:
    """(shard, key, first, n, ids) of the documents of ``runs``, cut out of the shard files named by ``shards``."""
    dtype = np.dtype("<u2") if width == 2 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "key", "first", "n", "ids"]
        for batch in batches:
            for shard, content, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = memoryview(content.as_buffer())
                footer = len(data) - width - 16
                count, magic = np.frombuffer(data[footer:footer + 16], "<i8")
                if magic != MAGIC:
                    raise ValueError(f"shard {shard} has no footer")
                table = footer - int(count) * ENTRY.itemsize
                for found in held:
                    at = table + found["entry"] * ENTRY.itemsize
                    entries = np.frombuffer(data[at:at + found["documents"] * ENTRY.itemsize], ENTRY)
                    entries = entries[entries["key"] == found["key"]]
                    ids = [np.frombuffer(data[a * width:(a + n) * width], dtype).astype("<u4").tobytes()
                           for a, n in zip(entries["first"].tolist(), entries["ids"].tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(entries), shard, np.int32)), *(pa.array(np.ascontiguousarray(entries[c])) for c in ENTRY.names),
                        pa.array(ids, pa.binary())], names=names)

    # Beyond so many files all are listed and the join leaves out those without a key.
    named = "part-{" + ",".join(f"{s:05d}" for s in shards) + "}-*" if 0 < len(shards) <= MOST_KEYS else "part-*"
    files = spark.read.format("binaryFile").option("pathGlobFilter", named).load(f"{folder}/shards")
    files = files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"), "content")
    held = runs.groupBy("shard").agg(F.collect_list(F.struct("key", "entry", "documents")).alias("held"))
    held = F.broadcast(held) if is_bounded(runs, 64) else held
    return files.join(held, "shard").select("shard", "content", "held").mapInArrow(run, "shard int, key bigint, first bigint, n bigint, ids binary")
