"""Words of whole texts as array columns, and where given word k-grams occur."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# What separates words: every ASCII character but digits and lower-case letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Most bytes a table may have to be broadcast by hand; it is measured first.
BROADCAST_BYTES = 64 * 1024 * 1024


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; texts of ASCII alone take the short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text, in order; a missing text has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), "")


def digest(text: Column) -> Column:
    """Identity of a text (null for null): rows with equal texts share their results."""
    return F.unhex(F.sha2(text, 256))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send Python workers at most so many rows at a time in the jobs run inside.

    The default suits numbers; of whole texts it would hold tens of megabytes in
    every worker, and again in its executor.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def gram_hash(array: Column, start: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(array, start + i) for i in range(size)])


def gram_text(array: Column, start: Column, size: int) -> Column:
    return F.array_join(F.slice(array, start + 1, size), " ")


def broadcast_if_bounded(df: DataFrame, row_bytes: int) -> DataFrame:
    """Mark a table for broadcast if its counted rows stay under the bound.

    Beyond it the table is returned as it is and Spark joins it by a shuffle.
    """
    return F.broadcast(df) if is_bounded(df, row_bytes) else df


def apart(df: DataFrame, meets: Column) -> Column:
    """A second join key: 0 for rows that may meet the other side, else a hash of the row.

    Rows without a partner then go to all tasks instead of to that of one missing key.
    The other side's key is ``nought``.
    """
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.when(meets, F.lit(0)).otherwise(F.pmod(F.xxhash64(*plain), F.lit(1 << 16)).cast("int"))


def nought(*keys: str) -> Column:
    """0 in every row, as a column that Spark deals by: an exchange then stands between an aggregate by
    ``keys`` and its join, and a partition that a hot key makes large can be split there."""
    return F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")


def is_bounded(df: DataFrame, row_bytes: int) -> bool:
    return df.count() * row_bytes <= BROADCAST_BYTES


def gram_occurrences(docs: DataFrame, grams: DataFrame, text: str = "text") -> DataFrame:
    """Places of given word k-grams in whole texts: (digest, pos, n_words, size, gram).

    ``grams`` has distinct (size int, gram string), the words joined by a space.
    Rolling hashes of every text meet the hashes of the grams in an equi-join and
    the words themselves are compared after it.  While the grams are broadcast, a word's place
    refers to the array of its text's words; beyond that a place goes into the shuffle with
    its own ``size`` words and never with the array, so what is shuffled is linear in the text.
    A text that several rows hold counts once.
    """
    split = docs.select(F.col(text).alias("text")).where("text is not null").select(
        digest(F.col("text")).alias("digest"), words(F.col("text")).alias("w"))
    split = split.where(F.size("w") > 0)
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect())  # a few lengths
    found = None
    for size in sizes:
        wanted = grams.where(F.col("size") == size).select(
            "gram", F.split("gram", " ").alias("g")).select(
            "gram", gram_hash(F.col("g"), F.lit(0), size).alias("h"))
        places = split.select("digest", "w", F.posexplode("w").alias("pos", "word")).where(
            F.col("pos") + size <= F.size("w"))
        hashed = gram_hash(F.col("w"), F.col("pos"), size).alias("h")
        if is_bounded(wanted, 120):
            met = places.select("digest", "w", "pos", F.size("w").alias("n_words"), hashed).join(F.broadcast(wanted), "h").where(
                gram_text(F.col("w"), F.col("pos"), size) == F.col("gram"))
        else:
            met = places.select("digest", "pos", F.size("w").alias("n_words"), hashed, gram_text(F.col("w"), F.col("pos"), size).alias("words")).join(
                wanted, "h").where(F.col("words") == F.col("gram"))
        one = met.select("digest", "pos", "n_words", F.lit(size).alias("size"), "gram")
        found = one if found is None else found.unionByName(one)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "digest binary, pos int, n_words int, size int, gram string")
    return found.distinct()
