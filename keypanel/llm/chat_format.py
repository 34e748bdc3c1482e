"""Chat formatting by perspective rotation.

For every participant the dialogue is rendered with that speaker as the assistant
and all others as named users; the mask lists the character ranges that the
participant wrote (with the closing marker), the only ones to train on.

A dialogue is rendered in parts of consecutive turns, so no task holds an unbounded
conversation: a block covers ``TURNS`` turn numbers, and where more rows than that
share them (repeated turns, rows without a conversation) their order cuts the block
into lots of ``TURNS`` rows.  The parts of one perspective joined by block and lot
are the whole rendering; masks count from the start of a part.  Ordinary dialogues
have one part.

Defined cases: turns are ordered by number, then speaker, then text; missing
numbers come first.  A missing text is empty; a missing or empty speaker is shown
as the user ``unknown`` and is no participant, nor is ``system``.  Rows with a
missing conversation id form one conversation.  Repeated rows are repeated turns.
A dialogue without participants gives no row.  ``<|`` inside a text or a name is
written ``<\\|`` so that it can't be taken for a marker.  Extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keypanel.session import stored

TURNS = 256
UNKNOWN = "unknown"
SYSTEM = "system"
END = "<|end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<\\|"))


def _head(role: Column, speaker: Column) -> Column:
    return (F.when(role == speaker, F.lit("<|assistant|>\n"))
            .when(role == SYSTEM, F.lit("<|system|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), escaped(role), F.lit("|>\n"))))


def _missing_first(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Turns without a number in the first block of their conversation, where numbers below zero are."""
    below = counts.where("block < 0").groupBy(F.col("conv_id").alias("c")).agg(F.min("block").alias("first"))
    return rows.join(below, F.col("conv_id").eqNullSafe(F.col("c")), "left").withColumn(
        "block", F.when(F.col("turn").isNull(), F.coalesce("first", "block")).otherwise(F.col("block"))).drop("c", "first")


def _in_lots(rows: DataFrame) -> DataFrame:
    """Rows of crowded blocks with the lot that their rank gives: place in a sorted range and rows of the ranges before."""
    order = ["conv_id", "block", "turn", "role", "text"]
    # equal rows differ by a number that only spreads them
    ranged = rows.withColumn("spread", F.monotonically_increasing_id() % 1024).repartitionByRange(*order, "spread")
    ranged = stored(ranged.sortWithinPartitions(*order).select(*order, F.monotonically_increasing_id().alias("place")))
    ranged = ranged.withColumn("task", F.shiftright("place", 33))
    bases = ranged.groupBy(F.col("conv_id").alias("c"), F.col("block").alias("b"), F.col("task").alias("t")).agg(
        F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("c", "b").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    bases = bases.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranged = ranged.join(bases, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")) & (F.col("task") == F.col("t")))
    return ranged.select(*order, F.floor((F.col("place") - F.col("first") + F.col("before")) / TURNS).alias("lot"))


def dialogue_parts(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, block, lot, turns): ordered turns of bounded parts."""
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.when(F.coalesce(F.col(role), F.lit("")) == "", UNKNOWN).otherwise(F.col(role)).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.floor(F.coalesce("turn", F.lit(0)) / TURNS))
    counts = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    most, least = counts.agg(F.max("n"), F.min("block")).first()
    if least is not None and least < 0:
        rows = _missing_first(rows, counts)
        counts = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
        most = counts.agg(F.max("n")).first()[0]
    rows = rows.withColumn("lot", F.lit(0).cast("long"))
    if most is not None and most > TURNS:
        crowded = counts.where(F.col("n") > TURNS).select(F.col("conv_id").alias("c"), F.col("block").alias("b"))
        same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
        rows = rows.join(crowded, same, "left_anti").unionByName(_in_lots(rows.join(crowded, same, "left_semi")))
    return rows.groupBy("conv_id", "block", "lot").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv_id, speaker, block, lot, n_turns, text, mask): one row per participant and part."""
    speakers = turns.select(F.col(conv).alias("c"), F.col(role).alias("speaker")).where(
        F.coalesce(F.col("speaker"), F.lit("")) != "").where(F.col("speaker") != SYSTEM).distinct()
    parts = dialogue_parts(turns, conv, turn, role, text)
    seen = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    seen = seen.withColumn("segments", F.transform("turns", lambda t: F.struct(
        _head(t["role"], F.col("speaker")).alias("head"), F.concat(escaped(t["text"]), F.lit(END)).alias("body"),
        (t["role"] == F.col("speaker")).alias("own"))))
    nothing = F.array().cast("array<struct<start:int,stop:int>>")
    mask = F.aggregate(
        "segments", F.struct(F.lit(0).alias("at"), nothing.alias("mask")),
        lambda acc, s: F.struct(
            (acc["at"] + F.char_length(s["head"]) + F.char_length(s["body"])).alias("at"),
            F.when(s["own"], F.concat(acc["mask"], F.array(F.struct(
                (acc["at"] + F.char_length(s["head"])).alias("start"),
                (acc["at"] + F.char_length(s["head"]) + F.char_length(s["body"])).alias("stop"))))).otherwise(acc["mask"]).alias("mask")),
        lambda acc: acc["mask"])
    return seen.select(
        "conv_id", "speaker", "block", "lot", F.size("turns").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"])), "").alias("text"), mask.alias("mask"))
