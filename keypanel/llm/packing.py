"""Best-fit packing of token sequences by minimum bin slack.

Per bin, a subset-sum over the available lengths, held as a bitset, finds the
fullest feasible combination around the longest length that is left; the
combination is then removed.  Pieces of equal length are alike, so the search
runs over a histogram of at most ``capacity`` counters, whatever the number of
documents, and a combination is used as often as its lengths last.

The plan is a list of slots: a length, a range of ranks among the pieces of that
length, the sequence of the first of them and the place in it.  A piece's rank is
its rank inside the task that made it plus the number of such pieces in earlier
tasks, so no group of pieces is ever gathered.  Pieces are written to the
checkpoint folder once and their ids are not shuffled (unless the table of task
counts outgrows its broadcast bound; then pieces meet it in a shuffle join).

Defined cases: a missing text is an empty one and packs as its end id.  Every row
is a document of its own, also when ids repeat or are missing.  Extra columns are
not carried.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keypanel.llm.tokens import encoder, slices, vocabulary_type
from keypanel.llm.words import arrow_rows, broadcast_if_bounded
from keypanel.session import stored

# Executors get these functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 2048
END_ID = 0
TEXTS = 2000  # that a worker gets at a time


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first takes the remainder."""
    first = length % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, with repetition, of a combination that fills ``room`` best."""
    reach, steps, goal = 1, [], 1 << room
    limit = (goal << 1) - 1
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length) if length <= room else 0
        part = 1
        while left > 0 and not reach & goal:
            take = min(part, left)
            steps.append((reach, length, take))
            reach |= (reach << length * take) & limit
            left -= take
            part *= 2
        if reach & goal:
            break
    at, chosen = reach.bit_length() - 1, []
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            chosen += [length] * take
            at -= length * take
    return chosen


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, pieces, first sequence, offset) of every slot."""
    counts = {length: n for length, n in histogram.items() if n > 0}
    ranks = dict.fromkeys(counts, 0)
    slots, sequence = [], 0
    while counts:
        seed = max(counts)
        rest = dict(counts)
        rest[seed] -= 1
        bin_ = [seed, *sorted(fullest({k: v for k, v in rest.items() if v}, capacity - seed), reverse=True)]
        uses = {length: bin_.count(length) for length in set(bin_)}
        times = min(counts[length] // n for length, n in uses.items())
        offset = 0
        for length in bin_:
            slots.append((length, ranks[length], times, sequence, offset))
            ranks[length] += times
            offset += length
        for length, n in uses.items():
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        sequence += times
    return slots


PIECES = "doc_id bigint, piece int, start bigint, length int, task int, nth bigint, ids binary"


def tokenized_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                     key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece, with its rank (``nth``) among the pieces of its length in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(path, spaced=True), TaskContext.get().partitionId()
        end, width = np.array([end_id], dtype=encode.dtype).tobytes(), encode.dtype.itemsize
        seen = [0] * (capacity + 1)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for begin, stop in slices(texts):
                rows = []
                for doc, ids in zip(keys[begin:stop], encode.encode(texts[begin:stop])):
                    ids += end
                    for piece, (start, length) in enumerate(cut(len(ids) // width, capacity)):
                        rows.append((doc, piece, start, length, task, seen[length], ids[start * width:(start + length) * width]))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], names=NAMES)

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, PIECES)


NAMES = [c.split()[0] for c in PIECES.split(", ")]
TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]


def placed(pieces: DataFrame, dtype: np.dtype, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of a stored table with ``sequence_id``, ``offset`` and ids as 32-bit integers."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = sorted(plan_slots(histogram, capacity))
    table = np.array(slots, dtype=np.int64).reshape(-1, 5)
    begins = np.searchsorted(table[:, 0], np.arange(capacity + 2))

    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    order = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    ranked = pieces.join(broadcast_if_bounded(bases, 32), ["length", "task"]).select(
        "doc_id", "piece", "start", "length", (F.col("base") + F.col("nth")).alias("rank"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(i).to_numpy() for i in (3, 4))
            sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                own = table[begins[length]:begins[length + 1]]
                of = lengths == length
                slot = own[np.searchsorted(own[:, 1], ranks[of], side="right") - 1]
                sequences[of], offsets[of] = slot[:, 3] + ranks[of] - slot[:, 1], slot[:, 4]
            ids = [np.frombuffer(x, dtype).astype("<u4").tobytes() for x in batch.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(ids, pa.binary()), pa.array(sequences), pa.array(offsets)],
                names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id bigint, piece int, start bigint, length int, ids binary, "
                                  "sequence_id bigint, offset bigint").withColumn("length", F.col("length").cast("long"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece of every document: (doc_id, piece, start, length, ids, sequence_id, offset)."""
    with arrow_rows(docs.sparkSession, TEXTS):
        pieces = stored(tokenized_pieces(docs, path, capacity, end_id, key, text))
    return placed(pieces, vocabulary_type(path), capacity)
