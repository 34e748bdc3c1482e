"""Sharding by histogram sort: near-equal bytes, one exchange.

Rows are ordered by key, then by a hash of the row.  Splitters between shards are
found without sorting: each round counts the exact bytes below a set of candidate
keys, over all partitions, and keeps for every splitter the nearest candidates
below and above its target.  New candidates come from the rows between the two,
picked by hash, until a splitter meets its tolerance or no row is left between
them.  Then rows are exchanged once, to ranges that lie inside shards; more ranges
than shards keep a task small when shards are large.

A key that repeats in equal rows can't be cut.  If such rows outweigh the
tolerance they are written to the checkpoint folder, where each has a number of its
own, and the search goes on with that number as the last part of the order.

Defined cases: a missing key sorts first; a missing text weighs nothing but the
overhead.  Every row, repeated or not, gets one slot.  An empty table gives an
empty result.  Columns named like a result are replaced.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keypanel.session import stored

# Executors get these functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OVERHEAD = 16
TOLERANCE = 0.001          # of a shard's bytes, at a shard's border
INNER_TOLERANCE = 0.2      # at borders between ranges of one shard
RANGE_BYTES = 64 * 1024 * 1024
MOST_RANGES = 4096         # ranges are made larger beyond it; shards may be more
PROBES = 32                # candidates per splitter and round, fewer where splitters are many
CANDIDATES = 100_000       # about as many in one round
SEARCHED = 512             # borders in one expression; beyond it they are searched on two levels

KEY = ("present", "key", "hash", "number")
WHOLE = (2, 0, 0, 0)       # above every row


def sizes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def _keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with the parts of their place in the order and their size."""
    return df.withColumns({
        "_llm_present": F.col(key).isNotNull().cast("long"), "_llm_key": F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long")),
        "_llm_hash": F.xxhash64(text), "_llm_number": F.lit(0).cast("long"), "_llm_size": sizes(F.col(text))})


def _intervals(columns: list[np.ndarray], probes: np.ndarray) -> np.ndarray:
    """For each row the number of candidates at or below it."""
    parts = [np.concatenate([probes[:, i], c]) for i, c in enumerate(columns)]
    is_row = np.arange(len(parts[0])) >= len(probes)
    order = np.lexsort((is_row, *reversed(parts)))
    below = np.cumsum(~is_row[order])
    out = np.empty(len(order), np.int64)
    out[order] = below
    return out[len(probes):]


def histogram(rows: DataFrame, probes: list[tuple]) -> list[tuple[int, int]]:
    """(bytes, rows) between neighbouring candidates, exact, over all partitions."""
    table = np.array(probes, dtype=np.int64).reshape(-1, 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, count = np.zeros(len(table) + 1, np.int64), np.zeros(len(table) + 1, np.int64)
        for batch in batches:
            at = _intervals([batch.column(i).to_numpy() for i in range(4)], table)
            np.add.at(weight, at, batch.column(4).to_numpy())
            np.add.at(count, at, 1)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(weight[held]), pa.array(count[held])], names=["at", "b", "n"])

    sums = rows.mapInArrow(run, "at bigint, b bigint, n bigint").groupBy("at").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
    found = {r["at"]: (r["b"], r["n"]) for r in sums.collect()}  # at most one row per candidate
    return [found.get(i, (0, 0)) for i in range(len(table) + 1)]


def candidates(rows: DataFrame, brackets: list[tuple[tuple, tuple]], turn: int) -> list[tuple]:
    """Up to ``PROBES`` rows strictly inside each bracket, picked by hash."""
    each = max(4, min(PROBES, CANDIDATES // len(brackets)))
    edges = np.array(sorted({e for b in brackets for e in b}), dtype=np.int64).reshape(-1, 4)
    inside = sorted({bisect_right([tuple(e) for e in edges.tolist()], low) for low, _ in brackets})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(4)]
            at = _intervals(columns, edges)
            on_edge = _intervals([*columns[:3], columns[3] - 1], edges) != at  # the row is an edge itself
            keep = np.isin(at, inside) & ~on_edge
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[keep]), *(pa.array(c[keep]) for c in columns)], names=["at", *KEY])

    drawn = rows.mapInArrow(run, "at bigint, present bigint, key bigint, hash bigint, number bigint")
    drawn = drawn.withColumn("lot", F.xxhash64(*KEY, F.lit(turn)))
    drawn = drawn.groupBy("at", F.pmod("lot", F.lit(each)).alias("part")).agg(F.min_by(F.struct(*KEY), "lot").alias("k"))
    return sorted({tuple(r["k"]) for r in drawn.collect()})  # at most PROBES per bracket


def splitters(rows: DataFrame, shards: int, pieces: int, total: int) -> tuple[list[tuple], list[tuple], list[tuple]]:
    """(borders, bytes and rows between them, keys too heavy to cut).

    A border is the first key of the range after it.
    """
    targets = [total * j // (shards * pieces) for j in range(1, shards * pieces)]
    slack = [total / shards * (TOLERANCE if j % pieces == 0 else INNER_TOLERANCE / pieces) for j in range(1, shards * pieces)]
    low, high = (-1, 0, 0, 0), WHOLE
    known = [(low, 0, 0), (high, total, None)]  # (key, bytes below it, rows below it), ascending
    open_, turn, heavy = list(range(len(targets))), 0, set()
    while open_:
        below = [k[1] for k in known]
        brackets = []
        for j in open_:
            at = bisect_left(below, targets[j])
            at = max(1, min(at, len(known) - 1))
            brackets.append((known[at - 1][0], known[at][0]))
        picked = candidates(rows, sorted(set(brackets)), turn)
        held = {k[0] for k in known}
        picked = [k for k in picked if k not in held]
        turn += 1
        if picked:
            probes = sorted({*picked, *(k[0] for k in known)})
            spans, run_b, run_n, fresh = histogram(rows, probes), 0, 0, []
            for probe, (b, n) in zip(probes, spans):
                run_b, run_n = run_b + b, run_n + n
                fresh.append((probe, run_b, run_n))
            known, below = fresh, [k[1] for k in fresh]
        still = []
        for j in open_:
            at = max(1, min(bisect_left(below, targets[j]), len(known) - 1))
            near = min(abs(known[i][1] - targets[j]) for i in (at - 1, at))
            settled = not any(known[at - 1][0] < k < known[at][0] for k in picked) and (
                (known[at - 1][0], known[at][0]) in brackets)
            if near <= slack[j]:
                continue
            if settled:
                if known[at][1] - known[at - 1][1] > max(slack[j], 0) * 2:
                    heavy.add(known[at - 1][0])
                continue
            still.append(j)
        open_ = still
    below = [k[1] for k in known]
    borders = []
    for target in targets:
        at = max(1, min(bisect_left(below, target), len(known) - 1))
        borders.append(known[min((at - 1, at), key=lambda i: abs(known[i][1] - target))])
    return borders, known, sorted(heavy)


def _place(df: DataFrame, order: Column, borders: list[tuple], name: str) -> DataFrame:
    """Rows with the number of borders at or below them."""
    if len(borders) <= SEARCHED:
        return df.withColumn(name, _search(order, borders, 0, len(borders)))
    step = int(len(borders) ** 0.5)
    coarse = borders[step - 1::step]
    rows = [(i, [tuple(map(int, b)) for b in borders[i * step:(i + 1) * step - 1]]) for i in range(len(coarse) + 1)]
    fine = df.sparkSession.createDataFrame(rows, f"_llm_part int, _llm_fine array<struct<{', '.join(f'{n}:bigint' for n in KEY)}>>")
    df = df.withColumn("_llm_part", _search(order, coarse, 0, len(coarse))).join(F.broadcast(fine), "_llm_part")
    below = F.size(F.filter("_llm_fine", lambda b: b <= order))
    return df.withColumn(name, F.col("_llm_part") * step + below).drop("_llm_part", "_llm_fine")


def _search(order: Column, borders: list[tuple], begin: int, stop: int) -> Column:
    """Number of borders at or below a row, as a binary search of comparisons."""
    if begin == stop:
        return F.lit(begin)
    middle = (begin + stop) // 2
    border = F.struct(*[F.lit(int(v)).cast("long").alias(n) for n, v in zip(KEY, borders[middle])])
    return F.when(order < border, _search(order, borders, begin, middle)).otherwise(
        _search(order, borders, middle + 1, stop))


def shard_rows(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with ``shard`` (from 0), ``slot`` (gapless inside the shard, in key order) and ``size``."""
    parts = [f"_llm_{name}" for name in KEY]
    keyed = _keyed(df.drop("shard", "slot", "size"), key, text)
    narrow = stored(keyed.select(*[F.col(f"_llm_{n}").alias(n) for n in KEY], F.col("_llm_size").alias("size")))
    total = narrow.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b")).first()["b"]
    pieces = max(1, min(-(-total // (shards * RANGE_BYTES)), MOST_RANGES // shards))
    borders, known, heavy = splitters(narrow, shards, pieces, total)
    if heavy:
        place = F.struct(*[F.col(n) for n in parts])
        hot = place.isin([F.struct(*[F.lit(int(v)).cast("long").alias(n) for n, v in zip(parts, k)]) for k in heavy])
        numbered = stored(keyed.where(hot).withColumn("_llm_number", F.monotonically_increasing_id()))
        keyed = keyed.where(~hot).unionByName(numbered)
        narrow = stored(keyed.select(*[F.col(f"_llm_{n}").alias(n) for n in KEY], F.col("_llm_size").alias("size")))
        borders, known, _ = splitters(narrow, shards, pieces, total)

    rows_below = [0] + [b[2] for b in borders]
    starts = [(r, r // pieces, rows_below[r] - rows_below[r // pieces * pieces]) for r in range(shards * pieces)]
    ranges = df.sparkSession.createDataFrame(starts, "range int, shard int, first bigint")
    order = F.struct(*[F.col(f"_llm_{n}").alias(n) for n in KEY])
    placed = _place(keyed, order, [b[0] for b in borders], "_llm_range")
    placed = placed.repartition(shards * pieces, "_llm_range")
    within = Window.partitionBy("_llm_range").orderBy(*parts)
    placed = placed.withColumn("_llm_row", F.row_number().over(within))
    placed = placed.join(F.broadcast(ranges), F.col("_llm_range") == F.col("range")).drop("range")
    return placed.withColumn("slot", F.col("first") + F.col("_llm_row") - 1).withColumnRenamed(
        "_llm_size", "size").drop("first", "_llm_row", "_llm_range", *parts)
