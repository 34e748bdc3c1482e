"""Groups of words that are one edit apart, with the most frequent spelling of each.

A list of words in sorted order is scanned once for every word.  The scan keeps the rows
of the edit matrix for the prefixes of the word it stands at, three cells each, as no
cell further from the diagonal can be within one edit.  The next word shares a prefix
with it, so only the rows behind that prefix are made anew; when no cell of a row is
within one edit, all words that share the prefix up to that row are skipped.

One list of all words would be one task, and a word's partners lie anywhere in it.  Of two
words one edit apart, the shorter of ``s`` letters, either the first or the last
``s // 2`` letters agree.  So there is a list for each half, whose words are sorted by the
rest of their letters, and a word is in four lists: by its first and its last letters, as
the shorter (or equal) word and as the longer one.  A list of more than ``LIST`` words is
divided the same way by its remaining letters, as often as needed; in the end at most two
letters are open, and their number bounds a list.  A pair that agrees in both halves is
taken in the list of the first half, so it is found once.

Edits are insertions, deletions and replacements of one code point.

Defined cases: null words and words of fewer than ``least`` code points are left out, counts of a
repeated word are added up, an empty table gives an empty one, extra columns are not
carried.  Of partners with equal counts the first in code-point order is the form.  Very
long words are words like any other.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keypanel.session import stored

# Executors get these functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST = 5
# Words of a list that is scanned as it is.
LIST = 1000
# A list: letters of its shorter words, agreed first and last letters, these letters, and the
# number of first letters that two words of a pair must not agree in.
GROUP = ["short", "head", "tail", "letters", "apart"]
UNBOUNDED = 1 << 30


def near_in_list(rest: list[str], head: int = 0, apart: int = UNBOUNDED, short: int = UNBOUNDED) -> Iterator[tuple[int, int]]:
    """Places (earlier, later) in a sorted list of the strings that are one edit apart.

    ``head`` letters before the strings agree; pairs that agree in ``apart`` letters, and
    pairs of two strings longer than ``short``, are left out.
    """
    n = len(rest)
    shared = [0] * (n + 1)
    for i in range(1, n):
        a, b = rest[i - 1], rest[i]
        k, most = 0, min(len(a), len(b))
        while k < most and a[k] == b[k]:
            k += 1
        shared[i] = k
    for i in range(n):
        word = rest[i]
        size = len(word)
        # rows[d]: edits from the first d letters of the other word to the first d-1, d, d+1 of this one.
        rows, at, reuse, agreed = [(9, 0, 1)], i + 1, 0, size
        while at < n:
            agreed = min(agreed, shared[at])  # letters that this word and the one at ``at`` share
            other = rest[at]
            del rows[reuse + 1:]
            left, same, right = rows[-1]
            dead = 0
            for d in range(reuse, len(other)):
                letter = other[d]
                a = min(left + (d < 1 or d > size or word[d - 1] != letter), same + 1)
                b = min(same + (d >= size or word[d] != letter), right + 1, a + 1)
                c = min(right + (d + 1 >= size or word[d + 1] != letter), b + 1)
                left, same, right = a, b, c
                if a > 1 and b > 1 and c > 1:
                    dead = d + 1
                    break
                rows.append((a, b, c))
            at += 1
            if dead:
                while at < n and shared[at] >= dead:
                    agreed = min(agreed, shared[at])
                    at += 1
                reuse = min(shared[at] if at < n else 0, dead - 1)
                continue
            over = size - len(other)
            if -1 <= over <= 1 and (left, same, right)[over + 1] == 1 and head + agreed < apart and (size <= short or over > 0):
                yield i, at - 1
            reuse = min(shared[at] if at < n else 0, len(rows) - 1)


def lists(words: DataFrame) -> DataFrame:
    """Rows of the first lists: two halves for each of the two lengths that the shorter word may have."""
    places = []
    for less in (0, 1):
        short = F.char_length("word") - less
        half = F.expr(f"(char_length(word) - {less}) DIV 2").cast("int")
        places.append(F.struct(short.alias("short"), half.alias("head"), F.lit(0).alias("tail"), F.lit(UNBOUNDED).alias("apart")))
        places.append(F.struct(short.alias("short"), F.lit(0).alias("head"), half.alias("tail"), half.alias("apart")))
    return with_letters(words.select("word", "n", F.explode(F.array(*places)).alias("at")).select("word", "n", "at.*"))


def with_letters(rows: DataFrame) -> DataFrame:
    """Rows with the letters that agree in their list, and the others."""
    return rows.withColumn("letters", F.expr("concat(left(word, head), '|', right(word, tail))")).withColumn(
        "rest", F.expr("substring(word, head + 1, char_length(word) - head - tail)"))


def divided(rows: DataFrame) -> DataFrame:
    """Rows of lists that are too long, in two lists each by half of the open letters."""
    half = F.expr("(short - head - tail) DIV 2").cast("int")
    first = F.struct((F.col("head") + half).alias("head"), F.col("tail"), F.col("apart"))
    last = F.struct(F.col("head"), (F.col("tail") + half).alias("tail"), F.least("apart", F.col("head") + half).alias("apart"))
    halves = rows.select("word", "n", "short", F.explode(F.array(first, last)).alias("at")).select("word", "n", "short", "at.*")
    return with_letters(halves.where("head < apart"))


def scanned(rows: DataFrame) -> DataFrame:
    """(word, near, near_n) for all pairs in the lists, in both directions."""
    order = [*GROUP, "rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def every():
            for batch in batches:
                yield from zip(*[batch.column(i).to_pylist() for i in range(len(order) + 2)])

        made: list[tuple[str, str, int]] = []
        for (short, head, tail, _, apart), own in groupby(every(), lambda r: r[:5]):
            own = list(own)
            for i, j in near_in_list([r[5] for r in own], head, apart, short - head - tail):
                (x, nx), (y, ny) = own[i][6:], own[j][6:]
                made += [(x, y, ny), (y, x, nx)]
            if len(made) >= 20_000:
                yield batch_of(made)
                made = []
        yield batch_of(made)

    def batch_of(made: list[tuple[str, str, int]]) -> pa.RecordBatch:
        columns = list(zip(*made)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
                                          names=["word", "near", "near_n"])

    together = rows.repartition(*GROUP).sortWithinPartitions(*order)
    return together.select(*order, "word", "n").mapInArrow(run, "word string, near string, near_n bigint")


def near_words(words: DataFrame, longest_list: int = LIST) -> DataFrame:
    """(word, near, near_n): every pair of words one edit apart, in both directions, once each."""
    rows, found = lists(words), None
    while True:
        sizes = rows.groupBy(*GROUP).agg(F.count("*").alias("rows"))
        too_long = stored(sizes.where((F.col("rows") > longest_list) & F.expr("short - head - tail >= 2")).select(*GROUP))
        more = not too_long.isEmpty()
        one = scanned(rows.join(too_long, GROUP, "left_anti") if more else rows)
        found = one if found is None else found.unionByName(one)
        if not more:
            return found
        rows = stored(divided(rows.join(too_long, GROUP, "left_semi")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): forms followed to the last, twice as far in every round.

    A form has more occurrences than its word, so no chain comes back to where it was.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        reached = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reached


def spelling_variants(counts: DataFrame, ratio: int = 2, least: int = LEAST, longest_list: int = LIST) -> DataFrame:
    """Per word of (word, n): form, root, n, n_near, form_n.

    ``form``: the most frequent word one edit apart, if ``ratio`` times as frequent at least.
    ``root``: the last of the forms followed from the word, or the word.
    """
    if least < 4:
        raise ValueError("words of fewer than four code points are mostly one edit apart")
    words = stored(counts.where(F.char_length("word") >= least).groupBy("word").agg(F.sum("n").alias("n")))
    near = near_words(words, longest_list).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near"))).alias("best"))
    fits = -F.col("best.rank") >= ratio * F.col("n")
    formed = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.near")).alias("form"),
        F.when(fits, -F.col("best.rank")).alias("form_n")))
    last = roots(formed.where("form IS NOT NULL"))
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
