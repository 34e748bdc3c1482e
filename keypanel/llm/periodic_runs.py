"""Runs of words that repeat with a period, found on sparse diagonals.

A run is a stretch of consecutive words in which words ``period`` apart are equal,
with the smallest such period, at least twice as long as the period and at least
``least`` words long, that no neighbouring word extends.

The match length of word ``i`` at lag ``q`` is one more than that of word ``i - 1`` at
lag ``q`` if words ``i`` and ``i - q`` are equal, else 0.  A lag stays active on its
diagonal as long as the length grows; when it ends and the length suffices (as many
words as the lag), the diagonal emits a run.  Only sparse cells are visited:

* Lags below ``least`` are compared as they are.
* Larger lags are handled in octaves: a run with a lag from k up to 2k matches k words in
  a row, so a lag becomes active only at earlier occurrences, between k and 2k words
  back, of the same k words.  Sequences of 2k words are told apart by pairs of those of
  k words, and a place whose words occur once in its text is never looked at again.
* k words that have a period of at most k/2 recur at every period, so an octave could
  meet many lags there.  They lie in a run that a lower octave has emitted.  A lag
  that keeps inside that run is a multiple of its period and never a smallest one; any
  other that sees nothing but such words begins where one of the two runs it leads
  through begins, so only the starts of these runs activate lags.  All other words recur
  at most three times in an octave.  Work is about n log n for a text of n words,
  whatever it repeats.

Words are compared themselves, by their numbers in a dictionary; nothing is hashed.

Defined cases: a missing text has no words and no runs, like an empty one.  Every row
is treated for itself, also when keys or texts repeat; an empty table gives an empty
one.  Extra columns are not carried.  A very long text is treated as a whole; it takes
about 150 bytes of memory a word.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors get these functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST = 12
# Bytes of text whose words are treated side by side.
TOGETHER = 6_000_000

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of each stretch of consecutive numbers."""
    breaks = np.flatnonzero(np.diff(places) != 1)
    return places[np.concatenate([[0], breaks + 1])], places[np.concatenate([breaks, [len(places) - 1]])]


def prime_factors(n: int) -> list[int]:
    found, f = [], 2
    while f * f <= n:
        if n % f == 0:
            found.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return found + [n] * (n > 1)


def is_smallest(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a run has no smaller period; as long as it is, a smaller one would divide it."""
    return not any(np.array_equal(words[start:start + period], words[start + d:start + d + period])
                   for d in (period // f for f in prime_factors(period)))


def active_until(words: np.ndarray, at: int, lag: int) -> int:
    """The first word from ``at`` on whose lag doesn't match."""
    step = 16
    while at < len(words):
        stop = min(at + step, len(words))
        differ = words[at:stop] != words[at - lag:stop - lag]
        if differ.any():
            return at + int(differ.argmax())
        at, step = stop, step * 2
    return at


def active_from(words: np.ndarray, at: int, lag: int) -> int:
    """The first word of the matches at a lag that end just before ``at``."""
    step = 16
    while at > lag:
        begin = max(at - step, lag)
        differ = words[begin:at] != words[begin - lag:at - lag]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, step = begin, step * 2
    return at


def repeated(places: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key another place has too, and the keys' numbers at all ``n`` places (-1 elsewhere)."""
    _, numbers, counts = np.unique(keys, return_inverse=True, return_counts=True)
    keep = counts[numbers] > 1
    names = np.full(n, -1, np.int64)
    names[places[keep]] = numbers[keep]
    return places[keep], names


def joined(places: np.ndarray, names: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """``repeated`` for pairs of names ``shift`` words apart."""
    places = places[places + shift < len(names)]
    places = places[names[places + shift] >= 0]
    return repeated(places, names[places] * (len(names) + 1) + names[places + shift], len(names))


def earlier_occurrences(places: np.ndarray, names: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) for all earlier occurrences of the same name from ``low`` up to ``high`` words back."""
    order = places[np.argsort(names[places], kind="stable")]
    own, found_at, lags, back = names[order], [], [], 1
    while back < len(order):
        lag = order[back:] - order[:-back]
        near = (own[back:] == own[:-back]) & (lag < high)
        if not near.any():
            break
        hit = near & (lag >= low)
        found_at.append(order[back:][hit])
        lags.append(lag[hit])
        back += 1
    if not found_at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_at), np.concatenate(lags)


def cells_of_starts(runs: list[tuple[int, int, int]], places: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of cells in which one of the two words begins a run and the other is in another run."""
    order = places[np.argsort(names[places], kind="stable")]
    own, found_at, lags = names[order], [], []
    for start, length, _ in runs:
        if (name := names[start]) < 0:
            continue
        same = order[np.searchsorted(own, name):np.searchsorted(own, name, side="right")]
        a, b, c, d = np.searchsorted(same, [start - 2 * k + 1, start - k + 1, start + k, start + 2 * k])
        before, after = same[a:b], same[c:d]
        after = after[after > start + length - k]  # not in the run itself
        found_at += [np.full(len(before), start), after]
        lags += [start - before, after - start]
    if not found_at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_at), np.concatenate(lags)


def find_runs(words: np.ndarray, longest: int, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, in any order.

    ``words``: numbers of words; texts are kept apart by numbers that occur once.
    ``longest``: words of the longest text.
    """
    runs, n = [], len(words)
    for lag in range(1, min(least, n)):
        places = np.flatnonzero(words[lag:] == words[:-lag])
        if len(places):
            first, last = stretches(places)
            enough = last - first + 1 >= max(lag, least - lag)
            runs += [(a, b - a + 1 + lag, lag) for a, b in zip(first[enough].tolist(), last[enough].tolist()) if is_smallest(words, a, lag)]

    places, names = repeated(np.arange(n), words, n)
    width = 1
    while width < least and len(places):
        shift = min(width, least - width)
        places, names = joined(places, names, shift)
        width += shift
    k = least
    while len(places) and 2 * k <= longest:
        within = [r for r in runs if r[2] <= k // 2 and r[1] >= k]
        inside = np.zeros(n, bool)
        for start, length, _ in within:
            inside[start:start + length - k + 1] = True
        found_at, lags = earlier_occurrences(places[~inside[places]], names, k, 2 * k)
        if within:
            more_at, more_lags = cells_of_starts(within, places, names, k)
            found_at, lags = np.concatenate([found_at, more_at]), np.concatenate([lags, more_lags])
        runs += emitted(words, found_at, lags, k)
        places, names = joined(places, names, k)
        k *= 2
    return runs


def emitted(words: np.ndarray, found_at: np.ndarray, lags: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Runs of the diagonals through given cells, each of which matches ``k`` words."""
    if not len(found_at):
        return []
    order = np.lexsort((found_at, lags))
    found_at, lags = found_at[order], lags[order]
    breaks = np.flatnonzero((np.diff(lags) != 0) | (np.diff(found_at) > 1)) + 1
    firsts, lasts = np.concatenate([[0], breaks]), np.concatenate([breaks - 1, [len(lags) - 1]])
    runs, lag_before, ended = [], 0, 0
    for at, last, lag in zip(found_at[firsts].tolist(), found_at[lasts].tolist(), lags[firsts].tolist()):
        if lag == lag_before and at < ended:
            continue  # on a diagonal that has been followed to its end
        begin, lag_before, ended = active_from(words, at, lag), lag, active_until(words, last + k, lag)
        if ended - begin >= lag and is_smallest(words, begin - lag, lag):
            runs.append((begin - lag, ended - begin + lag, lag))
    return runs


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Runs of every list of words, by start, then period."""
    flat = [w for words in texts for w in words]
    number = {w: i for i, w in enumerate(set(flat))}
    sizes = np.array([len(words) for words in texts], np.int64)
    codes = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat)) + np.repeat(np.arange(len(texts)), sizes) * len(number)
    begins = np.cumsum(sizes) - sizes + np.arange(len(texts))  # one place more for each text before
    words = np.empty(len(flat) + len(texts), np.int64)
    ends = begins + sizes
    words[ends] = -1 - np.arange(len(texts))
    inner = np.ones(len(words), bool)
    inner[ends] = False
    words[inner] = codes
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    runs = find_runs(words, int(sizes.max(initial=0)), least)
    if runs:
        of = np.searchsorted(begins, [r[0] for r in runs], side="right") - 1
        for (start, length, period), text in zip(runs, of.tolist()):
            found[text].append((start - int(begins[text]), length, period))
    return [sorted(own, key=lambda r: (r[0], r[2])) for own in found]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``TOGETHER`` bytes together; a longer text is alone."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > TOGETHER:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def periodic_runs(docs: DataFrame, least: int = LEAST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, runs (array of start, length, period), collapsed (kept words joined by blanks)."""
    names = [key, "n_words", "runs", "collapsed"]
    if key in names[1:]:
        raise ValueError(f"the name of the key clashes with a result: {key}")
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, (kind, T.LongType(), T.ArrayType(RUN), T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]
        for batch in batches:
            # Splitting bytes takes the six white-space characters of ASCII.
            rows = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for begin, stop in groups([len(r) for r in rows]):
                texts = [r.split() for r in rows[begin:stop]]
                found = runs_of_texts(texts, least)
                flat = np.array([r for own in found for r in own], np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=[pa.field(*f) for f in fields])
                offsets = np.concatenate([[0], np.cumsum([len(own) for own in found])]).astype(np.int32)
                collapsed = [b" ".join(kept_words(w, own)) for w, own in zip(texts, found)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, stop - begin), pa.array([len(w) for w in texts], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets), structs), pa.array(collapsed, pa.binary()).cast(pa.string())], names=names)

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema)
