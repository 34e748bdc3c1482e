"""Byte-level BPE encoding and decoding of whole texts, pre-tokenised without regular expressions.

Slices between which no merge happens are found in arrays of code points.  Each code
point gets a class from a table (letter, number, other, white space); whether white
space is the last of its run, and whether an apostrophe opens a contraction, is told
by its neighbours.  A class then is a function from the kind of the slice being read
to the next kind.  Composing such functions is associative and there are only a few
dozen compositions, so blocks of text are composed side by side, blocks are chained,
and the kinds inside all blocks follow from the kind at each block's start.

The slices become an Arrow dictionary.  Only slices that the worker hasn't met are
merged, pair by pair in order of rank.  With the ids go the byte offsets where each
id ends in its text: decoding places the bytes of all ids of a batch at once, and a
part of a text is decoded without the rest.

Defined cases: a missing text is an empty one and has no ids.  Every row is encoded
for itself, also when ids or texts repeat; an empty table gives an empty one.  Bytes
that are no UTF-8 count as U+FFFD.  A very long text is cut into slices in windows
of bounded size; its ids are held at once.  Extra columns are not carried by
``encode``; ``decode`` carries all columns but the two it reads.
"""

from __future__ import annotations

import base64
import heapq
import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors get these functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Slices a worker remembers, and bytes of text whose code points it takes at a time.
REMEMBERED = 500_000
WINDOW = 1_000_000
# Longest slice whose pairs are kept in a list, and the rank of a pair that never merges.
SHORT_BYTES, NEVER = 64, 1 << 62

# Classes of code points.  SPACE: more white space or the end follows.  BLANK, LONE: a blank, or other
# white space, that is the last of its run.  SHORT, LONG: an apostrophe that opens 's 't 'm 'd, or 're 've 'll.
LETTER, NUMBER, OTHER, SPACE, BLANK, LONE, SHORT, LONG = range(8)
CLASSES = 8  # a code point that begins its text has its class plus this

# Kinds of slices being read: nothing yet, runs, a blank that joins what follows, one or two letters to come.
NEW, LETTERS, NUMBERS, OTHERS, SPACES, JOINING, ONE_MORE, TWO_MORE = range(8)
KINDS = 8


def step(kind: int, of: int) -> tuple[int, bool]:
    """The kind of slice after a code point, and whether the code point begins a slice."""
    if of >= CLASSES:
        return step(NEW, of - CLASSES)[0], True
    if kind == TWO_MORE:
        return ONE_MORE, False
    if kind == ONE_MORE:
        return NEW, False
    runs = {LETTER: LETTERS, NUMBER: NUMBERS, OTHER: OTHERS}
    if of in runs:
        return runs[of], kind not in (runs[of], JOINING)
    if of in (SHORT, LONG):
        if kind in (OTHERS, JOINING):
            return OTHERS, False
        return (ONE_MORE if of == SHORT else TWO_MORE), True
    if of == SPACE:
        return SPACES, kind != SPACES
    return (JOINING if of == BLANK else NEW), True


NEXT = np.array([[step(k, c)[0] for c in range(2 * CLASSES)] for k in range(KINDS)], np.uint8)
BEGINS = np.array([[step(k, c)[1] for c in range(2 * CLASSES)] for k in range(KINDS)])


def compositions() -> tuple[np.ndarray, np.ndarray]:
    """All functions that classes compose to, as rows of kinds, and the table of a function followed by a class.

    Function 0 changes nothing.
    """
    rows, place, table = [tuple(range(KINDS))], {tuple(range(KINDS)): 0}, []
    for row in rows:  # grows while it is read
        after = []
        for of in range(2 * CLASSES):
            made = tuple(int(NEXT[k, of]) for k in row)
            if made not in place:
                place[made] = len(rows)
                rows.append(made)
            after.append(place[made])
        table.append(after)
    return np.array(rows, np.uint8), np.array(table, np.uint16)


FUNCTIONS, THEN = compositions()
BLOCK = 256


def slice_begins(classes: np.ndarray) -> np.ndarray:
    """For every code point whether it begins a slice, by scans over transition functions."""
    n = len(classes)
    blocks = -(-n // BLOCK)
    by_place = np.zeros(blocks * BLOCK, np.uint8)
    by_place[:n] = classes
    by_place = np.ascontiguousarray(by_place.reshape(blocks, BLOCK).T).astype(np.intp)  # a row: one place in all blocks
    whole, flat = np.zeros(blocks, np.intp), THEN.ravel()
    for at in by_place:
        whole = flat[whole * (2 * CLASSES) + at].astype(np.intp)
    entry, kind = np.empty(blocks, np.intp), NEW
    for b, f in enumerate(whole.tolist()):
        entry[b] = kind
        kind = int(FUNCTIONS[f, kind])
    found, after, begins = np.empty((BLOCK, blocks), bool), NEXT.ravel(), BEGINS.ravel()
    for place, at in enumerate(by_place):
        key = entry * (2 * CLASSES) + at
        found[place] = begins[key]
        entry = after[key].astype(np.intp)
    return found.T.ravel()[:n]


def class_ranges() -> list[tuple[int, int]]:
    """(first code point, class) of all ranges of equal class, as the tiktoken library's patterns tell them."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    of = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        one = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        matched = bytes(one.encode_ordinary(every)).decode()
        of[np.frombuffer(matched.encode("utf-32-le"), "<u4")] = kind
    starts = np.flatnonzero(np.diff(of, prepend=255))
    return list(zip(starts.tolist(), of[starts].tolist()))


def class_table(ranges: list[tuple[int, int]]) -> np.ndarray:
    starts = np.array([s for s, _ in ranges] + [0x110000])
    return np.repeat(np.array([c for _, c in ranges], np.uint8), np.diff(starts))


def seen_classes(points: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Classes of code points with what their neighbours tell; ``first``: places where texts begin."""
    of = table[points]
    after = np.full(len(of) + 2, LETTER, np.uint8)  # class of the next code point
    after[:len(of) - 1] = of[1:]
    after[first[first > 0] - 1] = SPACE  # the end of a text counts as white space
    after[len(of) - 1:] = SPACE
    spaces = np.flatnonzero(of == SPACE)
    last = spaces[after[spaces] != SPACE]
    of[last] = np.where(points[last] == 32, BLANK, LONE)
    marks = np.flatnonzero(points == 39)
    if len(marks):
        ends = np.append(first[1:], len(points))
        end = ends[np.searchsorted(first, marks, side="right") - 1]
        padded = np.append(points, [0, 0])
        one, two = (np.where(marks + i < end, padded[marks + i], 0) for i in (1, 2))
        of[marks[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        of[marks[np.any([(one == a) & (two == b) for a, b in pairs], axis=0)]] = LONG
    of[first] += CLASSES
    return of


class Coder:
    """Ranks of byte strings, and slices merged so far."""

    def __init__(self, ranks: dict[bytes, int], ranges: list[tuple[int, int]]):
        self.ranks, self.classes = ranks, class_table(ranges)
        self.bytes = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.pairs = {ranks[t[:i]] << 32 | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.lengths)])
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def starts(self, data: bytes, first: np.ndarray) -> np.ndarray:
        """Byte offsets at which slices begin; ``first``: byte offsets of texts that aren't empty."""
        raw = np.frombuffer(data, np.uint8)
        points = np.frombuffer(data.decode().encode("utf-32-le"), "<u4")
        if len(points) == len(raw):
            return np.flatnonzero(slice_begins(seen_classes(points, first, self.classes)))
        leads = np.flatnonzero((raw & 0xC0) != 0x80)
        return leads[slice_begins(seen_classes(points, np.searchsorted(leads, first), self.classes))]

    def long_starts(self, data: bytes) -> np.ndarray:
        """``starts`` of one long text, window by window; each begins where a slice does."""
        found, begin, width = [], 0, WINDOW
        while begin < len(data):
            stop = min(begin + width, len(data))
            while stop < len(data) and data[stop] & 0xC0 == 0x80:
                stop += 1
            own = self.starts(data[begin:stop], np.zeros(1, np.int64))
            if stop < len(data):  # the last slice, and what the next code points decide, are left to the next window
                own = own[own < stop - begin - 16]
                if len(own) < 2:
                    width *= 2
                    continue
                found.append(own[:-1] + begin)
                begin, width = begin + int(own[-1]), WINDOW
            else:
                found.append(own + begin)
                begin = stop
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a slice: always the adjacent pair of lowest rank, the leftmost first, becomes one."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        return self._merged_short(piece) if len(piece) <= SHORT_BYTES else self._merged_long(piece)

    def _merged_short(self, piece: bytes) -> list[int]:
        """All pairs' ranks in a list; right for any length, fast for words."""
        rank, ids = self.pairs.get, [self.bytes[b] for b in piece]
        pairs = [rank(a << 32 | b, NEVER) for a, b in zip(ids, ids[1:])]
        while pairs and (least := min(pairs)) != NEVER:
            i = pairs.index(least)
            ids[i] = least
            del ids[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(least << 32 | ids[i + 1], NEVER)
            if i:
                pairs[i - 1] = rank(ids[i - 1] << 32 | least, NEVER)
        return ids

    def _merged_long(self, piece: bytes) -> list[int]:
        """Pairs in a heap: time grows little faster than the slice."""
        n, rank, ids = len(piece), self.pairs.get, [self.bytes[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank(a << 32 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            least, i, a, b = heapq.heappop(heap)
            if ids[i] != a or (right := after[i]) >= n or ids[right] != b:
                continue  # one of the two has changed since
            ids[i], ids[right], after[i] = least, -1, after[right]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank(least << 32 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i, least, ids[after[i]]))
            if (left := before[i]) >= 0 and (r := rank(ids[left] << 32 | least)) is not None:
                heapq.heappush(heap, (r, left, ids[left], least))
        return [x for x in ids if x >= 0]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of every text."""
        data = b"".join(texts)
        if not data:
            return [np.empty(0, "<u4") for _ in texts]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        if len(texts) == 1 and len(data) > WINDOW:
            starts = self.long_starts(data)
        else:
            starts = self.starts(data, offsets[:-1][np.diff(offsets) > 0])
        bounds = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        made = []
        for piece in pieces.dictionary.to_pylist():
            if (ids := self.known.get(piece)) is None:
                if (ids := self.older.get(piece)) is None:
                    own = self.merged(piece)
                    ids = struct.pack(f"<{len(own)}I", *own)
                self.known[piece] = ids
            made.append(ids)
        counts = np.array([len(m) // 4 for m in made], np.int64)
        lists = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]), np.frombuffer(b"".join(made), "<u4"))
        of = pieces.indices.to_numpy()
        flat = lists.take(pieces.indices).flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum(counts[of])])[np.searchsorted(starts, offsets)]
        return [flat[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Where the bytes of each id end in the text."""
        return np.cumsum(self.lengths[ids]).astype("<u4")

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        """The bytes of ids whose ends are given, counted from the end of the id before them."""
        if not len(ids):
            return b""
        lengths = np.diff(ends.astype(np.int64), prepend=0)
        if not np.array_equal(lengths, self.lengths[ids]):
            raise ValueError("the offsets are not those of the ids")
        shift = np.repeat(self.at[ids] - (ends - lengths), lengths)
        return self.data[shift + np.arange(len(shift))].tobytes()

    def part(self, ids: np.ndarray, ends: np.ndarray, first: int, stop: int) -> bytes:
        """The bytes of the ids from ``first`` up to ``stop``, without decoding the others."""
        base = int(ends[first - 1]) if first else 0
        return self.decode(ids[first:stop], ends[first:stop].astype(np.int64) - base)


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks, from lines of a Base64 string and a number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def coder(path: str, ranges: list[tuple[int, int]]) -> Coder:
    """The worker's coder, which outlives its tasks; kept beside a library, since this module comes anew with every job."""
    import tiktoken

    kept = tiktoken.__dict__.setdefault("_kept_coders", {})
    if path not in kept:
        kept[path] = Coder(read_ranks(path), ranges)
    return kept[path]


def valid(text: bytes) -> bytes:
    """The text, with U+FFFD for bytes that are no UTF-8."""
    try:
        text.decode()
        return text
    except UnicodeDecodeError:
        return text.decode(errors="replace").encode()


def groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``WINDOW`` bytes together; a longer text is alone."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > WINDOW:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """(key, n_tokens long, ids, ends) of every row; ids and ends are little-endian unsigned 32-bit integers.

    With ``decoded`` the worker decodes the ids as well and adds the bytes as a column of that name.
    """
    if key in ("n_tokens", "ids", "ends", "decoded"):
        raise ValueError(f"the name of the key clashes with a result: {key}")
    ranges = class_ranges()
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("ends", T.BinaryType()), *[T.StructField("decoded", T.BinaryType())] * decoded])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, ranges)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).fill_null(b"")
            for begin, stop in groups(pc.binary_length(texts).to_pylist()):
                ids = own.encode([valid(t) for t in texts.slice(begin, stop - begin).to_pylist()])
                ends = [own.ends(x) for x in ids]
                columns = [batch.column(0).slice(begin, stop - begin), pa.array([len(x) for x in ids], pa.int64()),
                           pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([e.tobytes() for e in ends], pa.binary())]
                if decoded:
                    columns.append(pa.array([own.decode(x, e) for x, e in zip(ids, ends)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of encoded rows, with ``decoded`` (the text's bytes) in place of ids and ends."""
    others = [f for f in encoded.schema.fields if f.name not in ("ids", "ends", "decoded")]
    schema = T.StructType([*others, T.StructField("decoded", T.BinaryType())])
    ranges = class_ranges()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, ranges)
        for batch in batches:
            for begin, stop in groups(pc.binary_length(batch.column(0)).to_pylist()):
                rows = batch.slice(begin, stop - begin)
                texts = [own.decode(np.frombuffer(i, "<u4"), np.frombuffer(e, "<u4"))
                         for i, e in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([*rows.columns[2:], pa.array(texts, pa.binary())], names=schema.names)

    return encoded.select("ids", "ends", *[F.col(f"`{f.name}`") for f in others]).mapInArrow(run, schema)
