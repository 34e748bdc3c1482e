"""Token ids of whole texts with public tokenizers, inside Arrow batches.

Both kinds of tokenizers split at white space before they merge, so the ids of a
text are the ids of its chunks between single blanks and line feeds, one after the
other.  Chunks become a dictionary, and words are cut from the marks behind them,
by Arrow; only pieces that the worker hasn't met are encoded.  A word of Latin
letters goes to the tokenizer's merge model directly, any other piece through the
whole tokenizer, and so do whole texts in which chunks might not be independent.
"""

from __future__ import annotations

import os
import re
import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Executors get these functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pieces a worker remembers, and characters of text it takes at a time.
REMEMBERED = 500_000
CHARACTERS = 6_000_000

# White space other than blank and line feed, and separators that libraries class differently.
OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028-\u2029\u202f\u205f\u3000]")
ASCII_SPACE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
# Latin letters: all are letters in Unicode, keep their form in NFC and lower to one letter.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ȿ"
MARKS = ",.;:!?"
SIMPLE = re.compile(f" ?[{LETTERS}]+|[{MARKS}]+|\n")
# In front of a chunk: it begins its text, or a line; neither has a blank before it.
FIRST, LINE = "\x1f", "\x1e"


def byte_alphabet() -> dict[int, str]:
    """Characters by which byte-level vocabularies write bytes: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def uneven(text: str) -> bool:
    """Whether anything but one blank or one line feed stands between two words, or a blank at an end."""
    if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] == " " or text[-1:] == " ":
        return True
    return any(c in text for c in ASCII_SPACE) if text.isascii() else OTHER_SPACE.search(text) is not None


class Encoder:
    """Ids of texts as little-endian bytes, in a type wide enough for the vocabulary.

    ``spaced``: blanks belong to the ids (byte-level vocabularies); else white space
    and case are dropped.
    """

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.spaced = Tokenizer.from_file(path), spaced
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self._forget()

    def _forget(self) -> None:
        """Known pieces and their ids, one list each; the first is empty."""
        self.pieces = pa.array([""], pa.large_string())
        self.offsets, self.ids = np.zeros(2, np.int64), np.empty(0, self.dtype)

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, piece: str) -> bytes:
        """Ids of a simple piece, straight from the merge model."""
        if not piece.isascii() or piece == "\n":
            piece = piece.encode().decode("latin-1").translate(self.alphabet)
        elif piece[0] == " ":
            piece = self.alphabet[32] + piece[1:]
        return self._packed([t.id for t in self.model.tokenize(piece)])

    def _rows(self, pieces: pa.Array) -> np.ndarray:
        """Where the distinct pieces stand among the known ones; new ones are added."""
        if len(self.pieces) > REMEMBERED:
            self._forget()
        rows = pc.index_in(pieces, value_set=self.pieces)
        unknown = rows.is_null().to_numpy(zero_copy_only=False)
        rows = rows.fill_null(0).to_numpy().astype(np.int64)
        new = pieces.filter(pa.array(unknown))
        if len(new):
            texts = new.to_pylist()
            simple = [SIMPLE.fullmatch(t) is not None for t in texts]
            others = iter(self._whole([t for t, s in zip(texts, simple) if not s]))
            ids = [self._merged(t) if s else next(others) for t, s in zip(texts, simple)]
            lengths = np.array([len(x) for x in ids], np.int64) // self.dtype.itemsize
            rows[unknown] = len(self.pieces) + np.arange(len(new))
            self.pieces = pa.concat_arrays([self.pieces, new])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths)])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), self.dtype)])
        return rows

    def _cut(self, chunks: pa.Array) -> np.ndarray:
        """For each distinct chunk the known pieces that make it up: a line feed, a word, marks (or the empty one).

        A chunk that is not a word of letters with marks behind it is one piece.
        """
        nothing = pa.scalar("", pa.large_string())
        body, lead, line = chunks, nothing, pa.scalar(False)
        if self.spaced:
            line = pc.starts_with(chunks, LINE)
            bare = pc.or_(pc.starts_with(chunks, FIRST), line)
            body = pc.if_else(bare, pc.utf8_slice_codeunits(chunks, 1), chunks)
            lead = pc.if_else(bare, nothing, pa.scalar(" ", pa.large_string()))
        word = pc.ascii_rtrim(body, characters=MARKS)
        simple = pc.match_substring_regex(word, f"^[{LETTERS}]+$")
        easy = pc.binary_join_element_wise(lead, word if self.spaced else pc.utf8_lower(word), nothing)
        hard = pc.binary_join_element_wise(pc.if_else(line, pa.scalar("\n", pa.large_string()), lead), body, nothing)
        keys = pc.if_else(simple, easy, hard).dictionary_encode()
        marked = pc.and_(simple, pc.greater(pc.binary_length(body), pc.binary_length(word)))
        marks = pc.extract_regex(body.filter(marked), f"(?P<m>[{MARKS}]+)$").field(0).dictionary_encode()
        n = len(keys.dictionary)
        rows = self._rows(pa.concat_arrays([keys.dictionary, marks.dictionary, pa.array(["\n"], pa.large_string())]))
        parts = np.zeros((len(chunks), 3), np.int64)
        parts[:, 1] = rows[:n][keys.indices.to_numpy()]
        parts[np.flatnonzero(marked.to_numpy(zero_copy_only=False)), 2] = rows[n:-1][marks.indices.to_numpy()]
        if self.spaced:
            parts[pc.and_(simple, line).to_numpy(zero_copy_only=False), 0] = rows[-1]
        return parts

    def encode(self, texts: list[str]) -> list[bytes]:
        apart = [any(s in t for s in self.special) or (self.spaced and uneven(t)) for t in texts]
        even = []
        for t, a in zip(texts, apart):
            if not a and self.spaced:
                even.append(FIRST + t.replace("\n", " " + LINE))
            elif not a:
                for blank in "\t\n\x0b\x0c\r":
                    t = t.replace(blank, " ")
                even.append(t)
        split = pc.split_pattern(pa.array(even, pa.large_string()), " ")
        flat = split.flatten().dictionary_encode()
        parts = self._cut(flat.dictionary)
        known = pa.LargeListArray.from_arrays(self.offsets, self.ids)
        made = known.take(pa.array(parts.ravel()))
        chunks = pa.LargeListArray.from_arrays(pa.array(made.offsets.to_numpy()[::3]), made.flatten())
        data = chunks.take(flat.indices).flatten().to_numpy().tobytes()
        lengths = np.diff(chunks.offsets.to_numpy()) * self.dtype.itemsize
        ends = np.concatenate([[0], np.cumsum(lengths[flat.indices.to_numpy()])])[split.offsets.to_numpy()].tolist()
        found = (data[a:b] for a, b in zip(ends, ends[1:]))
        del split, flat, made, chunks
        pa.default_memory_pool().release_unused()
        return [self._whole([t])[0] if a else next(found) for t, a in zip(texts, apart)]


def encoder(path: str, spaced: bool) -> Encoder:
    """The worker's encoder, which outlives its tasks.

    It is kept beside the tokenizers library, since this module comes anew with every job.
    """
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_kept_encoders", {})
    if (path, spaced) not in kept:
        kept[path, spaced] = Encoder(path, spaced)
    return kept[path, spaced]


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def vocabulary_type(path: str) -> np.dtype:
    from tokenizers import Tokenizer

    return id_type(Tokenizer.from_file(path).get_vocab_size())


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``CHARACTERS`` characters each."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHARACTERS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
