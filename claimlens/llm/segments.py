"""Token ids of whole texts through a table of distinct pieces.

The ``tokenizers`` library spends nearly all its time on merging; most pieces of a text have been merged before.
Here a slice of texts is cut into the tokenizer's own pieces with numpy, each distinct piece is merged once by the
library's model (the table starts afresh when it is full), and the ids are gathered.  Texts with characters outside
the plain alphabet, or that may hold a special token, are encoded whole by the library.  The ids equal those of the
library in either case; the tests hold that.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import LOWER, SPACE, text_bytes

# Kinds of bytes.  Bytes from 0x80 count as letters; texts in which they are not are left to the library.
_KIND = np.ones(256, np.int8)                                  # 1: letter
_KIND[0x21:0x7F] = 3                                           # 3: other visible characters
_KIND[0x30:0x3A] = 2                                           # 2: digit
_KIND[0x41:0x5B] = 1
_KIND[0x61:0x7B] = 1
_KIND[SPACE] = 0                                               # 0: white space
# Left to the library: control characters, and everything over U+024F or under U+00C0 that is not ASCII.
_ODD = np.zeros(256, bool)
_ODD[:0x20] = True
_ODD[SPACE] = False
_ODD[0x7F] = True
_ODD[0xC0:0xC3] = True
_ODD[0xC9:] = True


class SegmentTable:
    """Ids by distinct piece, kept between the slices of a task, at most about ``max_entries`` of them."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], max_entries: int = 400_000):
        self.encode, self.max_entries = encode, max_entries
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.start = np.zeros(1 << 12, np.int64)
        self.length = np.zeros(1 << 12, np.int64)
        self.pool = np.zeros(1 << 15, np.uint32)
        self.used = 0

    def rows(self, pieces: list[str]) -> np.ndarray:
        """Row of each piece in the table; unknown ones are encoded first.  Pieces are distinct."""
        if len(self.at) + len(pieces) > self.max_entries:
            self._clear()
        found = np.fromiter(map(self.at.get, pieces, [-1] * len(pieces)), np.int64, len(pieces))
        new = np.flatnonzero(found < 0)
        if len(new):
            names = [pieces[i] for i in new]
            coded = self.encode(names)
            lengths = np.fromiter(map(len, coded), np.int64, len(coded))
            n, first, total = len(new), len(self.at), int(lengths.sum())
            while first + n > len(self.start):
                self.start = np.concatenate([self.start, np.zeros_like(self.start)])
                self.length = np.concatenate([self.length, np.zeros_like(self.length)])
            while self.used + total > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.length[first:first + n] = lengths
            self.start[first:first + n] = self.used + np.cumsum(lengths) - lengths
            self.pool[self.used:self.used + total] = np.fromiter((i for ids in coded for i in ids), np.uint32, total)
            self.used += total
            self.at.update(zip(names, range(first, first + n)))
            found[new] = np.arange(first, first + n)
        return found

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the rows in order, ids before each row; one entry more than rows)."""
        lengths = self.length[rows]
        before = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(lengths, out=before[1:])
        index = np.repeat(self.start[rows] - before[:-1], lengths)
        index += np.arange(before[-1])
        return self.pool[index], before


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for U+0100 upwards, in byte order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b if b in printable else next(rest)) for b in range(256)}


def library_texts(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts are left to the library: others than ASCII and Latin letters to U+024F, or with ``<|``."""
    odd = _ODD[flat]
    second = flat[1:]
    lead = flat[:-1]
    odd[:-1] |= (lead == 0xC3) & ((second == 0x97) | (second == 0xB7))          # the signs among Latin letters
    odd[:-1] |= (lead == 0xC4) & (second == 0xB0)                               # dotted I: lower case has two characters
    odd[:-1] |= (lead == 0x3C) & (second == 0x7C)
    marks = np.flatnonzero(odd)
    found = np.zeros(len(offsets) - 1, bool)
    found[np.searchsorted(offsets, marks, side="right") - 1] = True
    return found


def piece_starts(flat: np.ndarray, offsets: np.ndarray, spaced: bool) -> np.ndarray:
    """Where the tokenizer's pieces begin in plain texts.

    ``spaced``: a single space goes to the piece after it, of longer white space the last character stands alone
    and digits run together; else white space is in no piece and each digit is one.
    Contractions ('s 't 'm 'd 're 've 'll) are pieces where an apostrophe begins one.
    """
    kind = _KIND[flat]
    n = len(flat)
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True                                      # text bounds; the entry n is dropped at the end
    prev = np.empty(n, np.int8)
    prev[:1], prev[1:] = -1, kind[:-1]
    prev[offsets[:-1][offsets[:-1] < n]] = -1
    start = kind != prev
    if spaced:
        after_space = (prev == 0) & (kind != 0)
        start[1:] &= ~(after_space[1:] & (flat[:-1] == 0x20))   # joined to the space before it
        last = np.flatnonzero(after_space) - 1
        start[last] = True                                      # the last of a run of white space
    else:
        start |= kind == 2
    quotes = np.flatnonzero((flat == 0x27) & start)
    quotes = quotes[quotes + 1 < n]
    quotes = quotes[~begins[quotes + 1]]
    one = quotes[np.isin(flat[quotes + 1], np.frombuffer(b"stmd", np.uint8))]
    rest = quotes[quotes + 2 < n]
    rest = rest[~begins[rest + 2]]
    pair = flat[rest + 1].astype(np.int64) << 8 | flat[rest + 2]
    two = rest[np.isin(pair, [0x7265, 0x7665, 0x6C6C])]         # re, ve, ll
    start[one + 1] = False
    start[two + 1] = False
    for at in (one + 2, two + 3):
        at = at[at < n]
        start[at[kind[at] == 1]] = True                         # letters after it are a piece of their own
    return start


class PieceTokenizer:
    """Whole texts to ids with a ``tokenizers`` vocabulary given as bytes; special tokens in a text keep their ids."""

    def __init__(self, vocabulary: bytes, spaced: bool, max_entries: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(vocabulary.decode())
        self.spaced = spaced
        letters = _byte_letters()
        plain = [chr(i) for i in (*range(0x80), *range(0xC0, 0x250))]
        # lower-casing leads out of that range for some letters
        spelled = {ord(c): "".join(letters[b] for b in c.encode()) for p in plain for c in (p, *p.lower())}
        merge = self.library.model.tokenize

        def encode(pieces: list[str]) -> list[list[int]]:
            if spaced:
                return [[t.id for t in merge(p.translate(spelled))] for p in pieces]
            return [[t.id for t in merge(p if p.isascii() else p.lower().translate(spelled))] for p in pieces]

        self.table = SegmentTable(encode, max_entries)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, ids before each text; one entry more than texts)."""
        flat, offsets = text_bytes(texts)
        if not len(flat):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        whole = library_texts(flat, offsets)
        if whole.any():
            kept = np.repeat(~whole, np.diff(offsets))
            flat = flat[kept]
            offsets = np.concatenate([[0], np.cumsum(np.where(whole, 0, np.diff(offsets)))])
        if not self.spaced:
            flat = LOWER[flat]
        start = piece_starts(flat, offsets, self.spaced) if len(flat) else np.zeros(0, bool)
        if not self.spaced:
            visible = _KIND[flat] != 0
            start = start[visible]
            offsets = np.concatenate([[0], np.cumsum(visible)])[offsets]
            flat = flat[visible]
        first = np.flatnonzero(start)
        bounds = np.append(first, len(flat)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(flat)))
        coded = pieces.dictionary_encode()
        rows = self.table.rows(coded.dictionary.to_pylist())
        ids, before = self.table.gather(rows[coded.indices.to_numpy(zero_copy_only=False)] if len(first) else np.zeros(0, np.int64))
        bounds = before[np.searchsorted(first, offsets)]
        if not whole.any():
            return ids, bounds
        at = np.flatnonzero(whole)
        made = dict(zip(at, self.library.encode_batch_fast([texts[int(i)].as_py() for i in at], add_special_tokens=False)))
        lists = [np.asarray(made[i].ids, np.uint32) if whole[i] else ids[bounds[i]:bounds[i + 1]] for i in range(len(texts))]
        return np.concatenate(lists), np.concatenate([[0], np.cumsum([len(x) for x in lists])])
