"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is cut before each run of spaces: no piece of the vocabulary has a space after another character (checked when
the vocabulary is read), so nothing merges across.  Distinct segments are encoded by an agenda of adjacent symbol
pairs: the pair whose merged piece has the best score goes first, the leftmost of equals, and its neighbours are put
on the agenda anew.  Short segments of one length run the same agenda side by side in numpy, the longer ones have a
heap.  Characters without a piece become byte pieces.

Every distinct segment's ids are compared with the sentencepiece library's once per task, and so is the first whole
text of every slice; a difference raises an error.  Texts: null ones count as empty and give no ids; a very long one is a
slice of its own, cut into segments like any other.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from .common import append_columns, text_bytes
from .segments import SegmentTable

SPACE_MARK = "▁"
#: Segments of up to so many symbols run side by side in numpy.
SIDE_BY_SIDE = 40
_NONE = np.iinfo(np.int32).max


class PieceVocabulary:
    """A sentencepiece BPE model (given as bytes) with its merges by symbol pair."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib, n = self.library, self.library.get_piece_size()
        names = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        if any(SPACE_MARK in names[i].lstrip(SPACE_MARK) for i in plain) or any(lib.is_unused(i) for i in plain):
            raise ValueError("pieces with a space after another character, or unused pieces, are not supported")
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        symbols = {names[i]: i for i in plain}
        for i in plain:                                          # characters that occur only inside pieces
            for c in names[i]:
                symbols.setdefault(c, len(symbols) + n)
        self.ids, self.unknown = n, len(symbols) + n             # symbols from ids on are no pieces
        self.of_char = np.arange(0x110000, dtype=np.int64) + self.unknown
        for s, i in symbols.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        self.of_char[0x20] = self.of_char[ord(SPACE_MARK)]
        scores = sorted({lib.get_score(i) for i in plain}, reverse=True)
        rank = {x: r for r, x in enumerate(scores)}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}  # symbols -> (rank of the merged piece, its id)
        for i in plain:
            for cut in range(1, len(names[i])):
                a, b = symbols.get(names[i][:cut]), symbols.get(names[i][cut:])
                if a is not None and b is not None:
                    self.pairs[a, b] = (rank[lib.get_score(i)], i)
        self.base = self.unknown + 0x110000
        keys = np.array([a * self.base + b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.array([r for r, _ in self.pairs.values()], np.int64)[order], _NONE).astype(np.int32)
        self.merged = np.append(np.array([i for _, i in self.pairs.values()], np.int64)[order], -1)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of symbol pairs; rank _NONE where a pair does not merge."""
        key = a * self.base + b
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), self.merged[at]

    def agenda(self, symbols: list[int]) -> list[int]:
        """Merges one segment's symbols from a heap of (rank, left place, right place, symbols, merged)."""
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        heap: list[tuple] = []

        def add(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.pairs.get((symbols[i], symbols[j]))):
                heapq.heappush(heap, (found[0], i, j, symbols[i], symbols[j], found[1]))

        for i in range(len(symbols) - 1):
            add(i, i + 1)
        while heap:
            _, i, j, a, b, merged = heapq.heappop(heap)
            if symbols[i] != a or symbols[j] != b or after[i] != j:
                continue
            symbols[i], symbols[j] = merged, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            add(before[i], i)
            add(i, after[i])
        return [s for s in symbols if s >= 0]

    def side_by_side(self, grid: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same for many segments of one length: (rows, their symbols) for each number of symbols left."""
        done, rows = [], np.arange(len(grid))
        rank, merged = self.look_up(grid[:, :-1], grid[:, 1:])
        while len(rows):
            n = grid.shape[1]
            if n == 1:
                done.append((rows, grid))
                break
            best = rank.argmin(axis=1)
            going = rank[np.arange(len(rows)), best] != _NONE
            if not going.all():
                done.append((rows[~going], grid[~going]))
                rows, grid, rank, merged, best = rows[going], grid[going], rank[going], merged[going], best[going]
                if not len(rows):
                    break
            m, every = len(rows), np.arange(len(rows))
            new = merged[every, best]
            keep = np.ones((m, n), bool)
            keep[every, best + 1] = False
            grid = grid[keep].reshape(m, n - 1)
            grid[every, best] = new
            keep = np.ones((m, n - 1), bool)
            keep[every, best] = False
            rank, merged = rank[keep].reshape(m, n - 2), merged[keep].reshape(m, n - 2)
            left = np.flatnonzero(best > 0)
            at = best[left] - 1
            rank[left, at], merged[left, at] = self.look_up(grid[left, at], new[left])
            right = np.flatnonzero(best < n - 2)
            at = best[right]
            rank[right, at], merged[right, at] = self.look_up(new[right], grid[right, at + 1])
        return done

    def _pieces(self, symbols: list[int]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            if s < self.ids:
                out.append(s)
            else:
                out += [self.byte_ids[b] for b in self._char(s).encode()]
        return out

    def _char(self, symbol: int) -> str:
        return chr(symbol - self.unknown) if symbol >= self.unknown else chr(int(np.flatnonzero(self.of_char[:0x110000] == symbol)[0]))

    def encode(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments that begin with their spaces."""
        if not segments:
            return []
        points = np.frombuffer("".join(segments).encode("utf-32-le"), "<u4")
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        ends = np.cumsum(sizes)
        symbols = self.of_char[points]
        out: list = [None] * len(segments)
        for n in np.unique(sizes):
            which = np.flatnonzero(sizes == n)
            if n <= SIDE_BY_SIDE:
                grid = symbols[(ends[which] - n)[:, None] + np.arange(n)]
                for rows, left in self.side_by_side(grid):
                    strange = (left >= self.ids).any(axis=1)
                    for r, ids, odd in zip(which[rows].tolist(), left.tolist(), strange.tolist()):
                        out[r] = self._pieces(ids) if odd else ids
            else:
                for r in which:
                    out[r] = self._pieces(self.agenda(symbols[ends[r] - n:ends[r]].tolist()))
        # the library puts the first space mark itself, but not before an empty text
        checked = [(s[1:], ids) for s, ids in zip(segments, out) if len(s) > 1]
        if [ids for _, ids in checked] != self.library.encode([s for s, _ in checked], num_threads=1):
            raise ValueError("ids differ from the sentencepiece library's")
        return out


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(segments that begin with their spaces, segments before each text); each text gets the leading space mark."""
    if pc.any(pc.match_substring(texts, SPACE_MARK)).as_py():
        texts = pc.replace_substring(texts, SPACE_MARK, " ")
    flat, offsets = text_bytes(texts)
    filled = np.flatnonzero(np.diff(offsets))
    flat = np.insert(flat, offsets[filled], 0x20)
    offsets = offsets + np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
    space = flat == 0x20
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[offsets[:-1][filled]] = True
    first = np.flatnonzero(start)
    bounds = np.append(first, len(flat)).astype(np.int32)
    segments = pa.StringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(flat)))
    return segments, np.searchsorted(first, offsets)


class PieceEncoder:
    """Whole texts to ids; decode() is the library's, on all ids of a text."""

    def __init__(self, model: bytes, max_entries: int = 300_000):
        self.vocabulary = PieceVocabulary(model)
        self.table = SegmentTable(self.vocabulary.encode, max_entries)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, ids before each text; one entry more than texts)."""
        segments, bounds = cut(texts)
        coded = segments.dictionary_encode()
        rows = self.table.rows(coded.dictionary.to_pylist())
        ids, before = self.table.gather(rows[coded.indices.to_numpy(zero_copy_only=False)] if len(segments) else np.zeros(0, np.int64))
        before = before[bounds]
        if len(texts) and ids[:before[1]].tolist() != self.vocabulary.library.encode(texts[0].as_py()):
            raise ValueError("ids of a whole text differ from the sentencepiece library's")
        return ids, before

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.vocabulary.library.decode(ids, num_threads=1)


def encode_and_decode(df: DataFrame, text_col: str, model: bytes, keep_ids: bool = True) -> DataFrame:
    """df with n_tokens, ids (array, null with ``keep_ids=False``), ids_sha256 and decoded_sha256.

    Rows are taken as they come; a clashing column name gets an underscore; an empty table stays empty.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)      # a vocabulary file: under a MB, whatever the input

    def make():
        encoder = PieceEncoder(shared.value)
        names = [str(i) for i in range(encoder.vocabulary.ids)]
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()

        def compute(texts: pa.Array) -> list:
            ids, before = encoder.encode(texts)
            lists = [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])]
            return [np.diff(before), pa.array(lists if keep_ids else [None] * len(lists), pa.list_(pa.int32())),
                    pa.array([digest(",".join([names[i] for i in x])) for x in lists], pa.string()),
                    pa.array([digest(x) for x in encoder.decode(lists)], pa.string())]

        return compute

    return append_columns(df, text_col, {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()),
                                         "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}, make)
