"""Bounded-space online packing of tokenised documents into fixed windows.

Each partition keeps ``open_windows`` windows open.  A document's whole windows are emitted as they are; its rest
goes to the open window that it fills best.  When none has room, the fullest window takes as much as it can hold
and is emitted, and the remainder is placed again.  Windows still open at the end of the partitions are merged in
groups of ``merge_lanes`` partitions: their tokens are laid end to end, and what does not fill a window is cut into
sequences whose lengths are powers of two.  So no sequence needs padding.

Every piece says where its tokens stand in their document and in their sequence.  Texts: null or empty ones have the
end id alone.  Rows are taken as they come (repeated rows are packed once each, null document ids stay null); an
empty table gives no piece; columns other than the two named are ignored.  Memory: one slice of texts, plus
``open_windows`` windows, whatever the length of a text's copies or the size of the partition.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import arrow_schema, row_slices, ship_package, stage_table, texts_of
from .segments import PieceTokenizer


class Windows:
    """The open windows of one partition; pieces are (document id, start, ids, document's tokens)."""

    def __init__(self, capacity: int, count: int):
        self.capacity, self.count = capacity, count
        self.free: list[int] = []
        self.pieces: list[list[tuple]] = []

    def place(self, doc, start: int, ids: np.ndarray, total: int) -> Iterator[list[tuple]]:
        """Places a piece shorter than a window; yields windows that are full, as lists of pieces."""
        while len(ids):
            need = len(ids)
            fits = [(f, k) for k, f in enumerate(self.free) if f >= need]
            if fits:
                _, k = min(fits)
            elif len(self.free) < self.count:
                k = len(self.free)
                self.free.append(self.capacity)
                self.pieces.append([])
            else:
                k = self.free.index(min(self.free))
            put = min(need, self.free[k])
            self.pieces[k].append((doc, start, ids[:put], total))
            self.free[k] -= put
            if not self.free[k]:
                yield self.pieces[k]
                self.free.pop(k)
                self.pieces.pop(k)
            start += put
            ids = ids[put:]


def power_cuts(n: int) -> list[int]:
    """n as falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _columns(window: list[tuple], sequence: int, with_ids: bool, rows: list[list]) -> None:
    offset = 0
    for doc, start, ids, total in window:
        data = np.ascontiguousarray(ids, "<u4")
        for column, value in zip(rows, (doc, start, len(ids), zlib.crc32(data), total, sequence, offset,
                                        data.tobytes() if with_ids else None)):
            column.append(value)
        offset += len(ids)


def pack(df: DataFrame, id_col: str, text_col: str, vocabulary: bytes, spaced: bool = True, end_id: int = 1,
         capacity: int = 2048, open_windows: int = 16, merge_lanes: int = 8, keep_ids: bool = True) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers (null with ``keep_ids=False``).
    The pieces are staged once in the shared folder, so that a lost executor never numbers them anew.
    """
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(vocabulary)          # a vocabulary file: a few MB, whatever the input
    id_type = df.schema[id_col].dataType
    fields = [T.StructField(id_col, id_type), *(T.StructField(c, T.LongType()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")), T.StructField("ids", T.BinaryType())]
    schema = T.StructType([*fields, T.StructField("lane", T.LongType()), T.StructField("open", T.BooleanType())])
    target = arrow_schema(schema)

    def rows_of(rows: list[list], lane: int, is_open: bool) -> pa.RecordBatch:
        n = len(rows[0])
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip([*rows, [lane] * n, [is_open] * n], target)],
                                          schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = PieceTokenizer(shared.value, spaced)
        lane = TaskContext.get().partitionId()
        windows, sequence = Windows(capacity, open_windows), lane << 32
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            for first, n in row_slices(texts):
                ids, before = tokenizer.encode(texts.slice(first, n))
                ids = np.insert(ids, before[1:], end_id)
                before = before + np.arange(n + 1)
                rows: list[list] = [[] for _ in fields]
                for k in range(n):
                    own = ids[before[k]:before[k + 1]]
                    whole = len(own) // capacity * capacity
                    for at in range(0, whole, capacity):
                        _columns([(docs[first + k], at, own[at:at + capacity], len(own))], sequence, keep_ids, rows)
                        sequence += 1
                    for full in windows.place(docs[first + k], whole, own[whole:].copy(), len(own)):
                        _columns(full, sequence, keep_ids, rows)
                        sequence += 1
                if rows[0]:
                    yield rows_of(rows, lane, False)
        rows = [[] for _ in fields]
        for k, window in enumerate(windows.pieces):
            _columns(window, k, True, rows)
        yield rows_of(rows, lane, True)

    staged = stage_table(df.select(id_col, text_col).mapInArrow(run, schema), "packing")
    names = [f.name for f in fields]
    merged = arrow_schema(T.StructType(fields))

    def merge(key: tuple, left: pa.Table) -> pa.Table:
        left = left.sort_by([("lane", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        docs, starts, totals = (left[c].to_pylist() for c in (id_col, "start", "doc_tokens"))
        data = [np.frombuffer(x, "<u4") for x in left["ids"].to_pylist()]
        rest = sum(map(len, data))
        sizes = [capacity] * (rest // capacity) + power_cuts(rest % capacity)
        rows: list[list] = [[] for _ in fields]
        piece = used = 0
        for k, size in enumerate(sizes):
            window = []
            while size:
                take = min(size, len(data[piece]) - used)
                window.append((docs[piece], starts[piece] + used, data[piece][used:used + take], totals[piece]))
                size -= take
                used += take
                if used == len(data[piece]):
                    piece, used = piece + 1, 0
            _columns(window, ((1 << 30) + key[0].as_py() << 32) + k, keep_ids, rows)
        return pa.table([pa.array(v, target.field(n).type) for n, v in zip(names, rows)], schema=merged)

    leftovers = (staged.where("open").withColumn("_group", F.floor(F.col("lane") / merge_lanes))
                 .groupBy("_group").applyInArrow(merge, T.StructType(fields)))
    return staged.where("not open").select(*names).unionByName(leftovers)
