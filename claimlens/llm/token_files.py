"""Token files of independent zstandard frames, with a trailing seek table and a checksum for each frame.

A file is a valid zstandard stream of the ids (unsigned 32-bit, little-endian) of its documents in ascending id order.
After the data frames come two skippable frames: the document table (an Arrow stream, compressed) and the seek table
of the public seekable format, which ends with the number of frames, a descriptor and its magic number.  Readers
decompress only the frames that hold the documents they ask for, and compare each with its checksum.

Tasks write under names of their own and only report them; the list of files is staged once by Spark, so files left
by lost or repeated attempts are in no list.  The prefix sums that place a file's documents among all are taken over
that list, one row a file.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import arrow_schema, row_slices, ship_package, stage_table, texts_of
from .segments import PieceTokenizer

# Fixed values of the zstandard seekable format.
SEEK_TABLE_FRAME = 0x184D2A5E
SEEK_TABLE_END = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
#: Another skippable frame, for the document table.
DOCUMENTS_FRAME = 0x184D2A51


def _checksum(data) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class TokenFileWriter:
    """Writes one file; a frame closes when it holds ``frame_ids`` ids, long documents span frames."""

    def __init__(self, sink, frame_ids: int = 16384, level: int = 3):
        self.sink, self.frame_ids = sink, frame_ids
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list = []
        self.lengths: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, doc, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.lengths.append(len(ids))
        while len(ids):
            part = ids[:self.frame_ids - self.held]
            self.waiting.append(part)
            self.held += len(part)
            ids = ids[len(part):]
            if self.held == self.frame_ids:
                self._frame()

    def _frame(self) -> None:
        data = np.concatenate(self.waiting).astype("<u4").tobytes()
        packed = self.compress(data)
        self.sink.write(packed)
        self.frames.append((len(packed), len(data), _checksum(data)))
        self.waiting, self.held = [], 0

    def close(self, id_type: pa.DataType) -> None:
        if self.held:
            self._frame()
        table = io.BytesIO()
        batch = pa.record_batch({"doc": pa.array(self.docs, id_type), "n": pa.array(self.lengths, pa.int64())})
        with pa.ipc.new_stream(table, batch.schema) as stream:
            stream.write_batch(batch)
        packed = self.compress(table.getvalue())
        packed += struct.pack("<II", len(packed), _checksum(packed))
        self.sink.write(struct.pack("<II", DOCUMENTS_FRAME, len(packed)) + packed)
        entries = b"".join(struct.pack("<III", *f) for f in self.frames)
        self.sink.write(struct.pack("<II", SEEK_TABLE_FRAME, len(entries) + 9) + entries
                        + struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_TABLE_END))
        self.sink.close()


class TokenFileReader:
    """Documents of one file, by place in the file, without decompressing other frames."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_TABLE_END or not flag & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        table = size - 9 - 12 * n
        self.frames = np.frombuffer(self._at(table, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        length, check = struct.unpack("<II", self._at(table - 16, 8))
        packed = self._at(table - 16 - length, length)
        if _checksum(packed) != check:
            raise ValueError("the document table does not match its checksum")
        docs = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)).read_all()
        self.docs = docs["doc"].to_pylist()
        self.bounds = np.concatenate([[0], np.cumsum(docs["n"].to_numpy())]).astype(np.int64)
        self.packed_at = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.ids_at = np.concatenate([[0], np.cumsum(self.frames[:, 1])]) // 4
        self._frame: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def _at(self, start: int, n: int) -> bytes:
        self.source.seek(int(start))
        return self.source.read(int(n))

    def _ids(self, k: int) -> np.ndarray:
        if self._frame[0] != k:
            data = zstandard.ZstdDecompressor().decompress(self._at(self.packed_at[k], self.frames[k, 0]))
            if _checksum(data) != self.frames[k, 2]:
                raise ValueError(f"frame {k} does not match its checksum")
            self._frame = (k, np.frombuffer(data, "<u4"))
        return self._frame[1]

    def document(self, place: int) -> np.ndarray:
        a, b = int(self.bounds[place]), int(self.bounds[place + 1])
        out = []
        k = int(np.searchsorted(self.ids_at, a, side="right")) - 1
        while a < b:
            ids = self._ids(k)
            part = ids[a - self.ids_at[k]:b - self.ids_at[k]]
            out.append(part)
            a += len(part)
            k += 1
        return np.concatenate(out) if len(out) > 1 else out[0] if out else np.zeros(0, "<u4")


def write_token_files(df: DataFrame, id_col: str, text_col: str, folder: str, vocabulary: bytes, spaced: bool,
                      end_id: int) -> DataFrame:
    """Writes all texts' ids in ascending id order under ``folder``; the list of files: part, file, docs, ids, base.

    ``base`` counts the ids in the files before.  Null texts have the end id alone; null ids come first; rows with
    equal ids are ordered by a hash of their text; repeated rows are written once each; an empty table gives an empty
    list; other columns are ignored.
    """
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    # the row's place comes last, so that many equal rows are spread over ranges
    ordered = (df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
               .withColumns({"_tie": F.xxhash64("_text"), "_place": F.monotonically_increasing_id()})
               .repartitionByRange("_id", "_tie", "_place").sortWithinPartitions("_id", "_tie", "_place"))
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("file", T.StringType()),
                           T.StructField("docs", T.LongType()), T.StructField("ids", T.LongType())])
    target = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, writer, total = PieceTokenizer(shared.value, spaced), TaskContext.get().partitionId(), None, 0
        uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tokens"
        for batch in batches:
            docs, texts = batch.column(0), texts_of(batch.column(1))
            for first, n in row_slices(texts):
                if writer is None:
                    system, path = _open(uri)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    writer = TokenFileWriter(system.open_output_stream(path, compression=None))
                ids, before = tokenizer.encode(texts.slice(first, n))
                ids = np.insert(ids, before[1:], end_id)
                before = before + np.arange(n + 1)
                total += len(ids)
                for k, doc in enumerate(docs.slice(first, n).to_pylist()):
                    writer.add(doc, ids[before[k]:before[k + 1]])
                id_type = docs.type
        if writer is not None:
            writer.close(id_type)
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(
                (part, uri, len(writer.docs), total), target)], schema=target)

    files = stage_table(ordered.mapInArrow(run, schema), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row a file
    return files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(files: DataFrame, id_col: str, id_type: T.DataType, tasks: int, keep_ids: bool = True) -> DataFrame:
    """All documents of the listed files: id_col, start, n_tokens, ids_crc32, ids (null with ``keep_ids=False``)."""
    ship_package(files.sparkSession)
    schema = T.StructType([T.StructField(id_col, id_type), *(T.StructField(c, T.LongType()) for c in (
        "start", "n_tokens", "ids_crc32")), T.StructField("ids", T.BinaryType())])
    target = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _open(row["file"])
                with system.open_input_file(path) as source:
                    reader = TokenFileReader(source)
                    for first in range(0, len(reader.docs), 1024):
                        rows = []
                        for k in range(first, min(first + 1024, len(reader.docs))):
                            ids = np.ascontiguousarray(reader.document(k))
                            rows.append((reader.docs[k], row["base"] + int(reader.bounds[k]), len(ids), zlib.crc32(ids),
                                         ids.tobytes() if keep_ids else None))
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], schema=target)

    return files.select("file", "base").repartition(tasks, "file").mapInArrow(run, schema)
