"""Helpers shared by the operators: Arrow batches of texts, byte-level word views, appended columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from claimlens.session import checkpoint_dir, ship_package, stage_table

__all__ = ["append_columns", "arrow_schema", "checkpoint_dir", "free_name", "mix64", "row_slices", "run_sums",
           "read_table", "letters", "ship_package", "stage_table", "text_bytes", "texts_of", "word_spans", "vocabulary_file"]

#: Texts of one Arrow batch are handled in slices of about this many bytes, so memory follows the slice.
SLICE_BYTES = 2 << 20

# Bytes that separate words: space and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# A-Z to a-z, everything else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def vocabulary_file(name: str) -> str:
    """Path of a public tokenizer file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def texts_of(column: pa.Array) -> pa.Array:
    """A string column with nulls as empty texts."""
    column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def row_slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of slices of at most about max_bytes; a longer text is a slice of its own."""
    n = len(texts)
    if not n:
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < n:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield first, last - first
        first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts one after the other, offsets) of a string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def word_spans(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: (start byte, end byte, words before each text; one entry more than texts)."""
    inside = ~SPACE[flat]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    bounds = offsets[:-1][offsets[:-1] < len(flat)]
    starts[bounds] = inside[bounds]                       # a text's first byte starts a word of its own
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    ends[lasts] = inside[lasts]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(first, offsets)


def run_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive bounds (empty runs: 0)."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser over unsigned 64-bit integers."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores before it where df has such a column already (case does not tell them apart)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def append_columns(df: DataFrame, text_col: str, fields: dict[str, T.DataType],
                   make: Callable[[], Callable[[pa.Array], list[np.ndarray | pa.Array]]],
                   slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """df's rows with new columns computed from its texts in Arrow batches, every other column untouched.

    ``make()`` runs once per task and returns a function from a slice of texts (nulls as empty) to one
    array per field.  Names that df already has are given underscores by :func:`free_name`.
    """
    ship_package(df.sparkSession)
    schema = T.StructType(list(df.schema.fields) + [T.StructField(free_name(df, k), t) for k, t in fields.items()])
    target = arrow_schema(T.StructType(list(schema.fields)[len(df.columns):]))
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            texts = texts_of(batch.column(at))
            for first, n in row_slices(texts, slice_bytes):
                part = batch.slice(first, n)
                made = [pa.array(x, f.type) if not isinstance(x, pa.Array) else x.cast(f.type)
                        for x, f in zip(compute(texts.slice(first, n)), target)]
                yield pa.RecordBatch.from_arrays(part.columns + made, names=part.schema.names + target.names)

    return df.mapInArrow(run, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def letters(col) -> F.Column:
    """True where the text has a letter (null: false)."""
    return F.coalesce(col.rlike(r"\p{L}"), F.lit(False))
