"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints: texts are lower-cased (A-Z), cut into words and word shingles, repeats included; a bit is set where it is
set in over half of the shingles' XXH64 (seed 42).  Texts with fewer words than a shingle have one shingle of all their
words; texts without a word (null, empty) have fingerprint zero, which links like any other.

Links: fingerprints at ``max_distance`` 3 or fewer differing bits.  The 64 bits are three segments of 22, 21 and 21 bits.
With three errors in all, at least two segments have one error at most (two segments with two errors each would make
four), so a pair is found by two of its segments.  A segment is read as a word of the perfect (23, 12, 7) Golay code:
each word lies within three bits of exactly one codeword, its centre.  When two words differ in one bit, the centre of
one is at most four bits from the other.  So one side has the key (two centres) and the other all pairs of codewords
within four bits (one codeword, or six where the centre is three bits away); equal keys meet in a join, and the whole
fingerprints are compared.  Nothing is missed, and equal fingerprints are one node from the start, so a group of copies
has no pairs.

Components: smallest reachable fingerprint by rounds of large-star and small-star steps over the links, as joins and
aggregates, each round written to the shared folder.  Rows are taken as they come; a document's component is named by
the smallest id in it (null ids are never the smallest); an empty table gives no row; other columns are ignored.  A very
long text is a slice of its own, whose hashes are counted in parts.  Staged jobs run while the result is built.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .common import append_columns, free_name, stage_table, text_bytes

#: (shift, bits) of the three segments.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: Generator polynomial of the binary Golay code.
GENERATOR = 0b110001110101


def fingerprints(texts: pa.Array, words_per_shingle: int = 3) -> np.ndarray:
    """Unsigned 64-bit SimHash of each text."""
    flat, offsets = text_bytes(texts)
    data = flat.tobytes().lower()                                 # bytes: only A-Z change
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for i in range(len(texts)):
        words = data[offsets[i]:offsets[i + 1]].split()
        n = len(words)
        if not n:
            continue
        if n <= words_per_shingle:
            hashes = np.array([digest(b" ".join(words), 42)], np.uint64)
        else:
            joined = b" ".join(words)
            sizes = np.fromiter(map(len, words), np.int64, n)
            starts = np.cumsum(sizes + 1) - sizes - 1
            ends = (starts + sizes)[words_per_shingle - 1:]
            hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
        out[i] = majority(hashes)
    return out


def majority(hashes: np.ndarray) -> np.uint64:
    """Bits set in over half of the hashes."""
    bits = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = hashes[first:first + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0]


class Golay:
    """Centres and near codewords of 23-bit words, by 12-bit message."""

    def __init__(self):
        messages = np.arange(1 << 12, dtype=np.int64)
        rest = messages << 11
        for bit in range(22, 10, -1):                             # remainder of the division by the generator
            rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
        self.parity = rest
        codewords = messages << 11 | rest
        weight = np.bitwise_count(codewords)
        positions = 1 << np.arange(23, dtype=np.int64)
        errors = [0, *positions]
        errors += [a | b for k, a in enumerate(positions) for b in positions[:k]]
        errors += [a | b | c for k, a in enumerate(positions) for j, b in enumerate(positions[:k]) for c in positions[:j]]
        errors = np.array(errors, np.int64)                       # 2048 of them, one for each syndrome
        self.error = np.zeros(1 << 11, np.int64)
        self.error[self.syndrome(errors)] = errors
        # For errors of three bits: the five codewords of weight 7 that cover them, as messages.
        self.near = np.full((1 << 11, 5), -1, np.int64)
        sevens = codewords[weight == 7]
        for s in np.flatnonzero(np.bitwise_count(self.error) == 3):
            self.near[s] = sevens[sevens & self.error[s] == self.error[s]] >> 11

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.parity[words >> 11] ^ (words & 0x7FF)

    def keys(self, words: np.ndarray) -> np.ndarray:
        """(words x 6) messages of the codewords within four bits; the centre first, -1 where there are fewer."""
        s = self.syndrome(words)
        centre = (words ^ self.error[s]) >> 11
        near = self.near[s]
        return np.concatenate([centre[:, None], np.where(near < 0, -1, centre[:, None] ^ near)], axis=1)


def segment_keys(golay: Golay, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own key for each pair of segments; fingerprint number and key of all key pairs) of unsigned fingerprints."""
    parts = [golay.keys((fps >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64)) for shift, bits in SEGMENTS]
    own, rows, keys = [], [], []
    for p, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        own.append(p << 24 | parts[i][:, 0] << 12 | parts[j][:, 0])
        both = p << 24 | parts[i][:, :, None] << 12 | parts[j][:, None, :]
        fine = (parts[i][:, :, None] >= 0) & (parts[j][:, None, :] >= 0)
        rows.append(np.nonzero(fine)[0])
        keys.append(both[fine])
    return np.stack(own, axis=1), np.concatenate(rows), np.concatenate(keys)


def links(nodes: DataFrame, max_distance: int = 3) -> DataFrame:
    """Distinct pairs (u < v) of the fingerprints in column ``fp`` (distinct longs) at max_distance bits or fewer."""
    if max_distance > 3:
        raise ValueError("two segments with one error at most are certain up to three errors only")

    def keyed(every: bool):
        def run(batches):
            golay = Golay()
            for batch in batches:
                for first in range(0, batch.num_rows, 2048):
                    fps = batch.column(0).slice(first, 2048).to_numpy(zero_copy_only=False)
                    own, rows, keys = segment_keys(golay, fps.view(np.uint64))
                    if not every:
                        rows, keys = np.repeat(np.arange(len(fps)), own.shape[1]), own.ravel()
                    yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(fps[rows])], names=["key", "fp"])
        return run

    fps = nodes.select("fp")
    centres = fps.mapInArrow(keyed(False), "key long, fp long").select("key", F.col("fp").alias("u"))
    around = fps.mapInArrow(keyed(True), "key long, fp long").select("key", F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_distance
    same = centres["key"] == around["key"]
    # a fingerprint has many keys, of which the planner knows nothing: by its estimate either side would be broadcast
    return centres.join(around.hint("merge"), same & (F.col("u") < F.col("v")) & near).select("u", "v").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node with a link reaches; roots themselves have no row.

    Large-star: every larger neighbour of a node is linked to the smallest of its neighbours and itself.  Small-star:
    the smaller neighbours and the node are linked to the smallest of them.  Ends when a round changes nothing.
    """
    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()

    current = stage_table(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = mark(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage_table(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        current = stage_table(small, "small-star")
        after = mark(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _with_fingerprint(df: DataFrame, text_col: str, words_per_shingle: int) -> tuple[DataFrame, str, str]:
    """df with a fingerprint and a number for each row (part and place); and the two columns' names."""
    from pyspark import TaskContext
    fp, row = free_name(df, "fp"), free_name(df, "row")

    def make():
        place = TaskContext.get().partitionId() << 40

        def compute(texts: pa.Array) -> list[np.ndarray]:
            nonlocal place
            place += len(texts)
            return [fingerprints(texts, words_per_shingle).view(np.int64), np.arange(place - len(texts), place)]

        return compute

    return append_columns(df, text_col, {"fp": T.LongType(), "row": T.LongType()}, make), fp, row


def _roots(rows: DataFrame, max_distance: int) -> DataFrame:
    """(fp, root) for every fingerprint of rows (fp, ...)."""
    nodes = stage_table(rows.select("fp").distinct(), "fingerprints")
    linked = components(rows.sparkSession, links(nodes, max_distance))
    return nodes.join(linked, nodes["fp"] == linked["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(df: DataFrame, id_col: str, text_col: str, words_per_shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """id_col, fp and component_id (the smallest id reachable over links) for every row."""
    made, fp, _ = _with_fingerprint(df.select(id_col, text_col), text_col, words_per_shingle)
    rows = stage_table(made.select(F.col(id_col).alias("_id"), F.col(fp).alias("fp")), "fingerprinted")
    roots = _roots(rows, max_distance)
    low = rows.groupBy("fp").agg(F.min("_id").alias("_low"))
    named = low.join(roots, "fp")
    names = named.groupBy("root").agg(F.min("_low").alias("component_id"))
    names = stage_table(named.join(names, "root").select("fp", "component_id"), "components")
    return rows.join(names, "fp").select(F.col("_id").alias(id_col), "fp", "component_id")


def deduplicate(df: DataFrame, id_col: str, text_col: str, words_per_shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """One row of df for each component: the one with the smallest id (nulls last; the first of equal rows)."""
    made, fp, row = _with_fingerprint(df, text_col, words_per_shingle)
    staged = stage_table(made, "numbered")
    rows = staged.select(F.col(id_col).alias("_id"), F.col(fp).alias("fp"), F.col(row).alias("_row"))
    # the least of (is null, id, row) comes first
    key = F.struct(F.col("_id").isNull().alias("a"), F.col("_id").alias("b"), F.col("_row").alias("c"))
    roots = _roots(rows, max_distance)
    low = rows.groupBy("fp").agg(F.min(key).alias("_low"))
    kept = low.join(roots, "fp").groupBy("root").agg(F.min("_low").alias("_low")).select(F.col("_low.c").alias("_kept"))
    return staged.join(kept, staged[row] == kept["_kept"], "left_semi").drop(fp, row)


def hex_digits(fp: Column) -> Column:
    """16 lowercase hex digits of a fingerprint held as a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
