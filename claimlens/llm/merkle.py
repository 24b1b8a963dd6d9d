"""Merkle manifest of a table: one tree of leaves for each group, one tree over the groups' roots.

Leaves are SHA-256 digests (lowercase hex) of chosen columns; H of several digests is the SHA-256 of their hex texts one
after the other.  Within a group leaves ascend by id; every three consecutive nodes of a level become their H, the last
ones of a level fewer, until one is left.

Leaf coordinates come from bitmaps, without sorting the leaves.  Each task writes, for every group and every 1024 ids,
a compressed bitmap of the ids it holds (places as 16-bit integers where that is shorter) and the further rows of ids that
occur more than once; the bitmaps of one group and id range are merged by OR.  A merged bitmap has a directory of counts
before each of its words, and a three-level directory (18 bits of the id each) counts the rows before it, so that a leaf's
coordinate is one rank query: rows in earlier ranges, counts of earlier words, bits set before it.

Levels are reduced six at a time: the coordinate divided by 729 is the key of a slot array of 729 places, which one row
holds; its levels are folded in one go.  Paths then come down again, one for each slot array instead of one for each leaf.

Order: null ids first, then ascending; rows of one id by their leaf.  Rows with equal id and leaf are counted, not kept
apart, until coordinates are known, so that a repeated row is no hot group; rows of one id with different leaves are
ordered within ranges of their digests.  Groups ascend bytewise, the null group first.  Null texts and values are part of
the leaf; an empty table gives no row; other columns are ignored, and their names do not matter.  A very long text is read
by Spark's own hash function, never in Python.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import arrow_schema, ship_package, stage_table

#: Ids of one bitmap, as a power of two.
RANGE_BITS = 10
#: Levels that one slot array folds, and its places.
LEVELS = 6
PLACES = 3 ** LEVELS
#: Repeated rows that one task writes out at once.
REPEATS = 1 << 16


def leaf_digest(*columns: Column | str) -> Column:
    """SHA-256 of the columns, each '-' if null, else its byte count, a colon and its text."""
    parts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _h(digests: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(digests)).hexdigest().encode()


# --- Coordinates -------------------------------------------------------------------------------------------------------

def _id_keys(id_col: str) -> list[Column]:
    """Directory keys of an id: null (0) or not (1), three levels of 18 bits, range of 1024 ids within; all ascending."""
    top = F.col(id_col).bitwiseXOR(F.lit(-(1 << 63)))             # unsigned order
    level = lambda shift, bits: F.shiftrightunsigned(top, shift).bitwiseAND(F.lit((1 << bits) - 1))
    zero = F.lit(0).cast("long")
    return [F.when(F.col(id_col).isNull(), zero).otherwise(F.lit(1).cast("long")).alias("k0"),
            *(F.coalesce(level(s, 18), zero).alias(k) for k, s in (("k1", 46), ("k2", 28), ("k3", 10))),
            F.coalesce(level(0, RANGE_BITS), zero).cast("int").alias("low")]


RANGE = ["grp", "k0", "k1", "k2", "k3"]


def pack_bits(places: np.ndarray) -> bytes:
    """Compressed bitmap: 16-bit places where these are shorter than the bits."""
    if 2 * len(places) < (1 << RANGE_BITS) // 8:
        return b"p" + np.sort(places).astype("<u2").tobytes()
    bits = np.zeros(1 << RANGE_BITS, bool)
    bits[places] = True
    return b"b" + np.packbits(bits, bitorder="little").tobytes()


def unpack_bits(data: bytes) -> np.ndarray:
    """The bitmap as 64-bit words."""
    if data[:1] == b"b":
        return np.frombuffer(data, "<u8", offset=1).astype(np.uint64)
    bits = np.zeros(1 << RANGE_BITS, bool)
    bits[np.frombuffer(data, "<u2", offset=1)] = True
    return np.packbits(bits, bitorder="little").view("<u8").astype(np.uint64)


def pack_extra(places: np.ndarray, rows: np.ndarray) -> bytes:
    return places.astype("<i8").tobytes() + rows.astype("<i8").tobytes()


def unpack_extra(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(data, "<i8").reshape(2, -1)
    return both[0], both[1]


class Ranks:
    """Rank queries on one merged bitmap, with its popcount directory and the further rows of repeated ids."""

    def __init__(self, words: np.ndarray, places: np.ndarray, rows: np.ndarray):
        self.words = words
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.places, self.extra = places, np.concatenate([[0], np.cumsum(rows)])

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Rows with a smaller place."""
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return (self.before[word] + np.bitwise_count(below).astype(np.int64)
                + self.extra[np.searchsorted(self.places, places, side="left")])


def _runs(batch: pa.RecordBatch, n_keys: int) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of consecutive rows with equal keys (the first n_keys columns, without nulls)."""
    n = batch.num_rows
    if not n:
        return
    new = np.zeros(n, bool)
    for k in range(n_keys):
        values = batch.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    bounds = [0, *np.flatnonzero(new).tolist(), n]
    yield from zip(bounds[:-1], bounds[1:])


def _partial_bitmaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (RANGE keys, low, rows) sorted by key within a task: one bitmap for each key met in a batch."""
    for batch in batches:
        low, rows = (batch.column(k).to_numpy(zero_copy_only=False) for k in (5, 6))
        firsts, bits, extra, total = [], [], [], []
        for a, b in _runs(batch, 5):
            many = np.flatnonzero(rows[a:b] > 1)
            firsts.append(a)
            bits.append(pack_bits(low[a:b]))
            extra.append(pack_extra(low[a:b][many], rows[a:b][many] - 1))
            total.append(int(rows[a:b].sum()))
        if firsts:
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(pa.array(firsts)) for k in range(5)]
                + [pa.array(bits, pa.binary()), pa.array(extra, pa.binary()), pa.array(total, pa.int64())],
                names=[*RANGE, "bits", "extra", "total"])


def _merged_bitmaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a key with lists of partial bitmaps: their OR and the sums of further rows, directory included."""
    for batch in batches:
        bits_out, extra_out = [], []
        for parts, extras in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist()):
            words = np.bitwise_or.reduce([unpack_bits(p) for p in parts])
            places, rows = (np.concatenate(x) for x in zip(*map(unpack_extra, extras)))
            if len(places):
                places, which = np.unique(places, return_inverse=True)
                rows = np.bincount(which, rows).astype(np.int64)
            places_set = np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))
            bits_out.append(pack_bits(places_set))
            extra_out.append(pack_extra(places, rows))
        yield pa.RecordBatch.from_arrays(batch.columns[:5] + [pa.array(bits_out, pa.binary()), pa.array(extra_out, pa.binary()),
                                                              batch.column(7)], names=[*RANGE, "bits", "extra", "total"])


def _ranked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one key: first its bitmap (with its base), then the ids to look up; gives each id's coordinate."""
    key, ranks, base = None, None, 0
    for batch in batches:
        low = batch.column(6).to_numpy(zero_copy_only=False).astype(np.int64)
        pos = np.zeros(batch.num_rows, np.int64)
        wanted = np.ones(batch.num_rows, bool)
        for a, b in _runs(batch, 5):
            own = tuple(batch.column(k)[a].as_py() for k in range(5))
            if own != key:
                key = own                                         # its first row is its bitmap
                ranks = Ranks(unpack_bits(batch.column(7)[a].as_py()), *unpack_extra(batch.column(8)[a].as_py()))
                base = batch.column(9)[a].as_py()
                wanted[a] = False
                a += 1
            if b > a:
                pos[a:b] = base + ranks.rank(low[a:b])
        found = pa.RecordBatch.from_arrays([*batch.columns[:5], batch.column(6), batch.column(10), pa.array(pos)],
                                           names=[*RANGE, "low", "leaves", "pos"])
        yield found.filter(pa.array(wanted))


def coordinates(leaves: DataFrame) -> DataFrame:
    """Coordinate ``pos`` of the first of ``rows`` equal leaves, for leaves (grp, id, leaf, rows, ...) distinct in the first three.

    ``grp`` is a long without nulls, ``id`` a long, ``leaf`` a hex digest.
    """
    keyed = leaves.select("*", *_id_keys("id"))
    ids = stage_table(keyed.groupBy(*RANGE, "low").agg(F.sum("rows").alias("rows"), F.count("*").alias("leaves")), "ids")
    kinds = ", ".join(f"{k} long" for k in RANGE)
    parts = (ids.select(*RANGE, "low", "rows").sortWithinPartitions(*RANGE)
             .mapInArrow(_partial_bitmaps, f"{kinds}, bits binary, extra binary, total long"))
    merged = parts.groupBy(*RANGE).agg(F.collect_list("bits").alias("bits"), F.collect_list("extra").alias("extra"),
                                       F.sum("total").alias("total"))
    bitmaps = stage_table(merged.mapInArrow(_merged_bitmaps, f"{kinds}, bits binary, extra binary, total long"), "bitmaps")
    # three directory levels: rows before a range among its siblings (at most 2 ** 18 each), then before its parents
    level, sums = bitmaps.select(*RANGE, "total"), []
    for depth in (4, 3, 2, 1):
        up, child = RANGE[:depth], RANGE[depth]
        before = Window.partitionBy(*up).orderBy(child).rowsBetween(Window.unboundedPreceding, -1)
        sums.append(level.select(*up, child, F.coalesce(F.sum("total").over(before), F.lit(0)).alias(f"b{depth}")))
        level = level.groupBy(*up).agg(F.sum("total").alias("total"))
    based = bitmaps
    for depth, part in zip((4, 3, 2, 1), sums):
        based = based.join(part, RANGE[:depth + 1])
    based = based.withColumn("base", F.col("b1") + F.col("b2") + F.col("b3") + F.col("b4"))
    asked = based.select(*RANGE, F.lit(0).alias("kind"), F.lit(0).alias("low"), "bits", "extra", "base").unionByName(
        ids.select(*RANGE, F.lit(1).alias("kind"), "low", "leaves"), allowMissingColumns=True)
    ranked = (asked.repartition(*RANGE).sortWithinPartitions(*RANGE, "kind")
              .mapInArrow(_ranked, f"{kinds}, low int, leaves long, pos long"))
    own = [*RANGE, "low"]
    found = stage_table(keyed.join(ranked, own), "ranked")
    # rows of an id with several leaves follow their digest, by ranges of its first 16 bits
    several = found.where("leaves > 1").withColumn("part", F.substring("leaf", 1, 4))
    inside = Window.partitionBy(*own, "part").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*own).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = several.groupBy(*own, "part").agg(F.sum("rows").alias("total")).select(
        *own, "part", F.coalesce(F.sum("total").over(across), F.lit(0)).alias("first"))
    spread = several.withColumn("then", F.coalesce(F.sum("rows").over(inside), F.lit(0))).join(parts, [*own, "part"])
    kept = [*leaves.columns, "pos"]
    return found.where("leaves = 1").select(*kept).unionByName(
        spread.withColumn("pos", F.col("pos") + F.col("first") + F.col("then")).select(*kept))


# --- Trees -------------------------------------------------------------------------------------------------------------

def fold(nodes: list[bytes], whole: bool) -> tuple[bytes, list[list[bytes]]]:
    """(what remains, nodes of each level) of a slot array; ``whole``: it is its tree, so stop at one node, else fold all levels."""
    levels = []
    while len(nodes) > 1 if whole else len(levels) < LEVELS:
        levels.append(nodes)
        nodes = [_h(nodes[k:k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], levels


def siblings(levels: list[list[bytes]], place: int) -> list[tuple[int, list[bytes]]]:
    """(place in its run, the run) level by level for a node at ``place`` of the lowest one."""
    path = []
    for nodes in levels:
        first = place // 3 * 3
        path.append((place - first, nodes[first:first + 3]))
        place //= 3
    return path


def pack_path(path: list[tuple[int, list[bytes]]]) -> bytes:
    """Each level as its place, the run's size and the siblings' digests."""
    return b"".join(bytes([at, len(run)]) + bytes.fromhex(b"".join(run[:at] + run[at + 1:]).decode()) for at, run in path)


def unpack_path(data: bytes) -> tuple[bytes, list[tuple[int, list[bytes]]]]:
    """(all siblings' hex digests, (place, siblings) of each level)."""
    path, k = [], 0
    while k < len(data):
        at, n = data[k], data[k + 1] - 1
        digests = data[k + 2:k + 2 + 32 * n].hex().encode()
        path.append((at, [digests[64 * j:64 * j + 64] for j in range(n)]))
        k += 2 + 32 * n
    return b"".join(d for _, run in path for d in run), path


def climb(node: bytes, path: Iterable[tuple[int, list[bytes]]]) -> bytes:
    """The root over a node and its siblings."""
    for at, run in path:
        node = _h([*run[:at], node, *run[at:]])
    return node


def _split(packed: bytes) -> list[bytes]:
    text = packed.hex().encode()
    return [text[k:k + 64] for k in range(0, len(text), 64)]


def _reduced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slot arrays (tree, block, n, slots): adds the node that each becomes."""
    for batch in batches:
        n = batch.column(2).to_pylist()
        made = [fold(_split(x), size <= PLACES)[0] for x, size in zip(batch.column(3).to_pylist(), n)]
        yield pa.RecordBatch.from_arrays(batch.columns[:3] + [pa.array([bytes.fromhex(x.decode()) for x in made], pa.binary())],
                                         names=["tree", "block", "n", "node"])


def _paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slot arrays with the path above them: the path above each of their slots."""
    for batch in batches:
        trees, blocks, pos, paths = [], [], [], []
        for tree, block, n, slots, above in zip(*(c.to_pylist() for c in batch.columns[:5])):
            nodes = _split(slots)
            _, levels = fold(nodes, n <= PLACES)
            for place in range(len(nodes)):
                trees.append(tree)
                pos.append(block * PLACES + place)
                paths.append(pack_path(siblings(levels, place)) + above)
        yield pa.RecordBatch.from_arrays([pa.array(trees, pa.int64()), pa.array(pos, pa.int64()), pa.array(paths, pa.binary())],
                                         names=["tree", "pos", "path"])


def slot_arrays(nodes: DataFrame, *carried: str) -> DataFrame:
    """(tree, block, n, slots, rows) of nodes (tree, pos, n, node, carried...): 729 places in one row, in order.

    ``slots`` holds the digests one after the other, ``rows`` the carried columns.
    """
    place = (F.col("pos") % PLACES).cast("int").alias("place")
    rows = F.array_sort(F.collect_list(F.struct(place, "node", *carried)))                # at most 729 entries
    blocks = nodes.groupBy("tree", F.expr(f"pos div {PLACES}").alias("block")).agg(F.max("n").alias("n"), rows.alias("all"))
    slots = F.unhex(F.concat_ws("", F.transform("all", lambda r: F.hex(r["node"]))))
    kept = [F.transform("all", lambda r: F.struct(*(r[c].alias(c) for c in carried))).alias("rows")] if carried else []
    return blocks.select("tree", "block", "n", slots.alias("slots"), *kept)


def reduce_trees(nodes: DataFrame, *carried: str) -> tuple[DataFrame, list[DataFrame]]:
    """((tree, node) root of every tree, staged slot arrays round by round) of nodes (tree, pos, n, node, carried...)."""
    rounds, level = [], nodes
    while True:
        blocks = stage_table(slot_arrays(level, *([] if rounds else carried)), "slots")
        rounds.append(blocks)
        up = blocks.select("tree", "block", "n", "slots").mapInArrow(_reduced, "tree long, block long, n long, node binary")
        level = stage_table(up.select("tree", F.col("block").alias("pos"), F.expr(f"(n + {PLACES - 1}) div {PLACES}").alias("n"),
                                      "node"), "level")
        if level.where("n > 1").isEmpty():
            return level.select("tree", "node"), rounds


def paths_above(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """(tree, block, path) above every slot array of the first round; ``top``: (tree, path) above every tree's root."""
    above = top.select("tree", F.lit(0).cast("long").alias("block"), "path")
    for blocks in reversed(rounds[1:]):
        joined = blocks.join(above, ["tree", "block"]).select("tree", "block", "n", "slots", "path")
        above = joined.mapInArrow(_paths, "tree long, pos long, path binary").withColumnRenamed("pos", "block")
    return above


def group_numbers(groups: DataFrame, name: str) -> DataFrame:
    """(name, number): places of distinct values in ascending order, null first, without one task holding all."""
    sorted_ = groups.select(name).distinct().repartitionByRange(F.col(name).asc_nulls_first())
    placed = stage_table(sorted_.sortWithinPartitions(F.col(name).asc_nulls_first())
                         .withColumn("_at", F.monotonically_increasing_id()), "groups")
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)          # one row a partition
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.withColumn("_part", part).join(counts, "_part").select(
        name, (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("number"))


def manifest(df: DataFrame, id_col: str, group_col: str, leaf: Column, other_leaf: Column | None = None) -> DataFrame:
    """id_col, leaf, subroot, root, proof_sha256, folded_root, verified for every row of df.

    ``leaf`` is the digest that the trees are built on; ``other_leaf`` (null: the same) is the one that is folded with
    the original siblings and compared with the root.  Runs staged jobs while it is built.
    """
    ship_package(df.sparkSession)
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, T.LongType()), *(T.StructField(c, T.StringType()) for c in (
        "leaf", "subroot", "root", "proof_sha256", "folded_root")), T.StructField("verified", T.BooleanType())])
    other = F.lit(None).cast("string") if other_leaf is None else other_leaf
    rows = df.select(F.col(group_col).alias("name"), F.col(id_col).cast("long").alias("id"), leaf.alias("leaf"), other.alias("other"))
    # equal rows are one until their coordinates are known
    leaves = stage_table(rows.groupBy("name", "id", "leaf").agg(
        F.count("*").alias("rows"), F.unhex(F.max(F.when(F.col("other") != F.col("leaf"), F.col("other")))).alias("other")), "leaves")
    sizes = leaves.groupBy("name").agg(F.sum("rows").alias("n"))
    numbers = group_numbers(leaves, "name")
    trees = stage_table(numbers.join(sizes, numbers["name"].eqNullSafe(sizes["name"])).select(
        numbers["name"], F.col("number").alias("grp"), "n"), "trees")
    n_trees = trees.count()
    if not n_trees:
        return df.sparkSession.createDataFrame([], schema).withColumn(id_col, F.col(id_col).cast(id_type))
    numbered = leaves.join(trees, leaves["name"].eqNullSafe(trees["name"])).select("grp", "id", "leaf", "other", "rows", "n")
    subroots, rounds = reduce_trees(_spread(coordinates(numbered)), "id", "other")
    roots, upper = reduce_trees(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"),
                                                F.lit(n_trees).cast("long").alias("n"), "node"))
    root_hex = bytes(roots.first()["node"]).hex().encode()
    empty = roots.select("tree", F.lit(b"").alias("path"))
    first = upper[0].join(paths_above(upper, empty), ["tree", "block"]).select("tree", "block", "n", "slots", "path")
    top = first.mapInArrow(_paths, "tree long, pos long, path binary").select(F.col("pos").alias("tree"), "path")
    above = paths_above(rounds, stage_table(top, "paths"))
    blocks = rounds[0].join(above, ["tree", "block"]).join(subroots, "tree").select(
        "n", "slots", "path", "node", F.col("rows.id").alias("ids"), F.col("rows.other").alias("others"))
    target = arrow_schema(schema)

    def proofs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                n, slots, path, sub, ids, others = (c[k].as_py() for c in batch.columns)
                nodes = _split(slots)
                _, levels = fold(nodes, n <= PLACES)
                tail, higher = unpack_path(path)
                out = []
                for place, (own_id, other) in enumerate(zip(ids, others)):
                    own = [(at, run[:at] + run[at + 1:]) for at, run in siblings(levels, place)]
                    proof = hashlib.sha256(b"".join(d for _, run in own for d in run) + tail).hexdigest()
                    node = nodes[place] if other is None else other.hex().encode()
                    folded = climb(climb(node, own), higher)
                    out.append((own_id, nodes[place].decode(), sub.hex(), root_hex.decode(), proof, folded.decode(), folded == root_hex))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), target)], schema=target)

    return blocks.mapInArrow(proofs, schema).withColumn(id_col, F.col(id_col).cast(id_type))


def _spread(placed: DataFrame) -> DataFrame:
    """(tree, pos, n, node, id, other): one row for each of the counted rows, large counts over many tasks."""
    cols = [F.col("grp").alias("tree"), "n", F.unhex("leaf").alias("node"), "id", "other"]
    once = placed.where("rows = 1").select("pos", *cols)
    pieces = placed.where("rows > 1").withColumn("_from", F.explode(F.expr(f"sequence(0L, rows - 1, {REPEATS}L)")))
    pieces = pieces.repartition(F.col("grp"), F.col("pos"), F.col("_from"))
    more = pieces.withColumn("_k", F.explode(F.expr(f"sequence(_from, least(_from + {REPEATS - 1}L, rows - 1))")))
    return once.unionByName(more.select((F.col("pos") + F.col("_k")).alias("pos"), *cols))
