"""MinHash near-duplicates by bottom-k sketches.

A text (A-Z lower-cased) is the set of its distinct word shingles; with fewer words its whole sequence is one shingle, and
without a word it is empty and linked with nothing.  Two texts are linked when 100 * shared >= ``percent`` * united.

Method.  One hash function orders the shingles; a text's sketch is its ``k`` smallest values (all, if fewer).  Texts with
equal sets are one node from the start.  Inverted lists of the retained values generate overlaps: linked nodes share at
least ``least_shared`` of their sketches' values (the union's ``k`` smallest are a sample of the union, of which
``percent`` are shared; fewer than that bound is a chance under 1e-9 a pair, and sets of up to ``k`` shingles are compared
exactly).  So they meet in a list of one of the rarest values of each, and values that very many texts share need no list
of their own.  The union's ``k`` smallest values estimate the similarity of a pair; pairs under the same bound go.  What is
left is verified on the full sets of shingles, read again from the texts.

Work.  First each node is compared with two partners: of the central nodes of its lists (fewest values of their own) the
most central one, and the one that it shares most lists with.  These links join large groups of near copies around the text that they
were made from, without their pairs.  Lists that hold one component by then are done.  The nodes of all others get lists
from the whole sets, are compared with the central nodes of these in the same way, and then with all other nodes that
they may be linked with.  With whole sets the bounds are exact: linked nodes of a and b shingles share at least percent / (100 +
percent) * (a + b), so the first value that they share, rarest first, has few before it on either side.  A list is cut
by bands of both sides' sizes, and a node is only in those for whose sizes its place in the list still allows enough
shared values; texts that changed too much to be linked with anything like them drop out of the lists of what they kept.
Within a list, pairs have a node outside the component that holds most of the list.  No partner is dropped; components
end with every link between different texts that could join two of them verified.

Rows are taken as they come (repeated rows, null ids; a null id names a component only where all are null); null texts are
empty; an empty table gives no row; other columns are ignored.  A very long text is one set in one task.  Staged jobs run
while the result is built.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import append_columns, mix64, ship_package, stage_table, text_bytes, texts_of
from .simhash import components

#: Chance that a linked pair falls short of the bound.
MISS = 1e-9
#: Ratio of the sizes of consecutive bands.
BAND = 1.03


def least_shared(k: int, percent: int) -> int:
    """The largest bound that a sample of k falls short of with a chance of at most MISS."""
    p, total, t = percent / 100, 0.0, 0
    while t <= k:
        total += math.comb(k, t) * p ** t * (1 - p) ** (k - t)
        if total > MISS:
            return t
        t += 1
    return k


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value


def shingle_values(words: list[bytes], hashes: dict, size: int) -> np.ndarray:
    """Sorted distinct 64-bit values of a text's shingles."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(n, size)
    value = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        value = mix64(value + h[k:n - width + 1 + k])
    return np.unique(value)


def shingles(text: bytes, size: int) -> set:
    """The shingles themselves."""
    words = text.lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size))))


def sketched(df: DataFrame, text_col: str, size: int, k: int) -> DataFrame:
    """df with n (distinct shingles), two digests of its set and its sketch (longs in the order of unsigned values)."""
    def make():
        hashes = _WordHashes()

        def compute(texts: pa.Array) -> list:
            if len(hashes) > 1 << 20:
                hashes.clear()
            flat, offsets = text_bytes(texts)
            data = flat.tobytes().lower()
            n, digests, sketch, lengths = [], ([], []), [], [0]
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                values = shingle_values(data[a:b].split(), hashes, size)
                n.append(len(values))
                packed = values.tobytes()
                digests[0].append(xxhash.xxh64_intdigest(packed, 1))
                digests[1].append(xxhash.xxh64_intdigest(packed, 2))
                sketch.append(values[:k].view(np.int64))
                lengths.append(lengths[-1] + len(sketch[-1]))
            lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(sketch)))
            return [np.array(n, np.int64), *(np.array(d, np.uint64).view(np.int64) for d in digests), lists]

        return compute

    return append_columns(df, text_col, {"n": T.LongType(), "d1": T.LongType(), "d2": T.LongType(),
                                         "sketch": T.ArrayType(T.LongType())}, make)


def rarest(values: DataFrame) -> DataFrame:
    """(node, size, found) of values (node, v, size): its values that others have too, rarest first, as (df, v, place).

    ``place`` counts the node's values before it; those that no other node has are the rarest.
    """
    counts = stage_table(values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "value-counts")
    held = values.join(counts, "v").groupBy("node").agg(
        F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("df", "v"))).alias("found"))
    placed = F.transform("found", lambda x, i: F.struct(x["df"].alias("df"), x["v"].alias("v"),
                                                        (F.col("size") - F.size("found") + i).alias("place")))
    return held.select("node", "size", placed.alias("found"))


def _centrality() -> tuple:
    """Of :func:`rarest`'s rows: the share of values that no other node has, and how often others have the rest, negated."""
    own = (F.col("size") - F.size("found")) / F.col("size")
    common = F.aggregate("found", F.lit(0).cast("long"), lambda total, x: total + x["df"])
    return own.alias("own"), (-common).alias("common")


def estimates(a: list[np.ndarray], b: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values shared, size) of the union sketches of pairs."""
    n = len(a)
    both = np.full((n, 2 * k), np.iinfo(np.uint64).max, np.uint64)
    held = np.zeros((n, 2 * k), bool)
    for i in range(n):
        x, y = a[i].view(np.uint64), b[i].view(np.uint64)
        both[i, :len(x)], both[i, k:k + len(y)] = x, y
        held[i, :len(x)], held[i, k:k + len(y)] = True, True
    order = np.argsort(both, axis=1, kind="stable")
    both, held = np.take_along_axis(both, order, 1), np.take_along_axis(held, order, 1)
    twin = np.zeros_like(held)
    twin[:, 1:] = (both[:, 1:] == both[:, :-1]) & held[:, 1:] & held[:, :-1]
    place = np.cumsum(held & ~twin, axis=1)
    return (twin & (place <= k)).sum(1), np.minimum(place[:, -1], k)


class NearDuplicates:
    """The search over one table; see the module's text."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str, size: int = 5, percent: int = 80, k: int = 64):
        self.spark, self.size, self.percent, self.k = df.sparkSession, size, percent, k
        ship_package(self.spark)
        self.bound = least_shared(k, percent)
        self.docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        self.rows = stage_table(sketched(self.docs, "text", size, k).drop("text"), "sketches")
        sets = self.rows.where("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("low"), F.max("n").alias("n"),
                                                                F.first("sketch").alias("sketch"))
        self.sets = stage_table(sets.withColumn("node", F.monotonically_increasing_id()), "sets")

    def lists(self) -> DataFrame:
        """(v, node, own, common) of the sketches' rarest values: where two linked nodes meet.

        ``own`` and ``common`` order nodes from the most central: share of values that no other has, values' counts.
        """
        exact = F.expr(f"({self.percent}L * n + 99) div 100")
        least = F.when(F.col("n") * 100 <= self.percent * self.k, exact).otherwise(F.least(exact, F.lit(self.bound)))
        values = self.sets.select("node", F.least("n", F.lit(self.k)).alias("size"), F.explode("sketch").alias("v"))
        held = rarest(values).join(self.sets.select("node", least.alias("least")), "node")
        # a partner shares `least` values, so one of the size - least + 1 rarest
        near = held.where(F.size("found") >= F.col("least")).select("node", *_centrality(), F.explode(F.filter("found", lambda x: x["place"] <= F.col("size") - F.col("least"))).alias("f"))
        return stage_table(near.select(F.col("f.v").alias("v"), "node", "own", "common"), "lists")

    def entries(self, nodes: DataFrame) -> DataFrame:
        """(v, node, size, place, own, common) of the rarest shingles of whole sets, as many as a partner may lack and one more."""
        size, hashes = self.size, _WordHashes()

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    values = shingle_values(text.encode().lower().split(), hashes, size).view(np.int64)
                    for a in range(0, len(values), 1 << 16):
                        part = values[a:a + (1 << 16)]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), node)), pa.array(part),
                                                          pa.array(np.full(len(part), len(values)))], names=["node", "v", "size"])

        held = rarest(self.texts(nodes).mapInArrow(run, "node long, v long, size long"))
        lacks = F.col("size") - F.expr(f"({self.percent}L * size + 99) div 100")
        near = held.select("node", "size", *_centrality(), F.explode(F.filter("found", lambda x: x["place"] <= lacks)).alias("f"))
        return stage_table(near.select(F.col("f.v").alias("v"), "node", "size", F.col("f.place").alias("place"), "own", "common"), "entries")

    def _shared(self, a, b):
        """Shingles that linked sets of a and b shingles share at least."""
        return F.ceil((a + b) * F.lit(self.percent) / F.lit(100 + self.percent) - F.lit(1e-6))

    def banded(self, entries: DataFrame) -> DataFrame:
        """Entries by list: (v, small, large), the bands of the sizes of a pair's smaller and larger set, and ``is_large``.

        An entry is in a list only if enough shingles follow it for the least partner of that band.
        """
        band = lambda n: F.floor(F.log(n.cast("double")) / F.lit(math.log(BAND))).cast("int")
        size = F.col("size")
        least, most = F.ceil(size * self.percent / 100 - 1e-9), F.floor(size * 100 / F.lit(self.percent) + 1e-9)
        own = entries.withColumn("own", band(size))
        roles = F.array(*[F.struct(F.lit(large).alias("is_large"), partners.alias("partners")) for large, partners in (
            (False, F.sequence("own", band(most))), (True, F.sequence(band(least), F.col("own"))))])
        met = own.select("*", F.inline(roles)).select("v", "node", "root", "size", "place", "own", "is_large",
                                                      F.explode("partners").alias("other"))
        # the partner's band starts here or a little later (rounding), and a linked partner has at least `least`
        smallest = F.greatest(F.floor(F.pow(F.lit(BAND), F.col("other")) - 1e-6), least, F.when(F.col("is_large"), F.lit(0)).otherwise(size))
        met = met.where(size - F.col("place") >= self._shared(size, smallest))
        return met.select("v", F.when(F.col("is_large"), F.col("other")).otherwise(F.col("own")).alias("small"),
                          F.when(F.col("is_large"), F.col("own")).otherwise(F.col("other")).alias("large"),
                          "is_large", "node", "root", "size", "place")

    def texts(self, nodes: DataFrame) -> DataFrame:
        """(node, text) of nodes, read again from the table: a row of each set."""
        wanted = self.sets.join(nodes, "node", "left_semi").select("node", "low", "d1", "d2")
        ids = wanted.select("low").distinct()
        rows = self.docs.join(ids, self.docs["id"].eqNullSafe(ids["low"]), "left_semi")
        again = sketched(rows, "text", self.size, 0).where("n > 0").select("id", "text", "d1", "d2")
        found = again.join(wanted, ["d1", "d2"]).where(F.col("id").eqNullSafe(F.col("low")))
        return stage_table(found.select("node", "text").dropDuplicates(["node"]), "node-texts")

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) whose union sketch reaches the bound."""
        k, bound, percent = self.k, self.bound, self.percent
        sketch = self.sets.select("node", "sketch", "n")
        x = sketch.select(F.col("node").alias("u"), F.col("sketch").alias("su"), F.col("n").alias("nu"))
        y = sketch.select(F.col("node").alias("v"), F.col("sketch").alias("sv"), F.col("n").alias("nv"))
        # a set that is smaller than percent of the other cannot be linked with it
        fits = F.least("nu", "nv") * 100 >= percent * F.greatest("nu", "nv")

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 4096):
                    part = batch.slice(a, 4096)
                    su, sv = ([np.asarray(s, np.int64) for s in part.column(c).to_numpy(zero_copy_only=False)] for c in (2, 3))
                    shared, size = estimates(su, sv, k)
                    fine = np.where(size < k, shared * 100 >= percent * size, shared >= bound)
                    yield pa.RecordBatch.from_arrays(part.columns[:2], names=["u", "v"]).filter(pa.array(fine))

        joined = pairs.join(x, "u").join(y, "v").where(fits).select("u", "v", "su", "sv")
        return joined.mapInArrow(run, "u long, v long")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that are linked, by their full sets."""
        size, percent = self.size, self.percent
        pairs = stage_table(self.estimated(pairs), "candidates")
        if pairs.isEmpty():
            return pairs
        texts = self.texts(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct())
        x = texts.select(F.col("node").alias("u"), F.col("text").alias("tu"))
        y = texts.select(F.col("node").alias("v"), F.col("text").alias("tv"))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, own = None, set()
            for batch in batches:
                tu, tv = texts_of(batch.column(2)), texts_of(batch.column(3))
                fine = []
                for k, v in enumerate(batch.column(1).to_pylist()):
                    if v != last:
                        last, own = v, shingles(tv[k].as_py().encode(), size)
                    other = shingles(tu[k].as_py().encode(), size)
                    shared = len(own & other)
                    fine.append(100 * shared >= percent * (len(own) + len(other) - shared))
                yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(pa.array(fine, pa.bool_()))

        joined = pairs.join(x, "u").join(y, "v").select("u", "v", "tu", "tv")
        return stage_table(joined.mapInArrow(run, "u long, v long"), "verified")

    def first_pairs(self, lists: DataFrame) -> DataFrame:
        """(u, v): each node u with two of the central nodes of its lists: the one of most lists, and the most central."""
        heads = lists.groupBy("v").agg(F.min(F.struct("own", "common", "node")).alias("head"), F.count("*").alias("nodes")).where("nodes > 1")
        heads = stage_table(heads.select("v", "head"), "heads")
        met = lists.select("v", "node").join(heads, "v").where("node <> head.node").groupBy("node", "head").agg(F.count("*").alias("lists"))
        best = met.groupBy("node").agg(F.min("head").alias("a"), F.min(F.struct((-F.col("lists")).alias("lists"), "head")).alias("b"))
        return best.select(F.col("node").alias("u"), F.explode(F.array_distinct(F.array("a.node", "b.head.node"))).alias("v"))

    @staticmethod
    def _named(df: DataFrame, roots: DataFrame) -> DataFrame:
        return df.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def mixed_nodes(self, lists: DataFrame, roots: DataFrame) -> DataFrame:
        """Nodes of lists that hold several components."""
        named = stage_table(self._named(lists.select("v", "node"), roots), "named-lists")
        mixed = stage_table(named.groupBy("v").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("v"), "mixed")
        return stage_table(named.join(mixed, "v").select("node").distinct(), "mixed-nodes")

    def pairs_across(self, entries: DataFrame) -> DataFrame:
        """(u, v) of different components that meet in a list of (v, node, root, size, place) and may be linked."""
        key = ["v", "small", "large"]
        banded = stage_table(self.banded(entries), "banded")
        small = F.count_if(~F.col("is_large"))
        kinds = banded.groupBy(*key).agg(F.min("root").alias("a"), F.max("root").alias("b"), small.alias("s"), F.count("*").alias("n"))
        kinds = stage_table(kinds.where("a <> b and s > 0 and n > s").select(*key), "band-lists")
        mixed = stage_table(banded.join(kinds, key), "band-entries")
        counts = mixed.groupBy(*key, "root").agg(F.count("*").alias("n"))
        most = stage_table(counts.groupBy(*key).agg(F.max_by("root", F.struct("n", "root")).alias("most")), "band-components")
        told = stage_table(mixed.join(most, key).withColumn("in_most", F.col("root") == F.col("most")), "band-sides")
        side = lambda large, name: told.where(F.col("is_large") if large else ~F.col("is_large")).select(
            *key, *[F.col(c).alias(f"{c}_{name}") for c in ("node", "root", "size", "place", "in_most")])
        x, y = side(False, "x"), side(True, "y")
        enough = F.least(F.col("size_x") - F.col("place_x"), F.col("size_y") - F.col("place_y")) >= self._shared(F.col("size_x"), F.col("size_y"))
        fits = F.col("size_x") * 100 >= self.percent * F.col("size_y")
        apart = (F.col("root_x") != F.col("root_y")) & (F.col("size_x") <= F.col("size_y")) & fits & enough
        found = None
        for a, b in ((x.where("not in_most_x"), y), (x.where("in_most_x"), y.where("not in_most_y"))):
            same = [a[c] == b[c] for c in key]
            part = a.join(b, same[0] & same[1] & same[2] & apart).select(
                F.least("node_x", "node_y").alias("u"), F.greatest("node_x", "node_y").alias("v"))
            found = part if found is None else found.unionByName(part)
        return found.distinct()

    def roots(self) -> DataFrame:
        """(node, root) of every node with a link."""
        lists = self.lists()
        first = self.verified(self.first_pairs(lists))
        roots = stage_table(components(self.spark, first), "first-roots")
        nodes = self.mixed_nodes(lists, roots)
        if nodes.isEmpty():
            return roots
        # the same once more with the order of whole sets, in which the text that a group was made from is the most central
        entries = self.entries(nodes)
        pairs = self._named(self.first_pairs(entries).withColumnRenamed("u", "node"), roots)
        pairs = self._named(pairs.select(F.col("node").alias("u"), F.col("root").alias("ru"), F.col("v").alias("node")), roots)
        first = stage_table(first.unionByName(self.verified(pairs.where("ru <> root").select("u", F.col("node").alias("v")))), "first-links")
        roots = stage_table(components(self.spark, first), "second-roots")
        found = self.verified(self.pairs_across(self._named(entries, roots)))
        return components(self.spark, first.unionByName(found))

    def classes(self) -> DataFrame:
        """(d1, d2, component): the smallest id reachable from each set."""
        roots = self.roots()
        named = self.sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        names = named.groupBy("root").agg(F.min("low").alias("component"))
        return stage_table(named.join(names, "root").select("d1", "d2", "component"), "set-components")


def near_duplicates(df: DataFrame, id_col: str, text_col: str, size: int = 5, percent: int = 80, k: int = 64) -> DataFrame:
    """id_col, n_shingles, component_id, kept for every row of df; texts without a word are their own component."""
    search = NearDuplicates(df, id_col, text_col, size, percent, k)
    classes = search.classes()
    rows = search.rows.select("id", "n", "d1", "d2")
    full = rows.where("n > 0").join(classes, ["d1", "d2"]).select("id", "n", "component")
    empty = rows.where("n = 0").select("id", "n", F.col("id").alias("component"))
    both = full.unionByName(empty)
    return both.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                       F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
