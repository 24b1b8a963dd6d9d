"""Language-model scoring with a hashed maximum-entropy model and a class-factored softmax.

Tokens are the words of a text, lower-cased (A-Z), and one end.  The most frequent training words (an exact top of the
counts) have a bucket each, all others share a quarter as many by a hash; buckets are dealt to classes, as many classes as
members of one.

    P(word | context) = P(class | context) P(member | class, context) P(word | bucket)

The first two are softmaxes over weights of hashed features: the word before, the word before that (a skip), the pair of
them, and a constant; the member's also knows the class.  Features are hashed from the words themselves, so that n-grams
of all words are learned, whatever their bucket.  The third is the add-one share of the word in a shared bucket (one
unseen word included), so the probabilities of all words sum to one.

Sizes follow the counted vocabulary (:func:`sizes_for`): buckets and feature slots grow with the root of the number of
distinct training words; a parameter bounds the weights that a worker holds.

Training: each of ``rounds`` rounds takes its share of the training rows; every task starts from the model so far, makes
Adagrad updates on sparse batches, and returns the changes of its weights with how often each feature slot was met; Spark
sums them by blocks of slots in two steps, each slot's change weighted by its tokens, so that a slot that few tasks met
learns as fast as others.  Counts cover all training rows.  Scoring needs the counts of all words: those of the ``known_words`` most
frequent ones are broadcast (a documented bound), the rest meet the counts in a join on the word; rare words cannot be
hot keys.

Words of equal counts are ranked by their text.  Null texts count as empty: the end alone; a very long text is a slice of
its own, trained and scored in batches.  Without training rows every word has count 0 and the model is uniform.  Rows
are taken as they come (repeated rows are scored each); other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import LOWER, SPACE, arrow_schema, row_slices, run_sums, ship_package, stage_table, text_bytes, texts_of, word_spans

_TOKENS_AT_ONCE = 32768
_SLICE = 8 << 20


class Sizes(NamedTuple):
    """``side`` classes of ``side`` members; 2 ** ``bits`` feature slots."""

    side: int
    bits: int

    @property
    def buckets(self) -> int:
        return self.side ** 2

    @property
    def frequent(self) -> int:                                    # buckets of one word
        return self.side ** 2 * 3 // 4

    @property
    def tails(self) -> int:                                       # buckets that words share
        return self.side ** 2 - self.frequent

    @property
    def features(self) -> int:
        return 1 << self.bits


def sizes_for(distinct: int, most_weights: int = 1 << 26) -> Sizes:
    """Sizes for a vocabulary: buckets and slots in proportion to its root, in powers of two.

    ``most_weights``: what a worker holds at most (a parameter; slots are halved until they fit).
    """
    words = math.log2(max(16, distinct))
    side, bits = 1 << int((words + 2) // 4), math.ceil(words / 2) + 4
    while bits > 8 and 2 * side << bits > most_weights:
        bits -= 1
    return Sizes(side, bits)


def slice_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of each word, the distinct words, words before each text) of lower-cased texts."""
    flat, offsets = text_bytes(texts)
    flat = LOWER[flat]
    first, last, words = word_spans(flat, offsets)
    ends = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int32)
    visible = np.ascontiguousarray(flat[~SPACE[flat]]) if len(flat) else flat
    coded = pa.StringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(visible)).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, words


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over all texts; the end token is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(0))
            for first, n in row_slices(texts, 2 * _SLICE):
                codes, words, _ = slice_words(texts.slice(first, n))
                counts = np.bincount(codes, minlength=len(words)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([words, pa.array([""])]), pa.array(np.append(counts, n))],
                                                 names=["word", "n"])

    return docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int, top: int) -> list:
    """Rows of counts, greatest n first (ties by word): the exact first ``top``, and beyond these about ``most`` in all.

    Levels of n are sixteenths of a power of two, so the table of words by level is small whatever the corpus.  All words
    of the levels that fit into ``most`` are taken; if these are fewer than ``top``, the first ones of the others follow.
    """
    level = F.floor(16 * F.log2("n")).cast("int")
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    least, taken = math.inf, 0
    for at, words in sizes:
        if taken + words > most:
            break
        least, taken = at, taken + words
    rows = counts.where(level >= least).collect() if taken else []
    if taken < top:
        rest = counts.where(level < least) if taken else counts
        rows += stage_table(rest.orderBy(F.desc("n"), "word").limit(top - taken), "outcome-words").collect()
    return sorted(rows, key=lambda r: (-r["n"], r["word"]))


class Buckets:
    """Buckets and counts of words by the broadcast list of frequent words."""

    def __init__(self, sizes: Sizes, words: list[str], counts: list[int], tail_share: np.ndarray):
        self.sizes = sizes
        self.words, self.counts = pa.array(words, pa.string()), np.append(np.array(counts, np.int64), 0)
        self.tail_share = tail_share                              # log10 of a shared bucket's tokens + words + 1
        rank = np.arange(sizes.frequent)
        self.of_rank = (rank % sizes.side) * sizes.side + rank // sizes.side
        self.end = self(pa.array([""]))

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bucket, rank or -1, log10 of the shared bucket's size, 32-bit hash) of each word."""
        side, frequent = self.sizes.side, self.sizes.frequent
        rank = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        identity = np.fromiter(map(zlib.crc32, words.cast(pa.binary()).to_pylist()), np.int64, len(words))
        tail = identity % self.sizes.tails
        own = (rank >= 0) & (rank < frequent)
        bucket = np.where(own, self.of_rank[np.where(own, rank, 0)], tail % side * side + frequent // side + tail // side)
        return bucket, rank, np.where(own, 0.0, self.tail_share[tail]), identity


def contexts(identities: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words (by hash) one and two places before each token; -1 before a text's first."""
    one = np.full(len(identities), -1, np.int64)
    one[1:] = identities[:-1]
    starts = bounds[:-1]                                          # every text has a token, its end
    one[starts] = -1
    two = np.full(len(identities), -1, np.int64)
    two[1:] = one[:-1]
    two[starts] = -1
    return one, two


def _hashed(bits: int, kind: int, a: np.ndarray, b: np.ndarray | int = 0) -> np.ndarray:
    h = a.astype(np.uint32) * np.uint32(0x9E3779B1) + np.asarray(b).astype(np.uint32) * np.uint32(0x85EBCA77)
    h += np.uint32(kind * 0x27D4EB2F & 0xFFFFFFFF)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0x297A2D39)
    return (h >> np.uint32(32 - bits)).astype(np.int64)


class Model:
    """Weights of classes (features + 1 columns) and members (features + classes columns), one row for each outcome.

    ``met`` counts how often each column was trained.
    """

    def __init__(self, sizes: Sizes, flat: np.ndarray | None = None):
        side, features = sizes.side, sizes.features
        self.sizes, n = sizes, side * (features + 1)
        self.flat = np.zeros(n + side * (features + side), np.float32) if flat is None else flat.copy()
        self.of_class = self.flat[:n].reshape(side, features + 1)
        self.of_member = self.flat[n:].reshape(side, features + side)
        self.met = np.zeros(features + 1, np.int64), np.zeros(features + side, np.int64)

    def _forward(self, table: np.ndarray, features: list[np.ndarray], target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log probability of the target, probabilities of all outcomes by row) of each token."""
        logits = table.take(features[0], axis=1, mode="clip")
        for f in features[1:]:
            logits += table.take(f, axis=1, mode="clip")
        logits -= logits.max(axis=0)
        right = logits[target, np.arange(len(target))]
        np.exp(logits, out=logits)
        total = logits.sum(axis=0)
        return right - np.log(total), np.divide(logits, total, out=logits)

    def _features(self, cls: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        bits, features = self.sizes.bits, self.sizes.features
        return ([_hashed(bits, 1, one), _hashed(bits, 2, two), _hashed(bits, 3, one, two), np.full(len(cls), features)],
                [_hashed(bits, 4, one, cls), features + cls])

    def log_probabilities(self, buckets: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural log of P(class) P(member) of each token."""
        out = np.empty(len(buckets))
        for a in range(0, len(buckets), _TOKENS_AT_ONCE):
            some = slice(a, a + _TOKENS_AT_ONCE)
            cls, member = np.divmod(buckets[some], self.sizes.side)
            by_class, by_member = self._features(cls, one[some], two[some])
            out[some] = self._forward(self.of_class, by_class, cls)[0]
            out[some] += self._forward(self.of_member, by_member, member)[0]
        return out

    def train(self, squares: "Model", buckets: np.ndarray, one: np.ndarray, two: np.ndarray, rate: float) -> None:
        """Adagrad updates, one for each batch of tokens; ``squares`` holds the sums of squared gradients."""
        for a in range(0, len(buckets), _TOKENS_AT_ONCE):
            some = slice(a, a + _TOKENS_AT_ONCE)
            cls, member = np.divmod(buckets[some], self.sizes.side)
            by_class, by_member = self._features(cls, one[some], two[some])
            for table, sums, met, features, target in ((self.of_class, squares.of_class, self.met[0], by_class, cls),
                                                       (self.of_member, squares.of_member, self.met[1], by_member, member)):
                for f in features:
                    met += np.bincount(f, minlength=len(met))
                _, p = self._forward(table, features, target)
                p[target, np.arange(len(target))] -= 1
                for outcome, wrong in enumerate(p):
                    wrong = wrong.astype(np.float64)
                    slope = np.zeros(table.shape[1])
                    for f in features:
                        slope += np.bincount(f, wrong, table.shape[1])
                    sums[outcome] += slope * slope
                    table[outcome] -= rate * slope / np.sqrt(sums[outcome] + 1.0)


def _tokens(texts: pa.Array, buckets: Buckets) -> tuple[np.ndarray, np.ndarray, tuple, tuple, np.ndarray]:
    """(word numbers, words before each text, figures of the distinct words, buckets and contexts with ends, tokens before each text)."""
    codes, words, bounds = slice_words(texts)
    figures = buckets(words)
    stream, identities = (np.insert(figures[k][codes], bounds[1:], buckets.end[k][0]) for k in (0, 3))
    at = bounds + np.arange(len(bounds))
    return codes, bounds, (words, *figures), (stream, *contexts(identities, at)), at


def train(docs: DataFrame, text_col: str, share: Column, rounds: int, sizes: Sizes, buckets, rate: float = 0.3,
          blocks: int = 32) -> Model:
    """The model after ``rounds`` rounds over the rows with share 0, 1, ...; ``buckets`` is a broadcast of Buckets' arguments."""
    spark = docs.sparkSession
    model = Model(sizes)
    for k in range(rounds):
        start = spark.sparkContext.broadcast(model.flat)          # bounded by sizes_for

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup, own, squares, tokens = Buckets(*buckets.value), Model(sizes, start.value), Model(sizes), 0
            for batch in batches:
                texts = texts_of(batch.column(0))
                for first, n in row_slices(texts, _SLICE):
                    _, _, _, stream, _ = _tokens(texts.slice(first, n), lookup)
                    own.train(squares, *stream, rate)
                    tokens += len(stream[0])
            if tokens:
                # each table by blocks of its columns: how often these were met, and their changes
                before, lane = Model(sizes, start.value), TaskContext.get().partitionId() % 64
                for table, (new, old, met) in enumerate(((own.of_class, before.of_class, own.met[0]),
                                                         (own.of_member, before.of_member, own.met[1]))):
                    changes, counts = np.array_split(new - old, blocks, axis=1), np.array_split(met, blocks)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.arange(blocks, dtype=np.int32) + table * blocks), pa.array(np.full(blocks, lane, np.int32)),
                        pa.array([c.astype("<f4").tobytes() for c in counts], pa.binary()),
                        pa.array([c.astype("<f2").tobytes() for c in changes], pa.binary())], names=["block", "lane", "met", "change"])

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            met, change = 0.0, 0.0
            for m, c in zip(pdf["met"], pdf["change"]):
                m = np.frombuffer(m, "<f4").astype(np.float64)
                change = change + np.frombuffer(c, "<f2").astype(np.float64).reshape(-1, len(m)) * m
                met = met + m
            mean = (change / np.maximum(1.0, met)).astype("<f2")
            return pd.DataFrame({"block": pdf["block"].iloc[:1].to_numpy(), "lane": np.zeros(1, np.int32),
                                 "met": [met.astype("<f4").tobytes()], "change": [mean.tobytes()]})

        schema = "block int, lane int, met binary, change binary"
        sums = (docs.where(share == k).select(text_col).mapInArrow(run, schema)
                .groupBy("block", "lane").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema))
        found = sums.orderBy("block").collect()                   # the weights once
        if found:
            parts = [np.frombuffer(r["change"], "<f2").astype(np.float32).reshape(sizes.side, -1) for r in found]
            model = Model(sizes, model.flat)
            model.of_class += np.concatenate(parts[:blocks], axis=1)
            model.of_member += np.concatenate(parts[blocks:], axis=1)
    return model


def score(df: DataFrame, id_col: str, text_col: str, is_training: Column, rounds: int = 2, known_words: int = 131072) -> DataFrame:
    """id_col, training, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = df.sparkSession
    ship_package(spark)
    docs = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), is_training.alias("_training"))
    known = docs.where("_training")
    counts = stage_table(count_words(known, "_text"), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    sizes = sizes_for(distinct)
    top = frequent_words(counts, known_words, sizes.frequent)
    frequent = [r["word"] for r in top[:sizes.frequent]]
    tails = (counts.join(F.broadcast(spark.createDataFrame([(w,) for w in frequent], "word string")), "word", "left_anti")
             .groupBy((F.crc32(F.encode("word", "UTF-8")) % sizes.tails).alias("tail")).agg((F.sum("n") + F.count("*")).alias("size")))
    shared = np.ones(sizes.tails)
    for r in tails.collect():                                     # as many rows as shared buckets
        shared[r["tail"]] += r["size"]
    buckets = spark.sparkContext.broadcast((sizes, [r["word"] for r in top], [r["n"] for r in top], np.log10(shared)))
    model = train(known, "_text", F.pmod(F.xxhash64("_id", F.lit("round")), F.lit(rounds)), rounds, sizes, buckets)
    weights = spark.sparkContext.broadcast(model.flat)

    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("_id", df.schema[id_col].dataType),
                           T.StructField("training", T.BooleanType()), *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")),
                           T.StructField("counted", T.DoubleType()), T.StructField("modelled", T.DoubleType()),
                           T.StructField("word", T.StringType()), T.StructField("times", T.LongType())])
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, own = Buckets(*buckets.value), Model(sizes, weights.value)
        row = TaskContext.get().partitionId() << 40
        log_counts, end = np.log10(lookup.counts + 1.0), lookup.end
        for batch in batches:
            texts = texts_of(batch.column(1))
            for first, n in row_slices(texts, _SLICE):
                codes, bounds, (words, _, rank, tail, _), stream, at = _tokens(texts.slice(first, n), lookup)
                modelled = run_sums(own.log_probabilities(*stream), at) / np.log(10) - end[2][0]
                modelled -= run_sums(tail[codes], bounds)
                counted = run_sums(log_counts[rank][codes], bounds) + log_counts[end[1][0]]
                hits = run_sums((rank >= 0)[codes].astype(np.int64), bounds) + int(end[1][0] >= 0)
                in_tail = ((rank < 0) | (rank >= sizes.frequent))[codes]      # words in shared buckets have their counts, too
                modelled += run_sums(np.where(in_tail, log_counts[rank][codes], 0.0), bounds)
                if not 0 <= end[1][0] < sizes.frequent:
                    modelled += log_counts[end[1][0]]
                rows = np.arange(row, row + n)
                row += n
                none = pa.nulls(n, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), batch.column(0).slice(first, n), batch.column(2).slice(first, n), pa.array(np.diff(at)),
                     pa.array(hits), pa.array(counted), pa.array(modelled), none, pa.nulls(n, pa.int64())], schema=target)
                text = np.repeat(np.arange(n), np.diff(bounds))
                rare = rank[codes] < 0
                pair, times = np.unique(text[rare] * len(words) + codes[rare], return_counts=True)
                m = len(pair)
                if m:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[pair // len(words)]), pa.nulls(m, target.field(1).type), pa.nulls(m, pa.bool_()),
                         pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()),
                         words.take(pa.array(pair % len(words))), pa.array(times)], schema=target)

    staged = stage_table(docs.select("_id", "_text", "_training").mapInArrow(run, schema), "scored")
    rare = (staged.where("word is not null").select("row", "word", "times")
            .join(counts.withColumnRenamed("n", "c"), "word")
            .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"), F.sum("times").alias("found")))
    size = np.log10(total + distinct + 1)
    more, found = F.coalesce("more", F.lit(0.0)), F.coalesce("found", F.lit(0)).cast("long")
    return (staged.where("word is null").join(rare, "row", "left")
            .select(F.col("_id").alias(id_col), "training", "n_tokens", (F.col("n_known") + found).alias("n_known"),
                    F.lit(int(total)).cast("long").alias("train_tokens"),
                    (F.col("counted") + more - F.col("n_tokens") * F.lit(float(size))).alias("base_score"),
                    (F.col("modelled") + more).alias("score")))
