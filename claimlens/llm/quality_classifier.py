"""Naive Bayes support vectors: n-gram indicators scaled by class log-count ratios under a linear hinge-loss model.

Indicators of a text: its words and word pairs (lower-cased; a word after itself is one mark), and the 4-grams of its
shape, where letters are a or A, digits 0, and signs and white space stand for themselves.  Both are hashed.  The
log-count ratios count all labelled rows.  The classifier is fitted in one task on the rows of at most ``max_rows``
distinct ids and labels (a documented bound, chosen by a hash of the id): dual coordinate descent on the scaled and
normalised indicators, and a logistic scale of the margins on a fifth of the rows.

Null and empty texts have no indicator and get the score of the bias; a very long text is a slice of its own, and memory
follows it.  Without labelled rows of both classes the score is
the share of label 1 (0.5 without any).  Rows are taken as they come and keep all their columns; a clashing name gets an
underscore; repeated labels of a text and repeated rows of an id count each in the ratios; the sample has a label once and
up to 2 x ``max_rows`` rows in all, first one of every id, then a second one, and so on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import LOWER, append_columns, row_slices, run_sums, ship_package, text_bytes, texts_of, word_spans

HALF = 1 << 16
FEATURES = 2 * HALF
_ROWS_AT_ONCE = 64
_P = np.uint64(0x9E3779B97F4A7C15)
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x80:] = 0x61
_SHAPE[0x61:0x7B] = 0x61
_SHAPE[0x41:0x5B] = 0x41
_SHAPE[0x30:0x3A] = 0x30


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


class Indicators:
    """Distinct hashed indicators of slices of texts."""

    def __init__(self):
        self.inverse = np.uint64(pow(int(_P), -1, 1 << 64))

    def _word_hashes(self, flat: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Polynomial hashes of byte spans, from running sums."""
        with np.errstate(over="ignore"):
            terms = np.zeros(len(flat) + 1, np.uint64)
            np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _powers(_P, len(flat)), out=terms[1:])
            return (terms[last] - terms[first]) * _powers(self.inverse, len(flat) + 1)[first]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(distinct features of all texts in order, features before each text)."""
        flat, offsets = text_bytes(texts)
        n = len(texts)
        if not len(flat):
            return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
        first, last, words = word_spans(flat, offsets)
        with np.errstate(over="ignore"):
            one = self._word_hashes(LOWER[flat], first, last)
            two = one[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + one[1:]
            two[one[:-1] == one[1:]] = 1
            spread = lambda h: (((h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64)
            one, two = spread(one), spread(two)
            shape = _SHAPE[flat].astype(np.uint32)
            grams = (shape[:-3] << 24 | shape[1:-2] << 16 | shape[2:-1] << 8 | shape[3:]) if len(flat) > 3 else np.zeros(0, np.uint32)
            grams = ((grams * np.uint32(0x9E3779B1)) ^ (grams >> np.uint32(13))) * np.uint32(0x85EBCA77) >> np.uint32(16)
        grams = grams.astype(np.int64) + HALF
        out, sizes = [], np.zeros(n, np.int64)
        for a in range(0, n, _ROWS_AT_ONCE):
            b = min(n, a + _ROWS_AT_ONCE)
            seen = np.zeros((b - a, FEATURES), bool)
            rows = np.arange(b - a)
            bounds = words[a:b + 1]
            seen[np.repeat(rows, np.diff(bounds)), one[bounds[0]:bounds[-1]]] = True
            pairs = np.repeat(rows, np.diff(bounds))
            inside = np.flatnonzero(pairs[1:] == pairs[:-1])
            seen[pairs[inside], two[bounds[0] + inside]] = True
            byte = offsets[a:b + 1]
            text = np.repeat(rows, np.diff(byte))
            inside = np.flatnonzero(text[3:] == text[:-3])
            seen[text[inside], grams[byte[0] + inside]] = True
            where, feature = np.nonzero(seen)
            out.append(feature)
            sizes[a:b] = np.bincount(where, minlength=b - a)
        return np.concatenate(out), np.concatenate([[0], np.cumsum(sizes)])


def log_count_ratios(p: np.ndarray, q: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Of the rows with each feature in class 1 and in class 0."""
    p, q = p + smooth, q + smooth
    return np.log((p / p.sum()) / (q / q.sum()))


def class_counts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """(rows of class 1, rows of class 0 with each feature) over all labelled rows; ``labels`` has _id and _label.

    Labels are counted by id before they meet the texts, so repeated ones multiply no rows; texts are not sorted.  At most
    FEATURES rows reach the driver.
    """
    by_id = labels.groupBy("_id").agg(F.count_if(F.col("_label") == 1).alias("_p"), F.count_if(F.col("_label") == 0).alias("_q"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators, counts = Indicators(), np.zeros((2, FEATURES))
        for batch in batches:
            texts = texts_of(batch.column(0))
            times = [batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2)]
            for first, n in row_slices(texts):
                found, before = indicators(texts.slice(first, n))
                for total, t in zip(counts, times):
                    total += np.bincount(found, np.repeat(t[first:first + n], np.diff(before)), FEATURES)
        used = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(c[used].astype(np.int64)) for c in counts)],
                                         names=["feature", "p", "q"])

    table = (docs.join(by_id.hint("shuffle_hash"), docs[id_col] == by_id["_id"]).select(text_col, "_p", "_q")
             .mapInArrow(run, "feature int, p long, q long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
             .toPandas())
    p, q = np.zeros(FEATURES), np.zeros(FEATURES)
    p[table["feature"].to_numpy(np.int64)], q[table["feature"].to_numpy(np.int64)] = table["p"], table["q"]
    return p, q


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, cost: np.ndarray,
                 epochs: int = 12) -> np.ndarray:
    """Hinge-loss weights by dual coordinate descent; the last weight belongs to a constant feature."""
    w, dual = np.zeros(FEATURES + 1), np.zeros(len(rows))
    norms = np.array([x @ x for x in values]) + 1
    order = np.random.default_rng(5)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            slope = sign[i] * (w[rows[i]] @ values[i] + w[-1]) - 1
            new = min(max(dual[i] - slope / norms[i], 0.0), cost[i])
            step = (new - dual[i]) * sign[i]
            if step:
                w[rows[i]] += step * values[i]
                w[-1] += step
                dual[i] = new
    return w


def logistic_scale(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a m + b))) by Newton steps on smoothed targets."""
    up, down = positive.sum(), (~positive).sum()
    target = np.where(positive, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        g = np.array([((p - target) * margins).sum(), (p - target).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * margins * margins).sum() + 1e-3, (s * margins).sum()], [(s * margins).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int = 8192) -> dict:
    """Model from labelled rows; ``labels`` has id_col and label_col (0 or 1, others are ignored)."""
    spark = docs.sparkSession
    ship_package(spark)
    labelled = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
                .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")))
    ratios = spark.sparkContext.broadcast(log_count_ratios(*class_counts(docs, labelled, id_col, text_col)))
    chosen = (labelled.distinct()
              .orderBy(F.xxhash64("_id", F.lit("quality")), "_id", "_label").limit(max_rows))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in batches:
            texts = texts_of(batch.column(0))
            for first, n in row_slices(texts):
                found, before = indicators(texts.slice(first, n))
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(first, n),
                    pa.array([found[a:b].astype("<i4").tobytes() for a, b in zip(before[:-1], before[1:])], pa.binary()),
                    batch.column(2).slice(first, n)], names=["label", "at", "h"])

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["label", "at"], kind="stable")
        positive = pdf["label"].to_numpy() == 1
        if positive.all() or not positive.any():
            return pd.DataFrame({"v": [b""], "a": [0.0], "b": [20.0 if positive.all() else -20.0]})
        rows = [np.frombuffer(x, "<i4") for x in pdf["at"]]
        held = np.arange(len(rows)) % 5 == 4
        ratio = ratios.value
        values = [ratio[r] / (np.linalg.norm(ratio[r]) + 1e-12) for r in rows]
        share = positive[~held].mean()
        cost = np.where(positive, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
        kept = np.flatnonzero(~held)
        w = dual_descent([rows[i] for i in kept], [values[i] for i in kept], np.where(positive[kept], 1.0, -1.0), cost[kept])
        margins = np.array([w[rows[i]] @ values[i] + w[-1] for i in np.flatnonzero(held)])
        a, b = logistic_scale(margins, positive[held]) if held.any() else (1.0, 0.0)
        return pd.DataFrame({"v": [np.concatenate([ratio, w]).astype("<f8").tobytes()], "a": [a], "b": [b]})

    # max_rows ids and labels: small enough to broadcast, and their texts' indicators fit one task
    nth = F.row_number().over(Window.partitionBy("h", "label").orderBy("at"))
    sample = (docs.join(F.broadcast(chosen), docs[id_col] == chosen["_id"])
              .select(text_col, "_label", F.xxhash64("_id", F.lit("quality")).alias("_h"))
              .mapInArrow(features, "label int, at binary, h long")
              .withColumn("nth", nth).where(F.col("nth") <= 2 * max_rows)
              .orderBy("nth", "h", "label", "at").limit(2 * max_rows).drop("nth"))   # an id may have many rows
    model = sample.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(train, "v binary, a double, b double").first()
    if model is None:
        return {"v": None, "a": 0.0, "b": 0.0}
    v = np.frombuffer(model["v"], "<f8") if len(model["v"]) else None
    return {"v": v, "a": model["a"], "b": model["b"]}


def score(df: DataFrame, text_col: str, model: dict, threshold: float = 0.3) -> DataFrame:
    """df with score (0 to 1, higher: label 1 likelier) and predicted (1 at or above the threshold)."""
    shared = df.sparkSession.sparkContext.broadcast(model)      # 2 x FEATURES numbers

    def make():
        indicators, m = Indicators(), shared.value
        if m["v"] is not None:
            ratio, w = m["v"][:FEATURES], m["v"][FEATURES:]
            dots, squares = ratio * w[:-1], ratio * ratio

        def compute(texts: pa.Array) -> list[np.ndarray]:
            margins = np.zeros(len(texts))
            if m["v"] is not None:
                found, before = indicators(texts)
                margins = run_sums(dots[found], before) / (np.sqrt(run_sums(squares[found], before)) + 1e-12) + w[-1]
            p = 1 / (1 + np.exp(-np.clip(m["a"] * margins + m["b"], -40, 40)))
            return [p, (p >= threshold).astype(np.int32)]

        return compute

    return append_columns(df, text_col, {"score": T.DoubleType(), "predicted": T.IntegerType()}, make)
