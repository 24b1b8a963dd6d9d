"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes single spaces, and the 2- and 3-grams of what is left are hashed.
Document frequencies are counted over all training rows.  The classifier is fitted in one task on a sample of at most
``rows_per_language`` rows of each language (a documented bound): follow-the-regularised-leader with an L1 and an L2
penalty for each coordinate, then one temperature that minimises the log loss on a fifth of the sample.

Predictions: a text without a letter (null and empty ones too) is ``und`` with score 0, and so is every text when there
is no training row.  Rows are taken as they come and keep all their columns; a clashing name gets an underscore; equal
scores go to the language that comes first in order; very long texts are read whole, a slice at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import append_columns, letters, row_slices, run_sums, ship_package, texts_of

__all__ = ["document_frequencies", "fit", "held_out", "letters", "predict"]

BITS = 16
FEATURES = 1 << BITS
#: Texts in one bitmap of the document frequencies.
_ROWS_AT_ONCE = 128
#: A text's characters and n-grams take about 60 bytes for each of its own while they are read.
_SLICE = 1 << 20


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class Grams:
    """Hashed 2- and 3-grams of slices of texts."""

    def __init__(self):
        self.letter = _letters()

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(features of all texts in order, features before each text, whether each text has a letter)."""
        lowered = [t.lower() for t in texts.to_pylist()]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)))
        bounds = np.concatenate([[0], ends]).astype(np.int64)
        letter = self.letter[points]
        has_letter = run_sums(letter.astype(np.int64), bounds) > 0
        keep = letter.copy()
        keep[1:] |= letter[:-1]                                   # of white space and signs, one place after a letter
        points = np.where(letter, points, 0x20)[keep].astype(np.uint32)
        bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
        # every text gets a space before it, so that word beginnings are alike
        sizes = np.diff(bounds)
        points = np.insert(points, bounds[:-1], 0x20)
        bounds = bounds + np.arange(len(bounds))
        first, second = points[:-1], points[1:]
        pairs = first * np.uint32(0x9E3779B1) + second * np.uint32(0x85EBCA77)
        grams = np.empty(2 * len(points), np.uint32)
        valid = np.zeros(2 * len(points), bool)
        if len(pairs):
            grams[0:2 * len(pairs):2] = pairs
            valid[0:2 * len(pairs):2] = True
        if len(pairs) > 1:
            triples = pairs[:-1] * np.uint32(0xC2B2AE3D) + points[2:] * np.uint32(0x27D4EB2F)
            grams[1:2 * len(triples):2] = triples
            valid[1:2 * len(triples):2] = True
        valid[2 * bounds[1:] - 2] = valid[2 * bounds[1:] - 1] = False   # grams do not cross texts
        short = bounds[1:][sizes > 0]
        valid[2 * short - 3] = False
        grams = (grams[valid] ^ grams[valid] >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BITS)
        return grams.astype(np.int32), np.concatenate([[0], np.cumsum(valid)])[2 * bounds], has_letter


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """(documents with each feature, documents) over all rows; at most FEATURES + 1 numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts, rows = Grams(), np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            texts = texts_of(batch.column(0))
            rows += len(texts)
            for first, n in row_slices(texts, _SLICE):
                found, before, _ = grams(texts.slice(first, n))
                for a in range(0, n, _ROWS_AT_ONCE):
                    b = min(n, a + _ROWS_AT_ONCE)
                    seen = np.zeros((b - a, FEATURES), bool)
                    seen[np.repeat(np.arange(b - a), np.diff(before[a:b + 1])), found[before[a]:before[b]]] = True
                    counts += seen.sum(axis=0)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1), pa.int32()),
                                          pa.array(np.append(counts[used], rows), pa.int64())], names=["feature", "n"])

    table = (docs.select(text_col).mapInArrow(run, "feature int, n long")
             .groupBy("feature").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(FEATURES + 1, np.int64)
    counts[table["feature"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)
    return counts[:-1], int(counts[-1])


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, epochs: int = 4,
                      alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> np.ndarray:
    """FTRL-proximal weights (FEATURES x classes) from sparse rows (features, values)."""
    z = np.zeros((FEATURES + 1, classes))
    n = np.zeros((FEATURES + 1, classes))

    def weights(at):
        zs = z[at]
        return np.where(np.abs(zs) <= l1, 0.0, (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(n[at])) / alpha + l2))

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            w = weights(at)
            logit = x @ w
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[labels[i]] -= 1
            g = x[:, None] * p
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / alpha * w
            n[at] = new
    return weights(slice(None))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The scale of logits with the least log loss, from a grid of a ratio of 1.1.

    As separable logits would have no best scale, a share of one row's weight is spread over all classes.
    """
    if not len(labels):
        return 1.0
    best, spread = (np.inf, 1.0), 1 / (len(labels) + 2)
    for k in range(-40, 41):
        scaled = logits * 1.1 ** k
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        right = (1 - spread) * scaled[np.arange(len(labels)), labels] + spread * scaled.mean(axis=1)
        loss = np.mean(np.log(np.exp(scaled).sum(axis=1)) - right)
        best = min(best, (loss, 1.1 ** k))
    return best[1]


def usual_score(scaled: np.ndarray, share: float = 0.01) -> float:
    """What the best language's probability reaches for all but a share of the calibration rows; an even share without rows."""
    if not len(scaled):
        return 1 / scaled.shape[1]
    p = np.exp(scaled - scaled.max(axis=1, keepdims=True))
    return float(np.quantile(p.max(axis=1) / p.sum(axis=1), share))


def _values(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and values of one text: relative frequency times inverse document frequency, and a constant."""
    at, counts = np.unique(found, return_counts=True)
    return np.append(at, FEATURES), np.append(100.0 * counts / max(1, counts.sum()) * idf[at], 1.0)


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows_per_language: int = 1500) -> dict | None:
    """Model from the training rows (those of docs whose language is not null); None without any."""
    spark = docs.sparkSession
    ship_package(spark)
    labelled = docs.where(F.col(lang_col).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(lang_col).count().collect()}     # one row a language
    if not counts:
        return None
    langs = sorted(counts)
    n_docs_with, n_docs = document_frequencies(labelled, text_col)
    idf = np.log((1 + n_docs) / (1 + n_docs_with)) + 1
    share = F.lit(0.0)
    for lang, count in counts.items():
        share = F.when(F.col(lang_col) == lang, min(1.0, rows_per_language / count)).otherwise(share)
    # by a hash of the row's place too, so that rows with one id are not all taken together
    place = F.pmod(F.xxhash64(id_col, F.monotonically_increasing_id(), F.lit("language")), F.lit(1 << 40))
    chosen = labelled.where(place < share * (1 << 40))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            texts = texts_of(batch.column(0))
            for first, n in row_slices(texts, _SLICE):
                found, before, _ = grams(texts.slice(first, n))
                rows = [_values(found[a:b], idf) for a, b in zip(before[:-1], before[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(first, n), pa.array([a.astype("<i4").tobytes() for a, _ in rows], pa.binary()),
                    pa.array([x.astype("<f4").tobytes() for _, x in rows], pa.binary())], names=["lang", "at", "x"])

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["lang", "at", "x"], kind="stable")
        pdf = pdf.groupby("lang").head(rows_per_language)
        labels = pdf["lang"].map({x: k for k, x in enumerate(langs)}).to_numpy(np.int64)
        rows = [(np.frombuffer(a, "<i4"), np.frombuffer(x, "<f4").astype(float)) for a, x in zip(pdf["at"], pdf["x"])]
        held = np.arange(len(rows)) % 5 == 4
        w = follow_the_leader([r for r, h in zip(rows, held) if not h], labels[~held], len(langs))
        logits = np.array([x @ w[at] for (at, x), h in zip(rows, held) if h]).reshape(-1, len(langs))
        scale = temperature(logits, labels[held])
        return pd.DataFrame({"w": [w.astype("<f4").tobytes()], "scale": [scale], "usual": [usual_score(logits * scale)]})

    sample = chosen.select(text_col, F.col(lang_col).cast("string")).mapInArrow(features, "lang string, at binary, x binary")
    # at most rows_per_language rows a language: one task
    model = sample.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(train, "w binary, scale double, usual double").first()
    if model is None:
        return None
    w = np.frombuffer(model["w"], "<f4").reshape(FEATURES + 1, len(langs))
    return {"langs": langs, "w": w[:-1] * (100.0 * idf[:, None]), "bias": w[-1].astype(float), "scale": model["scale"],
            "usual": model["usual"]}


def predict(df: DataFrame, text_col: str, model: dict | None) -> DataFrame:
    """df with lang_pred and score."""
    shared = df.sparkSession.sparkContext.broadcast(model)      # FEATURES x languages numbers

    def make():
        grams, m = Grams(), shared.value

        def compute(texts: pa.Array) -> list:
            found, before, has_letter = grams(texts)
            if m is None:
                return [pa.array(["und"] * len(texts), pa.string()), np.zeros(len(texts))]
            sums = np.stack([run_sums(m["w"][:, k].astype(np.float64)[found], before) for k in range(len(m["langs"]))], axis=1)
            logits = (sums / np.maximum(1, np.diff(before))[:, None] + m["bias"]) * m["scale"]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            names = np.array(m["langs"], dtype=object)[best]
            names[~has_letter] = "und"
            return [pa.array(names, pa.string()), np.where(has_letter, p[np.arange(len(best)), best], 0.0)]

        return compute

    return append_columns(df, text_col, {"lang_pred": T.StringType(), "score": T.DoubleType()}, make, _SLICE)


def held_out(id_col: str, parts: int = 5, rest: int = 0) -> Column:
    """Whether crc32 of the id as text leaves the given remainder (null id: as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == rest
