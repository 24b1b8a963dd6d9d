"""Registered queries of this subpackage: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import language_id, maxent_lm, minhash, oracles, quality_classifier
from .common import checkpoint_dir, read_table, vocabulary_file
from .merkle import leaf_digest, manifest
from .packing import pack
from .periodic_runs import periodic_runs
from .piece_bpe import encode_and_decode
from .quality_rules import apply_rules
from .sharding import shard_by_bytes
from .simhash import hex_digits, near_duplicates
from .token_files import read_token_files, write_token_files
from .voronoi_knn import top_k


def _file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs, "doc_id", "text", words_per_shingle=3, max_distance=3).select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op2_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return top_k(vectors, "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5, scale=256)


def op3_packing(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    data = _file(vocabulary or vocabulary_file("byte_bpe_50k.json"))
    return pack(docs, "doc_id", "text", data, spaced=True, end_id=1, keep_ids=False).drop("ids")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return shard_by_bytes(docs, "doc_id", "text").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return apply_rules(docs, "text").drop("text")


def op6_piece_bpe(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return encode_and_decode(docs, "text", _file(model or vocabulary_file("piece_bpe_32k.model")),
                             keep_ids=False).drop("text", "ids")


def op7_token_files(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import uuid
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    files = write_token_files(docs, "doc_id", "text", folder, _file(vocabulary or vocabulary_file("word_bpe_49k.json")),
                              spaced=False, end_id=2)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_token_files(files, "doc_id", T.LongType(), tasks, keep_ids=False).drop("ids")


def op8_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    scored = maxent_lm.score(docs, "doc_id", "text", ~language_id.held_out("doc_id", 7, 2))
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality").where(~language_id.held_out("doc_id"))
    model = quality_classifier.fit(docs, labels, "doc_id", "text", "quality")
    return quality_classifier.score(docs, "text", model).select(
        "doc_id", language_id.held_out("doc_id").alias("held_out"), "score", "predicted")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language_id.fit(docs.where(~language_id.held_out("doc_id")), "doc_id", "text", "lang")
    return language_id.predict(docs.select("doc_id", "text"), "text", model).select(
        "doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def plant_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the contract's made-up repetition (one text in ten, by its id; none where the id is null)."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    found = periodic_runs(docs, "doc_id", "text", least_words=6, least_periods=4, prepare=plant_period)
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return minhash.near_duplicates(docs, "doc_id", "text", size=3, percent=85)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0,
                      leaf_digest("doc_id", "source", "lang", "n_chars", F.replace("text", F.lit("\n"), F.lit(""))))
    return manifest(docs, "doc_id", "source", leaf_digest("doc_id", "source", "lang", "n_chars", "text"), tampered)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash, "op2_voronoi_knn": op2_voronoi_knn,
        "op3_packing": op3_packing, "op4_sharding": op4_sharding, "op5_quality_rules": op5_quality_rules,
        "op6_piece_bpe": op6_piece_bpe, "op7_token_files": op7_token_files,
        "op8_maxent_lm": op8_maxent_lm, "op9_quality_classifier": op9_quality_classifier,
        "op10_language_id": op10_language_id, "op11_periodic_runs": op11_periodic_runs,
        "op12_minhash": op12_minhash, "op13_merkle_manifest": op13_merkle_manifest, "pipeline": pipeline,
    }


def llm_sql() -> dict[str, str]:
    """SQL of the three newest; the ten others are hashes, tokenizers, trained models, greedy packing and differencing."""
    return dict(oracles.SQL)
