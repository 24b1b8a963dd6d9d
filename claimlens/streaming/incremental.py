"""Incremental rollups (I01-I05): per-chunk partial aggregates merged into totals.

A chunk is a contiguous range of encounters (order key div chunk size).  Partial
aggregates are computed per chunk and merged by key; every merge is a sum or a
max, so the result does not depend on the order or grouping of chunks, and a
re-run of one chunk's micro-batch is idempotent when its partial is replaced.

I05 runs the rollups as Structured Streaming queries over chunk files as they
arrive.  The provider rollup writes each micro-batch's partials into a directory
of its own (``foreachBatch``, overwritten when the batch is replayed), and its
totals are one aggregate over them.  The rollups by type (I02-I04) have few keys:
they are stateful aggregates, kept in the query's state store and written in
whole after each batch (complete mode).  Both go on from the checkpoint after a
restart.  Nothing is collected to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions.money import to_double
from claimlens.operators.features import with_chunk_id
from claimlens.session import checkpoint_dir


#: Chunk files of one micro-batch.
FILES_PER_TRIGGER = 8


#: What the provider rollup reads of a line.
ROLLUP_COLUMNS = ["provider_id", "service_date", "fraud_label", "flagged_for_review", "allowed_amount"]


def provider_partials(df: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """Per (chunk, provider): lines, fraud, flagged, allowed sum, busiest day within the chunk."""
    day = df.groupBy(chunk, "provider_id", "service_date").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("fraud_label").alias("_f"),
        F.sum("flagged_for_review").alias("_g"), F.sum("allowed_amount").alias("_a"))
    return day.groupBy(chunk, "provider_id").agg(
        F.sum("_n").alias("lines"), F.sum("_f").alias("fraud_lines"), F.sum("_g").alias("flagged_lines"),
        F.sum("_a").alias("allowed_cents"), F.max("_n").alias("max_day_lines"))


def merge_provider_partials(partials: DataFrame) -> DataFrame:
    """Running provider totals from chunk partials (sums add, the day peak is the max of chunk peaks)."""
    g = partials.groupBy("provider_id").agg(
        F.sum("lines").cast("bigint").alias("lines"), F.sum("fraud_lines").cast("bigint").alias("fraud_lines"),
        F.sum("flagged_lines").cast("bigint").alias("flagged_lines"),
        F.sum("allowed_cents").alias("allowed_cents"), F.max("max_day_lines").cast("bigint").alias("max_day_lines"))
    return g.select("provider_id", "lines", "fraud_lines", "flagged_lines",
                    to_double(F.col("allowed_cents")).alias("allowed_total"), "max_day_lines",
                    (F.col("fraud_lines") / F.col("lines")).alias("fraud_rate"),
                    (F.col("flagged_lines") / F.col("lines")).alias("flag_rate"))


def merge_counts(df: DataFrame, key: str, chunk: str = "chunk_id") -> DataFrame:
    """Value counts per chunk, added across chunks (missing -> 0)."""
    part = df.groupBy(chunk, key).agg(F.count(F.lit(1)).alias("_c"))
    return part.groupBy(key).agg(F.sum("_c").cast("bigint").alias("count"))


def merge_confusion(df: DataFrame, chunk: str = "chunk_id", label: str = "fraud_label",
                    pred: str = "flagged_for_review") -> DataFrame:
    """Running tp / fp / fn / tn."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    part = df.groupBy(chunk).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                                 F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    return part.agg(*[F.sum(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")])


def merge_detection(df: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """Running n, caught and score sum per type; the mean is taken once at the end
    (the reference adds chunk means, which inflates the score by the number of chunks)."""
    part = df.groupBy(chunk, "fraud_type").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("flagged_for_review").alias("_c"), F.sum("rule_score").alias("_s"))
    g = part.groupBy("fraud_type").agg(F.sum("_n").cast("bigint").alias("n"), F.sum("_c").cast("bigint").alias("caught"),
                                       F.sum("_s").alias("_s"))
    return g.select("fraud_type", "n", "caught", (F.col("_s").cast("double") / F.col("n")).alias("avg_rule_score"),
                    (F.col("caught") / F.col("n")).alias("recall"))


def write_chunks(df: DataFrame, path: str, chunk_size: int) -> None:
    """Write the line table as chunk files, each chunk in one file (several chunks may share it)."""
    d = with_chunk_id(df, chunk_size)
    d.repartition("chunk_id").write.mode("overwrite").parquet(path)


def write_partials(batch: DataFrame, batch_id: int, path: str) -> None:
    """One micro-batch's partials, in a directory of its own: a replayed batch replaces what it wrote before."""
    provider_partials(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def stream_provider_rollup(spark: SparkSession, lines: DataFrame, chunk_size: int) -> DataFrame:
    """The provider rollup maintained by a streaming query as chunk files arrive."""
    base = checkpoint_dir(spark).rstrip("/") + f"/claimlens-stream/{uuid.uuid4().hex}"
    src, partials_path, ckpt = f"{base}/chunks", f"{base}/partials", f"{base}/checkpoint"
    write_chunks(lines.select("enc_key", *ROLLUP_COLUMNS), src, chunk_size)
    schema = spark.read.parquet(src).schema

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        write_partials(batch, batch_id, partials_path)

    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(src)
              .writeStream.foreachBatch(merge_batch).option("checkpointLocation", ckpt)
              .trigger(availableNow=True).start())
    stream.awaitTermination()
    return merge_provider_partials(spark.read.parquet(partials_path))


# Running totals by few keys: what the state store holds, and what is reported from it.
def counts_state(df: DataFrame, key: str = "fraud_type") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def confusion_state(df: DataFrame, label: str = "fraud_label", pred: str = "flagged_for_review") -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.groupBy().agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                            F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def detection_state(df: DataFrame) -> DataFrame:
    return df.groupBy("fraud_type").agg(F.count(F.lit(1)).alias("n"), F.sum("flagged_for_review").alias("caught"),
                                        F.sum("rule_score").alias("score_sum"))


def detection_report(state: DataFrame) -> DataFrame:
    """The mean score and the recall, taken once from the running sums."""
    return state.select("fraud_type", "n", "caught", (F.col("score_sum").cast("double") / F.col("n")).alias("avg_rule_score"),
                        (F.col("caught") / F.col("n")).alias("recall"))


def stream_totals(spark: SparkSession, source: str, folder: str, state: Callable[[DataFrame], DataFrame],
                  files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """I05 for I02-I04: totals over all chunk files in ``source``, going on from what ``folder`` holds.

    ``folder`` keeps the checkpoint with the state store, and the totals after each batch in a directory of its own
    (a replayed batch replaces it).  Returns the totals after the last batch.
    """
    schema = spark.read.parquet(source).schema
    totals = f"{folder}/totals"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{totals}/batch_id={batch_id}")

    stream = (state(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source))
              .writeStream.outputMode("complete").foreachBatch(write_batch).option("checkpointLocation", f"{folder}/checkpoint")
              .trigger(availableNow=True).start())
    stream.awaitTermination()
    written = spark.read.parquet(totals)
    last = written.agg(F.max("batch_id")).first()[0]
    return written.where(F.col("batch_id") == last).drop("batch_id")
