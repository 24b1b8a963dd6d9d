"""Sinks, manifest and sampling.

Writers go to paths the caller names (on a cluster: shared storage); the
summary CSV writer makes one file only where the caller says that the summary's
rows are bounded by a fixed catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.sampling import select_by_hash_quota, smallest_per_group
from claimlens.operators.features import with_chunk_id
from claimlens.session import stage_table


def write_lines(df: DataFrame, path: str, chunk_size: int) -> None:
    """The line table as parquet, one directory per chunk; clustered first, so a chunk has few files."""
    with_chunk_id(df, chunk_size).repartitionByRange("chunk_id", "enc_key").write.mode("overwrite").partitionBy("chunk_id").parquet(path)


def write_summary(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header.

    ``one_file`` is for summaries whose rows are bounded by a fixed catalogue (types, families, reasons); those
    keyed by providers or members grow with the data and keep their partitions.
    """
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def chunk_manifest(df: DataFrame, chunk_size: int) -> DataFrame:
    """One row per chunk: number, file name, format, rows, first and last service date."""
    g = with_chunk_id(df, chunk_size).groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("service_date").alias("min_service_date"),
        F.max("service_date").alias("max_service_date"))
    return g.select(F.col("chunk_id").alias("chunk_number"),
                    F.format_string("claims_lines_chunk_%03d.parquet", F.col("chunk_id")).alias("chunk_file"),
                    F.lit("parquet").alias("format"), "rows", "min_service_date", "max_service_date")


def file_manifest(lines: DataFrame) -> DataFrame:
    """K08 of files as they are: one row per file of a written line table, for lines read with a ``file`` column.

    Chunk number (from the directory), file name, format, rows, first and last service date.
    """
    name = F.element_at(F.split("file", "/"), -1)
    g = lines.groupBy("file").agg(F.count(F.lit(1)).alias("row_count"), F.min("service_date").alias("min_service_date"),
                                  F.max("service_date").alias("max_service_date"))
    return g.select(F.regexp_extract("file", "/chunk_id=([0-9]+)/", 1).cast("bigint").alias("chunk_number"), name.alias("file_name"),
                    F.element_at(F.split(name, "[.]"), -1).alias("format"), "row_count", "min_service_date", "max_service_date")


def sample_per_chunk(df: DataFrame, chunk_size: int, per_chunk: int, total: int, key: str = "line_id",
                     salt: str = "sample") -> DataFrame:
    """At most ``per_chunk`` rows of each chunk, then at most ``total`` of those, by smallest hash.

    One scan of the lines: a task keeps the first ``per_chunk`` rows of each chunk before the exchange.  What is left is
    written once; the second step is a cut-off over it.  The sample itself is the feature, so the caps are its parameters.
    """
    first = stage_table(smallest_per_group(with_chunk_id(df, chunk_size), ["chunk_id"], per_chunk, F.col(key), salt), "chunk-samples")
    first = select_by_hash_quota(first.withColumn("_all", F.lit(1)), ["_all"], lambda n: F.least(n, F.lit(total)), F.col(key),
                                 salt + "_total", "_in_total")
    return first.where("_in_total = 1").drop("_in_total", "_all")


def union_lines(*parts: DataFrame) -> DataFrame:
    """Stack families that carry different columns; a missing column becomes null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
