"""Driver-table scans.

Each reader names only the columns it needs, so the parquet scan's ReadSchema is
pruned; filters written downstream are pushed into the scan by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three tables the claim line table is built from, pruned to used columns."""
    return {
        "lineitem": read_table(spark, sf_dir, "lineitem", [
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_shipdate"]),
        "orders": read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]),
        "customer": read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"]),
    }


def read_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None, file_column: str | None = None) -> DataFrame:
    """Every chunk file of a written line table as one DataFrame, under a declared schema.

    A column that a file lacks (an earlier profile wrote it) is null; columns that the schema does not name are not
    read; no file is opened to infer types.  ``file_column``: a column for the file that each row came from.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if file_column is None else df.withColumn(file_column, F.col("_metadata.file_path"))
