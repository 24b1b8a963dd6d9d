"""Shards of nearly equal bytes by Karmarkar-Karp differencing over indivisible groups.

Rows with equal texts form a group and stay together.  A group of at least 1/``units`` of all bytes is a unit of its
own; smaller groups are bundled by their hash into ``units`` bundles.  So differencing sees at most 2 x ``units``
items whatever the size of the table, and runs in one task: each item starts as a partial partition with its bytes in
one part, and the two partial partitions with the largest spread are combined, one in rising and one in falling
order, until one is left.  Rows then look up the shard of their unit.

Null texts count as empty.  Rows are taken as they come (repeated rows are one group, null ids stay null); an empty
table gives no row; other columns are ignored.  A group larger than a fair share makes its shard that much larger: a
group is never split, by definition of this law.  ``slot`` counts a shard's rows gapless from 0: rows are numbered
inside buckets of a shard by a hash of their place in the staged table, so that equal rows are spread, too, and shifted
by the number of rows in the buckets before: no task sees a whole shard.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import ship_package, stage_table


def differencing(sizes: np.ndarray, parts: int) -> np.ndarray:
    """Part (0 to parts - 1) of each item by the largest differencing method.

    A partial partition is its parts' sums in rising order and, for each part, a tree of the items in it.
    """
    if not len(sizes):
        return np.zeros(0, np.int64)
    heap = []
    for k in np.argsort(-sizes, kind="stable"):
        sums = np.zeros(parts, np.int64)
        sums[-1] = sizes[k]
        heap.append((-int(sizes[k]), len(heap), sums, [None] * (parts - 1) + [int(k)]))
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        sums = a + b[::-1]
        both = [y if x is None else x if y is None else (x, y) for x, y in zip(in_a, reversed(in_b))]
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        count += 1
        heapq.heappush(heap, (-int(sums[-1] - sums[0]), count, sums, [both[i] for i in order]))
    part = np.zeros(len(sizes), np.int64)
    for p, tree in enumerate(heap[0][3]):
        stack = [] if tree is None else [tree]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            else:
                part[x] = p
    return part


def shard_by_bytes(df: DataFrame, id_col: str, text_col: str, shards: int = 24, overhead: int = 8,
                   units: int = 8192, buckets: int = 512) -> DataFrame:
    """id_col, size, text_crc32, shard, slot for every row; equal texts share a shard and shards' sizes are near equal."""
    ship_package(df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stage_table(df.select(
        F.col(id_col), (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("group"),
        F.monotonically_increasing_id().alias("_place")), "sharding")
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    alone = F.col("bytes") >= max(1, total // units)
    loads = (groups.withColumn("alone", alone)
             .withColumn("unit", F.when(alone, F.col("group")).otherwise(F.pmod("group", F.lit(units))))
             .groupBy("alone", "unit").agg(F.sum("bytes").alias("bytes")))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "alone", "unit"], ascending=False, kind="stable")
        return pdf.assign(shard=differencing(pdf["bytes"].to_numpy(np.int64), shards))[["alone", "unit", "shard"]]

    # at most 2 x units rows, whatever the table: one task, and small enough to broadcast
    placed = stage_table(loads.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(
        solve, "alone boolean, unit long, shard int"), "shards")
    large = placed.where("alone").select(F.col("unit").alias("group"), F.col("shard").alias("_own"))
    small = placed.where("not alone").select(F.col("unit").alias("_unit"), F.col("shard").alias("_bundled"))
    sharded = (rows.withColumn("_unit", F.pmod("group", F.lit(units)))
               .join(F.broadcast(large), "group", "left").join(F.broadcast(small), "_unit", "left")
               .select(id_col, "size", "text_crc32", F.coalesce("_own", "_bundled").alias("shard"),
                       "_place", F.pmod(F.xxhash64("_place"), F.lit(buckets)).cast("int").alias("_bucket")))
    before = (sharded.groupBy("shard", "_bucket").count()
              .withColumn("_before", F.coalesce(F.sum("count").over(
                  Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("count"))
    inside = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("_place"))
    return (sharded.withColumn("_row", inside).join(F.broadcast(before), ["shard", "_bucket"])
            .select(id_col, "size", "text_crc32", "shard", (F.col("_row") - 1 + F.col("_before")).cast("long").alias("slot")))
