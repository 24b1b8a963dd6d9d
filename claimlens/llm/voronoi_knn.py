"""Exact top-k inner products by a Voronoi join.

Vectors are scaled and floored to integers.  The largest inner products of a query are its nearest neighbours once every
candidate v gets the further component sqrt(M - v.v), M the largest squared length, and every query a zero there.  So
distances to pivots bound them:

* candidates and queries go to the cell of their nearest pivot (a bounded sample gives the pivots);
* summaries: for each cell, its count and range of distances, the k + 1 nearest distinct ids with their least distances to
  the pivot, and the largest distance of its queries.  From these each query, by its own distance to its pivot, gets a
  bound on the distance of its k-th neighbour, and for each candidate cell the range of distances to that pivot in which
  a neighbour can lie;
* a query is sent only to the cells whose range it meets; there its distance to the cell's pivot is known, and it meets
  only candidates whose own distance differs from that by its bound at most; a cell's candidates are sent only where some
  group's range holds them, once to each block of that cell's queries; cells are cut into blocks of about ``block_rows``
  by a hash of the row's number (so equal rows spread, too), their queries into blocks of about ``block_queries``;
* each block is solved with matrix products (exact: doubles while these have no rounding, then longs, then Python's
  integers) and gives at most k rows a query, merged by a ranking.  A score beyond a long is an error.

Vectors that are null or hold null or non-finite components take no part, nor do rows with a null id.  Shorter vectors
are filled with zeros.  Rows with a query's id are no candidates for it; queries with equal ids are one query (the least
vector); other repeated rows count each.  Ties go to the smaller id.  An empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ship_package, stage_table


def _quantised(vectors: Column, scale: int) -> Column:
    return F.transform(vectors, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _usable(vectors: Column) -> Column:
    return vectors.isNotNull() & F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample, each the farthest from those before."""
    chosen = [0]
    apart = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)) and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def group_bounds(between: np.ndarray, nearest: dict[int, list[tuple[int, float]]], reach: dict[int, float], k: int,
                 slack: float) -> list[tuple[int, int, float, float, float, float]]:
    """(query cell, candidate cell, least, greatest, apart, bound) for every pair of cells.

    A query ``q`` away from its pivot has its k nearest within ``q + bound``, and its distance to the other pivot is
    within ``q`` of ``apart``; least and greatest are the distances to that pivot at which any query of the cell can
    have a neighbour.
    """
    out = []
    for i, far in reach.items():
        near: dict[int, float] = {}                               # of each id over all cells
        for j, some in nearest.items():
            for id_, d in some:
                near[id_] = min(near.get(id_, math.inf), between[i, j] + d)
        upper = sorted(near.values())
        bound = upper[k] if len(upper) > k else math.inf          # one of the k + 1 ids may be the query's own
        for j in nearest:
            apart, wide = float(between[i, j]), float(2 * far + bound + slack)
            out.append((i, j, apart - wide, apart + wide, apart, float(bound + slack)))
    return out


def candidate_blocks(placed: DataFrame, cells: DataFrame) -> DataFrame:
    """Each candidate in its cell's range, once for every block of the cell's queries; equal rows go to different blocks."""
    return (placed.join(F.broadcast(cells), "cell").where(F.col("away").between(F.col("low"), F.col("high")))
            .select("cell", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block"),
                    F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("q_block"), "id", "v", "away"))


def top_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def top_k(df: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = 5, scale: int = 256,
          pivots: int | None = None, block_rows: int = 8192, block_queries: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k highest inner products.

    ``pivots``: a quarter of the root of the number of rows, 32 at least and 512 at most, if not given; they are taken
    from 16 rows each.
    """
    spark = df.sparkSession
    ship_package(spark)
    usable = df.where(F.col(id_col).isNotNull() & _usable(F.col(vector_col)))
    rows = stage_table(usable.select(F.col(id_col).cast("long").alias("id"), _quantised(F.col(vector_col), scale).alias("v"),
                                     is_query.alias("q"), F.monotonically_increasing_id().alias("row")), "vectors")
    squared = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))   # longs would overflow
    n, most, width = rows.agg(F.count("*"), F.max(squared), F.max(F.size("v"))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    width = max(1, width)
    pivots = pivots or min(512, max(32, math.isqrt(n) // 4))
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))
    rows = rows.withColumn("v", padded)

    def lifted(v: np.ndarray) -> np.ndarray:
        v = v.astype(float)
        return np.concatenate([v, np.sqrt(np.maximum(0.0, most - (v * v).sum(axis=1)))[:, None]], axis=1)

    some = rows.orderBy(F.xxhash64("id"), "id").limit(16 * pivots).select("v").toPandas()   # a bounded sample
    points = choose_pivots(lifted(np.array(some["v"].tolist())), pivots)

    def nearest(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        square = (v * v).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2 * v @ points.T
        cell = square.argmin(axis=1)
        return cell, np.sqrt(((v - points[cell]) ** 2).sum(axis=1))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            cell, away = nearest(lifted(v))
            query = np.concatenate([v.astype(float), np.zeros((len(v), 1))], axis=1)
            q_cell, q_away = nearest(query)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away),
                                              pa.array(q_cell.astype(np.int32)), pa.array(q_away)],
                                             names=["id", "v", "q", "row", "cell", "away", "q_cell", "q_away"])

    placed = stage_table(rows.mapInArrow(assign, "id long, v array<long>, q boolean, row long, cell int, away double, q_cell int, "
                                                 "q_away double"), "cells")
    queries = (placed.where("q").groupBy(F.col("id").alias("asked")).agg(F.min(F.struct("v", "q_cell", "q_away")).alias("s"))
               .select("asked", F.col("s.v").alias("vector"), F.col("s.q_cell").alias("q_cell"), F.col("s.q_away").alias("q_away")))
    reach = {r[0]: (r[1], r[2]) for r in queries.groupBy("q_cell").agg(F.max("q_away"), F.count("*")).collect()}
    if not reach:
        return empty
    # summaries: at most `pivots` cells, k + 1 ids each (no row of a query's id is its neighbour, so an id counts once)
    sizes = {r[0]: r[1:] for r in placed.groupBy("cell").agg(F.count("*"), F.min("away"), F.max("away")).collect()}
    order = Window.partitionBy("cell").orderBy("away", "id")
    first = (placed.groupBy("cell", "id").agg(F.min("away").alias("away"))
             .withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1))
    near: dict[int, list[tuple[int, float]]] = {}
    for r in first.collect():
        near.setdefault(r["cell"], []).append((r["id"], r["away"]))
    between = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    slack = 1e-6 * (1 + math.sqrt(most or 0))
    ranges = [b for b in group_bounds(between, near, {i: r[0] for i, r in reach.items()}, k, slack)
              if b[2] <= sizes[b[1]][2] and b[3] >= sizes[b[1]][1]]
    # what a cell's candidates must be sent to: its own meeting queries' blocks, and only those in some group's range
    asking: dict[int, int] = {}
    needed: dict[int, tuple[float, float]] = {}
    for i, j, least, greatest, *_ in ranges:
        asking[j] = asking.get(j, 0) + reach[i][1]
        low, high = needed.get(j, (math.inf, -math.inf))
        needed[j] = min(low, least), max(high, greatest)
    blocks = {j: -(-sizes[j][0] // block_rows) for j in needed}
    q_blocks = {j: -(-n // block_queries) for j, n in asking.items()}
    meet = spark.createDataFrame([(*b[:2], *b[4:], *sizes[b[1]][1:], blocks[b[1]], q_blocks[b[1]]) for b in ranges],
                                 "q_cell int, cell int, apart double, bound double, first double, last double, blocks int, q_blocks int")
    cells = spark.createDataFrame([(j, blocks[j], q_blocks[j], *needed[j]) for j in needed],
                                  "cell int, blocks int, q_blocks int, low double, high double")

    # a candidate goes once to every block of its cell's queries, a query to every block of the cells that its group meets
    left = candidate_blocks(placed, cells)
    # for a query of its own: where a neighbour's distance to the cell's pivot can be
    wide = 2 * F.col("q_away") + F.col("bound")
    right = (queries.join(F.broadcast(meet), "q_cell").where((F.col("apart") - wide <= F.col("last")) & (F.col("apart") + wide >= F.col("first")))
             .select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                     F.pmod(F.xxhash64("asked", F.lit("query")), F.col("q_blocks")).cast("int").alias("q_block"),
                     "asked", "vector", (F.col("q_away") + F.col("bound")).alias("within")))

    def solve(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(candidates) and len(asked):
            order = np.argsort(candidates["away"].to_numpy(), kind="stable")
            ids, away = candidates["id"].to_numpy()[order], candidates["away"].to_numpy()[order]
            matrix, vectors = (np.array(x.tolist()) for x in (candidates["v"], asked["vector"]))
            matrix = matrix[order]
            # products of doubles have no rounding, longs no overflow, else Python's integers (a score beyond longs is an error)
            largest = width * float(np.abs(matrix).max(initial=0)) * float(np.abs(vectors).max(initial=0))
            kind = float if largest < 2 ** 52 else np.int64 if largest < 2 ** 62 else object
            matrix = matrix.astype(kind)
            # a neighbour's distance to the pivot differs from the query's by their distance at most
            point = points[candidates["cell"].iloc[0]]
            to_pivot = np.sqrt(((vectors - point[:-1]) ** 2).sum(axis=1) + point[-1] ** 2)
            within = asked["within"].to_numpy()
            starts = np.searchsorted(away, to_pivot - within, side="left")
            ends = np.searchsorted(away, to_pivot + within, side="right")
            turn = np.argsort(starts, kind="stable")
            for a in range(0, len(turn), 256):
                part = turn[a:a + 256]
                low, high = int(starts[part].min()), int(ends[part].max())
                scores = (vectors[part].astype(kind) @ matrix[low:high].T).astype(np.int64)
                for n, row in zip(part, scores):
                    own = np.arange(starts[n], ends[n])
                    own = own[ids[own] != asked["asked"].iloc[n]]
                    top = own[top_rows(row[own - low], ids[own], k)]
                    out["query_id"] += [int(asked["asked"].iloc[n])] * len(top)
                    out["vec_id"] += ids[top].tolist()
                    out["score"] += row[top - low].tolist()
        return pd.DataFrame(out, dtype="int64")

    keys = ["cell", "block", "q_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(solve, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
