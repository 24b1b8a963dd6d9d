"""Exact hash quotas by cut-off.

"Take exactly q rows of each group, the ones with the smallest hash" without ranking, sorting or moving the rows:

1. a histogram (group, hash bucket) -> rows, a partial hash aggregate over the key columns only;
2. a running sum over each group's histogram finds the bucket that holds the q-th smallest hash; only that bucket's rows
   (about one in 2**20 of the group) are ranked, which gives the group's cut-off, the last hash and key that is taken;
3. the cut-offs, one row a group, go to the rows as a filter or a flag: the caller's own scan, with no exchange.

Buckets are 2**20 equal ranges of the hash.  Where the share that is taken is known, the hash of the q-th row is close to
that share of the range, so only the ranges around it are that fine and the others are 2**8: a few thousand counters a
group.  A cut-off outside the fine ranges is as exact; it happens in small groups, whose buckets are small.

Keys are unique within a group; rows with one key are taken or left together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.money import int_div
from claimlens.functions.scalar import join_groups
from claimlens.session import stage_table

FINE, COARSE = 12, 24          # bits of a 32-bit hash below a fine and a coarse bucket


def hash32(key: Column, salt: str) -> Column:
    """First 8 hex digits of md5(key|salt) as an unsigned 32-bit integer."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit("|" + salt))), 1, 8), 16, 10).cast("bigint")


def hash_bucket(h: Column, share: Column | None) -> Column:
    """Start of the bucket of a hash: fine within a coarse bucket's width of ``share`` of the range, coarse elsewhere."""
    fine = F.shiftleft(F.shiftright(h, FINE), FINE)
    if share is None:
        return fine
    near = F.shiftright((share * F.lit(float(1 << 32))).cast("bigint"), COARSE)
    apart = F.abs(F.shiftright(h, COARSE) - near)
    return F.when(apart <= 1, fine).otherwise(F.shiftleft(F.shiftright(h, COARSE), COARSE))


def hash_cut_offs(keyed: DataFrame, groups: list[str], quota: DataFrame | Callable[[Column], Column],
                  share: Column | None = None) -> DataFrame:
    """(groups, _cut_h, _cut_k): the last row taken of each group, for ``keyed`` (groups, _h, _k); no row where none is.

    ``quota``: a table (groups, _q), or a function from a group's size to its quota.  ``share``: about what part is taken.
    """
    bucket = hash_bucket(F.col("_h"), share)
    hist = stage_table(keyed.groupBy(*groups, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_c")), "hash-histogram")
    sizes = hist.groupBy(*groups).agg(F.sum("_c").alias("_n"), *([quota(F.sum("_c")).cast("bigint").alias("_q")] if callable(quota) else []))
    if not callable(quota):
        sizes = join_groups(sizes, quota, groups)
    sizes = sizes.select(*groups, F.least("_q", "_n").alias("_q"))
    below = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    running = join_groups(hist.withColumn("_before", F.coalesce(F.sum("_c").over(below), F.lit(0))), sizes, groups)
    edges = stage_table(running.where("_before < _q and _q <= _before + _c").select(
        *groups, F.col("_b").alias("_edge"), (F.col("_q") - F.col("_before")).alias("_need")), "hash-edges")
    edge_rows = join_groups(keyed, edges, groups).where(bucket == F.col("_edge"))
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy("_h", "_k"))
    last = edge_rows.withColumn("_rank", rank).where("_rank = _need")
    return stage_table(last.select(*groups, F.col("_h").alias("_cut_h"), F.col("_k").alias("_cut_k")), "hash-cut-offs")


def is_taken(h: Column, k: Column, cut_h: Column, cut_k: Column) -> Column:
    """Is a row at or before its group's cut-off?  Of a row beyond it, the hash is worked out once."""
    return F.coalesce((h <= cut_h) & ((h < cut_h) | (k <= cut_k)), F.lit(False))


def select_by_hash_quota(df: DataFrame, groups: list[str], quota: DataFrame | Callable[[Column], Column], key: Column, salt: str,
                         flag: str = "selected", share: float | None = None) -> DataFrame:
    """Add ``flag`` = 1 on exactly the quota of rows of each group (smallest hash first, key breaks ties).

    Groups missing from a quota table select nothing.  The cut-offs are worked out while the plan is built.
    """
    h, k = hash32(key, salt), key.cast("string")
    cuts = hash_cut_offs(df.select(*groups, h.alias("_h"), k.alias("_k")), groups, quota, None if share is None else F.lit(share))
    return join_groups(df, cuts, groups, "left").withColumn(
        flag, is_taken(h, k, F.col("_cut_h"), F.col("_cut_k")).cast("int")).drop("_cut_h", "_cut_k")


def fraction_of(fraction: float) -> Callable[[Column], Column]:
    """floor(n * fraction), in exact integer arithmetic (fraction in parts per million)."""
    ppm = int(round(fraction * 1_000_000))
    return lambda n: int_div(n.cast("bigint") * F.lit(ppm), 1_000_000)


def quota_fraction(df: DataFrame, groups: list[str], fraction: float) -> DataFrame:
    """q = floor(n * fraction) per group as a table."""
    return df.groupBy(*groups).agg(fraction_of(fraction)(F.count(F.lit(1))).alias("_q"))


def smallest_per_group(df: DataFrame, groups: list[str], cap: int, key: Column, salt: str) -> DataFrame:
    """At most ``cap`` rows of each group, those with the smallest hash.

    For groups that are small or caps that are: every task keeps its own ``cap`` first rows before the exchange.
    """
    h, k = hash32(key, salt), key.cast("string")
    first = F.row_number().over(Window.partitionBy(*groups).orderBy(h, k))
    return df.withColumn("_rank", first).where(F.col("_rank") <= cap).drop("_rank")


def sample_shares(df: DataFrame, stratum: str, shares: dict[str, float], key: Column, salt: str, rest: float = 0.0) -> DataFrame:
    """Each row with its stratum's share as chance (``rest`` where the stratum has none), by the hash of its key.

    A filter on every row by itself: no count, no exchange, and the same rows on every run and partitioning.
    """
    share = F.lit(float(rest))
    for name, value in shares.items():
        share = F.when(F.col(stratum) == name, F.lit(float(value))).otherwise(share)
    return df.where(hash32(key, salt) < F.floor(share * F.lit(float(1 << 32))))
