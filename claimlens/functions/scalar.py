"""Attaching small results (one-row totals, one row a group) to a DataFrame.

A one-row table is joined on a constant key with an explicit broadcast: its size
is one row by construction, so the join never pairs rows of two large inputs.  A
table of one row a group is broadcast only after its rows were counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY = "_scalar_key"

#: Rows of a table up to which it is broadcast; larger ones meet in a shuffle join, which AQE may split.
BROADCAST_ROWS = 100_000


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row DataFrame to every row of ``df``."""
    left = df.withColumn(_KEY, F.lit(1))
    right = F.broadcast(one_row.withColumn(_KEY, F.lit(1)))
    return left.join(right, _KEY).drop(_KEY)


def combine(*one_rows: DataFrame) -> DataFrame:
    """Put several one-row DataFrames side by side (still one row)."""
    out = one_rows[0]
    for r in one_rows[1:]:
        out = attach(out, r)
    return out


def broadcast_if_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` marked for broadcast if it has at most ``rows`` rows (it is counted now, so stage it before)."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def join_groups(df: DataFrame, table: DataFrame, groups: list[str], how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with the other columns of ``table``, one row a group; null groups meet, tables up to ``rows`` are broadcast."""
    right = broadcast_if_small(table.withColumnsRenamed({g: f"_g_{g}" for g in groups}), rows)
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups])
    return df.join(right, same, how).drop(*[f"_g_{g}" for g in groups])
