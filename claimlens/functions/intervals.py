"""Lookup of a point in a table of intervals, as an equi join.

An interval [lo, hi) is entered once for each cell of ``cell`` units that it touches; a point looks in its own cell and
keeps the interval that holds it.  So the join is on equal cells (hash or sort-merge), never a loop over all pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.draws import BP
from claimlens.functions.money import int_div


def interval_lookup(df: DataFrame, point: str, intervals: DataFrame, lo: str = "lo", hi: str = "hi", cell: int = 100,
                    how: str = "inner") -> DataFrame:
    """``df`` with the other columns of the interval that holds its ``point`` (integers; the intervals do not overlap)."""
    cells = F.explode(F.sequence(int_div(F.col(lo), cell), int_div(F.col(hi) - 1, cell)))
    table = intervals.where(F.col(lo) < F.col(hi)).withColumn("_cell", cells).withColumnsRenamed({lo: "_lo", hi: "_hi"})
    inside = (F.col(point) >= F.col("_lo")) & (F.col(point) < F.col("_hi"))
    return df.join(table, (int_div(F.col(point), cell) == F.col("_cell")) & inside, how).drop("_cell", "_lo", "_hi")


def weight_intervals(weights: Sequence[float], span: int = BP) -> list[tuple[int, int]]:
    """Intervals of 0..span with lengths in proportion to the weights; the last one takes what rounding leaves."""
    total = sum(weights)
    ends = [round(w / total * span) for w in accumulate(weights)]
    ends[-1] = span
    return list(zip([0, *ends[:-1]], ends))
