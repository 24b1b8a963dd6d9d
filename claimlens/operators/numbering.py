"""Line numbers and per-encounter flags where one encounter may hold any share of the rows.

Encounters of ordinary size are numbered by a window on the encounter, in the exchange that shaping needs anyway.  An
encounter beyond ``giant`` lines would be one task of that exchange.  Its lines are numbered in two levels instead: the
exchange and the window also have the line number and a range of the second sort column as keys, and the lines before
each such part come from a histogram of the parts, itself summed in three steps (ranges of line numbers, line numbers,
ranges of the second column), so that no step has more than some thousand entries of one encounter in a group.  Flags of
giant encounters are aggregates joined back, one row an encounter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.money import int_div
from claimlens.functions.scalar import join_groups
from claimlens.session import stage_table

GIANT = 1_000_000
#: Width of a range of line numbers, and of the second sort column.
RANGE = 1024


@dataclass
class Encounters:
    """Lines exchanged for numbering: ``lines``, and what the giants among their encounters need."""

    lines: DataFrame
    group: str
    order: list[str]
    parted: bool = False

    @property
    def keys(self) -> list[str]:
        return [self.group, "_line_part", "_range_part"] if self.parted else [self.group]

    def line_number(self) -> Column:
        within = F.row_number().over(Window.partitionBy(*self.keys).orderBy(*self.order))
        return (within + F.col("_before") if self.parted else within).cast("int")

    def flags(self, df: DataFrame, **tests: Column) -> DataFrame:
        """``df`` (the lines, with more columns) with 1 where any line of the encounter passes the test."""
        by = Window.partitionBy(*self.keys)
        out = df.withColumns({name: F.max(test.cast("int")).over(by) for name, test in tests.items()})
        if not self.parted:
            return out
        giants = df.where("_line_part is not null").groupBy(self.group).agg(*[F.max(t.cast("int")).alias(f"_any_{n}") for n, t in tests.items()])
        out = join_groups(out, stage_table(giants, "giant-flags"), [self.group], "left")
        return out.withColumns({n: F.greatest(n, f"_any_{n}") for n in tests}).drop(*[f"_any_{n}" for n in tests])

    def drop_parts(self, df: DataFrame) -> DataFrame:
        return df.drop("_line_part", "_range_part", "_before")


def _before(parts: DataFrame, within: list[str], step: str, name: str) -> DataFrame:
    w = Window.partitionBy(*within).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(*within, step, F.coalesce(F.sum("_c").over(w), F.lit(0)).alias(name))


def part_offsets(lines: DataFrame, group: str) -> DataFrame:
    """(group, _line_part, _range_part, _before) of lines with these parts: the group's lines in earlier parts."""
    # written once: its sums are read four times
    fine = stage_table(lines.groupBy(group, "_line_part", "_range_part").agg(F.count(F.lit(1)).alias("_c")), "giant-parts")
    fine = fine.withColumn("_lines", int_div(F.col("_line_part"), RANGE))
    line = fine.groupBy(group, "_lines", "_line_part").agg(F.sum("_c").alias("_c"))
    coarse = line.groupBy(group, "_lines").agg(F.sum("_c").alias("_c"))
    out = _before(fine, [group, "_lines", "_line_part"], "_range_part", "_b3")
    out = out.join(_before(line, [group, "_lines"], "_line_part", "_b2"), [group, "_lines", "_line_part"])
    out = out.join(_before(coarse, [group], "_lines", "_b1"), [group, "_lines"])
    return out.select(group, "_line_part", "_range_part", (F.col("_b1") + F.col("_b2") + F.col("_b3")).alias("_before"))


def exchange_by_encounter(lines: DataFrame, narrow: DataFrame, group: str, order: list[str], giant: int = GIANT) -> Encounters:
    """Exchange ``lines`` for numbering by ``order`` (first a line number, then an integer) within ``group``.

    ``narrow`` has the group and the first two order columns of the same lines; it is counted while the plan is built.
    """
    counts = narrow.groupBy(group).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > giant)
    giants = stage_table(counts.select(group, F.lit(True).alias("_giant")), "giant-encounters")
    if giants.isEmpty():
        return Encounters(lines.repartition(group), group, order)
    first, second = F.col(order[0]).cast("bigint"), F.col(order[1]).cast("bigint")

    def parted(df: DataFrame) -> DataFrame:
        df = join_groups(df, giants, [group], "left")
        return df.withColumns({"_line_part": F.when(F.col("_giant"), first),
                               "_range_part": F.when(F.col("_giant"), int_div(second, RANGE))}).drop("_giant")

    offsets = part_offsets(parted(narrow).where("_line_part is not null"), group)
    keys = [group, "_line_part", "_range_part"]
    spread = parted(lines)
    same = [spread[k].eqNullSafe(offsets[k]) for k in keys]
    spread = spread.join(offsets, same, "left").select(*[spread[c] for c in spread.columns],
                                                       F.coalesce(offsets["_before"], F.lit(0)).alias("_before"))
    return Encounters(spread.repartition(*keys), group, order, parted=True)
