"""Money and ratio expressions on exact integer cents.

Inside the engine every amount is a BIGINT number of cents and every rate a
BIGINT in fixed units (1e-2, 1e-4 or 1e-6).  Products are rounded half away
from zero with integer arithmetic, which is exactly what DECIMAL rounding gives,
but stays on primitive longs inside whole-stage codegen (Spark's DECIMAL
multiply goes through java.math.BigDecimal for every row).  Sums are exact and
order-free across partitions; amounts become DOUBLE only at output, as
``cents / 100.0`` -- the same correctly rounded double as casting DECIMAL(18,2).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def int_div(a: Column, b: Column | int) -> Column:
    """Exact BIGINT division, truncated towards zero (SQL ``div``)."""
    return F.call_function("div", a.cast("bigint"), (F.lit(b) if isinstance(b, int) else b).cast("bigint"))


def round_div(num: Column, den: Column | int) -> Column:
    """num / den rounded half away from zero, for den > 0 (BIGINT)."""
    den = F.lit(den) if isinstance(den, int) else den
    return int_div(F.abs(num) * 2 + den, den * 2) * F.when(num < 0, F.lit(-1)).otherwise(F.lit(1))


def scale(cents: Column, factor: Column, unit: int) -> Column:
    """round(cents * factor / unit): an amount times a fixed-point factor, back in cents."""
    return round_div(cents.cast("bigint") * factor.cast("bigint"), unit)


def to_double(cents: Column) -> Column:
    """Output form of an amount."""
    return cents.cast("double") / F.lit(100.0)


def sum_double(cents: Column) -> Column:
    """Aggregate: exact sum of cents as DOUBLE amount."""
    return F.sum(cents).cast("double") / F.lit(100.0)


def mean_double(sum_cents: Column, n: Column) -> Column:
    """Average from an exact cents sum: amount as double, then divided by the count (hazard H2)."""
    return (sum_cents.cast("double") / F.lit(100.0)) / n.cast("double")


def ratio4(num: Column, den: Column, floor_cents: int | None = 100) -> Column:
    """round(num / max(den, floor), 4) as DOUBLE, exactly, from cents."""
    n = num.cast("bigint")
    d = (F.greatest(den, F.lit(floor_cents)) if floor_cents is not None else den).cast("bigint")
    return round_div(n * 10000, d).cast("double") / F.lit(10000.0)
