"""Deterministic draws (K01, K02) in place of random number streams.

``draw(key, salt)`` is a portable uniform integer on 0..9999.  A 128-bit md5
digest holds four independent 32-bit words, so salts are grouped four to a
digest: the draw for a salt is word ``slot`` of ``md5(key || '|' || group)``,
read as an integer, modulo 10000.  Salts outside the table get their own digest
(``group = salt``, ``slot = 0``).  The digests a line needs are computed once as
columns (``with_digests``) and the draws read words out of them, so a line costs
four md5 calls instead of sixteen.  The DuckDB oracle reproduces the same bits.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BP = 10000  # draws live on 0..9999 (basis points)

# salt -> (digest group, 32-bit word within the digest)
SLOTS: dict[str, tuple[str, int]] = {
    "deny": ("d1", 0), "reason": ("d1", 1), "pay": ("d1", 2), "fraud": ("d1", 3),
    "pricing": ("d2", 0), "pricing_amt": ("d2", 1), "egregious": ("d2", 2), "egregious_amt": ("d2", 3),
    "units": ("d3", 0), "units_amt": ("d3", 1), "upcode": ("d3", 2), "upcode_amt": ("d3", 3),
    "member": ("d4", 0), "member_amt": ("d4", 1), "dup": ("d4", 2), "trend": ("d4", 3),
}
LINE_GROUPS = ["d1", "d2", "d3", "d4"]


def slot(salt: str) -> tuple[str, int]:
    return SLOTS.get(salt, (salt, 0))


def digest_col(group: str) -> str:
    return f"_md5_{group}"


def draw_key(*cols: Column | str) -> Column:
    """Join key parts with '|' (K02 input)."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def numbered(prefix: str, n: Column, width: int) -> Column:
    """``format_string`` of the prefix and ``%0<width>d``; numbers from 0 on are padded without java.util.Formatter."""
    digits = n.cast("string")
    padded = F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))
    return F.when(n >= 0, padded).otherwise(F.format_string(f"{prefix}%0{width}d", n))


def line_id() -> Column:
    """The line's id: encounter and line number."""
    return F.concat(numbered("L", F.col("enc_key"), 9), numbered("_", F.col("claim_line_no"), 8))


def digest(key: Column, group: str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit("|" + group)))


def with_digests(df: DataFrame, key: str = "line_key", groups: Sequence[str] = LINE_GROUPS) -> DataFrame:
    """Materialise the digests of the line draws once per row."""
    return df.withColumns({digest_col(g): digest(F.col(key), g) for g in groups})


def word(hexcol: Column, i: int) -> Column:
    return F.conv(F.substring(hexcol, 1 + 8 * i, 8), 16, 10).cast("bigint")


def draw(key: Column, salt: str, digests: bool = False) -> Column:
    """K02 hash_draw: uniform integer on 0..9999.

    With ``digests=True`` the word is read from the precomputed digest column of
    the salt's group (see ``with_digests``); otherwise the digest is computed here.
    """
    group, i = slot(salt)
    hexcol = F.col(digest_col(group)) if digests else digest(key, group)
    return F.pmod(word(hexcol, i), F.lit(BP))


def line_draw(salt: str) -> Column:
    """A draw keyed on the line (reads the precomputed digests)."""
    return draw(F.col("line_key"), salt, digests=True)


def uniform_e6(h: Column, lo: str, hi: str) -> Column:
    """U(lo, hi) = lo + (hi - lo) * h / 10000 in units of 1e-6, exact (BIGINT)."""
    lo_d, hi_d = Decimal(lo), Decimal(hi)
    base = int(lo_d * 1_000_000)
    step = int((hi_d - lo_d) * 100)
    return (F.lit(base) + F.lit(step) * h).cast("bigint")


def uniform(key: Column, salt: str, lo: str | float, hi: str | float) -> Column:
    """U(lo, hi) as DECIMAL(10,6) (for callers that want a decimal factor)."""
    e6 = uniform_e6(draw(key, salt), str(lo), str(hi))
    return (e6.cast("decimal(18,0)") * F.lit(Decimal("0.000001"))).cast("decimal(10,6)")


def int_between(h: Column, lo: int, hi: int) -> Column:
    """Integer uniform on lo..hi inclusive from a draw."""
    return (F.lit(lo) + F.pmod(h, F.lit(hi - lo + 1))).cast("int")


def weighted_category(h: Column, options: Sequence[tuple[str, float]]) -> Column:
    """Pick one label with the given weights (normalised to 1) from a draw."""
    cuts = weighted_cuts(options)
    expr = None
    for i, (label, cut) in enumerate(cuts):
        if i == len(cuts) - 1:
            expr = expr.otherwise(F.lit(label)) if expr is not None else F.lit(label)
            break
        expr = F.when(h < cut, F.lit(label)) if expr is None else expr.when(h < cut, F.lit(label))
    return expr


def weighted_cuts(options: Sequence[tuple[str, float]]) -> list[tuple[str, int]]:
    """Cut points used by ``weighted_category`` (the last label takes the remainder)."""
    total = sum(w for _, w in options)
    out, cum = [], 0.0
    for i, (label, w) in enumerate(options):
        cum += w
        out.append((label, BP if i == len(options) - 1 else int(round(cum / total * BP))))
    return out
