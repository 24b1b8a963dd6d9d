"""Detection features.

Counts and means over hot keys (a provider may hold a large share of all lines)
are computed as hash aggregates -- map-side partial aggregation makes a hot key
cheap -- and joined back.  Signatures are nearly unique, so only those that occur
more than once are kept and joined; tables with few keys (codes) are counted and
broadcast.  Other joins stay plain equi joins: AQE turns them into broadcast joins
when the aggregate is measured small at run time, and splits skewed partitions of
the line side when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.money import int_div, mean_double, ratio4
from claimlens.functions.scalar import join_groups
from claimlens.session import stage_table

V6_SIGNATURE = ["member_id", "provider_id", "service_date", "service_code", "contract_rate"]

#: Rows of a table of repeated signatures, or of one figure a provider, up to which it is broadcast: some 100 MB.  Beyond, the
#: lines or the provider's days are exchanged once more for it.
NARROW_ROWS = 1_000_000


def _scope(keys: list[str], scope: str) -> list[str]:
    """Features inside each chunk add the chunk id to every key."""
    return (["chunk_id"] + keys) if scope == "chunk" else keys


def with_chunk_id(df: DataFrame, chunk_size: int, key: str = "enc_key") -> DataFrame:
    """chunk id = encounter ordinal div chunk size."""
    return df.withColumn("chunk_id", int_div(F.col(key), chunk_size))


def contract_ratios(df: DataFrame) -> DataFrame:
    """billed/max(contract,1), contract/max(allowed,1), provider/code mean ratio, each to 4 places."""
    pc = F.col("provider_avg_contract_rate") / F.greatest(F.col("service_code_avg_contract_rate"), F.lit(1.0))
    return df.withColumns({
        "billed_to_contract_ratio": ratio4(F.col("billed_amount"), F.col("contract_rate")),
        "contract_to_allowed_ratio": ratio4(F.col("contract_rate"), F.col("allowed_amount")),
        "provider_to_code_ratio": F.round(pc, 4),
    })


def duplicate_counts(df: DataFrame, signature: list[str], name: str) -> DataFrame:
    """Rows with the same signature.

    Most signatures occur once, and their lines need no partner: only repeated signatures are kept, written once and
    joined (broadcast if they are few), instead of a table as large as the lines.
    """
    repeated = df.groupBy(*signature).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)
    out = join_groups(df, stage_table(repeated, "signatures"), signature, "left", NARROW_ROWS)
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(1).cast("bigint")))


def group_features(df: DataFrame, specs: list[tuple[list[str], dict[str, tuple[str, str]]]], few: tuple[str, ...] = (),
                   regroup: bool = False) -> DataFrame:
    """Counts and means over several key sets, joined back on the keys.

    ``specs``: (keys, {output name: (kind, column)}), kind ``repeats`` (a signature's count, alone in its set),
    ``count``, ``cents`` (mean of a cents column, as an amount) or ``mean``.  Each key set is aggregated once, map-side
    first.  A key set that is part of a larger one (the provider in the provider's day) is joined to that one's groups, so
    the lines are joined once for both and never meet a table keyed by a hot provider alone.  Its table is written and
    counted: broadcast to the larger set's groups, these are exchanged once, as the lines need them.  Sets of the keys
    named in ``few`` have few groups: their table is written, counted and broadcast.  ``regroup`` sums the part's figures
    from the larger set's groups and leaves both joins to the planner: the same figures, but another order of the rows.
    """
    out = df
    for keys, outputs in specs:
        for name, (kind, _) in outputs.items():
            if kind == "repeats":
                out = duplicate_counts(out, keys, name)
    specs = [(k, o) for k, o in specs if all(kind != "repeats" for kind, _ in o.values())]
    sets = [k for k, _ in specs]
    within = {tuple(k): next((o for o in sets if set(k) < set(o) and len(o) == len(k) + 1), k) for k in sets}
    for keys in (k for k in sets if within[tuple(k)] == k):
        inside = [(k, o) for k, o in specs if within[tuple(k)] == keys]
        joined = table = _sums(df, keys, [c for k, o in inside if regroup or k == keys for _, c in o.values() if c])
        for k, outputs in inside:
            if k == keys:
                joined = joined.withColumns({name: _figure(kind, c) for name, (kind, c) in outputs.items()})
            else:
                columns = [c for _, c in outputs.values() if c]
                coarse = _sums(df, k, columns) if not regroup else table.groupBy(*k).agg(
                    F.sum("_n").alias("_n"), *[F.sum(f"_sum_{c}").alias(f"_sum_{c}") for c in dict.fromkeys(columns)])
                coarse = coarse.select(*k, *[_figure(kind, c).alias(name) for name, (kind, c) in outputs.items()])
                joined = joined.join(coarse, k) if regroup else join_groups(joined, stage_table(coarse, "coarse-keys"), k, rows=NARROW_ROWS)
        names = [name for _, o in inside for name in o]
        if few and set(few) & set(keys):
            out = join_groups(out, stage_table(joined.select(*keys, *names), "few-keys"), keys, "left")
        else:
            out = out.join(joined.select(*keys, *names), keys, "left")
    return out


def _sums(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in dict.fromkeys(columns)])


def _figure(kind: str, column: str) -> Column:
    if kind == "count":
        return F.col("_n")
    if kind == "cents":
        return mean_double(F.col(f"_sum_{column}"), F.col("_n"))
    return F.col(f"_sum_{column}").cast("double") / F.col("_n").cast("double")


def features_v6(df: DataFrame, scope: str = "global") -> DataFrame:
    """G01-G05 for the v6 profile."""
    return contract_ratios(group_features_v6(df, scope))


def group_features_v6(df: DataFrame, scope: str = "global", member: str = "member_id", provider: str = "provider_id") -> DataFrame:
    """G01-G04 for the v6 profile: signature, provider-day with the provider's mean, and service code.

    ``member`` and ``provider``: the columns that tell these apart, ids or the keys behind them.
    """
    signature = [{"member_id": member, "provider_id": provider}.get(c, c) for c in V6_SIGNATURE]
    return group_features(df, [
        (_scope(signature, scope), {"duplicate_signature_count": ("repeats", "")}),
        (_scope([provider, "service_date"], scope), {"provider_day_claim_count": ("count", "")}),
        (_scope([provider], scope), {"provider_avg_contract_rate": ("cents", "contract_rate")}),
        (_scope(["service_code"], scope), {"service_code_avg_contract_rate": ("cents", "contract_rate")}),
    ], few=("service_code",))


def allowed_ratios(billed: Column, allowed: Column, profile: str) -> Column:
    """billed/allowed -- fd no floor; v2 floor 1; v3 floor 1 and 0 when allowed = 0."""
    if profile == "fd":
        return F.when(allowed > 0, ratio4(billed, allowed, floor_cents=None))
    r = ratio4(billed, allowed)
    if profile == "v3":
        return F.when(allowed == 0, F.lit(0.0)).otherwise(r)
    return r
