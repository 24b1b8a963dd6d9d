"""The canonical v6 line pipeline as one lazy DataFrame plan.

shape (K03) -> seed + edits + re-adjudicate (F08) -> features (G01-G05)
-> rules (R01-R12) -> line id and fixed projection (P15, P20).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions.draws import line_id
from claimlens.functions.money import int_div
from claimlens.operators.edits import adjudicate, external_edit, mue_like_edit
from claimlens.operators.features import contract_ratios, features_v6, group_features_v6, with_chunk_id
from claimlens.operators.rules import SIGNALS, RulesV6, TEST_RULES, apply_rules_v6
from claimlens.operators.seed import COPY_STEP, SEEDED_REASONS, SeedParams, seed_all_v6, seed_and_edit
from claimlens.operators.shape import (_case, _pick, catalogue_columns, claim_family, claims_from_star, class_from_key, diagnosis_code,
                                       encounter_columns, member_columns, provider_columns, service_catalog_df, specialty_from_key)
from claimlens.session import code_cut, stage_table
from claimlens.sources import catalogs as C
from claimlens.sources.tables import star_tables

# 68 output columns, in order; money and rates leave the engine as DOUBLE.
V6_COLUMNS = [
    ("line_id", "string"), ("episode_id", "string"), ("encounter_id", "string"), ("parent_encounter_id", "string"),
    ("linked_facility_claim", "int"), ("member_id", "string"), ("provider_id", "string"),
    ("provider_specialty", "string"), ("provider_class", "string"), ("provider_fraud_propensity", "double"),
    ("service_date", "date"), ("claim_family", "string"), ("encounter_type", "string"),
    ("place_of_service", "string"), ("revenue_code", "string"), ("diagnosis_code", "string"),
    ("service_code", "string"), ("drug_name", "string"), ("drug_type", "string"), ("ndc", "string"),
    ("days_supply", "double"), ("claim_line_no", "int"), ("units", "int"), ("member_age", "int"),
    ("member_gender", "string"), ("chronic_score", "int"), ("plan_type", "string"),
    ("annual_deductible", "double"), ("deductible_remaining_start", "double"), ("coinsurance_rate", "double"),
    ("allowed_amount", "double"), ("contract_rate", "double"), ("billed_amount", "double"),
    ("applied_to_deductible", "double"), ("coinsurance_amount", "double"), ("paid_amount", "double"),
    ("claim_status", "string"), ("denial_reason", "string"), ("payment_type", "string"),
    ("contract_discount_rate", "double"), ("ncci_like_edit_flag", "int"), ("mue_like_edit_flag", "int"),
    ("external_edit_flag", "int"), ("duplicate_signature_count", "bigint"), ("provider_day_claim_count", "bigint"),
    ("provider_avg_contract_rate", "double"), ("service_code_avg_contract_rate", "double"),
    ("billed_to_contract_ratio", "double"), ("contract_to_allowed_ratio", "double"),
    ("rule_duplicate", "int"), ("rule_provider_volume", "int"), ("rule_egregious_billed", "int"),
    ("rule_price_above_contract", "int"), ("rule_external_edit", "int"), ("rule_denied_repeat", "int"),
    ("rule_upcoding_pattern", "int"), ("rule_member_submit_outlier", "int"),
    ("strong_rule_hit", "int"), ("rule_score", "int"), ("flagged_for_review", "int"),
    ("pricing_error_signal", "int"), ("egregious_charge_signal", "int"), ("upcoding_signal", "int"),
    ("member_submit_outlier_signal", "int"), ("fraud_label", "int"), ("fraud_type", "string"),
    ("rule_primary_reason", "string"), ("rule_primary_reason_detected", "string"),
]

# v5 keeps 60 of them: no strong hit, signals or detected reason, and six of the eight rules.
V5_DROP = {"strong_rule_hit", "pricing_error_signal", "egregious_charge_signal", "upcoding_signal",
           "member_submit_outlier_signal", "rule_primary_reason_detected", "rule_upcoding_pattern",
           "rule_member_submit_outlier"}


@dataclass(frozen=True)
class V6Config:
    seed: SeedParams = field(default_factory=SeedParams)
    rules: RulesV6 = field(default_factory=RulesV6)
    scope: str = "global"          # G08: "global" or "chunk"
    chunk_size: int = 100_000      # encounters per chunk when scope == "chunk"


# The configuration the registered queries use on the small test tables:
# propensity and duplicate rate x5, volume threshold 3, upcoding ratio 1.0.
TEST_CONFIG = V6Config(seed=SeedParams(propensity_mult=5), rules=TEST_RULES)


def shaped_lines(spark: SparkSession, sf_dir: str, cut: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    return claims_from_star(spark, star_tables(spark, sf_dir), cut=cut)


def seeded_lines(spark: SparkSession, sf_dir: str, cfg: V6Config = TEST_CONFIG) -> DataFrame:
    return seed_all_v6(shaped_lines(spark, sf_dir), cfg.seed)


#: What the features, the rules and the line id read of the seeded lines.
SCORED_FROM = [
    "enc_key", "claim_line_no", "member_id", "provider_id", "provider_class", "service_date", "claim_family", "service_code",
    "allowed_amount", "contract_rate", "billed_amount", "claim_status", "external_edit_flag", "pricing_error_signal",
    "egregious_charge_signal", "upcoding_signal", "member_submit_outlier_signal",
]


def scored_lines(spark: SparkSession, sf_dir: str, cfg: V6Config = TEST_CONFIG, stage: bool = True,
                 columns: Iterable[str] | None = None) -> DataFrame:
    """Internal line table after rules: money in cents, internal keys kept.

    With ``stage=True`` the seeded table is written once (parquet, shared
    checkpoint folder) before the features: the feature aggregates and the join
    back then read it instead of re-running shaping and seeding per consumer.
    With ``columns`` the result has at least those; other seeded columns may be left out.
    """
    df = materialized_seeded(spark, sf_dir, cfg, columns) if stage else seeded_lines(spark, sf_dir, cfg)
    if cfg.scope == "chunk":
        df = with_chunk_id(df, cfg.chunk_size)
    df = features_v6(df, scope=cfg.scope)
    df = apply_rules_v6(df, cfg.rules)
    return df.withColumn("line_id", line_id())


_MATERIALIZED: dict[tuple, DataFrame] = {}
_SEEDED: dict[tuple, DataFrame] = {}
_SOME_COLUMNS: dict[tuple, tuple[frozenset[str], DataFrame]] = {}


def materialized_seeded(spark: SparkSession, sf_dir: str, cfg: V6Config = TEST_CONFIG,
                        columns: Iterable[str] | None = None) -> DataFrame:
    """The seeded, edited and adjudicated lines, written once per session (parquet, shared folder).

    With ``columns``, and no whole table written yet: those columns and the ones that scoring reads, written for the caller.
    """
    key = (spark.sparkContext.applicationId, sf_dir, cfg.seed)
    if key not in _SEEDED:
        df = seeded_lines(spark, sf_dir, cfg)
        if columns is not None:
            wanted = {*SCORED_FROM, *columns}
            return stage_table(df.select(*[c for c in df.columns if c in wanted]), "seeded-columns")
        _SEEDED[key] = stage_table(df.drop("member_key", *[c for c in df.columns if c.startswith("_md5_")]), "seeded")
    return _SEEDED[key]


def materialized_lines(spark: SparkSession, sf_dir: str, cfg: V6Config = TEST_CONFIG) -> DataFrame:
    """The scored line table, computed once per session and cut from its lineage.

    Summaries read the line table many times; recomputing the whole pipeline per
    read would multiply the shuffles.  ``checkpoint()`` writes it to the shared
    ``spark.checkpoint.dir`` (reliable: a lost executor does not lose it).
    """
    key = (spark.sparkContext.applicationId, sf_dir, cfg)
    if key not in _MATERIALIZED:
        _MATERIALIZED[key] = stage_table(scored_lines(spark, sf_dir, cfg), "scored")
    return _MATERIALIZED[key]


def lines_with(spark: SparkSession, sf_dir: str, columns: Iterable[str], cfg: V6Config = TEST_CONFIG) -> DataFrame:
    """The scored lines with at least ``columns`` (those that exist): every line and every step, but no column unasked for.

    The lines are exchanged, sorted and written several times, and a query reads a few of their 68 columns.  The first
    query of a session moves its own columns only; one that asks for others builds the whole table, which all later
    ones share.
    """
    key = (spark.sparkContext.applicationId, sf_dir, cfg)
    if key in _MATERIALIZED:
        return _MATERIALIZED[key]
    if key not in _SOME_COLUMNS:
        wanted = frozenset(columns)
        df = scored_lines(spark, sf_dir, cfg, columns=wanted)
        _SOME_COLUMNS[key] = wanted, stage_table(df.select(*[c for c in df.columns if c in wanted]), "scored-columns")
    held, lines = _SOME_COLUMNS[key]
    return lines if held.issuperset(columns) else materialized_lines(spark, sf_dir, cfg)


# ----------------------------------------------------------------------------- lines in compact form

#: What the compact form keeps of the seeded lines.
COMPACT = [
    "enc_key", "claim_line_no", "is_seeded_copy", "member_key", "provider_key", "l_partkey", "service_date", "qty", "labels",
    "linked_facility_claim", "service_code", "upcoded_from", "units", "allowed_amount", "contract_rate", "billed_amount",
    "ncci_like_edit_flag", *[f"{s}_signal" for s in SIGNALS],
]
#: Columns with few values, all from lists of the library's own: together the digits of one number, ``labels``.
LABELS = {
    "plan_type": sorted({*C.PLAN_BY_SEGMENT.values(), C.PLAN_OTHER}),
    "etype0": ["ed_facility", "inpatient_facility", "pharmacy", "admin", "member_submitted", "professional"],
    "denial_reason": ["", *C.DENIAL_REASONS],
    "payment_type": [name for name, _ in C.PAYMENT_TYPES],
    "fraud_type": list(SEEDED_REASONS),
}
#: The provider's key of lines that have none: they are one provider, as their id is one.
NO_KEY = -(1 << 63)


def fold_labels() -> Column:
    """One number for the ``LABELS`` columns of a line."""
    out, step = F.lit(0), 1
    for name, values in LABELS.items():
        out, step = out + _case(F.col(name), {v: i * step for i, v in enumerate(values)}, None), step * len(values)
    return out


def unfold_labels() -> dict[str, Column]:
    """The ``LABELS`` columns from their number."""
    out, step = {}, 1
    for name, values in LABELS.items():
        out[name], step = _pick(values, F.pmod(int_div(F.col("labels"), step), F.lit(len(values)))), step * len(values)
    return out


def compact_lines(spark: SparkSession, sf_dir: str, cfg: V6Config = TEST_CONFIG) -> DataFrame:
    """The seeded and edited lines without what follows from the rest of the line, a third of their bytes."""
    df = shaped_lines(spark, sf_dir, code_cut).withColumn("_code", F.col("service_code"))
    df = seed_and_edit(df, cfg.seed, code_cut).withColumns({
        "labels": fold_labels(), "provider_key": F.coalesce("l_suppkey", F.lit(NO_KEY)),
        "upcoded_from": F.when(F.col("service_code") != F.col("_code"), F.col("_code"))})
    return df.select(*COMPACT)


def featured_lines(spark: SparkSession, sf_dir: str, cfg: V6Config = TEST_CONFIG) -> DataFrame:
    """The compact lines, written once, with their features over all lines (G01-G04): what is exchanged is narrow."""
    return group_features_v6(stage_table(compact_lines(spark, sf_dir, cfg), "compact"), member="member_key", provider="provider_key")


def unfold(spark: SparkSession, df: DataFrame, cfg: V6Config = TEST_CONFIG) -> DataFrame:
    """The whole scored lines from compact ones with their features: ids, member, provider, encounter, catalogue row, A01, G05, rules.

    Every step is on the line by itself, so the rows keep their partitions and order.
    """
    k, etype0, family = F.col("l_suppkey"), F.col("etype0"), F.col("claim_family")
    df = df.withColumns(unfold_labels()).drop("labels").withColumns({
        "l_suppkey": F.when(F.col("provider_key") != NO_KEY, F.col("provider_key")),
        "claim_family": claim_family(etype0),
        "claim_status": F.when(F.col("denial_reason") == "", "paid").otherwise("denied"),
        "_code": F.coalesce("upcoded_from", "service_code"),
        "fraud_label": (F.col("fraud_type") != "none").cast("int"),
        "rule_primary_reason": _case(F.col("fraud_type"), SEEDED_REASONS, None),
    }).withColumns(provider_columns(k, specialty_from_key(k), class_from_key(k)))
    cat = F.broadcast(service_catalog_df(spark))
    df = df.join(cat, F.col("_code") == cat.code, "left").drop("code")
    df = external_edit(mue_like_edit(df)).withColumns(catalogue_columns(family, etype0, F.col("_code"), F.col("qty")))
    df = code_cut(df.drop("_code", "upcoded_from", "provider_key", "base_cents", "mue_limit", *[c for c in cat.columns if c.startswith("cat_")]))
    df = code_cut(apply_rules_v6(contract_ratios(df), cfg.rules))
    df = code_cut(df.withColumns(member_columns(F.col("member_key"), F.col("plan_type"))))
    df = code_cut(adjudicate(df))
    own_no = F.col("claim_line_no") - COPY_STEP * F.col("is_seeded_copy")
    df = df.withColumns(encounter_columns(F.col("linked_facility_claim") == 1, etype0, F.col("provider_specialty"), F.col("enc_key"), own_no))
    return df.withColumns({"diagnosis_code": diagnosis_code(F.col("l_partkey")), "line_id": line_id()})


def whole_lines(spark: SparkSession, sf_dir: str, cfg: V6Config = TEST_CONFIG) -> DataFrame:
    """All columns of the scored lines for one reader: those of the session if it has them, else unfolded and not written."""
    key = (spark.sparkContext.applicationId, sf_dir, cfg)
    return _MATERIALIZED[key] if key in _MATERIALIZED else unfold(spark, featured_lines(spark, sf_dir, cfg), cfg)


# Internal fixed-point columns: amounts in cents, rates in 1e-2.
CENTS_COLUMNS = {"annual_deductible", "deductible_remaining_start", "allowed_amount", "contract_rate",
                 "billed_amount", "applied_to_deductible", "coinsurance_amount", "paid_amount"}
E2_COLUMNS = {"coinsurance_rate", "contract_discount_rate"}


def output_value(df: DataFrame, c: str, t: str):
    """A column in its output form: cents and 1e-2 rates become DOUBLE; others cast to ``t``."""
    if c not in df.columns:
        return F.lit(None).cast(t).alias(c)
    if c in CENTS_COLUMNS or c in E2_COLUMNS:
        return (F.col(c).cast("double") / F.lit(100.0)).alias(c)
    return F.col(c).cast(t).alias(c)


def final_projection(df: DataFrame, columns=V6_COLUMNS, drop=()) -> DataFrame:
    """P20: fixed column order and types; absent columns become typed nulls."""
    return df.select([output_value(df, c, t) for c, t in columns if c not in drop])


def v6_lines(spark: SparkSession, sf_dir: str, cfg: V6Config = TEST_CONFIG) -> DataFrame:
    """The 68-column v6 line table."""
    return final_projection(scored_lines(spark, sf_dir, cfg))
