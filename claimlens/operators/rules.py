"""Rules, scores, review flags and reasons.

A rule profile is a frozen object holding thresholds; the rule functions are
column expressions, so a whole profile evaluates in one projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.operators.shape import flag
from claimlens.sources import catalogs as C

RISKY = ("medium_risk", "bad_actor")


@dataclass(frozen=True)
class RulesV6:
    volume_threshold: int = 30          # R02 (v5: 40)
    egregious_ratio: float = 6.0        # R03
    price_ratio: float = 1.15           # R04 (v5: 1.25)
    upcoding_ratio: float = 1.20        # R07
    member_ratio: float = 2.5           # R08
    score_threshold: int = 2            # R11


# Thresholds that can fire on the small test tables.
TEST_RULES = RulesV6(volume_threshold=3, upcoding_ratio=1.0)

V6_RULES = [
    "rule_duplicate", "rule_provider_volume", "rule_egregious_billed", "rule_price_above_contract",
    "rule_external_edit", "rule_denied_repeat", "rule_upcoding_pattern", "rule_member_submit_outlier",
]

# Priority order of the detected reason (first true wins); else "no_rule".
V6_REASONS = [
    ("rule_duplicate", "duplicate_signature"),
    ("rule_egregious_billed", "egregious_billed_charge"),
    ("rule_price_above_contract", "price_above_contract"),
    ("rule_external_edit", "external_edit"),
    ("rule_upcoding_pattern", "upcoding_pattern"),
    ("rule_member_submit_outlier", "outlier_member_submit"),
    ("rule_provider_volume", "provider_volume_outlier"),
    ("rule_denied_repeat", "denied_repeat_pattern"),
]


SIGNALS = ("pricing_error", "egregious_charge", "upcoding", "member_submit_outlier")


def _i(c: Column) -> Column:
    return c.cast("int")


def rule_duplicate(df: DataFrame) -> Column:
    return _i(F.col("duplicate_signature_count") > 1)                                   # R01


def rule_provider_volume(t: int) -> Column:
    return _i(F.col("provider_day_claim_count") >= t)                                   # R02


def rule_egregious_billed(t: float) -> Column:
    return _i(F.col("billed_to_contract_ratio") >= t)                                   # R03


def rule_price_above_contract(t: float) -> Column:
    return _i(F.col("contract_to_allowed_ratio") >= t)                                  # R04


def rule_denied_repeat() -> Column:
    return _i((F.col("claim_status") == "denied") & F.col("provider_class").isin(*RISKY))  # R06


def rule_upcoding_pattern(df: DataFrame, t: float) -> Column:                           # R07
    pattern = F.col("service_code").isin(*C.TOP_LEVEL_CODES) & (F.col("provider_to_code_ratio") >= t)
    return _i((flag(df, "upcoding_signal") == 1) | pattern)


def rule_member_submit_outlier(df: DataFrame, t: float) -> Column:                      # R08
    pattern = (F.col("claim_family") == "member_submitted") & (F.col("billed_to_contract_ratio") >= t)
    return _i((flag(df, "member_submit_outlier_signal") == 1) | pattern)


def primary_reason(pairs=V6_REASONS, default: str = "no_rule") -> Column:
    """First rule that fired, in priority order."""
    expr = None
    for col, reason in pairs:
        cond = F.col(col) == 1
        expr = F.when(cond, reason) if expr is None else expr.when(cond, reason)
    return expr.otherwise(default)


def apply_rules_v6(df: DataFrame, p: RulesV6 = RulesV6()) -> DataFrame:
    """R01-R12 on a featured line table."""
    df = df.withColumns({
        "rule_duplicate": rule_duplicate(df),
        "rule_provider_volume": rule_provider_volume(p.volume_threshold),
        "rule_egregious_billed": rule_egregious_billed(p.egregious_ratio),
        "rule_price_above_contract": rule_price_above_contract(p.price_ratio),
        "rule_external_edit": flag(df, "external_edit_flag"),                                   # R05
        "rule_denied_repeat": rule_denied_repeat(),
        "rule_upcoding_pattern": rule_upcoding_pattern(df, p.upcoding_ratio),
        "rule_member_submit_outlier": rule_member_submit_outlier(df, p.member_ratio),
    })
    strong = F.greatest(F.col("rule_duplicate"), *[flag(df, f"{s}_signal") for s in SIGNALS])    # R09
    score = sum((F.col(c) for c in V6_RULES[1:]), F.col(V6_RULES[0]))                          # R10
    df = df.withColumns({"strong_rule_hit": strong.cast("int"), "rule_score": score.cast("int")})
    secondary = (((F.col("rule_egregious_billed") == 1) & F.col("provider_class").isin(*RISKY))
                 | ((F.col("rule_external_edit") == 1) & (F.col("claim_family") == "institutional")
                    & (F.col("provider_class") != "clean")))
    flagged = (F.col("rule_score") >= p.score_threshold) | (F.col("strong_rule_hit") >= 1) | secondary   # R11
    return df.withColumns({
        "flagged_for_review": flagged.cast("int"),
        "rule_primary_reason_detected": primary_reason(),
    })


def review_queue(df: DataFrame) -> DataFrame:
    """Flagged lines with reason and score, most suspicious first."""
    return (df.filter(F.col("flagged_for_review") == 1)
            .select("line_id", "encounter_id", "provider_id", "member_id", "service_date", "claim_family",
                    "service_code", "rule_score", "rule_primary_reason_detected", "fraud_type",
                    "billed_amount", "contract_rate")
            .orderBy(F.col("rule_score").desc(), F.col("billed_amount").desc(), F.col("line_id")))
