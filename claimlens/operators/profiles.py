"""Earlier rule profiles on the same line table: v5 (R13), v2 (R15) and the first script.

Each profile is its thresholds plus column expressions; features come from one
aggregate per key set (``features.group_features``).  Flags may be of any type.

FIXED VALUES: thresholds and reason names are output values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.operators.features import group_features
from claimlens.operators.shape import code_key, flag


def _i(c: Column) -> Column:
    return c.cast("int")


def _score(cols: list[str]) -> Column:
    return sum((F.col(c) for c in cols[1:]), F.col(cols[0])).cast("int")


def _reason(pairs: list[tuple[str, str]]) -> Column:
    expr = None
    for col, why in pairs:
        expr = F.when(F.col(col) == 1, why) if expr is None else expr.when(F.col(col) == 1, why)
    return expr.otherwise("no_rule")


# ----------------------------------------------------------------------------- v5

@dataclass(frozen=True)
class RulesV5:
    volume_threshold: int = 40
    price_ratio: float = 1.25
    egregious_ratio: float = 6.0


V5_RULES = ["rule_duplicate", "rule_provider_volume", "rule_egregious_billed", "rule_price_above_contract",
            "rule_external_edit", "rule_denied_repeat"]


def rules_v5(df: DataFrame, p: RulesV5 = RulesV5()) -> DataFrame:
    """Six rules on the v6 features; flag = score >= 2 only; the reason column stays the seeded one."""
    df = df.withColumns({
        "rule_duplicate": _i(F.col("duplicate_signature_count") > 1),
        "rule_provider_volume": _i(F.col("provider_day_claim_count") >= p.volume_threshold),
        "rule_egregious_billed": _i(F.col("billed_to_contract_ratio") >= p.egregious_ratio),
        "rule_price_above_contract": _i(F.col("contract_to_allowed_ratio") >= p.price_ratio),
        "rule_external_edit": flag(df, "external_edit_flag"),
        "rule_denied_repeat": _i((F.col("claim_status") == "denied")
                                 & F.col("provider_class").isin("medium_risk", "bad_actor")),
    })
    df = df.withColumn("rule_score", _score(V5_RULES))
    return df.withColumn("flagged_for_review", _i(F.col("rule_score") >= 2))


# ----------------------------------------------------------------------------- v2

@dataclass(frozen=True)
class RulesV2:
    volume_threshold: int = 20
    prof_units: int = 8
    inst_units: int = 12
    amount_ratio: float = 2.0
    billed_allowed: float = 1.55
    or_ratio: float = 1.8
    ed_ratio: float = 1.7


V2_RULES = ["rule_duplicate", "rule_excessive_units", "rule_provider_volume", "rule_high_amount_ratio",
            "rule_high_billed_allowed", "rule_suspicious_or", "rule_suspicious_ed"]
V2_REASONS = [
    ("rule_duplicate", "duplicate_signature"), ("rule_excessive_units", "excessive_units"),
    ("rule_suspicious_or", "high_or_cost"), ("rule_suspicious_ed", "high_ed_cost"),
    ("rule_high_amount_ratio", "high_code_cost_ratio"), ("rule_provider_volume", "high_provider_day_volume"),
    ("rule_high_billed_allowed", "high_billed_allowed_ratio"),
]


def _dollars(c: str) -> Column:
    return F.col(c).cast("double") / F.lit(100.0)


def features_v2(df: DataFrame) -> DataFrame:
    """G01-G04 v2 keys (code key: revenue code for institutional), G06 v2, G07."""
    df = df.withColumn("code_key", code_key(F.col("claim_family"), F.lit(None), F.col("revenue_code"), F.col("service_code"),
                                           with_pharmacy=False))
    sig = ["member_id", "provider_id", "service_date", "diagnosis_code", "service_code", "revenue_code", "allowed_amount"]
    df = group_features(df, [
        (sig, {"duplicate_signature_count": ("repeats", "")}),
        (["provider_id", "service_date"], {"provider_day_claim_count": ("count", "")}),
        (["provider_id"], {"provider_avg_allowed": ("cents", "allowed_amount"), "provider_fraud_rate": ("mean", "fraud_label")}),
        (["code_key"], {"code_avg_allowed": ("cents", "allowed_amount")}),
    ], few=("code_key",))
    return df.withColumns({
        "allowed_to_code_avg_ratio": _dollars("allowed_amount") / F.greatest(F.col("code_avg_allowed"), F.lit(1.0)),
        "billed_to_allowed_ratio": _dollars("billed_amount") / F.greatest(_dollars("allowed_amount"), F.lit(1.0)),
    })


def rules_v2(df: DataFrame, p: RulesV2 = RulesV2()) -> DataFrame:
    """Seven rules, score >= 2 predicts, own reason order."""
    fam, r = F.col("claim_family"), F.col("allowed_to_code_avg_ratio")
    df = df.withColumns({
        "rule_duplicate": _i(F.col("duplicate_signature_count") > 1),
        "rule_excessive_units": _i(((fam == "professional") & (F.col("units") >= p.prof_units))
                                   | ((fam == "institutional") & (F.col("units") >= p.inst_units))),
        "rule_provider_volume": _i(F.col("provider_day_claim_count") >= p.volume_threshold),
        "rule_high_amount_ratio": _i(r >= p.amount_ratio),
        "rule_high_billed_allowed": _i(F.col("billed_to_allowed_ratio") >= p.billed_allowed),
        "rule_suspicious_or": _i((F.col("revenue_code") == "0360") & (r >= p.or_ratio)),
        "rule_suspicious_ed": _i((F.col("revenue_code") == "0450") & (r >= p.ed_ratio)),
    })
    df = df.withColumn("rule_score", _score(V2_RULES))
    return df.withColumns({"rule_pred": _i(F.col("rule_score") >= 2), "rule_primary_reason": _reason(V2_REASONS)})


# ----------------------------------------------------------------------------- first script (fd)

@dataclass(frozen=True)
class RulesFD:
    volume_threshold: int = 25
    units: int = 8
    amount_ratio: float = 2.0
    billed_allowed: float = 1.5


FD_RULES = ["rule_duplicate", "rule_excessive_units", "rule_provider_volume", "rule_high_amount_ratio",
            "rule_high_billed_allowed"]


def features_fd(df: DataFrame) -> DataFrame:
    """G01-G04 with the first script's keys; G06 without floors."""
    sig = ["member_id", "provider_id", "service_date", "diagnosis_code", "service_code", "allowed_amount"]
    # regrouped: the random forest draws its rows by their place in this table
    df = group_features(df, [
        (sig, {"duplicate_signature_count": ("repeats", "")}),
        (["provider_id", "service_date"], {"provider_day_claim_count": ("count", "")}),
        (["provider_id"], {"provider_avg_allowed": ("cents", "allowed_amount")}),
        (["service_code"], {"procedure_avg_allowed": ("cents", "allowed_amount")}),
    ], few=("service_code",), regroup=True)
    return df.withColumns({
        "allowed_to_proc_avg_ratio": F.when(F.col("procedure_avg_allowed") > 0,
                                            _dollars("allowed_amount") / F.col("procedure_avg_allowed")),
        "billed_to_allowed_ratio": F.when(F.col("allowed_amount") > 0,
                                          _dollars("billed_amount") / _dollars("allowed_amount")),
    })


def rules_fd(df: DataFrame, p: RulesFD = RulesFD()) -> DataFrame:
    """Five rules; prediction = score >= 2."""
    df = df.withColumns({
        "rule_duplicate": _i(F.col("duplicate_signature_count") > 1),
        "rule_excessive_units": _i(F.col("units") >= p.units),
        "rule_provider_volume": _i(F.col("provider_day_claim_count") >= p.volume_threshold),
        "rule_high_amount_ratio": F.coalesce(_i(F.col("allowed_to_proc_avg_ratio") >= p.amount_ratio), F.lit(0)),
        "rule_high_billed_allowed": F.coalesce(_i(F.col("billed_to_allowed_ratio") >= p.billed_allowed), F.lit(0)),
    })
    df = df.withColumn("rule_score", _score(FD_RULES))
    return df.withColumn("rule_pred", _i(F.col("rule_score") >= 2))
