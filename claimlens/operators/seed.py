"""Labelled-anomaly seeding (F01-F08, v6 profile).

Every step is a column expression over the previous step's columns, so the whole
chain collapses into one projection inside whole-stage codegen.  Copies (F07)
are made with ``explode`` of a one- or two-element array in the same pass, so the
upstream plan is never scanned twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.draws import int_between, line_draw, uniform_e6
from claimlens.functions.money import scale
from claimlens.operators.edits import adjudicate, apply_edits
from claimlens.sources import catalogs as C

# The catalogue's propensities in units of a draw (1/10000).
CLASS_PROPENSITY_BP = {cls: round(p * 10000) for cls, p in C.CLASS_PROPENSITY.items()}
PROPENSITY_DEFAULT_BP = round(C.PROPENSITY_DEFAULT * 10000)

#: Added to the line number of a copy.
COPY_STEP = 100


@dataclass(frozen=True)
class SeedParams:
    propensity_mult: int = 1      # scales every provider's propensity
    pricing_bp: int = 2000        # F02 p .20
    egregious_bp: int = 1600      # F03 p .16
    units_bp: int = 1800          # F04 p .18
    upcode_bp: int = 1600         # F05 p .16
    member_bp: int = 2000         # F06 p .20
    dup_bp: int = 30              # F07 p .003 (scaled by propensity_mult)


def fraud_draw(df: DataFrame | None, params: SeedParams) -> Column:
    """candidate when the line draw falls below the provider's propensity."""
    thr = F.lit(PROPENSITY_DEFAULT_BP)
    expr = None
    for cls, bp in CLASS_PROPENSITY_BP.items():
        expr = (F.when(F.col("provider_class") == cls, F.lit(bp)) if expr is None
                else expr.when(F.col("provider_class") == cls, F.lit(bp)))
    thr = expr.otherwise(thr) * params.propensity_mult
    return line_draw("fraud") < thr


def seed_duplicates(df: DataFrame, p: SeedParams) -> DataFrame:
    """copy medium_risk / bad_actor lines (p .003, not limited to candidates).

    The copy gets line number + 100 and the duplicate label; signals and edits are
    carried as they are.  One pass: explode [0] or [0, 1].
    """
    m = F.col("provider_class").isin("medium_risk", "bad_actor") & (
        line_draw("dup") < p.dup_bp * p.propensity_mult)
    df = df.withColumn("_copy", F.explode(F.when(m, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    c = F.col("_copy") == 1
    df = df.withColumns({
        "claim_line_no": F.when(c, F.col("claim_line_no") + COPY_STEP).otherwise(F.col("claim_line_no")),
        "fraud_label": F.when(c, F.lit(1)).otherwise(F.col("fraud_label")),
        "fraud_type": F.when(c, F.lit("duplicate_billing")).otherwise(F.col("fraud_type")),
        "rule_primary_reason": F.when(c, F.lit(SEEDED_REASONS["duplicate_billing"])).otherwise(F.col("rule_primary_reason")),
        "is_seeded_copy": F.col("_copy"),
    })
    return df.drop("_copy")


def seed_masks(params: SeedParams) -> dict[str, Column]:
    """F01 candidates and the F02-F06 masks, computed from the columns as they were before seeding."""
    cand = fraud_draw(None, params)
    fam, code = F.col("claim_family"), F.col("service_code")
    return {
        "_m1": cand & (line_draw("pricing") < params.pricing_bp),
        "_m2": cand & fam.isin("institutional", "professional") & (line_draw("egregious") < params.egregious_bp),
        "_m3": cand & F.col("mue_limit").isNotNull() & (line_draw("units") < params.units_bp),
        "_m4": cand & code.isin(*C.UPCODE_MAP) & (line_draw("upcode") < params.upcode_bp),
        "_m5": cand & (fam == "member_submitted") & (line_draw("member") < params.member_bp),
    }


def seed_expressions() -> tuple[dict[str, Column], dict[str, Column]]:
    """F02-F06 effects and labels as column expressions over the shaped columns and the masks
    (``seed_masks``), to be applied one after the other: F02's and F05's, then the rest.

    Masks read the columns as they were before seeding, effects read the earlier
    steps' results (F03 bills on F02's contract, F06 on F05's allowed), and the
    label, type and reason follow last-write-wins in step order.
    """
    code = F.col("service_code")
    m1, m2, m3, m4, m5 = (F.col(f"_m{i}") for i in range(1, 6))
    contract = F.when(m1, scale(F.col("contract_rate"), uniform_e6(line_draw("pricing_amt"), "1.15", "1.85"), 1_000_000)) \
        .otherwise(F.col("contract_rate"))
    billed = F.when(m2, scale(F.col("contract_rate"), uniform_e6(line_draw("egregious_amt"), "6", "18"), 1_000_000)) \
        .otherwise(F.col("billed_amount"))
    units = F.when(m3, F.col("mue_limit") + int_between(line_draw("units_amt"), 2, 7)).otherwise(F.col("units"))
    new_code = F.element_at(F.create_map(*[F.lit(x) for kv in C.UPCODE_MAP.items() for x in kv]), code)
    bases = {row[0]: C.cents(row[2]) for row in C.PROCEDURES}
    new_base = F.element_at(F.create_map(*[F.lit(x) for old, new in C.UPCODE_MAP.items() for x in (old, bases[new])]), code)
    allowed = F.when(m4, scale(new_base, uniform_e6(line_draw("upcode_amt"), "0.95", "1.20"), 1_000_000)) \
        .otherwise(F.col("allowed_amount"))
    billed = F.when(m5, scale(F.col("allowed_amount"), uniform_e6(line_draw("member_amt"), "3", "10"), 1_000_000)).otherwise(billed)
    steps = [(m5, "member_reimbursement_abuse"), (m4, "upcoding"), (m3, "excessive_units"), (m2, "egregious_billing"), (m1, "pricing_error")]
    ftype, reason = None, None
    for m, t in steps:
        r = SEEDED_REASONS[t]
        ftype = F.when(m, F.lit(t)) if ftype is None else ftype.when(m, F.lit(t))
        reason = F.when(m, F.lit(r)) if reason is None else reason.when(m, F.lit(r))
    return {"contract_rate": contract, "allowed_amount": allowed}, {
        "billed_amount": billed, "units": units.cast("int"),
        "service_code": F.when(m4, new_code).otherwise(code),
        "fraud_label": (m1 | m2 | m3 | m4 | m5).cast("int"),
        "fraud_type": ftype.otherwise(F.lit("none")), "rule_primary_reason": reason.otherwise(F.lit("none")),
        "pricing_error_signal": m1.cast("int"), "egregious_charge_signal": m2.cast("int"),
        "upcoding_signal": m4.cast("int"), "member_submit_outlier_signal": m5.cast("int"),
    }


#: The reason that goes with each seeded type.
SEEDED_REASONS = {"member_reimbursement_abuse": "outlier_member_submit", "upcoding": "level_shift", "excessive_units": "mue_like_units",
                  "egregious_billing": "egregious_billed_charge", "pricing_error": "price_above_contract",
                  "duplicate_billing": "duplicate_signature", "none": "none"}


def seed_all_v6(df: DataFrame, params: SeedParams = SeedParams()) -> DataFrame:
    """F02 -> F06 (one projection), coding edits X01-X03, F07 copies, then A01 re-adjudication."""
    return adjudicate(seed_and_edit(df, params))


def seed_and_edit(df: DataFrame, params: SeedParams = SeedParams(), cut: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """F08 up to the copies; ``cut`` goes between its steps."""
    masks = seed_masks(params)
    df = cut(df.select("*", *[e.alias(n) for n, e in masks.items()]))
    for effects in seed_expressions():
        df = cut(df.withColumns(effects))
    df = apply_edits(df.drop(*masks))
    return seed_duplicates(df, params)
