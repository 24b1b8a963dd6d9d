"""DuckDB oracle for the v3 profile, built on the shaped-line CTEs."""

from __future__ import annotations

from claimlens.functions.draws import weighted_cuts
from claimlens.plans.v3 import V3_MODES, V3_RULE_PRIORITY
from oracle.v6_sql import h, money, q, shaped_ctes, unif


def _t(col: str, salt: str, lo: str, hi: str) -> str:
    return money(f"{col} * {unif('line_key', salt, lo, hi)}")


def v3_ctes(mult: int = 5) -> str:
    cuts = weighted_cuts(V3_MODES)
    mode_case = "CASE " + " ".join(f"WHEN {h('line_key', 'v3_mode')} < {c} THEN {q(m)}" for m, c in cuts[:-1]) \
        + f" ELSE {q(cuts[-1][0])} END"
    reason = "CASE " + " ".join(f"WHEN {r} = 1 THEN {q(w)}" for r, w in V3_RULE_PRIORITY) + " ELSE 'no_rule' END"
    return "WITH " + shaped_ctes() + f""",
b0 AS (
  SELECT * REPLACE (
      CASE WHEN etype0 IN ('inpatient_facility', 'ed_facility') THEN 'institutional' WHEN etype0 = 'pharmacy' THEN 'pharmacy'
           WHEN etype0 = 'admin' THEN 'administrative' ELSE 'professional' END AS claim_family,
      etype0 AS encounter_type),
    CASE WHEN claim_status = 'denied' THEN 1 ELSE 0 END AS denied_flag
  FROM shaped2
),
b1 AS (
  SELECT *,
    CASE WHEN denied_flag = 1 THEN 0 ELSE {_t('allowed_amount', 'v3_paid', '0.80', '1.00')} END AS paid_amount,
    CASE WHEN claim_family = 'professional' AND service_code IN ('36415', '80048', '80053', '85025') AND claim_line_no > 1
         THEN 'NCCI_PTP_LIKE'
         WHEN (claim_family = 'professional' AND units >= 8) OR (claim_family = 'institutional' AND units >= 20)
           OR (claim_family = 'pharmacy' AND units >= 90) THEN 'MUE_LIKE' ELSE 'none' END AS coding_edit_type,
    CASE WHEN encounter_type = 'member_submitted' THEN 'manual_reprice' WHEN claim_family = 'pharmacy' THEN 'ingredient_plus_fee'
         WHEN claim_family = 'administrative' THEN 'administrative' ELSE 'contract_rate' END AS price_method0,
    CASE WHEN encounter_type = 'member_submitted' THEN 'member_portal' WHEN claim_family = 'institutional' THEN 'facility_837i'
         WHEN claim_family = 'pharmacy' THEN 'pharmacy_ncpdp' WHEN claim_family = 'administrative' THEN 'admin_platform'
         ELSE 'core_claims' END AS source_system,
    {h('line_key', 'v3_bg_price')} < 40 AS bgp, {h('line_key', 'v3_bg_egr')} < 30 AS bge
  FROM b0
),
b2 AS (
  SELECT * REPLACE (CASE WHEN bgp THEN {_t('allowed_amount', 'v3_bg_price_amt', '1.35', '2.50')} ELSE allowed_amount END
                    AS allowed_amount),
    CASE WHEN coding_edit_type <> 'none' THEN 1 ELSE 0 END AS coding_edit_flag
  FROM b1
),
b3 AS (
  SELECT * EXCLUDE (bgp, bge, price_method0) REPLACE (
      CASE WHEN bgp THEN CASE WHEN denied_flag = 1 THEN 0 ELSE {_t('allowed_amount', 'v3_bg_price_paid', '0.85', '1.00')} END
           ELSE paid_amount END AS paid_amount,
      CASE WHEN bge THEN {_t('billed_amount', 'v3_bg_egr_amt', '3', '10')} ELSE billed_amount END AS billed_amount),
    CASE WHEN bgp THEN 1 ELSE 0 END AS pricing_error_flag,
    CASE WHEN bgp THEN 'pricing_error' ELSE price_method0 END AS price_method,
    CASE WHEN bge THEN 1 ELSE 0 END AS egregious_charge_flag
  FROM b2
),
c0 AS (
  SELECT *, {h('line_key', 'v3_fraud')} < (CASE provider_class WHEN 'clean' THEN 5 WHEN 'low_risk' THEN 60
           WHEN 'medium_risk' THEN 200 WHEN 'bad_actor' THEN 800 ELSE 10 END) * {mult} AS cand
  FROM b3
),
c1 AS (
  SELECT *, CASE WHEN cand THEN {mode_case} END AS mode FROM c0
),
c2 AS (
  SELECT *,
    COALESCE(mode = 'upcoding' AND claim_family = 'professional', FALSE) AS up,
    COALESCE(mode = 'excessive_units', FALSE) AS ex,
    COALESCE(mode = 'unbundling' AND claim_family = 'professional', FALSE) AS unb,
    COALESCE(mode = 'high_cost_facility' AND claim_family = 'institutional', FALSE) AS hc,
    COALESCE(mode = 'pharmacy_refill_abuse' AND claim_family = 'pharmacy', FALSE) AS rf,
    COALESCE(mode = 'member_reimbursement_abuse' AND encounter_type = 'member_submitted', FALSE) AS mr,
    COALESCE(mode = 'pricing_error_abuse', FALSE) AS pe,
    COALESCE(mode = 'egregious_charge', FALSE) AS eg
  FROM c1
),
c3 AS (
  SELECT * REPLACE (
      CASE WHEN up THEN '99215' WHEN unb THEN ['36415', '80048', '85025'][{h('line_key', 'v3_unb_c')} % 3 + 1]
           ELSE service_code END AS service_code,
      CAST(CASE WHEN ex THEN CASE WHEN claim_family = 'professional' THEN 8 + {h('line_key', 'v3_ex_u')} % 12
                                  WHEN claim_family = 'pharmacy' THEN 90 + {h('line_key', 'v3_ex_u')} % 91
                                  ELSE 18 + {h('line_key', 'v3_ex_u')} % 22 END
                WHEN rf THEN [90, 120, 180][{h('line_key', 'v3_rf_u')} % 3 + 1] ELSE units END AS INTEGER) AS units,
      CASE WHEN up THEN {_t('billed_amount', 'v3_up_b', '1.35', '1.90')} WHEN ex THEN {_t('billed_amount', 'v3_ex_b', '1.4', '2.8')}
           WHEN hc THEN {_t('billed_amount', 'v3_hc_b', '1.8', '3.5')} WHEN rf THEN {_t('billed_amount', 'v3_rf_b', '1.4', '2.5')}
           WHEN mr THEN {_t('billed_amount', 'v3_mr_b', '1.6', '4.0')} WHEN eg THEN {_t('billed_amount', 'v3_eg_b', '3', '9')}
           ELSE billed_amount END AS billed_amount,
      CASE WHEN up THEN {_t('allowed_amount', 'v3_up_a', '1.20', '1.60')} WHEN ex THEN {_t('allowed_amount', 'v3_ex_a', '1.2', '2.2')}
           WHEN hc THEN {_t('allowed_amount', 'v3_hc_a', '1.4', '2.6')} WHEN rf THEN {_t('allowed_amount', 'v3_rf_a', '1.2', '2.0')}
           WHEN mr THEN {_t('allowed_amount', 'v3_mr_a', '1.1', '2.2')} WHEN pe THEN {_t('allowed_amount', 'v3_pe_a', '1.5', '3.0')}
           ELSE allowed_amount END AS allowed_amount,
      CASE WHEN unb THEN 1 ELSE coding_edit_flag END AS coding_edit_flag,
      CASE WHEN unb THEN 'NCCI_PTP_LIKE' ELSE coding_edit_type END AS coding_edit_type,
      CASE WHEN pe THEN 1 ELSE pricing_error_flag END AS pricing_error_flag,
      CASE WHEN pe THEN 'pricing_error' ELSE price_method END AS price_method,
      CASE WHEN eg THEN 1 ELSE egregious_charge_flag END AS egregious_charge_flag),
    CASE WHEN cand THEN 1 ELSE 0 END AS fraud_label, COALESCE(mode, 'none') AS fraud_type
  FROM c2
),
c4 AS (
  SELECT * REPLACE (
      CASE WHEN up OR ex OR hc OR rf OR mr OR pe THEN
        CASE WHEN denied_flag = 1 THEN 0
             WHEN up THEN {_t('allowed_amount', 'v3_up_p', '0.85', '1.00')} WHEN ex THEN {_t('allowed_amount', 'v3_ex_p', '0.80', '1.00')}
             WHEN hc THEN {_t('allowed_amount', 'v3_hc_p', '0.82', '1.00')} WHEN rf THEN {_t('allowed_amount', 'v3_rf_p', '0.90', '1.00')}
             WHEN mr THEN {_t('allowed_amount', 'v3_mr_p', '0.65', '0.95')} ELSE {_t('allowed_amount', 'v3_pe_p', '0.85', '1.00')} END
      ELSE paid_amount END AS paid_amount)
  FROM c3
),
d0 AS (
  SELECT *, CASE WHEN mode = 'duplicate' AND ROW_NUMBER() OVER (PARTITION BY mode = 'duplicate'
                ORDER BY ('0x' || substr(md5(line_key || '|v3_dup_pick'), 1, 8))::BIGINT, line_key)
                <= FLOOR(0.55 * COUNT(*) FILTER (WHERE mode = 'duplicate') OVER ()) THEN 1 ELSE 0 END AS dup_sel
  FROM c4
),
d1 AS (
  SELECT * EXCLUDE (dup_sel) FROM d0
  UNION ALL
  SELECT * EXCLUDE (dup_sel) REPLACE (claim_line_no + 200 AS claim_line_no) FROM d0 WHERE dup_sel = 1
),
e0 AS (
  SELECT *, COALESCE(ndc, '') AS ndc11,
    CASE WHEN claim_family = 'pharmacy' THEN COALESCE(ndc, '') WHEN claim_family = 'institutional' THEN revenue_code
         ELSE service_code END AS code_key
  FROM d1
),
e1 AS (
  SELECT e0.*,
    COUNT(*) OVER (PARTITION BY member_id, provider_id, service_date, diagnosis_code, service_code, revenue_code, ndc11,
                   allowed_amount) AS duplicate_signature_count,
    COUNT(*) OVER (PARTITION BY provider_id, service_date) AS provider_day_claim_count,
    CAST(SUM(allowed_amount) OVER (PARTITION BY provider_id) AS DOUBLE) / COUNT(*) OVER (PARTITION BY provider_id) AS provider_avg_allowed,
    CAST(SUM(allowed_amount) OVER (PARTITION BY code_key) AS DOUBLE) / COUNT(*) OVER (PARTITION BY code_key) AS code_avg_allowed,
    (SELECT quantile_cont(billed_amount, 0.98) FROM e0) AS q98
  FROM e0
),
e2 AS (
  SELECT *,
    CAST(allowed_amount AS DOUBLE) / GREATEST(code_avg_allowed, 1.0) AS allowed_to_code_avg_ratio,
    CASE WHEN allowed_amount = 0 THEN 0.0 ELSE CAST(billed_amount AS DOUBLE) / GREATEST(CAST(allowed_amount AS DOUBLE), 1.0) END
      AS billed_to_allowed_ratio
  FROM e1
),
r0 AS (
  SELECT *,
    CASE WHEN duplicate_signature_count > 1 THEN 1 ELSE 0 END AS rule_duplicate,
    CASE WHEN (claim_family = 'professional' AND units >= 8) OR (claim_family = 'institutional' AND units >= 20)
           OR (claim_family = 'pharmacy' AND units >= 90) THEN 1 ELSE 0 END AS rule_excessive_units,
    CASE WHEN allowed_to_code_avg_ratio >= 2.2 THEN 1 ELSE 0 END AS rule_high_amount_ratio,
    CASE WHEN billed_amount > GREATEST(allowed_amount, 1) * 4.5 OR egregious_charge_flag = 1 THEN 1 ELSE 0 END AS rule_egregious_charge,
    CASE WHEN pricing_error_flag = 1 OR (price_method = 'pricing_error' AND paid_amount > allowed_amount * 0.95)
         THEN 1 ELSE 0 END AS rule_pricing_error,
    CASE WHEN denied_flag = 1 AND billed_amount >= q98 THEN 1 ELSE 0 END AS rule_denied_high_charge,
    CASE WHEN encounter_type = 'member_submitted' AND (billed_amount > allowed_amount * 2.5 OR claim_status = 'denied')
         THEN 1 ELSE 0 END AS rule_member_submission_outlier,
    CASE WHEN claim_family = 'pharmacy' AND (allowed_to_code_avg_ratio >= 1.8 OR units >= 90 OR ndc11 = '00781-1506')
         THEN 1 ELSE 0 END AS rule_high_pharmacy_cost,
    CASE WHEN coding_edit_type = 'NCCI_PTP_LIKE' OR (service_code IN ('36415', '80048', '80053', '85025') AND claim_line_no > 1)
         THEN 1 ELSE 0 END AS rule_ncci_ptp_like,
    CASE WHEN coding_edit_type = 'MUE_LIKE' OR (claim_family = 'institutional' AND units >= 20)
           OR (claim_family = 'professional' AND units >= 8) THEN 1 ELSE 0 END AS rule_mue_like
  FROM e2
),
v3 AS (
  SELECT *,
    rule_duplicate + rule_excessive_units + rule_high_amount_ratio + rule_egregious_charge + rule_pricing_error
      + rule_denied_high_charge + rule_member_submission_outlier + rule_high_pharmacy_cost + rule_ncci_ptp_like
      + rule_mue_like AS rule_score,
    {reason} AS rule_primary_reason,
    printf('L%09d_%08d', enc_key, claim_line_no) AS line_id
  FROM r0
)
"""


V3_OUT = [
    ("line_id", "VARCHAR"), ("claim_family", "VARCHAR"), ("encounter_type", "VARCHAR"), ("service_code", "VARCHAR"),
    ("units", "INTEGER"), ("billed_amount", "DOUBLE"), ("allowed_amount", "DOUBLE"), ("paid_amount", "DOUBLE"),
    ("claim_status", "VARCHAR"), ("coding_edit_flag", "INTEGER"), ("coding_edit_type", "VARCHAR"),
    ("price_method", "VARCHAR"), ("source_system", "VARCHAR"), ("pricing_error_flag", "INTEGER"),
    ("egregious_charge_flag", "INTEGER"), ("fraud_label", "INTEGER"), ("fraud_type", "VARCHAR"),
    ("duplicate_signature_count", "BIGINT"), ("provider_day_claim_count", "BIGINT"),
    ("provider_avg_allowed", "DOUBLE"), ("code_avg_allowed", "DOUBLE"),
    ("allowed_to_code_avg_ratio", "DOUBLE"), ("billed_to_allowed_ratio", "DOUBLE"),
] + [(r, "INTEGER") for r, _ in V3_RULE_PRIORITY] + [
    ("rule_score", "INTEGER"), ("rule_pred", "INTEGER"), ("rule_primary_reason", "VARCHAR"),
]


def v3_select() -> str:
    cols = []
    for c, t in V3_OUT:
        expr = "CASE WHEN rule_score >= 2 THEN 1 ELSE 0 END" if c == "rule_pred" else c
        cols.append(f"CAST({expr} AS {t}) AS {c}")
    return v3_ctes() + "SELECT " + ", ".join(cols) + " FROM v3"


def v3_over(select_sql: str) -> str:
    """Oracle for a summary over the v3 lines (as view ``v3``)."""
    return v3_ctes() + select_sql
