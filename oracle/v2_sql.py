"""DuckDB oracle for the v2 profile, built on the shaped-line CTEs."""

from __future__ import annotations

from claimlens.functions.draws import weighted_cuts
from claimlens.operators.profiles import V2_REASONS, V2_RULES
from claimlens.plans.v2 import FACILITY_PLACES, INSTITUTIONAL, MENUS, PROFESSIONAL, PROFESSIONAL_PLACES, V2_MODES
from oracle.v6_sql import h, lst, money, q, shaped_ctes, unif


def _t(amount: str, salt: str, lo: str, hi: str) -> str:
    return money(f"{amount} * {unif('line_key', salt, lo, hi)}")


def _weighted(salt: str, options: list) -> str:
    cuts = weighted_cuts(options)
    return "CASE " + " ".join(f"WHEN {h('line_key', salt)} < {c} THEN {q(v)}" for v, c in cuts[:-1]) + f" ELSE {q(cuts[-1][0])} END"


def propensity(lo: str, hi: str) -> str:
    return f"CAST({lo} AS DECIMAL(12,8)) + CAST({hi} - {lo} AS DECIMAL(4,3)) * {h('provider_id', 'v2_propensity')} * 0.0001"


def v2_ctes(mult: int = 2, volume: int = 3) -> str:
    pairs = ", ".join(f"({i}, {q(r[0])}, {q(r[1] or '')}, {r[5]})" for i, r in enumerate(INSTITUTIONAL))
    prices = ", ".join([f"('', {q(c)}, CAST({b} AS DECIMAL(10,2)), {u}, {q(k)})" for c, b, u, k in PROFESSIONAL]
                       + [f"({q(r)}, {q(c or '')}, CAST({b} AS DECIMAL(10,2)), {u}, {q(k)})" for r, c, b, u, k, _ in INSTITUTIONAL])
    menu = "CASE " + " ".join(f"WHEN specialty = {q(s)} THEN {lst(c)}[l_partkey % {len(c)} + 1]" for s, c in MENUS.items()) \
        + f" ELSE {lst(MENUS['Primary Care'])}[l_partkey % {len(MENUS['Primary Care'])} + 1] END"
    reason = "CASE " + " ".join(f"WHEN {r} = 1 THEN {q(w)}" for r, w in V2_REASONS) + " ELSE 'no_rule' END"
    return "WITH " + shaped_ctes() + f""",
weights AS (SELECT * FROM (VALUES {pairs}) AS t(i, pair_revenue, pair_service, w)),
pair_cuts AS (
  SELECT pair_revenue, pair_service, CAST(round((sum(w) OVER (ORDER BY i) - w) / (SELECT sum(w) FROM weights) * 10000) AS INTEGER) AS lo,
    CAST(round(sum(w) OVER (ORDER BY i) / (SELECT sum(w) FROM weights) * 10000) AS INTEGER) AS hi FROM weights),
prices AS (SELECT * FROM (VALUES {prices}) AS t(revenue_code, service_code, base, typical_units, category)),
a0 AS (
  SELECT enc_key, claim_line_no, line_key, member_id, member_age, member_gender, chronic_score, provider_id, provider_specialty,
    provider_class, service_date, diagnosis_code, disc, l_partkey,
    CASE WHEN provider_specialty = 'Hospital' THEN 'institutional' ELSE 'professional' END AS claim_family,
    CASE WHEN provider_specialty LIKE '% Therapy' THEN 'Therapy' ELSE provider_specialty END AS specialty FROM shaped2),
a1 AS (
  SELECT a0.*, CASE WHEN claim_family = 'institutional' THEN pair_revenue ELSE '' END AS revenue_code,
    CASE WHEN claim_family = 'institutional' THEN pair_service ELSE {menu} END AS service_code,
    CASE WHEN claim_family = 'institutional' THEN {_weighted('v2_pos', FACILITY_PLACES)}
         ELSE {_weighted('v2_pos', PROFESSIONAL_PLACES)} END AS place_of_service
  FROM a0 JOIN pair_cuts ON {h('line_key', 'v2_pair')} >= lo AND {h('line_key', 'v2_pair')} < hi),
a2 AS (
  SELECT a1.*, base, category, CAST(least(greatest(typical_units - 1 + {h('line_key', 'v2_units')} % 3, 1),
    CASE WHEN claim_family = 'institutional' THEN 12 ELSE 6 END) AS INTEGER) AS units,
    CASE provider_class WHEN 'low_risk' THEN {propensity('0.002', '0.010')}
      WHEN 'medium_risk' THEN {propensity('0.02', '0.06')}
      WHEN 'bad_actor' THEN {propensity('0.08', '0.18')} ELSE 0 END AS propensity
  FROM a1 JOIN prices USING (revenue_code, service_code)),
a3 AS (
  SELECT *, {money('''base * CAST(units AS DECIMAL(6,0)) * CAST(0.80 + 4 * disc AS DECIMAL(6,2)) *
      CAST(1 + 0.04 * chronic_score + CASE WHEN place_of_service = '21' THEN 0.35 WHEN place_of_service = '23' THEN 0.08 ELSE 0 END AS DECIMAL(8,4)) *
      CAST(1 + 0.0025 * greatest(member_age - 50, 0) AS DECIMAL(6,4))''')} AS allowed0 FROM a2),
a4 AS (
  SELECT *, {_t('allowed0', 'v2_billed', '1.08', '1.50')} AS billed0, {_t('allowed0', 'v2_paid', '0.72', '1.00')} AS paid0,
    CASE WHEN {h('line_key', 'v2_fraud')} < propensity * 10000 * {mult} THEN {_weighted('v2_mode', V2_MODES)} ELSE 'none' END AS fraud_type,
    claim_family = 'institutional' AS fac FROM a3),
a5 AS (
  SELECT * REPLACE (
    CASE WHEN fraud_type = 'upcoding' AND NOT fac THEN '99215' WHEN fraud_type = 'unbundling' AND NOT fac THEN '36415' ELSE service_code END AS service_code,
    CASE WHEN fraud_type = 'upcoding' AND fac THEN '0360' WHEN fraud_type = 'unbundling' AND fac THEN '0300' ELSE revenue_code END AS revenue_code,
    CASE WHEN fraud_type = 'upcoding' THEN CASE WHEN fac THEN 'OR' ELSE 'E&M' END WHEN fraud_type = 'unbundling' THEN 'Lab' ELSE category END AS category,
    CAST(CASE WHEN fraud_type = 'upcoding' AND NOT fac THEN 1 WHEN fraud_type = 'excessive_units' THEN
      CASE WHEN fac THEN 12 + {h('line_key', 'v2_ex_u')} % 23 ELSE 8 + {h('line_key', 'v2_ex_u')} % 12 END ELSE units END AS INTEGER) AS units)
  FROM a4),
a6 AS (
  SELECT *, CASE WHEN fraud_type = 'upcoding' THEN CASE WHEN fac THEN {_t('allowed0', 'v2_or_a', '2', '3')}
        ELSE {_t('CAST(210 AS DECIMAL(10,2))', 'v2_up_a', '1.00', '1.25')} END
      WHEN fraud_type = 'excessive_units' THEN {_t('base * units', 'v2_ex_a', '1.00', '1.35')}
      WHEN fraud_type = 'high_cost_facility' THEN {_t('allowed0', 'v2_hc_a', '1.6', '3.2')} ELSE allowed0 END AS allowed_amount FROM a5),
seeded2 AS (
  SELECT *,
    CASE WHEN fraud_type = 'upcoding' THEN CASE WHEN fac THEN {_t('billed0', 'v2_or_b', '2', '3')} ELSE {_t('allowed_amount', 'v2_up_b', '1.25', '1.65')} END
      WHEN fraud_type = 'excessive_units' THEN {_t('allowed_amount', 'v2_ex_b', '1.2', '1.7')}
      WHEN fraud_type = 'unbundling' THEN {_t('billed0', 'v2_un_b', '1.2', '1.6')}
      WHEN fraud_type = 'high_cost_facility' THEN {_t('billed0', 'v2_hc_b', '1.8', '3.4')} ELSE billed0 END AS billed_amount,
    CASE WHEN fraud_type = 'upcoding' THEN CASE WHEN fac THEN {_t('paid0', 'v2_or_p', '1.7', '2.6')} ELSE {_t('allowed_amount', 'v2_up_p', '0.8', '1.0')} END
      WHEN fraud_type = 'excessive_units' THEN {_t('allowed_amount', 'v2_ex_p', '0.8', '1.0')}
      WHEN fraud_type = 'unbundling' THEN {_t('paid0', 'v2_un_p', '1.05', '1.25')}
      WHEN fraud_type = 'high_cost_facility' THEN {_t('paid0', 'v2_hc_p', '1.3', '2.4')} ELSE paid0 END AS paid_amount,
    CASE WHEN fraud_type <> 'none' THEN 1 ELSE 0 END AS fraud_label
  FROM a6),
replayed AS (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY ('0x' || substr(md5(line_key || '|v2_replay'), 1, 8))::BIGINT, line_key) AS rk,
    count(*) OVER () AS n FROM seeded2 WHERE fraud_type = 'duplicate') WHERE rk <= greatest(floor(n * 0.7), 1)),
v2 AS (
  SELECT 'V' || line_key AS claim_id, * FROM seeded2
  UNION ALL BY NAME SELECT 'VR' || line_key AS claim_id, * EXCLUDE (rk, n) FROM replayed),
v2f AS (
  SELECT *, CASE WHEN claim_family = 'institutional' THEN revenue_code ELSE service_code END AS code_key FROM v2),
v2g AS (
  SELECT *,
    count(*) OVER (PARTITION BY member_id, provider_id, service_date, diagnosis_code, service_code, revenue_code, allowed_amount) AS duplicate_signature_count,
    count(*) OVER (PARTITION BY provider_id, service_date) AS provider_day_claim_count,
    CAST(sum(allowed_amount) OVER (PARTITION BY provider_id) AS DOUBLE) / count(*) OVER (PARTITION BY provider_id) AS provider_avg_allowed,
    CAST(sum(fraud_label) OVER (PARTITION BY provider_id) AS DOUBLE) / count(*) OVER (PARTITION BY provider_id) AS provider_fraud_rate,
    CAST(sum(allowed_amount) OVER (PARTITION BY code_key) AS DOUBLE) / count(*) OVER (PARTITION BY code_key) AS code_avg_allowed FROM v2f),
v2h AS (
  SELECT *, CAST(allowed_amount AS DOUBLE) / greatest(code_avg_allowed, 1.0) AS allowed_to_code_avg_ratio,
    CAST(billed_amount AS DOUBLE) / greatest(CAST(allowed_amount AS DOUBLE), 1.0) AS billed_to_allowed_ratio FROM v2g),
v2r AS (
  SELECT *, CASE WHEN duplicate_signature_count > 1 THEN 1 ELSE 0 END AS rule_duplicate,
    CASE WHEN (NOT fac AND units >= 8) OR (fac AND units >= 12) THEN 1 ELSE 0 END AS rule_excessive_units,
    CASE WHEN provider_day_claim_count >= {volume} THEN 1 ELSE 0 END AS rule_provider_volume,
    CASE WHEN allowed_to_code_avg_ratio >= 2.0 THEN 1 ELSE 0 END AS rule_high_amount_ratio,
    CASE WHEN billed_to_allowed_ratio >= 1.55 THEN 1 ELSE 0 END AS rule_high_billed_allowed,
    CASE WHEN revenue_code = '0360' AND allowed_to_code_avg_ratio >= 1.8 THEN 1 ELSE 0 END AS rule_suspicious_or,
    CASE WHEN revenue_code = '0450' AND allowed_to_code_avg_ratio >= 1.7 THEN 1 ELSE 0 END AS rule_suspicious_ed FROM v2h),
v2s AS (SELECT *, {' + '.join(V2_RULES)} AS rule_score, {reason} AS rule_primary_reason FROM v2r)
"""


def v2_sql() -> dict[str, str]:
    rules = ", ".join(f"CAST({r} AS INTEGER) AS {r}" for r in V2_RULES)
    return {
        "v2_lines": v2_ctes() + """
SELECT claim_id, member_id, provider_id, service_date, claim_family, place_of_service, diagnosis_code, revenue_code, service_code,
  category, units, CAST(billed_amount AS DOUBLE) AS billed_amount, CAST(allowed_amount AS DOUBLE) AS allowed_amount,
  CAST(paid_amount AS DOUBLE) AS paid_amount, CAST(propensity AS DOUBLE) AS provider_fraud_propensity,
  CASE WHEN place_of_service = '02' THEN 1 ELSE 0 END AS telehealth_flag, CASE WHEN place_of_service = '21' THEN 1 ELSE 0 END AS inpatient_flag,
  CASE WHEN place_of_service = '23' THEN 1 ELSE 0 END AS emergency_flag, fraud_label, fraud_type FROM v2""",
        "v2_rules": v2_ctes() + f"""
SELECT claim_id, duplicate_signature_count, provider_day_claim_count, provider_avg_allowed, code_avg_allowed,
  allowed_to_code_avg_ratio, billed_to_allowed_ratio, provider_fraud_rate, {rules}, CAST(rule_score AS INTEGER) AS rule_score,
  CASE WHEN rule_score >= 2 THEN 1 ELSE 0 END AS rule_pred, rule_primary_reason, fraud_type FROM v2s""",
        "v2_recall_within_type": v2_ctes() + """
SELECT fraud_type, COUNT(*) AS n, CAST(SUM(CASE WHEN rule_score >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS caught,
       CAST(SUM(rule_score) AS DOUBLE) / COUNT(*) AS avg_rule_score,
       CAST(SUM(CASE WHEN rule_score >= 2 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS recall FROM v2s GROUP BY fraud_type""",
    }
