"""DuckDB SQL of the first script's and v3's pricing, propensities by range, and the rules row of the performance table."""

from __future__ import annotations

from claimlens.functions.draws import weighted_cuts
from claimlens.plans.early import FD_MENUS, FD_OTHER_MENU, FD_PLACES, V3_PRODUCTS
from claimlens.plans.v2 import PROFESSIONAL
from oracle.profiles_sql import appended_sql
from oracle.v2_sql import propensity
from oracle.v6_sql import h, lst, money, q, shaped_ctes, unif


def fd_lines() -> str:
    menu = "CASE " + " ".join(f"WHEN specialty = {q(s)} THEN {lst(c)}[l_partkey % {len(c)} + 1]" for s, c in FD_MENUS.items()) \
        + f" ELSE {lst(FD_OTHER_MENU)}[l_partkey % {len(FD_OTHER_MENU)} + 1] END"
    cuts = weighted_cuts(FD_PLACES)
    place = "CASE " + " ".join(f"WHEN {h('line_key', 'fd_pos')} < {c} THEN {q(v)}" for v, c in cuts[:-1]) + f" ELSE {q(cuts[-1][0])} END"
    prices = ", ".join(f"({q(c)}, CAST({b} AS DECIMAL(10,2)), {u}, {q(k)})" for c, b, u, k in PROFESSIONAL)
    return "WITH " + shaped_ctes() + f""",
prices AS (SELECT * FROM (VALUES {prices}) AS t(code, base, typical, category)),
a AS (SELECT *, CASE WHEN provider_specialty LIKE '% Therapy' THEN 'Therapy' ELSE provider_specialty END AS specialty FROM shaped2),
b AS (SELECT line_key, member_age, chronic_score, disc, {menu} AS code, {place} AS pos FROM a),
c AS (SELECT *, CAST(least(greatest(typical - 1 + {h('line_key', 'fd_units')} % 3, 1), 6) AS INTEGER) AS n FROM b JOIN prices USING (code)),
d AS (SELECT *, {money("""base * CAST(n AS DECIMAL(6,0)) * CAST(0.80 + 4 * disc AS DECIMAL(6,2)) *
  CAST(1 + 0.03 * chronic_score + CASE WHEN pos = '21' THEN 0.25 ELSE 0 END AS DECIMAL(8,4)) *
  CAST(1 + 0.002 * greatest(member_age - 50, 0) AS DECIMAL(6,4))""")} AS allowed FROM c)
SELECT line_key, code AS service_code, category, pos AS place_of_service, n AS units, CASE WHEN pos = '02' THEN 1 ELSE 0 END AS telehealth_flag,
  CASE WHEN pos = '21' THEN 1 ELSE 0 END AS inpatient_flag, CAST(allowed AS DOUBLE) AS allowed_amount,
  CAST({money(f"allowed * {unif('line_key', 'fd_billed', '1.10', '1.45')}")} AS DOUBLE) AS billed_amount,
  CAST({money(f"allowed * {unif('line_key', 'fd_paid', '0.85', '1.00')}")} AS DOUBLE) AS paid_amount FROM d"""


def v3_pharmacy_lines() -> str:
    rows = ", ".join(f"({k}, {q(n)}, {q(d)}, CAST({b} AS DECIMAL(10,2)), {q(t)})" for k, (n, d, b, t) in enumerate(V3_PRODUCTS))
    return "WITH " + shaped_ctes() + f""",
products AS (SELECT * FROM (VALUES {rows}) AS t(k, ndc11, drug_name, base, drug_type)),
a AS (SELECT line_key, l_partkey % {len(V3_PRODUCTS)} AS k, CAST([30, 30, 30, 90][{h('line_key', 'v3_days')} % 4 + 1] AS INTEGER) AS units
  FROM shaped2 WHERE claim_family = 'pharmacy')
SELECT line_key, ndc11, drug_name, drug_type, units, CAST({money(f"base * CASE WHEN units = 90 THEN {unif('line_key', 'v3_ninety', '2.2', '2.8')} ELSE 1 END * {unif('line_key', 'v3_margin', '1.0', '1.12')}")} AS DOUBLE) AS billed_amount
FROM a JOIN products USING (k)"""


def provider_propensities() -> str:
    def column(low: tuple, medium: tuple, high: tuple) -> str:
        return (f"CAST(CASE provider_class WHEN 'low_risk' THEN {propensity(*low)} WHEN 'medium_risk' THEN {propensity(*medium)} "
                f"WHEN 'bad_actor' THEN {propensity(*high)} ELSE 0 END AS DOUBLE)")
    return f"""
SELECT provider_id, provider_class, {column(('0.002', '0.010'), ('0.02', '0.06'), ('0.08', '0.18'))} AS v2_propensity,
  {column(('0.001', '0.010'), ('0.015', '0.050'), ('0.06', '0.16'))} AS v3_propensity
FROM (SELECT printf('P%06d', s_suppkey + 1) AS provider_id, CASE WHEN s_suppkey % 20 = 0 THEN 'bad_actor' WHEN s_suppkey % 20 IN (1, 2) THEN 'medium_risk'
  WHEN s_suppkey % 20 IN (3, 4, 5) THEN 'low_risk' ELSE 'clean' END AS provider_class FROM supplier)"""


def performance_rules_fd() -> str:
    return f"""
SELECT 'rules' AS model, round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round(p, 9) AS precision, round(r, 9) AS recall,
  CASE WHEN p + r > 0 THEN round(2 * p * r / (p + r), 9) ELSE 0.0 END AS f1, tn, fp, fn, tp
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r
  FROM (SELECT count_if(fraud_label = 1 AND rule_pred = 1) AS tp, count_if(fraud_label <> 1 AND rule_pred = 1) AS fp,
    count_if(fraud_label = 1 AND rule_pred <> 1) AS fn, count_if(fraud_label <> 1 AND rule_pred <> 1) AS tn
    FROM ({appended_sql()["rules_fd_appended"]})))"""


def early_sql() -> dict[str, str]:
    return {"fd_lines": fd_lines(), "v3_pharmacy_lines": v3_pharmacy_lines(), "provider_propensities": provider_propensities(),
            "performance_rules_fd": performance_rules_fd()}
