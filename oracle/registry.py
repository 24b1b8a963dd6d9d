"""Oracle SQL per registered query (DuckDB dialect)."""

from __future__ import annotations

from claimlens.plans.queries import LINE_PROJECTIONS
from oracle.early_sql import early_sql
from oracle.extra_sql import extra_sql
from oracle.lake_sql import lake_sql
from oracle.profiles_sql import append_fixed_rate_sql, appended_sql, profile_sql
from oracle.summaries_sql import SUMMARY_SQL
from oracle.v3_sql import v3_over, v3_select
from oracle.v6_sql import V6_OUT, shaped_ctes, v6_lines_select, with_lines

DUCK_TYPES = dict(V6_OUT)


def v3_queries() -> dict[str, str]:
    pred = "CASE WHEN rule_score >= 2 THEN 1 ELSE 0 END"
    return {
        "v3_lines": v3_select(),
        "v3_recall_within_type": v3_over(f"""
SELECT fraud_type, COUNT(*) AS n, CAST(SUM({pred}) AS BIGINT) AS caught,
       CAST(SUM(rule_score) AS DOUBLE) / COUNT(*) AS avg_rule_score,
       CAST(SUM({pred}) AS DOUBLE) / COUNT(*) AS recall
FROM v3 GROUP BY fraud_type"""),
        "v3_provider_rollup": v3_over(f"""
SELECT provider_id, COUNT(*) AS lines, CAST(SUM(fraud_label) AS BIGINT) AS fraud_lines,
       CAST(SUM({pred}) AS BIGINT) AS flagged_lines, CAST(SUM(allowed_amount) AS DOUBLE) AS allowed_total,
       MAX(p.max_day_lines) AS max_day_lines, CAST(SUM(fraud_label) AS DOUBLE) / COUNT(*) AS fraud_rate,
       CAST(SUM({pred}) AS DOUBLE) / COUNT(*) AS flag_rate
FROM v3 JOIN (SELECT provider_id, MAX(n) AS max_day_lines
              FROM (SELECT provider_id, service_date, COUNT(*) AS n FROM v3 GROUP BY ALL) GROUP BY 1) p USING (provider_id)
GROUP BY provider_id"""),
        "v3_rule_metrics": v3_over(f"""
SELECT tp, fp, fn, tn, ROUND(p, 9) AS precision, ROUND(r, 9) AS recall, fraud_rate, flag_rate,
       ROUND(2 * p * r / (p + r + 1e-9), 9) AS f1
FROM (SELECT tp, fp, fn, tn, CAST(tp AS DOUBLE) / GREATEST(tp + fp, 1) AS p, CAST(tp AS DOUBLE) / GREATEST(tp + fn, 1) AS r,
             CAST(tp + fn AS DOUBLE) / (tp + fp + fn + tn) AS fraud_rate, CAST(tp + fp AS DOUBLE) / (tp + fp + fn + tn) AS flag_rate
      FROM (SELECT COUNT(*) FILTER (WHERE fraud_label = 1 AND {pred} = 1) AS tp,
                   COUNT(*) FILTER (WHERE fraud_label <> 1 AND {pred} = 1) AS fp,
                   COUNT(*) FILTER (WHERE fraud_label = 1 AND {pred} <> 1) AS fn,
                   COUNT(*) FILTER (WHERE fraud_label <> 1 AND {pred} <> 1) AS tn FROM v3))"""),
        "v3_reason_summary": v3_over(f"""
SELECT rule_primary_reason, CAST({pred} AS INTEGER) AS rule_pred, COUNT(*) AS count FROM v3 GROUP BY ALL"""),
    }


def _proj(cols: list[str]) -> str:
    return "SELECT " + ", ".join(f"CAST({c} AS {DUCK_TYPES[c]}) AS {c}" for c in cols) + " FROM lines"


def all_sql() -> dict[str, str]:
    out = {
        "v6_lines": with_lines(v6_lines_select()),
        "claims_from_star": "WITH " + shaped_ctes() + """
SELECT enc_key AS order_key, CAST(claim_line_no AS INTEGER) AS claim_line_no, member_id, provider_id, service_date,
       encounter_type, claim_family, service_code, units, CAST(allowed_amount AS DOUBLE) AS allowed_amount,
       CAST(contract_rate AS DOUBLE) AS contract_rate, CAST(billed_amount AS DOUBLE) AS billed_amount,
       claim_status, denial_reason, payment_type
FROM shaped2""",
        "review_queue": with_lines("""
SELECT line_id, encounter_id, provider_id, member_id, service_date, claim_family, service_code,
       CAST(rule_score AS INTEGER) AS rule_score, rule_primary_reason_detected, fraud_type,
       CAST(billed_amount AS DOUBLE) AS billed_amount, CAST(contract_rate AS DOUBLE) AS contract_rate
FROM lines WHERE flagged_for_review = 1"""),
    }
    out.update({name: with_lines(_proj(cols)) for name, cols in LINE_PROJECTIONS.items()})
    out.update(v3_queries())
    out.update(profile_sql())
    out.update(lake_sql())
    out["append_fixed_rate"] = append_fixed_rate_sql()
    out.update(appended_sql())
    out.update({name: with_lines(sql) for name, sql in SUMMARY_SQL.items()})
    out.update(extra_sql())
    out.update(early_sql())
    return out
