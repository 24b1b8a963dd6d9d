"""Oracle SQL for the J, N and V queries, each a SELECT over the ``lines`` CTE."""

from __future__ import annotations

CK = "(encounter_id || '|' || provider_id || '|' || claim_family)"


def _mean(c: str) -> str:
    return f"CAST(SUM({c}) AS DOUBLE) / COUNT(*)"


def _rate(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*)"


def _msum(c: str) -> str:
    return f"CAST(SUM({c}) AS DOUBLE)"


LEVEL_RATES = f"""
lr AS (
  SELECT (SELECT {_mean('fraud_label')} FROM lines) AS line_fraud_rate,
         (SELECT {_mean('flagged_for_review')} FROM lines) AS line_flag_rate,
         (SELECT {_mean('cf')} FROM (SELECT MAX(fraud_label) AS cf FROM lines GROUP BY {CK})) AS claim_fraud_rate,
         (SELECT {_mean('cg')} FROM (SELECT MAX(flagged_for_review) AS cg FROM lines GROUP BY {CK})) AS claim_flag_rate,
         (SELECT {_mean('ef')} FROM (SELECT MAX(fraud_label) AS ef FROM lines GROUP BY encounter_id)) AS encounter_fraud_rate,
         (SELECT {_mean('eg')} FROM (SELECT MAX(flagged_for_review) AS eg FROM lines GROUP BY encounter_id)) AS encounter_flag_rate
)"""


def _with(extra: str, body: str) -> str:
    """Append more CTEs after ``lines`` then the final SELECT."""
    return f", {extra}\n{body}"


SUMMARY_SQL = {
    "fraud_breakdown": "SELECT fraud_type, claim_family, COUNT(*) AS count FROM lines GROUP BY ALL",
    "provider_summary": f"""
SELECT provider_id, provider_specialty, provider_class, COUNT(*) AS total_lines,
       COUNT(*) FILTER (WHERE claim_status = 'paid') AS paid_lines,
       COUNT(*) FILTER (WHERE claim_status = 'denied') AS denied_lines,
       {_mean('fraud_label')} AS fraud_rate, {_mean('contract_rate')} AS avg_contract,
       {_mean('billed_amount')} AS avg_billed, {_mean('paid_amount')} AS avg_paid,
       {_mean('flagged_for_review')} AS flagged_rate
FROM lines GROUP BY ALL""",
    "family_financials": f"""
SELECT claim_family, claim_status, payment_type, COUNT(*) AS lines,
       {_msum('billed_amount')} AS billed_total, {_msum('contract_rate')} AS contract_total,
       {_msum('paid_amount')} AS paid_total, {_msum('applied_to_deductible')} AS deductible_total,
       {_msum('coinsurance_amount')} AS coinsurance_total
FROM lines GROUP BY ALL""",
    "claim_level": f"""
SELECT {CK} AS claim_key, MAX(fraud_label) AS claim_fraud, MAX(flagged_for_review) AS claim_flag
FROM lines GROUP BY 1""",
    "encounter_level": """
SELECT encounter_id, MAX(fraud_label) AS encounter_fraud, MAX(flagged_for_review) AS encounter_flag
FROM lines GROUP BY 1""",
    "dataset_metrics": _with(LEVEL_RATES + f""",
b AS (
  SELECT COUNT(*) AS rows_, COUNT(DISTINCT member_id) AS um, COUNT(DISTINCT provider_id) AS up,
         COUNT(DISTINCT encounter_id) AS ue, {_rate("claim_status = 'denied'")} AS dr,
         {_rate("claim_family = 'pharmacy'")} AS ps, {_rate("claim_family = 'institutional'")} AS ins,
         {_mean('linked_facility_claim')} AS lk
  FROM lines
)""", """
SELECT metric, value FROM (
  SELECT 'rows' AS metric, CAST(rows_ AS DOUBLE) AS value FROM b
  UNION ALL SELECT 'unique_members', CAST(um AS DOUBLE) FROM b
  UNION ALL SELECT 'unique_providers', CAST(up AS DOUBLE) FROM b
  UNION ALL SELECT 'unique_encounters', CAST(ue AS DOUBLE) FROM b
  UNION ALL SELECT 'line_fraud_rate', ROUND(line_fraud_rate, 6) FROM lr
  UNION ALL SELECT 'line_flag_rate', ROUND(line_flag_rate, 6) FROM lr
  UNION ALL SELECT 'claim_fraud_rate', ROUND(claim_fraud_rate, 6) FROM lr
  UNION ALL SELECT 'claim_flag_rate', ROUND(claim_flag_rate, 6) FROM lr
  UNION ALL SELECT 'encounter_fraud_rate', ROUND(encounter_fraud_rate, 6) FROM lr
  UNION ALL SELECT 'encounter_flag_rate', ROUND(encounter_flag_rate, 6) FROM lr
  UNION ALL SELECT 'denial_rate', ROUND(dr, 6) FROM b
  UNION ALL SELECT 'pharmacy_share', ROUND(ps, 6) FROM b
  UNION ALL SELECT 'institutional_share', ROUND(ins, 6) FROM b
  UNION ALL SELECT 'linked_facility_professional_share', ROUND(lk, 6) FROM b
)"""),
    "dataset_metrics_v5": _with(f"""
b AS (
  SELECT COUNT(*) AS rows_, COUNT(DISTINCT member_id) AS um, COUNT(DISTINCT provider_id) AS up,
         COUNT(DISTINCT encounter_id) AS ue, {_mean('fraud_label')} AS lf, {_mean('flagged_for_review')} AS lg,
         {_rate("claim_status = 'denied'")} AS dr,
         {_rate("claim_family = 'pharmacy'")} AS ps, {_rate("claim_family = 'institutional'")} AS ins,
         {_mean('linked_facility_claim')} AS lk
  FROM lines
)""", """
SELECT metric, value FROM (
  SELECT 'rows' AS metric, CAST(rows_ AS DOUBLE) AS value FROM b
  UNION ALL SELECT 'unique_members', CAST(um AS DOUBLE) FROM b
  UNION ALL SELECT 'unique_providers', CAST(up AS DOUBLE) FROM b
  UNION ALL SELECT 'unique_encounters', CAST(ue AS DOUBLE) FROM b
  UNION ALL SELECT 'fraud_rate', ROUND(lf, 6) FROM b
  UNION ALL SELECT 'flag_rate', ROUND(lg, 6) FROM b
  UNION ALL SELECT 'denial_rate', ROUND(dr, 6) FROM b
  UNION ALL SELECT 'pharmacy_share', ROUND(ps, 6) FROM b
  UNION ALL SELECT 'institutional_share', ROUND(ins, 6) FROM b
  UNION ALL SELECT 'linked_facility_professional_share', ROUND(lk, 6) FROM b
)"""),
    "calibration_summary": _with(LEVEL_RATES.lstrip().rstrip(), """
SELECT level, fraud_rate, flag_rate, ROUND(flag_rate - fraud_rate, 6) AS flag_minus_fraud,
       flag_rate > fraud_rate AS flag_rate_exceeds_fraud_rate
FROM (
  SELECT 'line' AS level, ROUND(line_fraud_rate, 6) AS fraud_rate, ROUND(line_flag_rate, 6) AS flag_rate FROM lr
  UNION ALL SELECT 'claim', ROUND(claim_fraud_rate, 6), ROUND(claim_flag_rate, 6) FROM lr
  UNION ALL SELECT 'encounter', ROUND(encounter_fraud_rate, 6), ROUND(encounter_flag_rate, 6) FROM lr
)"""),
    "rule_reason_summary": """
SELECT rule_primary_reason_detected, flagged_for_review, COUNT(*) AS count FROM lines GROUP BY ALL""",
    "detection_by_fraud_type": f"""
SELECT fraud_type, COUNT(*) AS lines, {_mean('flagged_for_review')} AS flagged_rate,
       {_mean('rule_score')} AS avg_rule_score
FROM lines GROUP BY ALL""",
    "member_provider_history": f"""
SELECT member_id, provider_id, MIN(service_date) AS first_service_date, MAX(service_date) AS last_service_date,
       COUNT(*) AS line_count, {_msum('paid_amount')} AS paid_total,
       CAST(datediff('day', MIN(service_date), MAX(service_date)) AS INTEGER) AS days_between_first_last
FROM lines GROUP BY ALL""",
    "claim_status_reason": "SELECT claim_status, denial_reason, COUNT(*) AS count FROM lines GROUP BY ALL",
    "provider_summary_simple": f"""
SELECT a.*, p.max_day_volume FROM (
  SELECT provider_id, provider_specialty, provider_class, COUNT(*) AS lines, {_mean('allowed_amount')} AS avg_allowed,
         {_mean('fraud_label')} AS fraud_rate, {_mean('rule_score')} AS avg_rule_score
  FROM lines GROUP BY ALL) a
JOIN (SELECT provider_id, MAX(n) AS max_day_volume
      FROM (SELECT provider_id, service_date, COUNT(*) AS n FROM lines GROUP BY ALL) GROUP BY 1) p USING (provider_id)""",
    "fraud_breakdown_label": "SELECT fraud_type, fraud_label, COUNT(*) AS count FROM lines GROUP BY ALL",
    "rule_reason_by_label": """
SELECT rule_primary_reason_detected, fraud_label, COUNT(*) AS count FROM lines GROUP BY ALL""",
    "rule_recall_within_type": """
SELECT fraud_type, COUNT(*) AS n, CAST(SUM(flagged_for_review) AS BIGINT) AS caught,
       CAST(SUM(rule_score) AS DOUBLE) / COUNT(*) AS avg_rule_score,
       CASE WHEN COUNT(*) > 0 THEN CAST(SUM(flagged_for_review) AS DOUBLE) / COUNT(*) ELSE 0.0 END AS recall
FROM lines GROUP BY ALL""",
    "provider_rollup": """
SELECT provider_id, COUNT(*) AS lines, CAST(SUM(fraud_label) AS BIGINT) AS fraud_lines,
       CAST(SUM(flagged_for_review) AS BIGINT) AS flagged_lines, CAST(SUM(allowed_amount) AS DOUBLE) AS allowed_total,
       MAX(p.max_day_lines) AS max_day_lines,
       CAST(SUM(fraud_label) AS DOUBLE) / COUNT(*) AS fraud_rate,
       CAST(SUM(flagged_for_review) AS DOUBLE) / COUNT(*) AS flag_rate
FROM lines JOIN (SELECT provider_id, MAX(n) AS max_day_lines
                 FROM (SELECT provider_id, service_date, COUNT(*) AS n FROM lines GROUP BY ALL) GROUP BY 1) p
     USING (provider_id)
GROUP BY provider_id""",
    "family_profile": f"""
SELECT claim_family, COUNT(*) AS line_count, {_msum('billed_amount')} AS billed_total,
       {_msum('allowed_amount')} AS allowed_total, {_msum('paid_amount')} AS paid_total,
       {_mean('billed_amount')} AS avg_billed, {_mean('paid_amount')} AS avg_paid,
       {_mean('fraud_label')} AS fraud_rate, {_rate("claim_status = 'denied'")} AS denial_rate,
       COUNT(DISTINCT {CK}) AS claim_count
FROM lines GROUP BY ALL""",
    "provider_profile": f"""
SELECT provider_id, provider_specialty, provider_class, COUNT(*) AS line_count,
       {_mean('billed_amount')} AS avg_billed, {_mean('paid_amount')} AS avg_paid,
       {_mean('fraud_label')} AS fraud_rate, {_mean('flagged_for_review')} AS flag_rate,
       {_rate("claim_status = 'denied'")} AS denial_rate,
       MIN(service_date) AS first_service_date, MAX(service_date) AS last_service_date,
       COUNT(DISTINCT {CK}) AS claim_count, COUNT(DISTINCT member_id) AS member_count
FROM lines GROUP BY ALL""",
    "fraud_profile": f"""
SELECT fraud_type, COUNT(*) AS line_count, {_mean('billed_amount')} AS avg_billed, {_mean('paid_amount')} AS avg_paid,
       COUNT(DISTINCT {CK}) AS claim_count, COUNT(DISTINCT provider_id) AS provider_count,
       COUNT(DISTINCT member_id) AS member_count
FROM lines GROUP BY ALL""",
    "reason_precision": """
SELECT rule_primary_reason_detected, COUNT(*) AS flag_count,
       CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () AS share_of_all_flags,
       CAST(SUM(fraud_label) AS BIGINT) AS true_fraud_count,
       CAST(SUM(fraud_label) AS DOUBLE) / COUNT(*) AS precision_within_reason
FROM lines WHERE flagged_for_review = 1 GROUP BY ALL""",
    "relationship_profile": f"""
SELECT member_id, provider_id, COUNT(*) AS line_count, {_msum('paid_amount')} AS paid_total,
       {_mean('paid_amount')} AS avg_paid, COUNT(DISTINCT {CK}) AS claim_count,
       COUNT(DISTINCT CASE WHEN fraud_type <> 'none' THEN fraud_type END) AS distinct_fraud_types
FROM lines GROUP BY ALL""",
    "status_profile": f"""
SELECT claim_status, denial_reason, COUNT(*) AS line_count,
       CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () AS share_of_lines,
       {_msum('billed_amount')} AS billed_total, {_msum('paid_amount')} AS paid_total
FROM lines GROUP BY ALL""",
    "dataset_profile": _with(f"""
b AS (
  SELECT COUNT(*) AS lines_, COUNT(DISTINCT {CK}) AS claims, COUNT(DISTINCT encounter_id) AS encounters,
         COUNT(DISTINCT member_id) AS members, COUNT(DISTINCT provider_id) AS providers,
         {_mean('fraud_label')} AS fraud_rate, {_rate("claim_status = 'denied'")} AS denial_rate,
         {_rate("claim_status = 'paid'")} AS paid_rate, {_mean('billed_amount')} AS avg_billed,
         {_mean('allowed_amount')} AS avg_allowed, {_mean('paid_amount')} AS avg_paid
  FROM lines
)""", """
SELECT metric, value FROM (
  SELECT 'lines' AS metric, ROUND(CAST(lines_ AS DOUBLE), 6) AS value FROM b
  UNION ALL SELECT 'claims', ROUND(CAST(claims AS DOUBLE), 6) FROM b
  UNION ALL SELECT 'encounters', ROUND(CAST(encounters AS DOUBLE), 6) FROM b
  UNION ALL SELECT 'members', ROUND(CAST(members AS DOUBLE), 6) FROM b
  UNION ALL SELECT 'providers', ROUND(CAST(providers AS DOUBLE), 6) FROM b
  UNION ALL SELECT 'fraud_rate', ROUND(fraud_rate, 6) FROM b
  UNION ALL SELECT 'denial_rate', ROUND(denial_rate, 6) FROM b
  UNION ALL SELECT 'paid_rate', ROUND(paid_rate, 6) FROM b
  UNION ALL SELECT 'avg_billed', ROUND(avg_billed, 6) FROM b
  UNION ALL SELECT 'avg_allowed', ROUND(avg_allowed, 6) FROM b
  UNION ALL SELECT 'avg_paid', ROUND(avg_paid, 6) FROM b
)"""),
    "denial_clusters": """
SELECT d.claim_family, d.denial_reason, d.denied_lines, f.family_lines,
       CAST(d.denied_lines AS DOUBLE) / f.family_lines AS denial_rate
FROM (SELECT claim_family, denial_reason, COUNT(*) AS denied_lines FROM lines WHERE claim_status = 'denied' GROUP BY ALL) d
JOIN (SELECT claim_family, COUNT(*) AS family_lines FROM lines GROUP BY ALL) f USING (claim_family)""",
    "fraud_concentration": """
SELECT fraud_type, CAST(SUM(n) FILTER (WHERE r <= 3) AS BIGINT) AS top_k_lines, CAST(SUM(n) AS BIGINT) AS type_lines,
       CAST(SUM(n) FILTER (WHERE r <= 3) AS DOUBLE) / SUM(n) AS top_k_share
FROM (SELECT fraud_type, provider_id, n, ROW_NUMBER() OVER (PARTITION BY fraud_type ORDER BY n DESC, provider_id) AS r
      FROM (SELECT fraud_type, provider_id, COUNT(*) AS n FROM lines WHERE fraud_label = 1 GROUP BY ALL))
GROUP BY fraud_type""",
    "specialty_suspicion": f"""
SELECT provider_specialty, COUNT(*) AS lines, {_mean('flagged_for_review')} AS flag_rate, {_mean('fraud_label')} AS fraud_rate
FROM lines GROUP BY ALL""",
    "persistent_relationships": """
SELECT member_id, provider_id, COUNT(DISTINCT service_date) AS flagged_dates,
       MIN(service_date) AS first_flagged_date, MAX(service_date) AS last_flagged_date,
       CAST(datediff('day', MIN(service_date), MAX(service_date)) AS INTEGER) AS span_days
FROM lines WHERE flagged_for_review = 1 GROUP BY ALL HAVING COUNT(DISTINCT service_date) >= 2""",
    "episode_summary": """
SELECT episode_id,
       COUNT(*) FILTER (WHERE claim_family = 'institutional') AS facility_lines,
       CAST(SUM(CASE WHEN claim_family = 'institutional' THEN billed_amount ELSE 0 END) AS DOUBLE) AS facility_billed,
       CAST(SUM(CASE WHEN claim_family = 'institutional' THEN paid_amount ELSE 0 END) AS DOUBLE) AS facility_paid,
       COUNT(*) FILTER (WHERE linked_facility_claim = 1) AS professional_lines,
       CAST(SUM(CASE WHEN linked_facility_claim = 1 THEN billed_amount ELSE 0 END) AS DOUBLE) AS professional_billed,
       CAST(SUM(CASE WHEN linked_facility_claim = 1 THEN paid_amount ELSE 0 END) AS DOUBLE) AS professional_paid,
       MAX(flagged_for_review) AS episode_flag, MAX(fraud_label) AS episode_fraud
FROM lines GROUP BY episode_id HAVING COUNT(*) FILTER (WHERE claim_family = 'institutional') > 0""",
    "confusion_counts": """
SELECT COUNT(*) FILTER (WHERE fraud_label = 1 AND flagged_for_review = 1) AS tp,
       COUNT(*) FILTER (WHERE fraud_label <> 1 AND flagged_for_review = 1) AS fp,
       COUNT(*) FILTER (WHERE fraud_label = 1 AND flagged_for_review <> 1) AS fn,
       COUNT(*) FILTER (WHERE fraud_label <> 1 AND flagged_for_review <> 1) AS tn
FROM lines""",
    "rule_vs_label_by_level": f"""
SELECT 'line' AS level, fraud_label AS fraud, flagged_for_review AS flag, COUNT(*) AS count FROM lines GROUP BY ALL
UNION ALL
SELECT 'claim', f, g, COUNT(*) FROM (SELECT MAX(fraud_label) AS f, MAX(flagged_for_review) AS g FROM lines GROUP BY {CK}) GROUP BY ALL
UNION ALL
SELECT 'encounter', f, g, COUNT(*) FROM (SELECT MAX(fraud_label) AS f, MAX(flagged_for_review) AS g FROM lines GROUP BY encounter_id) GROUP BY ALL""",
    "roc_auc_rule_score": """
SELECT CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0
            THEN ROUND((SUM(pos * neg_below) + SUM(pos * neg) * 0.5) / (SUM(pos) * SUM(neg)), 9) END AS roc_auc
FROM (SELECT s, pos, neg, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
      FROM (SELECT CAST(rule_score AS DOUBLE) AS s, COUNT(*) FILTER (WHERE fraud_label = 1) AS pos,
                   COUNT(*) FILTER (WHERE fraud_label <> 1) AS neg FROM lines GROUP BY 1))""",
}


def _metrics_sql() -> str:
    return """
SELECT tp, fp, fn, tn, ROUND(p, 9) AS precision, ROUND(r, 9) AS recall, fraud_rate, flag_rate,
       ROUND(2 * p * r / (p + r + 1e-9), 9) AS f1
FROM (SELECT tp, fp, fn, tn, CAST(tp AS DOUBLE) / GREATEST(tp + fp, 1) AS p, CAST(tp AS DOUBLE) / GREATEST(tp + fn, 1) AS r,
             CAST(tp + fn AS DOUBLE) / (tp + fp + fn + tn) AS fraud_rate, CAST(tp + fp AS DOUBLE) / (tp + fp + fn + tn) AS flag_rate
      FROM (SELECT COUNT(*) FILTER (WHERE fraud_label = 1 AND flagged_for_review = 1) AS tp,
                   COUNT(*) FILTER (WHERE fraud_label <> 1 AND flagged_for_review = 1) AS fp,
                   COUNT(*) FILTER (WHERE fraud_label = 1 AND flagged_for_review <> 1) AS fn,
                   COUNT(*) FILTER (WHERE fraud_label <> 1 AND flagged_for_review <> 1) AS tn FROM lines))"""


def _perf_sql(name: str) -> str:
    return f"""
SELECT '{name}' AS model, ROUND(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 9) AS accuracy, ROUND(p, 9) AS precision,
       ROUND(r, 9) AS recall, ROUND(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 9) AS f1, tn, fp, fn, tp
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS p,
                CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS r
      FROM (SELECT COUNT(*) FILTER (WHERE fraud_label = 1 AND flagged_for_review = 1) AS tp,
                   COUNT(*) FILTER (WHERE fraud_label <> 1 AND flagged_for_review = 1) AS fp,
                   COUNT(*) FILTER (WHERE fraud_label = 1 AND flagged_for_review <> 1) AS fn,
                   COUNT(*) FILTER (WHERE fraud_label <> 1 AND flagged_for_review <> 1) AS tn FROM lines))"""


SUMMARY_SQL["rule_metrics"] = _metrics_sql()
SUMMARY_SQL["model_performance_rules"] = _perf_sql("rules_v6")
