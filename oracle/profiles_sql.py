"""Oracle SQL for the v5 / v2 / first-script profiles and the incremental rollups."""

from __future__ import annotations

from oracle.v6_sql import V6_OUT, v6_lines_select, with_lines

VOLUME = 3
CHUNK = 4096

_SEEDED_IDS = "SELECT s.*, printf('L%09d_%08d', enc_key, claim_line_no) AS line_id_s FROM seeded s"

V5 = f"""
SELECT line_id,
  CASE WHEN duplicate_signature_count > 1 THEN 1 ELSE 0 END AS rule_duplicate,
  CASE WHEN provider_day_claim_count >= {VOLUME} THEN 1 ELSE 0 END AS rule_provider_volume,
  CASE WHEN billed_to_contract_ratio >= 6.0 THEN 1 ELSE 0 END AS rule_egregious_billed,
  CASE WHEN contract_to_allowed_ratio >= 1.25 THEN 1 ELSE 0 END AS rule_price_above_contract,
  COALESCE(external_edit_flag, 0) AS rule_external_edit,
  CASE WHEN claim_status = 'denied' AND provider_class IN ('medium_risk', 'bad_actor') THEN 1 ELSE 0 END AS rule_denied_repeat,
  rule_primary_reason
FROM lines"""


def _v5_select() -> str:
    return f"""
SELECT line_id, rule_duplicate, rule_provider_volume, rule_egregious_billed, rule_price_above_contract,
       rule_external_edit, rule_denied_repeat, CAST(score AS INTEGER) AS rule_score,
       CASE WHEN score >= 2 THEN 1 ELSE 0 END AS flagged_for_review, rule_primary_reason
FROM (SELECT *, rule_duplicate + rule_provider_volume + rule_egregious_billed + rule_price_above_contract
                + rule_external_edit + rule_denied_repeat AS score FROM ({V5}))"""


def _v2() -> str:
    return f"""
SELECT line_id_s AS line_id, duplicate_signature_count, provider_day_claim_count, provider_avg_allowed, code_avg_allowed,
       allowed_to_code_avg_ratio, billed_to_allowed_ratio, provider_fraud_rate,
       rule_duplicate, rule_excessive_units, rule_provider_volume, rule_high_amount_ratio, rule_high_billed_allowed,
       rule_suspicious_or, rule_suspicious_ed,
       CAST(rule_duplicate + rule_excessive_units + rule_provider_volume + rule_high_amount_ratio + rule_high_billed_allowed
            + rule_suspicious_or + rule_suspicious_ed AS INTEGER) AS rule_score,
       CASE WHEN rule_duplicate + rule_excessive_units + rule_provider_volume + rule_high_amount_ratio
                 + rule_high_billed_allowed + rule_suspicious_or + rule_suspicious_ed >= 2 THEN 1 ELSE 0 END AS rule_pred,
       CASE WHEN rule_duplicate = 1 THEN 'duplicate_signature' WHEN rule_excessive_units = 1 THEN 'excessive_units'
            WHEN rule_suspicious_or = 1 THEN 'high_or_cost' WHEN rule_suspicious_ed = 1 THEN 'high_ed_cost'
            WHEN rule_high_amount_ratio = 1 THEN 'high_code_cost_ratio'
            WHEN rule_provider_volume = 1 THEN 'high_provider_day_volume'
            WHEN rule_high_billed_allowed = 1 THEN 'high_billed_allowed_ratio' ELSE 'no_rule' END AS rule_primary_reason
FROM (
  SELECT *,
    CASE WHEN duplicate_signature_count > 1 THEN 1 ELSE 0 END AS rule_duplicate,
    CASE WHEN (claim_family = 'professional' AND units >= 8) OR (claim_family = 'institutional' AND units >= 12)
         THEN 1 ELSE 0 END AS rule_excessive_units,
    CASE WHEN provider_day_claim_count >= {VOLUME} THEN 1 ELSE 0 END AS rule_provider_volume,
    CASE WHEN allowed_to_code_avg_ratio >= 2.0 THEN 1 ELSE 0 END AS rule_high_amount_ratio,
    CASE WHEN billed_to_allowed_ratio >= 1.55 THEN 1 ELSE 0 END AS rule_high_billed_allowed,
    CASE WHEN revenue_code = '0360' AND allowed_to_code_avg_ratio >= 1.8 THEN 1 ELSE 0 END AS rule_suspicious_or,
    CASE WHEN revenue_code = '0450' AND allowed_to_code_avg_ratio >= 1.7 THEN 1 ELSE 0 END AS rule_suspicious_ed
  FROM (
    SELECT *, CAST(allowed_amount AS DOUBLE) / GREATEST(code_avg_allowed, 1.0) AS allowed_to_code_avg_ratio,
              CAST(billed_amount AS DOUBLE) / GREATEST(CAST(allowed_amount AS DOUBLE), 1.0) AS billed_to_allowed_ratio
    FROM (
      SELECT *,
        COUNT(*) OVER (PARTITION BY member_id, provider_id, service_date, diagnosis_code, service_code, revenue_code,
                       allowed_amount) AS duplicate_signature_count,
        COUNT(*) OVER (PARTITION BY provider_id, service_date) AS provider_day_claim_count,
        CAST(SUM(allowed_amount) OVER (PARTITION BY provider_id) AS DOUBLE) / COUNT(*) OVER (PARTITION BY provider_id)
          AS provider_avg_allowed,
        CAST(SUM(allowed_amount) OVER (PARTITION BY code_key) AS DOUBLE) / COUNT(*) OVER (PARTITION BY code_key)
          AS code_avg_allowed,
        AVG(CAST(fraud_label AS DOUBLE)) OVER (PARTITION BY provider_id) AS provider_fraud_rate
      FROM (SELECT *, CASE WHEN claim_family = 'institutional' THEN revenue_code ELSE service_code END AS code_key
            FROM ({_SEEDED_IDS})))))"""


def _fd_features() -> str:
    """The seeded lines with the first script's features."""
    return f"""
    SELECT *,
      CASE WHEN procedure_avg_allowed > 0 THEN CAST(allowed_amount AS DOUBLE) / procedure_avg_allowed END
        AS allowed_to_proc_avg_ratio,
      CASE WHEN allowed_amount > 0 THEN CAST(billed_amount AS DOUBLE) / CAST(allowed_amount AS DOUBLE) END
        AS billed_to_allowed_ratio
    FROM (
      SELECT *,
        COUNT(*) OVER (PARTITION BY member_id, provider_id, service_date, diagnosis_code, service_code, allowed_amount)
          AS duplicate_signature_count,
        COUNT(*) OVER (PARTITION BY provider_id, service_date) AS provider_day_claim_count,
        CAST(SUM(allowed_amount) OVER (PARTITION BY provider_id) AS DOUBLE) / COUNT(*) OVER (PARTITION BY provider_id)
          AS provider_avg_allowed,
        CAST(SUM(allowed_amount) OVER (PARTITION BY service_code) AS DOUBLE) / COUNT(*) OVER (PARTITION BY service_code)
          AS procedure_avg_allowed
      FROM ({_SEEDED_IDS}))"""


def _fd() -> str:
    return f"""
SELECT line_id_s AS line_id, duplicate_signature_count, provider_day_claim_count, provider_avg_allowed,
       procedure_avg_allowed, allowed_to_proc_avg_ratio, billed_to_allowed_ratio,
       rule_duplicate, rule_excessive_units, rule_provider_volume, rule_high_amount_ratio, rule_high_billed_allowed,
       CAST(rule_duplicate + rule_excessive_units + rule_provider_volume + rule_high_amount_ratio
            + rule_high_billed_allowed AS INTEGER) AS rule_score,
       CASE WHEN rule_duplicate + rule_excessive_units + rule_provider_volume + rule_high_amount_ratio
                 + rule_high_billed_allowed >= 2 THEN 1 ELSE 0 END AS rule_pred
FROM (
  SELECT *,
    CASE WHEN duplicate_signature_count > 1 THEN 1 ELSE 0 END AS rule_duplicate,
    CASE WHEN units >= 8 THEN 1 ELSE 0 END AS rule_excessive_units,
    CASE WHEN provider_day_claim_count >= {VOLUME} THEN 1 ELSE 0 END AS rule_provider_volume,
    COALESCE(CASE WHEN allowed_to_proc_avg_ratio >= 2.0 THEN 1 ELSE 0 END, 0) AS rule_high_amount_ratio,
    COALESCE(CASE WHEN billed_to_allowed_ratio >= 1.5 THEN 1 ELSE 0 END, 0) AS rule_high_billed_allowed
  FROM ({_fd_features()}))"""


def _fd_vector() -> str:
    """The 15 model inputs."""
    plain = ("units", "billed_amount", "allowed_amount", "paid_amount", "member_age", "chronic_score")
    made = ("provider_day_claim_count", "duplicate_signature_count", "provider_avg_allowed", "procedure_avg_allowed",
            "allowed_to_proc_avg_ratio", "billed_to_allowed_ratio")
    cols = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in plain + made)
    return f"""
SELECT line_id_s AS line_id, fraud_label, {cols}, CAST(contract_discount_rate AS DOUBLE) AS provider_risk_score,
       CASE WHEN place_of_service = '02' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS telehealth_flag,
       CASE WHEN place_of_service = '21' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS inpatient_flag
FROM ({_fd_features()})"""


def _reprice() -> str:
    """P10 over the seeded lines."""
    from oracle.v6_sql import money, unif
    return f"""
SELECT line_id_s AS line_id, contract_rate_id, CAST(billed_amount AS DOUBLE) AS billed_amount,
       CAST(CASE WHEN billed_amount < 0 THEN billed_amount ELSE {money('billed_amount * factor * share')} END AS DOUBLE)
         AS contracted_allowed
FROM (
  SELECT *, CAST(CASE contract_rate_id WHEN 'COMM_A' THEN 1.00 WHEN 'COMM_B' THEN 0.92 WHEN 'COMM_C' THEN 0.85
                                       WHEN 'MEDICARE_LIKE' THEN 0.78 WHEN 'OON' THEN 0.55 END AS DECIMAL(3,2)) AS factor,
         CASE WHEN encounter_type = 'member_submitted' THEN {unif('line_key', 'reprice', '0.85', '1.00')}
              ELSE CAST(1 AS DECIMAL(10,6)) END AS share
  FROM (SELECT *, CASE WHEN encounter_type = 'member_submitted' THEN 'OON' WHEN plan_type = 'gold' THEN 'COMM_A'
                       WHEN plan_type = 'silver' THEN 'COMM_B' WHEN plan_type = 'bronze' THEN 'COMM_C'
                       WHEN plan_type = 'self_funded' THEN 'MEDICARE_LIKE' END AS contract_rate_id
        FROM ({_SEEDED_IDS})))"""


_CHUNKED = f"(SELECT *, enc_key // {CHUNK} AS chunk_id FROM lines)"

PARTIALS = f"""
SELECT provider_id, COUNT(*) AS lines, CAST(SUM(f) AS BIGINT) AS fraud_lines, CAST(SUM(g) AS BIGINT) AS flagged_lines,
       CAST(SUM(a) AS DOUBLE) AS allowed_total, MAX(n) AS max_day_lines,
       CAST(SUM(f) AS DOUBLE) / COUNT(*) AS fraud_rate, CAST(SUM(g) AS DOUBLE) / COUNT(*) AS flag_rate
FROM (SELECT provider_id, chunk_id, fraud_label AS f, flagged_for_review AS g, allowed_amount AS a,
             COUNT(*) OVER (PARTITION BY chunk_id, provider_id, service_date) AS n FROM {_CHUNKED})
GROUP BY provider_id"""


def _h32(key: str, salt: str) -> str:
    return f"('0x' || substr(md5({key} || '|{salt}'), 1, 8))::BIGINT"


def _ratio4(num: str, den: str) -> str:
    n = f"CAST(({num}) * 100 AS BIGINT)"
    d = f"CAST(GREATEST({den}, 1.00) * 100 AS BIGINT)"
    return f"((2 * {n} * 10000 + {d}) // (2 * {d}))::DOUBLE / 10000.0"


def _more_sql() -> dict[str, str]:
    from oracle.v6_sql import h, scored_ctes, shaped_ctes
    ck = "(encounter_id || '|' || provider_id || '|' || claim_family)"
    expected = ("CAST(ROUND(allowed_amount * (1 - CASE WHEN provider_specialty = 'Hospital' THEN 0.35 "
                "ELSE COALESCE(contract_discount_rate, 0.25) END), 2) AS DECIMAL(18,2))")
    trend = f"(6500 + 4 * {h('line_key', 'trend')})"
    rem = (f"CAST((GREATEST(CAST(deductible_remaining_start * 100 AS BIGINT) * (3650000 - dayofyear(service_date) * {trend}), 0)"
           f" * 2 + 3650000) // 7300000 AS DECIMAL(18,0)) * 0.01")
    return {
        "dictionary_fields": with_lines(f"""
SELECT line_id, CAST(applied_to_deductible + coinsurance_amount AS DOUBLE) AS member_liability_amount,
       {_ratio4('billed_amount', 'allowed_amount')} AS charge_to_allowed_ratio,
       {_ratio4('allowed_amount', 'contract_rate')} AS allowed_to_contract_ratio,
       COUNT(*) OVER (PARTITION BY {ck}) AS service_line_count,
       rule_duplicate AS duplicate_flag, rule_egregious_billed AS egregious_charge_flag,
       CAST(e AS DOUBLE) AS expected_contract_rate, CAST(GREATEST(contract_rate - e, 0) AS DOUBLE) AS pricing_error_amount,
       CASE WHEN contract_rate <> e THEN 1 ELSE 0 END AS contract_mismatch_flag
FROM (SELECT *, {expected} AS e FROM lines)"""),
        "top_suspicious_providers": with_lines(TOP_PROVIDERS + """
ORDER BY fraud_rate DESC, avg_rule_score DESC, avg_allowed DESC, provider_id LIMIT 10"""),
        "top_suspicious_providers_fd": with_lines(TOP_PROVIDERS + """
ORDER BY fraud_rate DESC, avg_allowed DESC, max_day_volume DESC, provider_id LIMIT 10"""),
        "top_fraud_types": with_lines("""
SELECT fraud_type, COUNT(*) AS count FROM lines GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
        "top_rule_reasons": with_lines("""
SELECT rule_primary_reason_detected, COUNT(*) AS count FROM lines GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
        "v5_lines": v5_lines_sql(),
        "adjudicate_initial": "WITH " + shaped_ctes() + f"""
SELECT enc_key AS order_key, CAST(claim_line_no AS INTEGER) AS claim_line_no, claim_status,
       CAST(contract_rate AS DOUBLE) AS contract_rate,
       CAST(CASE WHEN claim_status = 'denied' THEN 0 ELSE ded0 END AS DOUBLE) AS applied_to_deductible,
       CAST(CASE WHEN claim_status = 'denied' THEN 0 ELSE ROUND(rest * coinsurance_rate, 2) END AS DOUBLE) AS coinsurance_amount,
       CAST(CASE WHEN claim_status = 'denied' THEN 0 ELSE ROUND(rest * (1 - coinsurance_rate), 2) END AS DOUBLE) AS paid_amount
FROM (SELECT *, GREATEST(contract_rate - ded0, 0) AS rest
      FROM (SELECT *, LEAST(contract_rate, CAST({rem} AS DECIMAL(18,2))) AS ded0 FROM shaped2))""",
        "features_chunk_scope": scored_ctes(chunk=CHUNK) + """
SELECT line_id, chunk_id, duplicate_signature_count, provider_day_claim_count, provider_avg_contract_rate,
       service_code_avg_contract_rate, CAST(rule_score AS INTEGER) AS rule_score, flagged_for_review
FROM lines""",
        "line_flags": with_lines("""
SELECT line_id, CASE WHEN member_age >= 70 OR chronic_score >= 4 THEN 1 ELSE 0 END AS high_risk_member,
       CASE WHEN provider_specialty = 'Hospital' THEN 'facility' ELSE 'professional' END AS provider_type,
       CASE WHEN place_of_service = '02' THEN 1 ELSE 0 END AS telehealth_flag,
       CASE WHEN place_of_service = '21' THEN 1 ELSE 0 END AS inpatient_flag,
       CASE WHEN place_of_service = '23' THEN 1 ELSE 0 END AS emergency_flag,
       CAST(10000 + GREATEST(member_age - 50, 0) * 20 AS DOUBLE) / 10000.0 AS age_factor,
       LEAST(GREATEST(units, 1), 6) AS clipped_units
FROM lines"""),
    }


TOP_PROVIDERS = """
SELECT a.*, p.max_day_volume FROM (
  SELECT provider_id, provider_specialty, provider_class, COUNT(*) AS lines,
         CAST(SUM(allowed_amount) AS DOUBLE) / COUNT(*) AS avg_allowed,
         CAST(SUM(fraud_label) AS DOUBLE) / COUNT(*) AS fraud_rate, CAST(SUM(rule_score) AS DOUBLE) / COUNT(*) AS avg_rule_score
  FROM lines GROUP BY ALL) a
JOIN (SELECT provider_id, MAX(n) AS max_day_volume
      FROM (SELECT provider_id, service_date, COUNT(*) AS n FROM lines GROUP BY ALL) GROUP BY 1) p USING (provider_id)"""

# Columns that v5 computes with its own rules.
V5_OWN = ["rule_duplicate", "rule_provider_volume", "rule_egregious_billed", "rule_price_above_contract", "rule_external_edit",
          "rule_denied_repeat", "rule_score", "flagged_for_review", "rule_primary_reason"]
V5_ABSENT = {"rule_upcoding_pattern", "rule_member_submit_outlier", "strong_rule_hit", "pricing_error_signal",
             "egregious_charge_signal", "upcoding_signal", "member_submit_outlier_signal", "rule_primary_reason_detected"}


def v5_lines_sql() -> str:
    cols = ", ".join(f"{'r' if c in V5_OWN else 'l'}.{c}" for c, _ in V6_OUT if c not in V5_ABSENT)
    return (f"SELECT {cols} FROM ({with_lines(v6_lines_select())}) l "
            f"JOIN ({with_lines(_v5_select())}) r USING (line_id)").replace("SELECT l.line_id", "SELECT line_id", 1)


def profile_sql() -> dict[str, str]:
    return {
        **_more_sql(),
        "stratified_split": with_lines(f"""
SELECT line_id, fraud_label,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY fraud_label ORDER BY {_h32('line_id', 'split')}, line_id)
                 <= FLOOR(COUNT(*) OVER (PARTITION BY fraud_label) * 0.3) THEN 1 ELSE 0 END AS is_test
FROM lines"""),
        "chunk_manifest": with_lines(f"""
SELECT chunk_id AS chunk_number, printf('claims_lines_chunk_%03d.parquet', chunk_id) AS chunk_file, 'parquet' AS format,
       COUNT(*) AS rows, MIN(service_date) AS min_service_date, MAX(service_date) AS max_service_date
FROM {_CHUNKED} GROUP BY chunk_id"""),
        "sample_per_chunk": with_lines(f"""
SELECT line_id, chunk_id, fraud_type FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY {_h32('line_id', 'sample_total')}, line_id) AS r2 FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY chunk_id ORDER BY {_h32('line_id', 'sample')}, line_id) AS r1
    FROM {_CHUNKED}) WHERE r1 <= 1500) WHERE r2 <= 4000"""),
        "union_families": with_lines("""
SELECT line_id, claim_family, drug_name, drug_type, ndc, CAST(days_supply AS DOUBLE) AS days_supply FROM lines WHERE claim_family = 'pharmacy'
UNION ALL BY NAME SELECT line_id, claim_family, revenue_code FROM lines WHERE claim_family = 'institutional'
UNION ALL BY NAME SELECT line_id, claim_family FROM lines WHERE claim_family NOT IN ('pharmacy', 'institutional')"""),
        "write_lines": with_lines(f"SELECT line_id, chunk_id, fraud_label FROM {_CHUNKED}"),
        "write_summary_csv": with_lines("SELECT fraud_type, claim_family, COUNT(*) AS count FROM lines GROUP BY ALL"),
        "rules_v5": with_lines(_v5_select()),
        "rule_reason_summary_v5": with_lines(f"""
SELECT rule_primary_reason, flagged_for_review, COUNT(*) AS count FROM ({_v5_select()}) GROUP BY ALL"""),
        "rules_v2": with_lines(_v2()),
        "rules_fd": with_lines(_fd()),
        "feature_vector": with_lines(_fd_vector()),
        "contract_reprice": with_lines(_reprice()),
        "merge_provider_partials": with_lines(PARTIALS),
        "stream_provider_rollup": with_lines(PARTIALS),
        "merge_counts": with_lines(f"SELECT fraud_type, COUNT(*) AS count FROM {_CHUNKED} GROUP BY ALL"),
        "merge_confusion": with_lines("""
SELECT COUNT(*) FILTER (WHERE fraud_label = 1 AND flagged_for_review = 1) AS tp,
       COUNT(*) FILTER (WHERE fraud_label <> 1 AND flagged_for_review = 1) AS fp,
       COUNT(*) FILTER (WHERE fraud_label = 1 AND flagged_for_review <> 1) AS fn,
       COUNT(*) FILTER (WHERE fraud_label <> 1 AND flagged_for_review <> 1) AS tn FROM lines"""),
        "merge_detection": with_lines("""
SELECT fraud_type, COUNT(*) AS n, CAST(SUM(flagged_for_review) AS BIGINT) AS caught,
       CAST(SUM(rule_score) AS DOUBLE) / COUNT(*) AS avg_rule_score,
       CAST(SUM(flagged_for_review) AS DOUBLE) / COUNT(*) AS recall
FROM lines GROUP BY ALL"""),
    }


def append_fixed_rate_sql() -> str:
    """F19-F21 oracle over the shaped lines."""
    from oracle.v6_sql import h, money, shaped_ctes, unif

    def pick(kind: str, rate: str) -> str:
        return (f"(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {_h32('line_key', f'fd_{kind}_pick')}, line_key) AS r,"
                f" COUNT(*) OVER () AS n FROM shaped2) WHERE r <= FLOOR(n * {rate}))")

    def u(salt: str, lo: str, hi: str) -> str:
        return unif("line_key", salt, lo, hi)

    cols = "claim_id, line_key, fraud_type, 1 AS fraud_label, provider_id, service_code, CAST(units AS INTEGER) AS units"
    money_cols = ("CAST(allowed_amount AS DOUBLE) AS allowed_amount, CAST(billed_amount AS DOUBLE) AS billed_amount, "
                  "CAST(paid_amount AS DOUBLE) AS paid_amount")
    return "WITH " + shaped_ctes() + f""",
outlier AS (
  SELECT provider_id, CAST(ROW_NUMBER() OVER (ORDER BY {h('provider_id', 'fd_outlier_provider')}, provider_id) - 1 AS INTEGER) AS idx
  FROM (SELECT printf('P%06d', s_suppkey + 1) AS provider_id FROM supplier)
  QUALIFY idx < 3
),
dup AS (SELECT 'FDUP' || line_key AS claim_id, line_key, 'duplicate_billing' AS fraud_type, provider_id, service_code, units,
               allowed_amount, billed_amount, CAST(NULL AS DECIMAL(18,2)) AS paid_amount FROM {pick('duplicate_billing', '0.015')}),
exu0 AS (SELECT *, 8 + {h('line_key', 'fd_exu_units')} % 13 AS u2 FROM {pick('excessive_units', '0.012')}),
exu1 AS (SELECT *, {money(f"base_allowed * u2 * {u('fd_exu_a', '1.0', '1.3')}")} AS a2 FROM exu0),
exu AS (SELECT 'FEXU' || line_key AS claim_id, line_key, 'excessive_units' AS fraud_type, provider_id, service_code, u2 AS units,
               a2 AS allowed_amount, {money(f"a2 * {u('fd_exu_b', '1.20', '1.60')}")} AS billed_amount,
               {money(f"a2 * {u('fd_exu_p', '0.80', '1.00')}")} AS paid_amount FROM exu1),
upc1 AS (SELECT *, {money(f"210.00 * {u('fd_upc_a', '1.00', '1.20')}")} AS a2 FROM {pick('upcoding', '0.010')}),
upc AS (SELECT 'FUPC' || line_key AS claim_id, line_key, 'upcoding' AS fraud_type, provider_id, '99215' AS service_code, 1 AS units,
               a2 AS allowed_amount, {money(f"a2 * {u('fd_upc_b', '1.25', '1.60')}")} AS billed_amount,
               {money(f"a2 * {u('fd_upc_p', '0.85', '1.00')}")} AS paid_amount FROM upc1),
unb0 AS (SELECT s.*, p.part FROM {pick('unbundling', '0.008')} s, (VALUES ('A'), ('B')) p(part)),
unb1 AS (SELECT *, CASE WHEN part = 'A' THEN ROUND({u('fd_unb_a', '6', '12')}, 2) ELSE ROUND({u('fd_unb_b', '18', '35')}, 2) END AS a2
         FROM unb0),
unb AS (SELECT 'FUN' || part || line_key AS claim_id, line_key, 'unbundling' AS fraud_type, provider_id,
               CASE WHEN part = 'A' THEN '36415' ELSE '85025' END AS service_code, units, a2 AS allowed_amount,
               {money(f"a2 * {u('fd_unb_bill', '1.2', '1.5')}")} AS billed_amount,
               {money(f"a2 * {u('fd_unb_paid', '0.8', '1.0')}")} AS paid_amount FROM unb1),
pro0 AS (SELECT s.* EXCLUDE (provider_id), o.provider_id, 4 + {h('line_key', 'fd_pro_units')} % 8 AS u2
         FROM {pick('provider_outlier', '0.010')} s JOIN outlier o ON o.idx = {h('line_key', 'fd_pro_pick')} % 3),
pro1 AS (SELECT *, {money(f"base_allowed * u2 * {u('fd_pro_a', '1.3', '1.8')}")} AS a2 FROM pro0),
pro AS (SELECT 'FPRO' || line_key AS claim_id, line_key, 'provider_outlier' AS fraud_type, provider_id, service_code,
               u2 AS units, a2 AS allowed_amount, {money(f"a2 * {u('fd_pro_b', '1.3', '1.7')}")} AS billed_amount,
               {money(f"a2 * {u('fd_pro_p', '0.85', '1.00')}")} AS paid_amount FROM pro1)
SELECT {cols}, {money_cols} FROM dup
UNION ALL SELECT {cols}, {money_cols} FROM exu
UNION ALL SELECT {cols}, {money_cols} FROM upc
UNION ALL SELECT {cols}, {money_cols} FROM unb
UNION ALL SELECT {cols}, {money_cols} FROM pro
"""


def _appended_ctes() -> str:
    """fd_all: the shaped and first adjudicated lines, and the copies with what they keep from their source lines."""
    from oracle.v6_sql import shaped_ctes

    kept = ("member_id", "service_date", "diagnosis_code", "place_of_service", "member_age", "chronic_score",
            "contract_discount_rate")
    amounts = ("allowed_amount", "billed_amount", "paid_amount")
    return "WITH " + shaped_ctes() + f""",
first_paid AS ({_more_sql()["adjudicate_initial"]}),
fd_base AS (SELECT s.*, CAST(f.paid_amount AS DECIMAL(18,2)) AS paid_amount
            FROM shaped2 s JOIN first_paid f ON f.order_key = s.enc_key AND f.claim_line_no = s.claim_line_no),
fd_copies AS ({append_fixed_rate_sql()}),
fd_all AS (
  SELECT printf('L%09d_%08d', enc_key, claim_line_no) AS line_id_s, 'none' AS fraud_type, 0 AS fraud_label, provider_id,
         service_code, units, {", ".join(amounts + kept)} FROM fd_base
  UNION ALL
  SELECT 'L' || c.claim_id, c.fraud_type, c.fraud_label, c.provider_id, c.service_code, c.units,
         CAST(c.allowed_amount AS DECIMAL(18,2)), CAST(c.billed_amount AS DECIMAL(18,2)),
         CASE WHEN c.fraud_type = 'duplicate_billing' THEN b.paid_amount ELSE CAST(c.paid_amount AS DECIMAL(18,2)) END,
         {", ".join("b." + c for c in kept)}
  FROM fd_copies c JOIN fd_base b USING (line_key)
)"""


def appended_sql() -> dict[str, str]:
    """The first script's rules and model inputs on base lines and appended copies."""
    def over(sql: str) -> str:
        return _appended_ctes() + sql.replace(_SEEDED_IDS, "SELECT * FROM fd_all")

    return {"rules_fd_appended": over(_fd().replace("line_id_s AS line_id,", "line_id_s AS line_id, fraud_type, fraud_label,", 1)),
            "feature_vector_appended": over(_fd_vector())}
