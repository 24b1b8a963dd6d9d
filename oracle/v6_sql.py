"""DuckDB oracle for the v6 line table, written as plain SQL CTEs.

Written independently of the DataFrame code from the same contract (FIXTURES.md
"""

from __future__ import annotations

from claimlens.functions.draws import SLOTS
from claimlens.sources import catalogs as C


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def h(key: str, salt: str) -> str:
    """Draw on 0..9999: 32-bit word ``slot`` of md5(key|group) (the draw contract's salt table)."""
    group, slot = SLOTS.get(salt, (salt, 0))
    return f"(('0x' || substr(md5({key} || '|{group}'), {1 + 8 * slot}, 8))::BIGINT % 10000)"


def unif(key: str, salt: str, lo: str, hi: str) -> str:
    from decimal import Decimal
    span = Decimal(hi) - Decimal(lo)
    return f"CAST({lo} + {span} * {h(key, salt)} * 0.0001 AS DECIMAL(10,6))"


def lst(items) -> str:
    return "[" + ", ".join(q(x) for x in items) + "]"


def money(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS DECIMAL(18,2))"


def ratio4(num: str, den: str, floor: str | None = "1.00") -> str:
    n = f"CAST(({num}) * 100 AS BIGINT)"
    dd = f"GREATEST({den}, {floor})" if floor is not None else f"({den})"
    d = f"CAST({dd} * 100 AS BIGINT)"
    return (f"(CASE WHEN {n} < 0 THEN -((-{n} * 20000 + {d}) // (2 * {d})) "
            f"ELSE (({n} * 20000 + {d}) // (2 * {d})) END)::DOUBLE / 10000.0")


def catalog_values() -> str:
    rows = []
    for code, pos, base, rev, mue in C.PROCEDURES:
        rows.append(f"({q(code)}, {q(pos)}, CAST({base} AS DECIMAL(10,2)), "
                    f"{q(rev) if rev else 'NULL'}, {mue if mue is not None else 'NULL'}, NULL, NULL, NULL)")
    for ndc, name, dtype, base, days in C.DRUGS:
        rows.append(f"({q(ndc)}, '01', CAST({base} AS DECIMAL(10,2)), NULL, NULL, {q(name)}, {q(dtype)}, {days})")
    rows.append(f"('ADMIN001', '99', CAST({C.ADMIN_BASE} AS DECIMAL(10,2)), NULL, NULL, NULL, NULL, NULL)")
    rows.append(f"('MSUB001', '11', CAST({C.MEMBER_SUBMIT_BASE} AS DECIMAL(10,2)), NULL, NULL, NULL, NULL, NULL)")
    return ("SELECT * FROM (VALUES " + ",\n ".join(rows) +
            ") AS t(code, cat_pos, base_allowed, cat_revenue_code, mue_limit, cat_drug_name, cat_drug_type, cat_days_supply)")


def shaped_ctes() -> str:
    spec_case = "CASE " + " ".join(
        f"WHEN l_suppkey % 15 = {i} THEN {q(s)}" for i, s in enumerate(C.SPECIALTY_BY_MOD)) + " END"
    class_case = ("CASE WHEN l_suppkey % 20 = 0 THEN 'bad_actor' WHEN l_suppkey % 20 IN (1, 2) THEN 'medium_risk' "
                  "WHEN l_suppkey % 20 IN (3, 4, 5) THEN 'low_risk' ELSE 'clean' END")
    prof_menu = "CASE " + " ".join(
        f"WHEN provider_specialty = {q(s)} THEN {lst(codes)}[(l_partkey % {len(codes)}) + 1]"
        for s, codes in C.SPECIALTY_CODES.items()) + " ELSE '99213' END"
    drugs = [d[0] for d in C.DRUGS]
    linked_specs = ", ".join(q(s) for s, _ in C.LINKED_SPECIALTIES)
    return f"""
mem AS (
  SELECT c_custkey,
         printf('M%07d', c_custkey + 1) AS member_id,
         CAST(c_custkey % 90 AS INTEGER) AS member_age,
         CASE WHEN c_custkey % 100 < 53 THEN 'F' ELSE 'M' END AS member_gender,
         CAST(c_custkey % 6 AS INTEGER) AS chronic_score,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'bronze' WHEN 'BUILDING' THEN 'silver'
              WHEN 'FURNITURE' THEN 'gold' ELSE 'self_funded' END AS plan_type
  FROM customer
),
mem2 AS (
  SELECT *,
    CAST(CASE plan_type WHEN 'bronze' THEN 7000 WHEN 'silver' THEN 4000 WHEN 'gold' THEN 1500
         WHEN 'self_funded' THEN 2500 ELSE 3000 END AS DECIMAL(18,2)) AS annual_deductible,
    CAST(CASE plan_type WHEN 'bronze' THEN 0.40 WHEN 'silver' THEN 0.25 WHEN 'gold' THEN 0.10
         ELSE 0.20 END AS DECIMAL(4,2)) AS coinsurance_rate
  FROM mem
),
mem3 AS (
  SELECT *, CAST(annual_deductible * (c_custkey % 86 + 15) * 0.01 AS DECIMAL(18,2)) AS deductible_remaining_start
  FROM mem2
),
li AS (
  SELECT l.l_orderkey AS enc_key, l.l_partkey, l.l_suppkey,
         ROW_NUMBER() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                            l.l_shipdate, l.l_extendedprice, l.l_quantity, l.l_discount) AS claim_line_no,
         CAST(l.l_quantity AS INTEGER) AS qty,
         CAST(l.l_discount AS DECIMAL(4,2)) AS disc,
         CAST(l.l_shipdate AS DATE) AS service_date,
         m.member_id, m.member_age, m.member_gender, m.chronic_score, m.plan_type,
         m.annual_deductible, m.coinsurance_rate, m.deductible_remaining_start
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN mem3 m ON o.o_custkey = m.c_custkey
),
li2 AS (
  SELECT *,
    printf('P%06d', l_suppkey + 1) AS provider_id,
    {spec_case} AS provider_specialty,
    {class_case} AS provider_class
  FROM li
),
li3 AS (
  SELECT *,
    CASE provider_class WHEN 'clean' THEN 0.0005 WHEN 'low_risk' THEN 0.006 WHEN 'medium_risk' THEN 0.02
         WHEN 'bad_actor' THEN 0.08 ELSE 0.001 END::DOUBLE AS provider_fraud_propensity,
    CAST(CASE provider_specialty WHEN 'Hospital' THEN 0.38 WHEN 'Pharmacy' THEN 0.22
         WHEN 'Administration' THEN 0.10 ELSE 0.28 END AS DECIMAL(4,2)) AS contract_discount_rate,
    CASE WHEN provider_specialty = 'Hospital' THEN
              CASE WHEN {h('CAST(enc_key AS VARCHAR)', 'etype')} < 5500 THEN 'ed_facility' ELSE 'inpatient_facility' END
         WHEN provider_specialty = 'Pharmacy' THEN 'pharmacy'
         WHEN provider_specialty = 'Administration' THEN 'admin'
         WHEN provider_specialty = 'Primary Care' AND {h('CAST(enc_key AS VARCHAR)', 'msub')} < 400 THEN 'member_submitted'
         ELSE 'professional' END AS etype0
  FROM li2
),
li4 AS (
  SELECT *,
    MAX(CASE WHEN etype0 IN ('ed_facility', 'inpatient_facility') THEN 1 ELSE 0 END)
        OVER (PARTITION BY enc_key) AS enc_has_facility
  FROM li3
),
li5 AS (
  SELECT *,
    CASE WHEN etype0 = 'professional' AND provider_specialty IN ({linked_specs}) AND enc_has_facility = 1
         THEN 1 ELSE 0 END AS linked_facility_claim
  FROM li4
),
li6 AS (
  SELECT *,
    printf('EP%09d', enc_key) AS episode_id,
    CASE WHEN linked_facility_claim = 1 THEN printf('LE%09d%03d', enc_key, claim_line_no) ELSE printf('E%09d', enc_key) END AS encounter_id,
    CASE WHEN linked_facility_claim = 1 THEN printf('E%09d', enc_key) ELSE '' END AS parent_encounter_id,
    CASE WHEN linked_facility_claim = 1 THEN 'linked_' || lower(replace(provider_specialty, ' ', '_'))
         ELSE etype0 END AS encounter_type,
    CASE WHEN etype0 IN ('inpatient_facility', 'ed_facility') THEN 'institutional'
         WHEN etype0 = 'pharmacy' THEN 'pharmacy' WHEN etype0 = 'admin' THEN 'administrative'
         WHEN etype0 = 'member_submitted' THEN 'member_submitted' ELSE 'professional' END AS claim_family,
    CASE WHEN etype0 = 'ed_facility' THEN {lst(C.ED_CODES)}[(l_partkey % {len(C.ED_CODES)}) + 1]
         WHEN etype0 = 'inpatient_facility' THEN {lst(C.INPATIENT_CODES)}[(l_partkey % {len(C.INPATIENT_CODES)}) + 1]
         WHEN etype0 = 'pharmacy' THEN {lst(drugs)}[(l_partkey % {len(drugs)}) + 1]
         WHEN etype0 = 'admin' THEN 'ADMIN001'
         WHEN etype0 = 'member_submitted' THEN 'MSUB001'
         ELSE {prof_menu} END AS service_code,
    CAST(enc_key AS VARCHAR) || '|' || CAST(claim_line_no AS VARCHAR) AS line_key,
    {lst(C.DX_CODES)}[(l_partkey % {len(C.DX_CODES)}) + 1] AS diagnosis_code
  FROM li5
),
cat AS ({catalog_values()}),
li7 AS (
  SELECT li6.*, cat.*,
    CASE WHEN etype0 = 'ed_facility' THEN '23' WHEN etype0 = 'inpatient_facility' THEN '21'
         WHEN claim_family = 'pharmacy' THEN '01' WHEN etype0 = 'admin' THEN '99'
         WHEN etype0 = 'member_submitted' THEN '11' ELSE cat.cat_pos END AS place_of_service,
    COALESCE(cat.cat_revenue_code, '') AS revenue_code,
    CAST(CASE WHEN claim_family IN ('professional', 'institutional') THEN qty % 5 + 1 ELSE 1 END AS INTEGER) AS units,
    CAST(CASE WHEN claim_family = 'pharmacy' THEN
              CASE WHEN cat.cat_drug_type = 'controlled' THEN qty % 21 + 10 ELSE cat.cat_days_supply END
         END AS INTEGER) AS days_supply,
    cat.cat_drug_name AS drug_name, cat.cat_drug_type AS drug_type,
    CASE WHEN claim_family = 'pharmacy' THEN service_code END AS ndc
  FROM li6 LEFT JOIN cat ON li6.service_code = cat.code
),
li8 AS (
  SELECT *,
    {money('''base_allowed * CAST(units AS DECIMAL(6,0)) *
      CAST(CASE WHEN claim_family = 'institutional'
                THEN 1 + CAST(chronic_score AS DECIMAL(6,0)) * 0.05 + CASE WHEN etype0 = 'inpatient_facility' THEN 0.35 ELSE 0 END
                WHEN claim_family = 'professional'
                THEN 1 + CAST(chronic_score AS DECIMAL(6,0)) * 0.035 + CASE WHEN place_of_service = '21' THEN 0.15 ELSE 0 END
                ELSE 1 END AS DECIMAL(8,4)) *
      CAST(0.80 + 4 * disc AS DECIMAL(6,2))''')} AS allowed_amount
  FROM li7
),
li9 AS (
  SELECT *,
    {money("allowed_amount * (1 - CASE WHEN provider_specialty = 'Hospital' THEN 0.35 ELSE COALESCE(contract_discount_rate, 0.25) END)")} AS contract_rate
  FROM li8
),
shaped AS (
  SELECT *,
    {money('''GREATEST(allowed_amount, contract_rate) *
      CASE WHEN claim_family = 'institutional' THEN 1.8 + 0.054 * CAST(qty AS DECIMAL(6,0))
           ELSE 1.15 + 0.033 * CAST(qty AS DECIMAL(6,0)) END''')} AS billed_amount,
    CASE WHEN {h('line_key', 'deny')} < CASE claim_family WHEN 'member_submitted' THEN 1000
              WHEN 'administrative' THEN 200 WHEN 'pharmacy' THEN 600 ELSE 400 END
         THEN 'denied' ELSE 'paid' END AS claim_status,
    CASE WHEN {h('line_key', 'pay')} < 1800 THEN 'check' WHEN {h('line_key', 'pay')} < 9000 THEN 'electronic'
         ELSE 'checkless' END AS payment_type
  FROM li9
),
shaped2 AS (
  SELECT *,
    CASE WHEN claim_status = 'denied' THEN {lst(C.DENIAL_REASONS)}[{h('line_key', 'reason')} % 6 + 1] ELSE '' END AS denial_reason
  FROM shaped
)"""


def seeded_ctes(mult: int = 5) -> str:
    k = "line_key"
    cand = (f"{h(k, 'fraud')} < (CASE provider_class WHEN 'clean' THEN 5 WHEN 'low_risk' THEN 60 "
            f"WHEN 'medium_risk' THEN 200 WHEN 'bad_actor' THEN 800 ELSE 10 END) * {mult}")
    upmap = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in C.UPCODE_MAP.items())
    bases = {r[0]: r[2] for r in C.PROCEDURES}
    upbase = " ".join(f"WHEN {q(b)} THEN {bases[b]}" for b in sorted(set(C.UPCODE_MAP.values())))
    return f"""
s0 AS (
  SELECT *, {cand} AS cand FROM shaped2
),
s1 AS (  -- pricing error
  SELECT * EXCLUDE (m) REPLACE (
      CASE WHEN m THEN {money(f"contract_rate * {unif(k, 'pricing_amt', '1.15', '1.85')}")} ELSE contract_rate END AS contract_rate),
    m AS m1
  FROM (SELECT *, cand AND {h(k, 'pricing')} < 2000 AS m FROM s0)
),
s2 AS (  -- egregious billing on the already modified contract
  SELECT * EXCLUDE (m) REPLACE (
      CASE WHEN m THEN {money(f"contract_rate * {unif(k, 'egregious_amt', '6', '18')}")} ELSE billed_amount END AS billed_amount),
    m AS m2
  FROM (SELECT *, cand AND claim_family IN ('institutional', 'professional') AND {h(k, 'egregious')} < 1600 AS m
        FROM s1)
),
s3 AS (  -- excessive units
  SELECT * EXCLUDE (m) REPLACE (
      CASE WHEN m THEN mue_limit + 2 + ({h(k, 'units_amt')} % 6) ELSE units END AS units),
    m AS m3
  FROM (SELECT *, cand AND mue_limit IS NOT NULL AND {h(k, 'units')} < 1800 AS m FROM s2)
),
s4 AS (  -- upcoding
  SELECT * EXCLUDE (m, new_code) REPLACE (
      CASE WHEN m THEN {money(f"CAST(CASE new_code {upbase} END AS DECIMAL(10,2)) * {unif(k, 'upcode_amt', '0.95', '1.20')}")}
           ELSE allowed_amount END AS allowed_amount,
      CASE WHEN m THEN new_code ELSE service_code END AS service_code),
    m AS m4
  FROM (SELECT *, CASE service_code {upmap} END AS new_code,
               cand AND service_code IN ({", ".join(q(c) for c in C.UPCODE_MAP)}) AND {h(k, 'upcode')} < 1600 AS m
        FROM s3)
),
s5 AS (  -- member reimbursement abuse
  SELECT * EXCLUDE (m) REPLACE (
      CASE WHEN m THEN {money(f"allowed_amount * {unif(k, 'member_amt', '3', '10')}")} ELSE billed_amount END AS billed_amount),
    m AS m5
  FROM (SELECT *, cand AND claim_family = 'member_submitted' AND {h(k, 'member')} < 2000 AS m FROM s4)
),
s6 AS (
  SELECT *,
    CASE WHEN m5 THEN 'member_reimbursement_abuse' WHEN m4 THEN 'upcoding' WHEN m3 THEN 'excessive_units'
         WHEN m2 THEN 'egregious_billing' WHEN m1 THEN 'pricing_error' ELSE 'none' END AS fraud_type,
    CASE WHEN m5 THEN 'outlier_member_submit' WHEN m4 THEN 'level_shift' WHEN m3 THEN 'mue_like_units'
         WHEN m2 THEN 'egregious_billed_charge' WHEN m1 THEN 'price_above_contract' ELSE 'none' END AS rule_primary_reason,
    CASE WHEN m1 OR m2 OR m3 OR m4 OR m5 THEN 1 ELSE 0 END AS fraud_label,
    CASE WHEN m1 THEN 1 ELSE 0 END AS pricing_error_signal,
    CASE WHEN m2 THEN 1 ELSE 0 END AS egregious_charge_signal,
    CASE WHEN m4 THEN 1 ELSE 0 END AS upcoding_signal,
    CASE WHEN m5 THEN 1 ELSE 0 END AS member_submit_outlier_signal
  FROM s5
),
s7 AS (  -- coding edits on the seeded values
  SELECT *,
    CASE WHEN service_code = '36415' AND MAX(CASE WHEN service_code IN ('80053', '85025') THEN 1 ELSE 0 END)
              OVER (PARTITION BY enc_key, encounter_id) = 1 THEN 1 ELSE 0 END AS ncci_like_edit_flag,
    CASE WHEN units > COALESCE(mue_limit, 9999) THEN 1 ELSE 0 END AS mue_like_edit_flag
  FROM s6
),
s8 AS (
  SELECT *, GREATEST(ncci_like_edit_flag, mue_like_edit_flag) AS external_edit_flag,
    provider_class IN ('medium_risk', 'bad_actor') AND {h(k, 'dup')} < {30 * mult} AS is_dup
  FROM s7
),
s9 AS (  -- duplicate copies
  SELECT * EXCLUDE (is_dup), 0 AS is_seeded_copy FROM s8
  UNION ALL
  SELECT * EXCLUDE (is_dup) REPLACE (claim_line_no + 100 AS claim_line_no, 1 AS fraud_label,
         'duplicate_billing' AS fraud_type, 'duplicate_signature' AS rule_primary_reason), 1 AS is_seeded_copy
  FROM s8 WHERE is_dup
),
s10 AS (
  SELECT *,
    CAST((GREATEST(CAST(deductible_remaining_start * 100 AS BIGINT) * (3650 - 9 * dayofyear(service_date)), 0) * 2 + 3650)
         // 7300 AS DECIMAL(18,0)) * 0.01 AS rem
  FROM s9
),
seeded AS (
  SELECT * EXCLUDE (rem, ded0, coins0),
    {money("CASE WHEN claim_status = 'denied' THEN 0 ELSE ded0 END")} AS applied_to_deductible,
    {money("CASE WHEN claim_status = 'denied' THEN 0 ELSE coins0 END")} AS coinsurance_amount,
    {money("CASE WHEN claim_status = 'denied' THEN 0 ELSE GREATEST(0, contract_rate - ded0 - coins0) END")} AS paid_amount
  FROM (SELECT *, LEAST(contract_rate, CAST(rem AS DECIMAL(18,2))) AS ded0,
               GREATEST(0, (contract_rate - LEAST(contract_rate, CAST(rem AS DECIMAL(18,2)))) * coinsurance_rate) AS coins0
        FROM s10)
)"""


def scored_ctes(mult: int = 5, volume: int = 3, upcode_ratio: float = 1.0, price_ratio: float = 1.15,
                egregious_ratio: float = 6.0, member_ratio: float = 2.5, chunk: int | None = None) -> str:
    reasons = [
        ("rule_duplicate", "duplicate_signature"), ("rule_egregious_billed", "egregious_billed_charge"),
        ("rule_price_above_contract", "price_above_contract"), ("rule_external_edit", "external_edit"),
        ("rule_upcoding_pattern", "upcoding_pattern"), ("rule_member_submit_outlier", "outlier_member_submit"),
        ("rule_provider_volume", "provider_volume_outlier"), ("rule_denied_repeat", "denied_repeat_pattern"),
    ]
    reason_case = "CASE " + " ".join(f"WHEN {c} = 1 THEN {q(r)}" for c, r in reasons) + " ELSE 'no_rule' END"
    chunk_col = f", enc_key // {chunk} AS chunk_id" if chunk else ""
    ck = "chunk_id, " if chunk else ""
    return "WITH " + shaped_ctes() + "," + seeded_ctes(mult) + f""",
f_src AS (
  SELECT *{chunk_col} FROM seeded
),
f_sig AS (
  SELECT {ck}member_id, provider_id, service_date, service_code, contract_rate, COUNT(*) AS duplicate_signature_count
  FROM f_src GROUP BY ALL
),
f_day AS (
  SELECT {ck}provider_id, service_date, COUNT(*) AS provider_day_claim_count FROM f_src GROUP BY ALL
),
f_prov AS (
  SELECT {ck}provider_id, CAST(SUM(contract_rate) AS DOUBLE) / COUNT(*) AS provider_avg_contract_rate FROM f_src GROUP BY ALL
),
f_code AS (
  SELECT {ck}service_code, CAST(SUM(contract_rate) AS DOUBLE) / COUNT(*) AS service_code_avg_contract_rate FROM f_src GROUP BY ALL
),
featured AS (
  SELECT s.*, g.duplicate_signature_count, d.provider_day_claim_count, p.provider_avg_contract_rate,
         c.service_code_avg_contract_rate,
         {ratio4('s.billed_amount', 's.contract_rate')} AS billed_to_contract_ratio,
         {ratio4('s.contract_rate', 's.allowed_amount')} AS contract_to_allowed_ratio,
         ROUND(p.provider_avg_contract_rate / GREATEST(c.service_code_avg_contract_rate, 1.0), 4) AS provider_to_code_ratio
  FROM f_src s
  JOIN f_sig g USING ({ck}member_id, provider_id, service_date, service_code, contract_rate)
  JOIN f_day d USING ({ck}provider_id, service_date)
  JOIN f_prov p USING ({ck}provider_id)
  JOIN f_code c USING ({ck}service_code)
),
ruled AS (
  SELECT *,
    CASE WHEN duplicate_signature_count > 1 THEN 1 ELSE 0 END AS rule_duplicate,
    CASE WHEN provider_day_claim_count >= {volume} THEN 1 ELSE 0 END AS rule_provider_volume,
    CASE WHEN billed_to_contract_ratio >= {egregious_ratio} THEN 1 ELSE 0 END AS rule_egregious_billed,
    CASE WHEN contract_to_allowed_ratio >= {price_ratio} THEN 1 ELSE 0 END AS rule_price_above_contract,
    COALESCE(external_edit_flag, 0) AS rule_external_edit,
    CASE WHEN claim_status = 'denied' AND provider_class IN ('medium_risk', 'bad_actor') THEN 1 ELSE 0 END AS rule_denied_repeat,
    CASE WHEN upcoding_signal = 1 OR (service_code IN ('99215', '99223', '99233') AND provider_to_code_ratio >= {upcode_ratio})
         THEN 1 ELSE 0 END AS rule_upcoding_pattern,
    CASE WHEN member_submit_outlier_signal = 1 OR (claim_family = 'member_submitted' AND billed_to_contract_ratio >= {member_ratio})
         THEN 1 ELSE 0 END AS rule_member_submit_outlier
  FROM featured
),
ruled2 AS (
  SELECT *,
    GREATEST(rule_duplicate, pricing_error_signal, egregious_charge_signal, upcoding_signal, member_submit_outlier_signal) AS strong_rule_hit,
    rule_duplicate + rule_provider_volume + rule_egregious_billed + rule_price_above_contract + rule_external_edit
      + rule_denied_repeat + rule_upcoding_pattern + rule_member_submit_outlier AS rule_score
  FROM ruled
),
lines AS (
  SELECT *,
    CASE WHEN rule_score >= 2 OR strong_rule_hit >= 1
           OR (rule_egregious_billed = 1 AND provider_class IN ('medium_risk', 'bad_actor'))
           OR (rule_external_edit = 1 AND claim_family = 'institutional' AND provider_class <> 'clean')
         THEN 1 ELSE 0 END AS flagged_for_review,
    {reason_case} AS rule_primary_reason_detected,
    printf('L%09d_%08d', enc_key, claim_line_no) AS line_id
  FROM ruled2
)
"""


V6_OUT = [
    ("line_id", "VARCHAR"), ("episode_id", "VARCHAR"), ("encounter_id", "VARCHAR"), ("parent_encounter_id", "VARCHAR"),
    ("linked_facility_claim", "INTEGER"), ("member_id", "VARCHAR"), ("provider_id", "VARCHAR"),
    ("provider_specialty", "VARCHAR"), ("provider_class", "VARCHAR"), ("provider_fraud_propensity", "DOUBLE"),
    ("service_date", "DATE"), ("claim_family", "VARCHAR"), ("encounter_type", "VARCHAR"),
    ("place_of_service", "VARCHAR"), ("revenue_code", "VARCHAR"), ("diagnosis_code", "VARCHAR"),
    ("service_code", "VARCHAR"), ("drug_name", "VARCHAR"), ("drug_type", "VARCHAR"), ("ndc", "VARCHAR"),
    ("days_supply", "DOUBLE"), ("claim_line_no", "INTEGER"), ("units", "INTEGER"), ("member_age", "INTEGER"),
    ("member_gender", "VARCHAR"), ("chronic_score", "INTEGER"), ("plan_type", "VARCHAR"),
    ("annual_deductible", "DOUBLE"), ("deductible_remaining_start", "DOUBLE"), ("coinsurance_rate", "DOUBLE"),
    ("allowed_amount", "DOUBLE"), ("contract_rate", "DOUBLE"), ("billed_amount", "DOUBLE"),
    ("applied_to_deductible", "DOUBLE"), ("coinsurance_amount", "DOUBLE"), ("paid_amount", "DOUBLE"),
    ("claim_status", "VARCHAR"), ("denial_reason", "VARCHAR"), ("payment_type", "VARCHAR"),
    ("contract_discount_rate", "DOUBLE"), ("ncci_like_edit_flag", "INTEGER"), ("mue_like_edit_flag", "INTEGER"),
    ("external_edit_flag", "INTEGER"), ("duplicate_signature_count", "BIGINT"), ("provider_day_claim_count", "BIGINT"),
    ("provider_avg_contract_rate", "DOUBLE"), ("service_code_avg_contract_rate", "DOUBLE"),
    ("billed_to_contract_ratio", "DOUBLE"), ("contract_to_allowed_ratio", "DOUBLE"),
    ("rule_duplicate", "INTEGER"), ("rule_provider_volume", "INTEGER"), ("rule_egregious_billed", "INTEGER"),
    ("rule_price_above_contract", "INTEGER"), ("rule_external_edit", "INTEGER"), ("rule_denied_repeat", "INTEGER"),
    ("rule_upcoding_pattern", "INTEGER"), ("rule_member_submit_outlier", "INTEGER"),
    ("strong_rule_hit", "INTEGER"), ("rule_score", "INTEGER"), ("flagged_for_review", "INTEGER"),
    ("pricing_error_signal", "INTEGER"), ("egregious_charge_signal", "INTEGER"), ("upcoding_signal", "INTEGER"),
    ("member_submit_outlier_signal", "INTEGER"), ("fraud_label", "INTEGER"), ("fraud_type", "VARCHAR"),
    ("rule_primary_reason", "VARCHAR"), ("rule_primary_reason_detected", "VARCHAR"),
]


def v6_lines_select(source: str = "lines") -> str:
    return "SELECT " + ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in V6_OUT) + f" FROM {source}"


def with_lines(select_sql: str, **kw) -> str:
    """A full oracle statement: the scored line CTEs then ``select_sql`` over ``lines``."""
    return scored_ctes(**kw) + select_sql
