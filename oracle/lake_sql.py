"""DuckDB oracle for the claim lake (header, lines, dx bridge, labels, member months)."""

from __future__ import annotations

from claimlens.functions.draws import weighted_cuts
from claimlens.plans import lake as L
from oracle.v6_sql import h, lst, q


def rd(a: str, b: str) -> str:
    """a / b rounded half up, for a >= 0 and b > 0 (integers)."""
    return f"((2 * CAST(({a}) AS BIGINT) + ({b})) // (2 * CAST(({b}) AS BIGINT)))"


def _cut_case(hexpr: str, options) -> str:
    cuts = weighted_cuts(options)
    return "CASE " + " ".join(f"WHEN {hexpr} < {c} THEN {q(str(lab))}" for lab, c in cuts[:-1]) + \
        f" ELSE {q(str(cuts[-1][0]))} END"


def _map(col: str, mapping: dict, default: int) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {q(k) if isinstance(k, str) else k} THEN {v}" for k, v in mapping.items()) \
        + f" ELSE {default} END"


def lake_ctes() -> str:
    spec = lst(L.SPECIALTIES)
    proc = "CASE " + " ".join(
        f"WHEN specialty = {q(s)} THEN {_cut_case(h('lk', 'lake_proc'), list(zip(L.CPT, ws)))}"
        for s, ws in L.PROC_WEIGHTS.items()) + " END"
    base = "CAST(" + _map("proc_code", {k: int(v) * 100 for k, v in L.BASE_FEE.items()}, int(L.DEFAULT_FEE) * 100) + " AS BIGINT)"
    up = _map("specialty", {k: round(float(v) * 100) for k, v in L.UPLIFT.items()}, 100)
    pf = _map("place_of_service", {k: round(float(v) * 100) for k, v in L.POS_FACTOR.items()}, 100)
    ck = "CAST(claim_id AS VARCHAR)"
    return f"""WITH
prov0 AS (
  SELECT s_suppkey AS provider_id, {spec}[s_suppkey % 8 + 1] AS specialty, s_nationkey AS state,
         CASE WHEN {h('CAST(s_suppkey AS VARCHAR)', 'lake_oon')} < 1500 THEN 'OON' ELSE 'INN' END AS network_status
  FROM supplier
),
prov AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY ('0x' || substr(md5(CAST(provider_id AS VARCHAR) || '|lake_bad'), 1, 8))::BIGINT,
                                         CAST(provider_id AS VARCHAR))
                      <= GREATEST(FLOOR(COUNT(*) OVER () * {L.BAD_PROVIDER_RATE}), 1) THEN 1 ELSE 0 END AS is_bad_provider
  FROM prov0
),
firstline AS (
  SELECT l_orderkey, l_suppkey AS provider_id FROM (
    SELECT l_orderkey, l_suppkey, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r
    FROM lineitem) WHERE r = 1
),
hdr0 AS (
  SELECT o.o_orderkey AS claim_id, o.o_custkey AS member_id, p.provider_id, p.specialty, p.network_status, p.is_bad_provider,
         CAST(o.o_orderdate AS DATE) AS service_date
  FROM orders o JOIN firstline f ON o.o_orderkey = f.l_orderkey JOIN prov p ON p.provider_id = f.provider_id
),
hdr AS (
  SELECT claim_id, member_id, provider_id, specialty,
    CASE WHEN {h(ck, 'lake_ctype')} < 8600 THEN 'PROF' ELSE 'INST' END AS claim_type,
    CAST({_cut_case(h(ck, 'lake_pos'), [(str(p), w) for p, w in L.POS_WEIGHTS])} AS INTEGER) AS place_of_service,
    service_date, network_status, CAST(year(service_date) AS INTEGER) AS year, CAST(month(service_date) AS INTEGER) AS month,
    fraud AS fraud_flag, CASE WHEN fraud = 1 THEN {_cut_case(h(ck, 'lake_ftype'), L.FRAUD_TYPES)} END AS fraud_type
  FROM (SELECT *, CASE WHEN {h(ck, 'lake_fraud')} < {L.CLAIM_FRAUD_RATE_BP}
                         OR (is_bad_provider = 1 AND {h(ck, 'lake_bad_fraud')} < {L.BAD_PROVIDER_FRAUD_BP}) THEN 1 ELSE 0 END AS fraud
        FROM hdr0)
),
ln0 AS (
  SELECT h.claim_id, h.member_id, h.provider_id, h.service_date, h.place_of_service, h.specialty, h.network_status,
         h.fraud_flag AS is_fraud_line, h.year, h.month, h.fraud_type,
         CAST(ROW_NUMBER() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate,
                                 l.l_extendedprice, l.l_quantity, l.l_discount) AS INTEGER) AS line_num,
         GREATEST(CAST(l.l_quantity AS INTEGER) % 3, 1) AS units,
         80 + 4 * CAST(CAST(l.l_discount AS DECIMAL(4,2)) * 100 AS INTEGER) AS noise
  FROM lineitem l JOIN hdr h ON l.l_orderkey = h.claim_id
),
ln1 AS (
  SELECT *, CAST(claim_id AS VARCHAR) || '|' || CAST(line_num AS VARCHAR) AS lk FROM ln0
),
ln2 AS (
  SELECT *, {proc} AS proc_code FROM ln1
),
ln3 AS (
  SELECT *, {rd(f"GREATEST({rd(f'({base}) * ({up}) * ({pf})', '10000')}, 100) * noise", '100')} AS unit_allowed,
         LEAST(GREATEST(CASE WHEN network_status = 'OON' THEN {L.OON_SHARE_E4} ELSE {L.INN_SHARE_E4} END
                        + {h('lk', 'lake_share')} % 1001 - 500, 500), 8000) AS share
  FROM ln2
),
ln4 AS (
  SELECT *, {rd(f"unit_allowed * (1050000 + {h('lk', 'lake_bmult')} * 295) * units", '1000000')} AS billed_amount,
         unit_allowed * units AS allowed_amount
  FROM ln3
),
ln5 AS (
  SELECT *, {rd('allowed_amount * (10000 - share)', '10000')} AS paid_amount FROM ln4
),
per AS (
  SELECT claim_id, MAX(line_num) AS max_line,
         arg_min(line_num, {h('lk', 'lake_ex_pick')} * 100000 + line_num) AS pick_line
  FROM ln5 GROUP BY claim_id
),
an0 AS (
  SELECT l.*, p.max_line, p.pick_line,
    fraud_type = 'UPCODE' AND line_num = 1 AS up1, fraud_type = 'UNBUNDLE' AND line_num = 1 AS ub1,
    fraud_type = 'EXCESS_UNITS' AND line_num = p.pick_line AS ex1,
    LEAST(GREATEST(units * (6 + {h('lk', 'lake_ex_r1')} % 12), 8), 50) AS nu,
    6 + {h('lk', 'lake_ex_r2')} % 12 AS r2
  FROM ln5 l JOIN per p USING (claim_id)
),
an1 AS (
  SELECT * REPLACE (
      CASE WHEN up1 THEN '99215' WHEN ub1 THEN '80053' ELSE proc_code END AS proc_code,
      CASE WHEN up1 THEN {rd('allowed_amount * 145', '100')} WHEN ub1 THEN {rd('allowed_amount * 65', '100')}
           WHEN ex1 THEN {rd('allowed_amount * nu', 'GREATEST(nu // r2, 1)')} ELSE allowed_amount END AS allowed_amount,
      CASE WHEN up1 THEN {rd('billed_amount * 155', '100')} WHEN ub1 THEN {rd('billed_amount * 70', '100')}
           WHEN ex1 THEN {rd('billed_amount * 180', '100')} ELSE billed_amount END AS billed_amount,
      CASE WHEN up1 THEN {rd('paid_amount * 135', '100')} WHEN ex1 THEN {rd('paid_amount * 150', '100')}
           ELSE paid_amount END AS paid_amount,
      CAST(CASE WHEN ex1 THEN nu ELSE units END AS INTEGER) AS units)
  FROM an0
),
an2 AS (
  SELECT * FROM an1
  UNION ALL
  SELECT * REPLACE (CAST(max_line + 1 AS INTEGER) AS line_num,
      ['45378', '99215'][{h(ck, 'lake_phantom')} % 2 + 1] AS proc_code, 1 AS units,
      {rd('allowed_amount * 220', '100')} AS allowed_amount, {rd('billed_amount * 270', '100')} AS billed_amount,
      {rd('paid_amount * 200', '100')} AS paid_amount)
  FROM an1 WHERE fraud_type = 'PHANTOM' AND line_num = 1
  UNION ALL
  SELECT * REPLACE (CAST(max_line + 1 AS INTEGER) AS line_num, '85025' AS proc_code,
      {rd('allowed_amount * 85', '100')} AS allowed_amount, {rd('billed_amount * 90', '100')} AS billed_amount,
      {rd('paid_amount * 85', '100')} AS paid_amount)
  FROM an1 WHERE fraud_type = 'UNBUNDLE' AND line_num = 1
),
lines AS (
  SELECT claim_id, line_num, member_id, provider_id, service_date, place_of_service, specialty, proc_code, units,
         billed_amount, allowed_amount, paid_amount, 1 AS dx_pointer_primary, is_fraud_line, year, month FROM an2
  UNION ALL
  SELECT claim_id + {L.DUPLICATE_ID_OFFSET}, line_num, member_id, provider_id,
         CAST(service_date + INTERVAL ({h(ck, 'lake_dup_day')} % 3) DAY AS DATE), place_of_service, specialty, proc_code,
         units, billed_amount, allowed_amount, paid_amount, 1, 1, year, month
  FROM an2 WHERE fraud_type = 'DUPLICATE'
),
headers AS (
  SELECT claim_id, member_id, provider_id, claim_type, place_of_service, service_date, network_status, year, month
  FROM hdr
  UNION ALL
  SELECT claim_id + {L.DUPLICATE_ID_OFFSET}, member_id, provider_id, claim_type, place_of_service,
         CAST(service_date + INTERVAL ({h(ck, 'lake_dup_day')} % 3) DAY AS DATE), network_status, year, month
  FROM hdr WHERE fraud_type = 'DUPLICATE'
),
labels AS (
  SELECT claim_id, 1 AS fraud_flag, fraud_type, year, month FROM hdr WHERE fraud_flag = 1
  UNION ALL
  SELECT claim_id + {L.DUPLICATE_ID_OFFSET}, 1, 'DUPLICATE', year, month FROM hdr WHERE fraud_type = 'DUPLICATE'
)
"""


def lake_sql() -> dict[str, str]:
    c = lake_ctes()
    icd = lst(L.ICD10)
    dxk = h("CAST(claim_id AS VARCHAR)", "lake_dx_k")
    return {
        "lake_header": c + """
SELECT h.claim_id, h.member_id, h.provider_id, h.claim_type, h.place_of_service, h.service_date, h.network_status,
       h.year, h.month, CAST(t.b AS DOUBLE) / 100.0 AS total_billed, CAST(t.a AS DOUBLE) / 100.0 AS total_allowed,
       CAST(t.p AS DOUBLE) / 100.0 AS total_paid, t.line_count
FROM headers h LEFT JOIN (SELECT claim_id, SUM(billed_amount) AS b, SUM(allowed_amount) AS a, SUM(paid_amount) AS p,
                                 MAX(line_num) AS line_count FROM lines GROUP BY claim_id) t USING (claim_id)""",
        "lake_lines": c + """
SELECT claim_id, line_num, member_id, provider_id, service_date, place_of_service, specialty, proc_code, units,
       CAST(billed_amount AS DOUBLE) / 100.0 AS billed_amount, CAST(allowed_amount AS DOUBLE) / 100.0 AS allowed_amount,
       CAST(paid_amount AS DOUBLE) / 100.0 AS paid_amount, dx_pointer_primary, is_fraud_line, year, month FROM lines""",
        "lake_dx_bridge": c + f"""
SELECT claim_id, CAST(dx_rank AS INTEGER) AS dx_rank,
       {icd}[{h("CAST(claim_id AS VARCHAR) || '|' || CAST(dx_rank AS VARCHAR)", 'lake_dx')} % {len(L.ICD10)} + 1] AS icd10_code,
       year, month
FROM (SELECT claim_id, year, month, UNNEST(range(1, CAST(CASE WHEN claim_type = 'INST' THEN 3 + {dxk} % 7
                                                            ELSE 1 + {dxk} % 4 END AS BIGINT) + 1)) AS dx_rank
      FROM headers)""",
        "lake_labels": c + "SELECT claim_id, fraud_flag, fraud_type, year, month FROM labels",
        "bad_provider_pick": c + "SELECT provider_id, specialty, state, network_status, is_bad_provider FROM prov",
        "lake_member_months": c + """
SELECT m.member_id, CAST(m.month_start AS DATE) AS month_start,
       CAST(LEAST(GREATEST((40 + (m.member_id % 25) * 10) * 35, 200), 30000) AS DOUBLE) / 10000.0 AS expected_claims,
       COALESCE(a.n, 0) AS actual_claims
FROM (SELECT c_custkey AS member_id,
             UNNEST(generate_series((SELECT date_trunc('month', MIN(service_date)) FROM headers),
                                    (SELECT date_trunc('month', MAX(service_date)) FROM headers), INTERVAL 1 MONTH)) AS month_start
      FROM customer) m
LEFT JOIN (SELECT member_id, date_trunc('month', service_date) AS ms, COUNT(*) AS n FROM headers GROUP BY ALL) a
  ON a.member_id = m.member_id AND CAST(a.ms AS DATE) = CAST(m.month_start AS DATE)""",
        "lake_partition_counts": c + f"""
SELECT 'header' AS table_name, year, month, COUNT(*) AS row_count FROM headers GROUP BY ALL
UNION ALL SELECT 'lines', year, month, COUNT(*) FROM lines GROUP BY ALL
UNION ALL SELECT 'dx', year, month, COUNT(*) FROM (
  SELECT year, month, UNNEST(range(1, CAST(CASE WHEN claim_type = 'INST' THEN 3 + {dxk} % 7 ELSE 1 + {dxk} % 4 END AS BIGINT) + 1))
  FROM headers) GROUP BY ALL
UNION ALL SELECT 'labels', year, month, COUNT(*) FROM labels GROUP BY ALL""",
    }
