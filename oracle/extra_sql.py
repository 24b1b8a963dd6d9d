"""DuckDB SQL of the queries in plans/extra.py."""

from __future__ import annotations

from claimlens.operators.rules import SIGNALS
from claimlens.plans.extra import SAMPLE_REST, SAMPLE_SHARES
from claimlens.plans.queries import CHUNK_SIZE
from oracle.lake_sql import lake_sql
from oracle.profiles_sql import profile_sql
from oracle.v2_sql import v2_sql
from oracle.v6_sql import q, with_lines


def _text_flag(c: str) -> str:
    return (f"CASE (enc_key * 7 + claim_line_no) % 6 WHEN 0 THEN ' ' || CAST({c} AS VARCHAR) || ' ' WHEN 1 THEN 'n/a' WHEN 2 THEN NULL "
            f"WHEN 3 THEN CAST({c} AS VARCHAR) || '.0' WHEN 4 THEN '' ELSE CAST({c} AS VARCHAR) END")


def rules_text_flags() -> str:
    flags = ["external_edit_flag", *[f"{s}_signal" for s in SIGNALS]]
    texts = ", ".join(f"{_text_flag(c)} AS t_{c}" for c in flags)
    numbers = ", ".join(f"CAST(coalesce(trunc(TRY_CAST(trim(t_{c}) AS DOUBLE)), 0) AS INTEGER) AS n_{c}" for c in flags)
    return with_lines(f"""
SELECT line_id, {', '.join(f't_{c} AS {c}' for c in flags)}, n_external_edit_flag AS rule_external_edit, up AS rule_upcoding_pattern,
  ms AS rule_member_submit_outlier, strong AS strong_rule_hit, score AS rule_score,
  CASE WHEN score >= 2 OR strong >= 1 OR (rule_egregious_billed = 1 AND provider_class IN ('medium_risk', 'bad_actor'))
    OR (n_external_edit_flag = 1 AND claim_family = 'institutional' AND provider_class <> 'clean') THEN 1 ELSE 0 END AS flagged_for_review
FROM (SELECT *, rule_duplicate + rule_provider_volume + rule_egregious_billed + rule_price_above_contract + n_external_edit_flag
        + rule_denied_repeat + up + ms AS score,
        greatest(rule_duplicate, {', '.join(f'n_{s}_signal' for s in SIGNALS)}) AS strong
      FROM (SELECT *, CASE WHEN n_upcoding_signal = 1 OR (service_code IN ('99215', '99223', '99233') AND provider_to_code_ratio >= 1.0) THEN 1 ELSE 0 END AS up,
              CASE WHEN n_member_submit_outlier_signal = 1 OR (claim_family = 'member_submitted' AND billed_to_contract_ratio >= 2.5) THEN 1 ELSE 0 END AS ms
            FROM (SELECT *, {numbers} FROM (SELECT *, {texts} FROM lines))))""")


def extra_sql() -> dict[str, str]:
    chunk = f"enc_key // {CHUNK_SIZE}"
    v6_only = ["strong_rule_hit", "rule_upcoding_pattern", "upcoding_signal", "rule_primary_reason_detected"]
    share = "CASE claim_family " + " ".join(f"WHEN {q(f)} THEN {s}" for f, s in SAMPLE_SHARES.items()) + f" ELSE {SAMPLE_REST} END"
    merges, lake = profile_sql(), lake_sql()
    return {
        **v2_sql(),
        "rules_text_flags": rules_text_flags(),
        "read_lines": with_lines(f"""
SELECT line_id, {chunk} AS chunk_id, fraud_type, CAST(billed_amount AS DOUBLE) AS billed_amount, service_date,
  CAST(days_supply AS DOUBLE) AS days_supply, CAST(rule_score AS INTEGER) AS rule_score,
  {', '.join(f'CASE WHEN {chunk} % 2 = 0 THEN {c} END AS {c}' for c in v6_only)} FROM lines"""),
        "file_manifest": with_lines(f"""
SELECT {chunk} AS chunk_number, 'parquet' AS format, CAST(COUNT(*) AS BIGINT) AS row_count, MIN(service_date) AS min_service_date,
  MAX(service_date) AS max_service_date, TRUE AS has_files FROM lines GROUP BY 1"""),
        "sample_shares": with_lines(f"""
SELECT line_id, claim_family, fraud_type FROM lines
WHERE ('0x' || substr(md5(line_id || '|shares'), 1, 8))::BIGINT < floor(CAST({share} AS DOUBLE) * 4294967296)"""),
        "stream_counts": merges["merge_counts"],
        "stream_confusion": merges["merge_confusion"],
        "stream_detection": merges["merge_detection"],
        "lake_rerun_counts": lake["lake_partition_counts"],
    }
