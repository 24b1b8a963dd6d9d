"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables and runs over all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions.draws import line_id
from claimlens.functions.money import to_double
from claimlens.operators import evaluate as V
from claimlens.operators import summaries as S
from claimlens.operators.rules import review_queue
from claimlens.plans.v6 import TEST_CONFIG, V6_COLUMNS, final_projection, lines_with, materialized_lines, shaped_lines, whole_lines

Query = Callable[[SparkSession, str], DataFrame]

V6_TYPES = dict(V6_COLUMNS)

# Line-level operators shown as projections of the scored v6 line table:
# query name -> columns (line_id first).
LINE_PROJECTIONS: dict[str, list[str]] = {
    "encounter_type": ["line_id", "provider_specialty", "encounter_type", "linked_facility_claim",
                       "parent_encounter_id", "episode_id", "encounter_id"],
    "claim_family": ["line_id", "encounter_type", "claim_family", "place_of_service"],
    "price_from_catalogue": ["line_id", "service_code", "revenue_code", "units", "drug_name", "drug_type", "ndc",
                             "days_supply", "allowed_amount"],
    "contract_rate": ["line_id", "provider_specialty", "contract_discount_rate", "allowed_amount", "contract_rate"],
    "billed_amount": ["line_id", "claim_family", "contract_rate", "billed_amount"],
    "denial_assignment": ["line_id", "claim_family", "claim_status", "denial_reason"],
    "payment_type": ["line_id", "payment_type"],
    "member_benefits": ["line_id", "member_id", "member_age", "member_gender", "chronic_score", "plan_type",
                        "annual_deductible", "coinsurance_rate", "deductible_remaining_start"],
    "provider_attributes": ["line_id", "provider_id", "provider_specialty", "provider_class",
                            "provider_fraud_propensity", "contract_discount_rate"],
    "seed_labels": ["line_id", "fraud_label", "fraud_type", "rule_primary_reason", "pricing_error_signal",
                    "egregious_charge_signal", "upcoding_signal", "member_submit_outlier_signal",
                    "contract_rate", "billed_amount", "allowed_amount", "units", "service_code"],
    "coding_edits": ["line_id", "service_code", "units", "ncci_like_edit_flag", "mue_like_edit_flag",
                     "external_edit_flag"],
    "adjudicate": ["line_id", "claim_status", "contract_rate", "applied_to_deductible", "coinsurance_amount",
                   "paid_amount"],
    "detection_features": ["line_id", "duplicate_signature_count", "provider_day_claim_count",
                           "provider_avg_contract_rate", "service_code_avg_contract_rate",
                           "billed_to_contract_ratio", "contract_to_allowed_ratio"],
    "rules_v6": ["line_id", "rule_duplicate", "rule_provider_volume", "rule_egregious_billed",
                 "rule_price_above_contract", "rule_external_edit", "rule_denied_repeat", "rule_upcoding_pattern",
                 "rule_member_submit_outlier", "strong_rule_hit", "rule_score", "flagged_for_review",
                 "rule_primary_reason_detected"],
}

# Summaries over the scored line table.
SUMMARIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "fraud_breakdown": S.fraud_breakdown,
    "provider_summary": S.provider_summary,
    "family_financials": S.family_financials,
    "claim_level": S.claim_level,
    "encounter_level": S.encounter_level,
    "dataset_metrics": S.dataset_metrics,
    "dataset_metrics_v5": S.dataset_metrics_v5,
    "calibration_summary": S.calibration_summary,
    "rule_reason_summary": S.rule_reason_summary,
    "detection_by_fraud_type": S.detection_by_fraud_type,
    "member_provider_history": S.member_provider_history,
    "claim_status_reason": S.claim_status_reason,
    "provider_summary_simple": S.provider_summary_simple,
    "fraud_breakdown_label": S.fraud_breakdown_label,
    "rule_reason_by_label": S.rule_reason_by_label,
    "rule_recall_within_type": S.rule_recall_within_type,
    "provider_rollup": S.provider_rollup,
    "family_profile": S.family_profile,
    "provider_profile": S.provider_profile,
    "fraud_profile": S.fraud_profile,
    "reason_precision": S.reason_precision,
    "relationship_profile": S.relationship_profile,
    "status_profile": S.status_profile,
    "dataset_profile": S.dataset_profile,
    "denial_clusters": S.denial_clusters,
    "fraud_concentration": S.fraud_concentration,
    "specialty_suspicion": S.specialty_suspicion,
    "persistent_relationships": S.persistent_relationships,
    "episode_summary": S.episode_summary,
    "confusion_counts": V.confusion_counts,
    "rule_metrics": V.rule_metrics,
    "model_performance_rules": lambda df: V.model_performance(df, "rules_v6"),
    "roc_auc_rule_score": V.roc_auc,
    "rule_vs_label_by_level": V.rule_vs_label_by_level,
}


# What each summary reads of a line.
_CLAIM = ["encounter_id", "provider_id", "claim_family"]
_MARKS = ["fraud_label", "flagged_for_review"]
_MONEY = ["billed_amount", "allowed_amount", "paid_amount"]
_PROVIDER = ["provider_id", "provider_specialty", "provider_class"]
_PAIR_DAYS = ["member_id", "provider_id", "service_date"]
_SIMPLE = [*_PROVIDER, "service_date", "allowed_amount", "fraud_label", "rule_score"]
SUMMARY_COLUMNS: dict[str, list[str]] = {
    "fraud_breakdown": ["fraud_type", "claim_family"],
    "provider_summary": [*_PROVIDER, *_MARKS, "claim_status", "contract_rate", "billed_amount", "paid_amount"],
    "family_financials": ["claim_family", "claim_status", "payment_type", "billed_amount", "contract_rate", "paid_amount",
                          "applied_to_deductible", "coinsurance_amount"],
    "claim_level": [*_CLAIM, *_MARKS],
    "encounter_level": ["encounter_id", *_MARKS],
    "dataset_metrics": [*_CLAIM, *_MARKS, "member_id", "claim_status", "linked_facility_claim"],
    "dataset_metrics_v5": [*_CLAIM, *_MARKS, "member_id", "claim_status", "linked_facility_claim"],
    "calibration_summary": [*_CLAIM, *_MARKS],
    "rule_reason_summary": ["rule_primary_reason_detected", "flagged_for_review"],
    "detection_by_fraud_type": ["fraud_type", "flagged_for_review", "rule_score"],
    "member_provider_history": [*_PAIR_DAYS, "paid_amount"],
    "claim_status_reason": ["claim_status", "denial_reason"],
    "provider_summary_simple": _SIMPLE,
    "fraud_breakdown_label": ["fraud_type", "fraud_label"],
    "rule_reason_by_label": ["rule_primary_reason_detected", "fraud_label"],
    "rule_recall_within_type": ["fraud_type", "flagged_for_review", "rule_score"],
    "provider_rollup": ["provider_id", "service_date", *_MARKS, "allowed_amount"],
    "family_profile": [*_CLAIM, *_MONEY, "fraud_label", "claim_status"],
    "provider_profile": [*_CLAIM, *_PROVIDER, *_MARKS, "billed_amount", "paid_amount", "claim_status", "service_date", "member_id"],
    "fraud_profile": [*_CLAIM, "fraud_type", "billed_amount", "paid_amount", "member_id"],
    "reason_precision": ["rule_primary_reason_detected", *_MARKS],
    "relationship_profile": [*_CLAIM, "member_id", "paid_amount", "fraud_type"],
    "status_profile": ["claim_status", "denial_reason", "billed_amount", "paid_amount"],
    "dataset_profile": [*_CLAIM, *_MONEY, "fraud_label", "claim_status", "member_id"],
    "denial_clusters": ["claim_family", "claim_status", "denial_reason"],
    "fraud_concentration": ["fraud_label", "fraud_type", "provider_id"],
    "specialty_suspicion": ["provider_specialty", *_MARKS],
    "persistent_relationships": [*_PAIR_DAYS, "flagged_for_review"],
    "episode_summary": ["episode_id", "claim_family", "linked_facility_claim", "billed_amount", "paid_amount", *_MARKS],
    "confusion_counts": _MARKS,
    "rule_metrics": _MARKS,
    "model_performance_rules": _MARKS,
    "roc_auc_rule_score": ["fraud_label", "rule_score"],
    "rule_vs_label_by_level": [*_CLAIM, *_MARKS],
}


def _lines(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The scored lines: the whole table, or at least the columns that the query reads."""
    if columns is None:
        return materialized_lines(spark, sf_dir, TEST_CONFIG)
    return lines_with(spark, sf_dir, columns, TEST_CONFIG)


def _projection(cols: list[str]) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return final_projection(_lines(spark, sf_dir, cols), [(c, V6_TYPES[c]) for c in cols])
    return q


def _summary(fn: Callable[[DataFrame], DataFrame], cols: list[str]) -> Query:
    return lambda spark, sf_dir: fn(_lines(spark, sf_dir, cols))


def v6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return final_projection(_lines(spark, sf_dir))


def claims_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K03 before seeding: the shaped and priced line table."""
    df = shaped_lines(spark, sf_dir)
    return df.select(
        F.col("enc_key").alias("order_key"), "claim_line_no", "member_id", "provider_id", "service_date",
        "encounter_type", "claim_family", "service_code", "units",
        to_double(F.col("allowed_amount")).alias("allowed_amount"),
        to_double(F.col("contract_rate")).alias("contract_rate"),
        to_double(F.col("billed_amount")).alias("billed_amount"),
        "claim_status", "denial_reason", "payment_type")


def review_queue_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    rq = review_queue(_lines(spark, sf_dir, [
        "line_id", "encounter_id", "provider_id", "member_id", "service_date", "claim_family", "service_code", "rule_score",
        "rule_primary_reason_detected", "fraud_type", "billed_amount", "contract_rate", "flagged_for_review"]))
    return rq.select(*[to_double(F.col(c)).alias(c) if c in ("billed_amount", "contract_rate") else F.col(c)
                       for c in rq.columns])


# ----------------------------------------------------------------------------- v3 profile

_V3_CACHE: dict[tuple, tuple[set[str], DataFrame]] = {}
V3_TYPES = {
    "units": "int", "billed_amount": "cents", "allowed_amount": "cents", "paid_amount": "cents",
    "coding_edit_flag": "int", "pricing_error_flag": "int", "egregious_charge_flag": "int", "fraud_label": "int",
    "duplicate_signature_count": "bigint", "provider_day_claim_count": "bigint", "provider_avg_allowed": "double",
    "code_avg_allowed": "double", "allowed_to_code_avg_ratio": "double", "billed_to_allowed_ratio": "double",
    "rule_score": "int", "rule_pred": "int",
}


def _v3(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """The scored v3 lines with at least ``columns``; a query that asks for others than the first one builds the whole table."""
    from claimlens.plans.v3 import v3_lines as build
    from claimlens.session import stage_table
    key = (spark.sparkContext.applicationId, sf_dir)
    held, lines = _V3_CACHE.get(key, (None, None))
    if lines is not None and set(columns) <= held:
        return lines
    if lines is None:
        df = build(spark, sf_dir, columns=columns).select(*columns)
    else:
        df = build(spark, sf_dir)
    _V3_CACHE[key] = set(df.columns), stage_table(df, "v3-scored")
    return _V3_CACHE[key][1]


def v3_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.plans.v3 import V3_RULES
    cols = ["line_id", "claim_family", "encounter_type", "service_code", "units", "billed_amount", "allowed_amount",
            "paid_amount", "claim_status", "coding_edit_flag", "coding_edit_type", "price_method", "source_system",
            "pricing_error_flag", "egregious_charge_flag", "fraud_label", "fraud_type", "duplicate_signature_count",
            "provider_day_claim_count", "provider_avg_allowed", "code_avg_allowed", "allowed_to_code_avg_ratio",
            "billed_to_allowed_ratio"] + V3_RULES + ["rule_score", "rule_pred", "rule_primary_reason"]
    df = _v3(spark, sf_dir, cols)
    out = []
    for c in cols:
        t = V3_TYPES.get(c, "int" if c.startswith("rule_") and c != "rule_primary_reason" else "string")
        out.append(to_double(F.col(c)).alias(c) if t == "cents" else F.col(c).cast(t).alias(c))
    return df.select(*out)


def v3_recall_within_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J16 on the v3 profile (caught = rule_pred)."""
    df = _v3(spark, sf_dir, ["fraud_type", "rule_pred", "rule_score"])
    return S.rule_recall_within_type(df.withColumnRenamed("rule_pred", "flagged_for_review"))


def v3_provider_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J17 on the v3 profile."""
    df = _v3(spark, sf_dir, ["provider_id", "service_date", "fraud_label", "rule_pred", "allowed_amount"])
    return S.provider_rollup(df.withColumnRenamed("rule_pred", "flagged_for_review"))


def v3_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V02 on the v3 profile."""
    return V.rule_metrics(_v3(spark, sf_dir, ["fraud_label", "rule_pred"]), pred="rule_pred")


def v3_reason_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reason x prediction counts on the v3 profile."""
    df = _v3(spark, sf_dir, ["rule_primary_reason", "rule_pred"])
    return df.groupBy("rule_primary_reason", "rule_pred").agg(F.count(F.lit(1)).alias("count"))


# ----------------------------------------------------------------------------- other profiles

TEST_VOLUME = 3  # provider-day thresholds that can fire on the small test tables (SURVEY H8)
CHUNK_SIZE = 4096  # encounters (order keys) per chunk for the incremental queries


def _seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.plans.v6 import materialized_seeded
    return materialized_seeded(spark, sf_dir, TEST_CONFIG).withColumn("line_id", line_id())


def rules_v5_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.operators.profiles import V5_RULES, RulesV5, rules_v5
    df = rules_v5(_lines(spark, sf_dir), RulesV5(volume_threshold=TEST_VOLUME))
    return df.select("line_id", *V5_RULES, "rule_score", "flagged_for_review", "rule_primary_reason")


def v5_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: the 60-column v5 line table, with v5's own rules."""
    from claimlens.operators.profiles import RulesV5, rules_v5
    from claimlens.plans.v6 import V5_DROP
    return final_projection(rules_v5(whole_lines(spark, sf_dir, TEST_CONFIG), RulesV5(volume_threshold=TEST_VOLUME)), drop=V5_DROP)


def rule_reason_summary_v5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v5 reason summary: counts by the seeded reason and the v5 flag."""
    from claimlens.operators.profiles import RulesV5, rules_v5
    df = rules_v5(_lines(spark, sf_dir), RulesV5(volume_threshold=TEST_VOLUME))
    return df.groupBy("rule_primary_reason", "flagged_for_review").agg(F.count(F.lit(1)).alias("count"))


def rules_v2_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.operators.profiles import V2_RULES, RulesV2, features_v2, rules_v2
    df = rules_v2(features_v2(_seeded(spark, sf_dir)), RulesV2(volume_threshold=TEST_VOLUME))
    return df.select("line_id", "duplicate_signature_count", "provider_day_claim_count", "provider_avg_allowed",
                     "code_avg_allowed", "allowed_to_code_avg_ratio", "billed_to_allowed_ratio",
                     "provider_fraud_rate", *V2_RULES, "rule_score", "rule_pred", "rule_primary_reason")


_FD: dict[tuple, DataFrame] = {}


def _fd_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first script's adjudicated base lines, with what it reads of them."""
    from claimlens.operators.edits import adjudicate_initial
    from claimlens.operators.seed_fd import FD_CARRIED
    from claimlens.session import code_cut
    return adjudicate_initial(shaped_lines(spark, sf_dir, code_cut)).select(
        "enc_key", "claim_line_no", "line_key", "provider_id", "service_code", "units", "base_cents",
        "allowed_amount", "billed_amount", "paid_amount", *FD_CARRIED)


def _fd_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first script's whole set: adjudicated base lines and the copies of F19-F21 (written once per session)."""
    from claimlens.operators.seed_fd import base_and_copies
    from claimlens.session import stage_table
    from claimlens.sources.tables import read_table
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FD:
        base = stage_table(_fd_base(spark, sf_dir), "fd-base")
        _FD[key] = stage_table(base_and_copies(base, read_table(spark, sf_dir, "supplier", ["s_suppkey"])), "fd-claims")
    return _FD[key]


def _fd_lines(spark: SparkSession, sf_dir: str, claims: DataFrame | None = None) -> DataFrame:
    """G01-G04, G06 and R16 of the first script, with its model inputs (amounts as DOUBLE), on the seeded lines or ``claims``.

    The star tables hold no provider risk score: the provider's contract discount stands in for it.
    """
    from claimlens.operators.profiles import RulesFD, features_fd, rules_fd
    from claimlens.operators.shape import pos_flags
    claims = _seeded(spark, sf_dir) if claims is None else claims
    df = rules_fd(features_fd(claims), RulesFD(volume_threshold=TEST_VOLUME))
    telehealth, inpatient, _ = pos_flags(F.col("place_of_service"))
    return df.withColumns({
        "telehealth_flag": telehealth, "inpatient_flag": inpatient,
        "provider_risk_score": F.col("contract_discount_rate").cast("double") / F.lit(100.0),
        **{c: to_double(F.col(c)) for c in ("allowed_amount", "billed_amount", "paid_amount")}})


def _fd_model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model inputs, labels and rule prediction of base lines and copies, written once: both models read them several times."""
    from claimlens.session import stage_table
    return stage_table(_fd_lines(spark, sf_dir, _fd_claims(spark, sf_dir)).select("line_id", "fraud_label", "rule_pred", *V.FD_FEATURES), "fd-features")


def feature_vector_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first script's 15 model inputs, null as 0."""
    return V.feature_vector(_fd_lines(spark, sf_dir))


def feature_vector_appended_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M01 on the first script's set, base lines and appended copies."""
    return V.feature_vector(_fd_lines(spark, sf_dir, _fd_claims(spark, sf_dir)))


def _rules_fd_columns(df: DataFrame, *more: str) -> DataFrame:
    from claimlens.operators.profiles import FD_RULES
    return df.select("line_id", *more, "duplicate_signature_count", "provider_day_claim_count", "provider_avg_allowed",
                     "procedure_avg_allowed", "allowed_to_proc_avg_ratio", "billed_to_allowed_ratio",
                     *FD_RULES, "rule_score", "rule_pred")


def rules_fd_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules_fd_columns(_fd_lines(spark, sf_dir))


def rules_fd_appended_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R16 on the first script's set, base lines and appended copies."""
    return _rules_fd_columns(_fd_lines(spark, sf_dir, _fd_claims(spark, sf_dir)), "fraud_type", "fraud_label")


def _chunked(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    from claimlens.operators.features import with_chunk_id
    return with_chunk_id(_lines(spark, sf_dir, ["enc_key", *columns]), CHUNK_SIZE)


def merge_provider_partials_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.streaming.incremental import ROLLUP_COLUMNS, merge_provider_partials, provider_partials
    return merge_provider_partials(provider_partials(_chunked(spark, sf_dir, ROLLUP_COLUMNS)))


def merge_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.streaming.incremental import merge_counts
    return merge_counts(_chunked(spark, sf_dir, ["fraud_type"]), "fraud_type")


def merge_confusion_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.streaming.incremental import merge_confusion
    return merge_confusion(_chunked(spark, sf_dir, _MARKS))


def merge_detection_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.streaming.incremental import merge_detection
    return merge_detection(_chunked(spark, sf_dir, SUMMARY_COLUMNS["detection_by_fraud_type"]))


def stream_provider_rollup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.streaming.incremental import ROLLUP_COLUMNS, stream_provider_rollup
    return stream_provider_rollup(spark, _lines(spark, sf_dir, ["enc_key", *ROLLUP_COLUMNS]), CHUNK_SIZE)


# ----------------------------------------------------------------------------- claim lake

_LAKE: dict[tuple, dict] = {}


def _lake(spark: SparkSession, sf_dir: str) -> dict:
    from claimlens.plans.lake import build_lake
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKE:
        _LAKE[key] = build_lake(spark, sf_dir)
    return _LAKE[key]


def lake_header_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lake(spark, sf_dir)["header"]


def lake_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _lake(spark, sf_dir)["lines"]
    return df.select(*[to_double(F.col(c)).alias(c) if c.endswith("_amount") else F.col(c) for c in df.columns])


def lake_dx_bridge_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lake(spark, sf_dir)["dx"]


def lake_labels_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lake(spark, sf_dir)["labels"]


def lake_member_months_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.plans.lake import member_months
    return member_months(spark, sf_dir, _lake(spark, sf_dir)["raw_header"])


def bad_provider_pick_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.plans.lake import lake_providers
    return lake_providers(spark, sf_dir).select("provider_id", "specialty", "state", "network_status",
                                                F.col("is_bad_provider").cast("int").alias("is_bad_provider"))


def lake_partition_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the lake hive-partitioned by (year, month), read it back, count rows per partition."""
    import uuid
    from claimlens.plans.lake import write_lake
    from claimlens.session import checkpoint_dir
    path = checkpoint_dir(spark).rstrip("/") + f"/claimlens-lake/{uuid.uuid4().hex}"
    write_lake(_lake(spark, sf_dir), path)
    out = None
    for name in ("header", "lines", "dx", "labels"):
        part = spark.read.parquet(f"{path}/{name}").groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count")) \
            .select(F.lit(name).alias("table_name"), "year", "month", "row_count")
        out = part if out is None else out.unionByName(part)
    return out


# ----------------------------------------------------------------------------- sinks, manifest, sampling

SAMPLE_PER_CHUNK, SAMPLE_TOTAL = 1500, 4000


def _scratch(spark: SparkSession, what: str) -> str:
    import uuid
    from claimlens.session import checkpoint_dir
    return checkpoint_dir(spark).rstrip("/") + f"/claimlens-{what}/{uuid.uuid4().hex}"


def chunk_manifest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.sources.sinks import chunk_manifest
    return chunk_manifest(_lines(spark, sf_dir, ["enc_key", "service_date"]), CHUNK_SIZE)


def sample_per_chunk_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.sources.sinks import sample_per_chunk
    # a sample's candidates are shuffled, sorted and written whole: only the columns that it returns
    columns = ["line_id", "enc_key", "fraud_type"]
    lines = _lines(spark, sf_dir, columns).select(*columns)
    return sample_per_chunk(lines, CHUNK_SIZE, SAMPLE_PER_CHUNK, SAMPLE_TOTAL).select("line_id", "chunk_id", "fraud_type")


def union_families_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.sources.sinks import union_lines
    d = _lines(spark, sf_dir, ["line_id", "claim_family", "drug_name", "drug_type", "ndc", "days_supply", "revenue_code"])
    fam = F.col("claim_family")
    pharm = d.filter(fam == "pharmacy").select("line_id", "claim_family", "drug_name", "drug_type", "ndc",
                                               F.col("days_supply").cast("double").alias("days_supply"))
    inst = d.filter(fam == "institutional").select("line_id", "claim_family", "revenue_code")
    rest = d.filter(~fam.isin("pharmacy", "institutional")).select("line_id", "claim_family")
    return union_lines(pharm, inst, rest)


def write_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.sources.sinks import write_lines
    path = _scratch(spark, "lines")
    columns = ["line_id", "enc_key", "fraud_label"]
    write_lines(_lines(spark, sf_dir, columns).select(*columns), path, CHUNK_SIZE)
    return spark.read.parquet(path).select("line_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), "fraud_label")


def write_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlens.sources.sinks import write_summary
    path = _scratch(spark, "summary")
    summary = S.fraud_breakdown(_lines(spark, sf_dir, SUMMARY_COLUMNS["fraud_breakdown"]))
    write_summary(summary, path, one_file=True)
    return spark.read.option("header", True).schema(summary.schema).csv(path)


# ----------------------------------------------------------------------------- models

def random_forest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M04 (rows-only check): test-split predictions of the balanced random forest."""
    from claimlens.operators.models import random_forest
    return random_forest(_fd_model_input(spark, sf_dir), num_trees=200, max_depth=10)


def isolation_forest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M02 (rows-only check): isolation-forest scores and the 8 % anomaly flag."""
    from claimlens.operators.models import isolation_forest
    return isolation_forest(_fd_model_input(spark, sf_dir))


def performance_table_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V04 (rows-only check): rules, forest and isolation forest side by side."""
    from claimlens.operators.models import isolation_forest, performance_rows, random_forest
    lines = _fd_model_input(spark, sf_dir)
    return performance_rows(lines, random_forest(lines, num_trees=200, max_depth=10), isolation_forest(lines))


def stratified_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 30 % test share per label."""
    columns = ["line_id", "fraud_label"]
    return V.stratified_split(_lines(spark, sf_dir, columns).select(*columns)).select(
        "line_id", "fraud_label", "is_test")


# ----------------------------------------------------------------------------- more line operators

def dictionary_fields_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N13."""
    return S.dictionary_fields(_lines(spark, sf_dir, [
        "line_id", *_CLAIM, "provider_specialty", "contract_discount_rate", "allowed_amount", "contract_rate", "billed_amount",
        "applied_to_deductible", "coinsurance_amount", "rule_duplicate", "rule_egregious_billed"]))


def top_suspicious_providers_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 10 providers of J13 (full tiebreak)."""
    return S.top_suspicious_providers(_lines(spark, sf_dir, _SIMPLE))


def top_suspicious_providers_fd_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J14 in the first script's order."""
    return S.top_suspicious_providers_fd(_lines(spark, sf_dir, _SIMPLE))


def top_fraud_types_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent types."""
    return S.top_counts(_lines(spark, sf_dir, ["fraud_type"]), "fraud_type")


def top_rule_reasons_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent reasons."""
    return S.top_counts(_lines(spark, sf_dir, ["rule_primary_reason_detected"]), "rule_primary_reason_detected")


def adjudicate_initial_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjudication with a drawn trend, before seeding."""
    from claimlens.operators.edits import adjudicate_initial
    df = adjudicate_initial(shaped_lines(spark, sf_dir))
    return df.select(F.col("enc_key").alias("order_key"), "claim_line_no", "claim_status",
                     *[to_double(F.col(c)).alias(c) for c in ("contract_rate", "applied_to_deductible",
                                                             "coinsurance_amount", "paid_amount")])


def features_chunk_scope_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The v6 features computed inside each chunk of CHUNK_SIZE encounters."""
    from dataclasses import replace
    from claimlens.plans.v6 import scored_lines
    cfg = replace(TEST_CONFIG, scope="chunk", chunk_size=CHUNK_SIZE)
    df = scored_lines(spark, sf_dir, cfg)
    return df.select("line_id", "chunk_id", "duplicate_signature_count", "provider_day_claim_count",
                     "provider_avg_contract_rate", "service_code_avg_contract_rate", "rule_score",
                     "flagged_for_review")


def line_flags_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D02, D05, P03, P05, P08 on the line table."""
    from claimlens.operators.shape import age_factor, clip_units, high_risk_member, pos_flags, provider_type
    d = _lines(spark, sf_dir, ["line_id", "member_age", "chronic_score", "provider_specialty", "place_of_service", "units"])
    tele, inpat, emerg = pos_flags(F.col("place_of_service"))
    return d.select(
        "line_id", high_risk_member(F.col("member_age"), F.col("chronic_score")).alias("high_risk_member"),
        provider_type(F.col("provider_specialty")).alias("provider_type"),
        tele.alias("telehealth_flag"), inpat.alias("inpatient_flag"), emerg.alias("emergency_flag"),
        (age_factor(F.col("member_age")).cast("double") / 10000.0).alias("age_factor"),
        clip_units(F.col("units")).alias("clipped_units"))


# The star tables hold no contract: a member's plan stands for the network that it buys.
PLAN_CONTRACT = {"gold": "COMM_A", "silver": "COMM_B", "bronze": "COMM_C", "self_funded": "MEDICARE_LIKE"}


def contract_reprice_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: contract and contracted allowed amount of every line."""
    from claimlens.functions.draws import draw
    from claimlens.operators.shape import contract_reprice
    plan = F.lit(None).cast("string")
    for name, contract in PLAN_CONTRACT.items():
        plan = F.when(F.col("plan_type") == name, F.lit(contract)).otherwise(plan)
    contract, allowed = contract_reprice(F.col("billed_amount"), plan, F.col("encounter_type"), draw(F.col("line_key"), "reprice"))
    return _seeded(spark, sf_dir).select("line_id", contract.alias("contract_rate_id"),
                                         to_double(F.col("billed_amount")).alias("billed_amount"),
                                         to_double(allowed).alias("contracted_allowed"))


def append_fixed_rate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first script's appended anomaly copies (appended rows only)."""
    from claimlens.operators.seed_fd import append_fixed_rate
    from claimlens.session import stage_table
    from claimlens.sources.tables import read_table
    shaped = shaped_lines(spark, sf_dir)
    shaped = stage_table(shaped.select("line_key", "provider_id", "service_code", "units", "base_cents",
                                       "allowed_amount", "billed_amount"), "fd-source")
    rows = append_fixed_rate(shaped, read_table(spark, sf_dir, "supplier", ["s_suppkey"]))
    return rows.select(*[to_double(F.col(c)).alias(c) if c.endswith("_amount") else F.col(c) for c in rows.columns])


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {"v6_lines": v6_lines, "claims_from_star": claims_from_star, "review_queue": review_queue_q,
                             "v3_lines": v3_lines_q, "v3_recall_within_type": v3_recall_within_type,
                             "v3_provider_rollup": v3_provider_rollup, "v3_rule_metrics": v3_rule_metrics,
                             "v3_reason_summary": v3_reason_summary,
                             "rules_v5": rules_v5_q, "rule_reason_summary_v5": rule_reason_summary_v5,
                             "rules_v2": rules_v2_q, "rules_fd": rules_fd_q, "feature_vector": feature_vector_q,
                             "merge_provider_partials": merge_provider_partials_q, "merge_counts": merge_counts_q,
                             "merge_confusion": merge_confusion_q, "merge_detection": merge_detection_q,
                             "stream_provider_rollup": stream_provider_rollup_q,
                             "lake_header": lake_header_q, "lake_lines": lake_lines_q,
                             "lake_dx_bridge": lake_dx_bridge_q, "lake_labels": lake_labels_q,
                             "lake_member_months": lake_member_months_q, "bad_provider_pick": bad_provider_pick_q,
                             "lake_partition_counts": lake_partition_counts_q,
                             "chunk_manifest": chunk_manifest_q, "sample_per_chunk": sample_per_chunk_q,
                             "union_families": union_families_q, "write_lines": write_lines_q,
                             "write_summary_csv": write_summary_q,
                             "random_forest": random_forest_q, "isolation_forest": isolation_forest_q,
                             "performance_table": performance_table_q, "stratified_split": stratified_split_q,
                             "dictionary_fields": dictionary_fields_q,
                             "top_suspicious_providers": top_suspicious_providers_q,
                             "top_suspicious_providers_fd": top_suspicious_providers_fd_q,
                             "top_fraud_types": top_fraud_types_q, "top_rule_reasons": top_rule_reasons_q,
                             "v5_lines": v5_lines_q,
                             "adjudicate_initial": adjudicate_initial_q,
                             "features_chunk_scope": features_chunk_scope_q, "line_flags": line_flags_q,
                             "append_fixed_rate": append_fixed_rate_q,
                             "rules_fd_appended": rules_fd_appended_q, "feature_vector_appended": feature_vector_appended_q,
                             "contract_reprice": contract_reprice_q}
    from claimlens.plans.extra import extra_queries
    out.update(extra_queries())
    out.update({name: _projection(cols) for name, cols in LINE_PROJECTIONS.items()})
    out.update({name: _summary(fn, SUMMARY_COLUMNS[name]) for name, fn in SUMMARIES.items()})
    return out
