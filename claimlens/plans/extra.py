"""Registered queries of the v2 profile, streamed totals, written line tables, text flags, shares and re-run lakes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions.money import to_double
from claimlens.functions.sampling import sample_shares
from claimlens.operators import summaries as S
from claimlens.operators.profiles import V2_RULES, RulesV2
from claimlens.operators.rules import SIGNALS, apply_rules_v6
from claimlens.operators.evaluate import model_performance
from claimlens.plans import early, v2
from claimlens.plans.queries import CHUNK_SIZE, TEST_VOLUME, _fd_claims, _fd_lines, _lake, _lines, _scratch
from claimlens.plans.v6 import TEST_CONFIG, V5_DROP, V6_COLUMNS, featured_lines, final_projection, shaped_lines, unfold
from claimlens.session import code_cut, stage_table
from claimlens.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

# ----------------------------------------------------------------------------- v2 profile

_V2: dict[tuple, DataFrame] = {}


def _v2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _V2:
        _V2[key] = v2.v2_lines(spark, sf_dir)
    return _V2[key]


def _v2_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v2.v2_scored(_v2_lines(spark, sf_dir), RulesV2(volume_threshold=TEST_VOLUME))


def v2_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P23, P04, P05, P08, A03, D03 and F09-F14 of v2: the seeded lines with the replayed duplicates."""
    return _v2_lines(spark, sf_dir).select(
        "claim_id", "member_id", "provider_id", "service_date", "claim_family", "place_of_service", "diagnosis_code", "revenue_code",
        "service_code", "category", "units", *[to_double(F.col(c)).alias(c) for c in ("billed_amount", "allowed_amount", "paid_amount")],
        (F.col("provider_propensity").cast("double") / F.lit(1e8)).alias("provider_fraud_propensity"),
        "telehealth_flag", "inpatient_flag", "emergency_flag", "fraud_label", "fraud_type")


def v2_rules_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R15 on v2's own seeded lines."""
    return _v2_scored(spark, sf_dir).select(
        "claim_id", "duplicate_signature_count", "provider_day_claim_count", "provider_avg_allowed", "code_avg_allowed",
        "allowed_to_code_avg_ratio", "billed_to_allowed_ratio", "provider_fraud_rate", *V2_RULES, "rule_score", "rule_pred",
        "rule_primary_reason", "fraud_type")


def v2_recall_within_type_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J16 on the v2 profile."""
    return S.rule_recall_within_type(_v2_scored(spark, sf_dir).withColumnRenamed("rule_pred", "flagged_for_review"))


# ----------------------------------------------------------------------------- first script, v3 pharmacy, providers

def _amounts(df: DataFrame, *names: str) -> list:
    return [to_double(F.col(c)).alias(c) for c in names]


def fd_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P04, P05, P08, P21 and A03 in the first script's form."""
    df = early.fd_lines(spark, shaped_lines(spark, sf_dir))
    return df.select("line_key", "service_code", "category", "place_of_service", "units", "telehealth_flag", "inpatient_flag",
                     *_amounts(df, "allowed_amount", "billed_amount", "paid_amount"))


def v3_pharmacy_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P21 in v3's pharmacy form."""
    df = early.v3_pharmacy_lines(spark, shaped_lines(spark, sf_dir))
    return df.select("line_key", "ndc11", "drug_name", "drug_type", "units", *_amounts(df, "billed_amount"))


def provider_propensities_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D03 in its range forms."""
    return early.provider_propensities(read_table(spark, sf_dir, "supplier", ["s_suppkey"]))


def performance_rules_fd_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The performance table's rules row on the first script's set."""
    return model_performance(_fd_lines(spark, sf_dir, _fd_claims(spark, sf_dir)), "rules", pred="rule_pred")


# ----------------------------------------------------------------------------- text flags

def text_flag(name: str) -> F.Column:
    """A flag as exports write it: padded, with a decimal point, empty, missing or no number at all."""
    v, k = F.col(name).cast("string"), F.pmod(F.col("enc_key") * 7 + F.col("claim_line_no"), F.lit(6))
    return (F.when(k == 0, F.concat(F.lit(" "), v, F.lit(" "))).when(k == 1, "n/a").when(k == 2, F.lit(None).cast("string"))
            .when(k == 3, F.concat(v, F.lit(".0"))).when(k == 4, "").otherwise(v))


def rules_text_flags_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The v6 rules on lines whose flags are texts, bad ones among them."""
    flags = ["external_edit_flag", *[f"{s}_signal" for s in SIGNALS]]
    df = _lines(spark, sf_dir)
    df = apply_rules_v6(df.withColumns({c: text_flag(c) for c in flags}), TEST_CONFIG.rules)
    return df.select("line_id", *flags, "rule_external_edit", "rule_upcoding_pattern", "rule_member_submit_outlier", "strong_rule_hit",
                     "rule_score", "flagged_for_review")


# ----------------------------------------------------------------------------- written line tables

_WRITTEN: dict[tuple, str] = {}

#: Declared schema of a written line table: the v6 columns and the chunk directory.
LINE_SCHEMA = ", ".join(f"{c} {t}" for c, t in V6_COLUMNS) + ", chunk_id bigint"


def _written_lines(spark: SparkSession, sf_dir: str) -> str:
    """A line table written by two versions: even chunks with the 68 columns of v6, odd ones with the 60 of v5.

    The compact lines are staged with their features and brought to their chunks' order; only then are they unfolded to
    all columns, so the wide rows go from there to their files without an exchange or a sort.
    """
    from claimlens.operators.features import with_chunk_id
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = _scratch(spark, "line-files")
        chunked = with_chunk_id(stage_table(featured_lines(spark, sf_dir, TEST_CONFIG), "featured"), CHUNK_SIZE)
        for odd, drop in ((0, ()), (1, V5_DROP)):
            order = ["chunk_id", "enc_key", "claim_line_no"]
            part = chunked.where(F.col("chunk_id") % 2 == odd).repartitionByRange(*order).sortWithinPartitions(*order)
            # the cut keeps this sort from being given up for one of the wide rows
            out = final_projection(unfold(spark, code_cut(part), TEST_CONFIG), V6_COLUMNS + [("chunk_id", "bigint")], drop)
            out.write.mode("append").option("compression", "zstd").partitionBy("chunk_id").parquet(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def read_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk files of both versions under the declared schema; what a file lacks is null."""
    from claimlens.sources.tables import read_lines
    df = read_lines(spark, _written_lines(spark, sf_dir), LINE_SCHEMA)
    return df.select("line_id", "chunk_id", "fraud_type", "billed_amount", "service_date", "days_supply", "rule_score", "strong_rule_hit",
                     "rule_upcoding_pattern", "upcoding_signal", "rule_primary_reason_detected")


def file_manifest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K08 from the files themselves, summed by chunk (file names differ from run to run)."""
    from claimlens.sources.sinks import file_manifest
    from claimlens.sources.tables import read_lines
    files = file_manifest(read_lines(spark, _written_lines(spark, sf_dir), LINE_SCHEMA, file_column="file"))
    return files.groupBy("chunk_number", "format").agg(
        F.sum("row_count").alias("row_count"), F.min("min_service_date").alias("min_service_date"),
        F.max("max_service_date").alias("max_service_date"), (F.count_distinct("file_name") > 0).alias("has_files"))


# FIXED PARAMETERS of the registered sample.
SAMPLE_SHARES = {"professional": 0.10, "institutional": 0.30, "pharmacy": 0.50}
SAMPLE_REST = 0.05


def sample_shares_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K09 in its share form: each family's share of lines, by the hash of the line."""
    return sample_shares(_lines(spark, sf_dir, ["line_id", "claim_family", "fraud_type"]), "claim_family", SAMPLE_SHARES, F.col("line_id"), "shares", SAMPLE_REST).select(
        "line_id", "claim_family", "fraud_type")


# ----------------------------------------------------------------------------- streamed totals

def _stream(spark: SparkSession, sf_dir: str, state: Callable[[DataFrame], DataFrame]) -> DataFrame:
    from claimlens.streaming.incremental import stream_totals, write_chunks
    folder = _scratch(spark, "totals")
    columns = ["enc_key", "fraud_type", "fraud_label", "flagged_for_review", "rule_score"]
    lines = _lines(spark, sf_dir, columns).select(*columns)
    write_chunks(lines, f"{folder}/chunks", CHUNK_SIZE)
    return stream_totals(spark, f"{folder}/chunks", folder, state)


def stream_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I05 for I02."""
    from claimlens.streaming.incremental import counts_state
    return _stream(spark, sf_dir, counts_state)


def stream_confusion_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I05 for I03."""
    from claimlens.streaming.incremental import confusion_state
    return _stream(spark, sf_dir, confusion_state)


def stream_detection_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I05 for I04."""
    from claimlens.streaming.incremental import detection_report, detection_state
    return detection_report(_stream(spark, sf_dir, detection_state))


# ----------------------------------------------------------------------------- lake written again

def lake_rerun_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by month after the first quarter of the lake was written a second time."""
    from claimlens.plans.lake import write_lake
    path, lake = _scratch(spark, "lake"), _lake(spark, sf_dir)
    names = ("header", "lines", "dx", "labels")
    write_lake(lake, path, replace_months=True)
    write_lake({name: lake[name].where(F.col("month").cast("int") <= 3) for name in names}, path, replace_months=True)
    out = None
    for name in names:
        part = spark.read.parquet(f"{path}/{name}").groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count")) \
            .select(F.lit(name).alias("table_name"), "year", "month", "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def extra_queries() -> dict[str, Query]:
    return {
        "v2_lines": v2_lines_q, "v2_rules": v2_rules_q, "v2_recall_within_type": v2_recall_within_type_q,
        "fd_lines": fd_lines_q, "v3_pharmacy_lines": v3_pharmacy_lines_q, "provider_propensities": provider_propensities_q,
        "performance_rules_fd": performance_rules_fd_q, "rules_text_flags": rules_text_flags_q, "read_lines": read_lines_q, "file_manifest": file_manifest_q,
        "sample_shares": sample_shares_q, "stream_counts": stream_counts_q, "stream_confusion": stream_confusion_q,
        "stream_detection": stream_detection_q, "lake_rerun_counts": lake_rerun_counts_q,
    }
