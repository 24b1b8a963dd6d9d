"""The relational claim lake: header, line, diagnosis bridge and label tables.

Headers are orders, lines are their lineitems, members are customers and
providers are suppliers.  Claim-level anomalies (F22-F27) are applied with
joins to per-claim aggregates and ``explode`` for added lines, never with
per-claim loops; header totals (L04) are recomputed from the final lines.
Money is integer cents inside, DOUBLE at output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions.draws import draw, weighted_category
from claimlens.functions.money import round_div, scale, to_double
from claimlens.functions.sampling import select_by_hash_quota
from claimlens.operators.numbering import exchange_by_encounter
from claimlens.operators.shape import LINE_ORDER
from claimlens.sources.catalogs import cents
from claimlens.sources.tables import read_table

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference for equal results)
# ---------------------------------------------------------------------------
ICD10 = ["E11.9", "I10", "E78.5", "E66.9", "J06.9", "J45.909", "J18.9", "M54.5", "M25.561", "F41.1", "F32.9",
         "K21.9", "S93.401A", "Z00.00", "Z12.11"]
CPT = ["99213", "99214", "99215", "93000", "80053", "85025", "71046", "45378", "20610"]
SPECIALTIES = ["FAMILY", "IM", "ER", "CARD", "ORTHO", "RAD", "LAB", "GI"]
POS_WEIGHTS = [(11, 0.70), (21, 0.12), (22, 0.10), (23, 0.08)]
PROC_WEIGHTS = {
    "FAMILY": [0.40, 0.25, 0.05, 0.03, 0.10, 0.10, 0.02, 0.03, 0.02],
    "IM": [0.35, 0.30, 0.08, 0.04, 0.10, 0.08, 0.02, 0.02, 0.01],
    "ER": [0.20, 0.30, 0.15, 0.07, 0.08, 0.08, 0.06, 0.03, 0.03],
    "CARD": [0.20, 0.25, 0.08, 0.22, 0.08, 0.07, 0.05, 0.03, 0.02],
    "ORTHO": [0.18, 0.22, 0.05, 0.02, 0.07, 0.06, 0.10, 0.02, 0.28],
    "RAD": [0.05, 0.07, 0.03, 0.02, 0.05, 0.05, 0.65, 0.05, 0.03],
    "LAB": [0.03, 0.04, 0.01, 0.01, 0.45, 0.40, 0.02, 0.02, 0.02],
    "GI": [0.12, 0.15, 0.05, 0.02, 0.06, 0.06, 0.03, 0.45, 0.06],
}
BASE_FEE = {"99213": "90", "99214": "140", "99215": "220", "93000": "55", "80053": "40", "85025": "25",
            "71046": "70", "45378": "750", "20610": "120"}
DEFAULT_FEE = "100"
UPLIFT = {"FAMILY": "1.00", "IM": "1.05", "ER": "1.15", "CARD": "1.35", "ORTHO": "1.25", "RAD": "1.20",
          "LAB": "0.90", "GI": "1.30"}
POS_FACTOR = {11: "1.00", 22: "1.25", 23: "1.35", 21: "1.55"}
FRAUD_TYPES = [("DUPLICATE", 0.25), ("UPCODE", 0.25), ("PHANTOM", 0.15), ("EXCESS_UNITS", 0.20), ("UNBUNDLE", 0.15)]
CLAIM_FRAUD_RATE_BP = 200          # 2 % of claims
BAD_PROVIDER_RATE = 0.03
BAD_PROVIDER_FRAUD_BP = 2000       # bad providers: 20 %
OON_SHARE_E4, INN_SHARE_E4 = 4500, 2200
DUPLICATE_ID_OFFSET = 10 ** 12     # duplicate claims get claim_id + offset


def _e2(x: str) -> int:
    return int(round(float(x) * 100))


def _map_int(col: Column, mapping: dict, default: int) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def fee_schedule(code: Column, specialty: Column, pos: Column) -> Column:
    """base[code] else 100, x uplift[specialty] else 1, x POS factor else 1, floor $1 (cents)."""
    base = _map_int(code, {k: cents(v) for k, v in BASE_FEE.items()}, cents(DEFAULT_FEE))
    up = _map_int(specialty, {k: _e2(v) for k, v in UPLIFT.items()}, 100)
    pf = _map_int(pos, {k: _e2(v) for k, v in POS_FACTOR.items()}, 100)
    return F.greatest(scale(base, up * pf, 10000), F.lit(100))


def bad_provider_pick(providers: DataFrame, rate: float = BAD_PROVIDER_RATE) -> DataFrame:
    """Exactly max(1, floor(n * rate)) providers, without replacement (smallest hash)."""
    g = providers.withColumn("_all", F.lit(1))
    quota = lambda n: F.greatest(F.floor(n * F.lit(rate)), F.lit(1))
    return select_by_hash_quota(g, ["_all"], quota, F.col("provider_id"), "lake_bad", "is_bad_provider", share=rate).drop("_all")


def lake_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    p = s.select(F.col("s_suppkey").alias("provider_id"),
                 F.element_at(F.array(*[F.lit(x) for x in SPECIALTIES]), (F.pmod("s_suppkey", F.lit(8)) + 1).cast("int"))
                 .alias("specialty"),
                 F.col("s_nationkey").alias("state"),
                 F.when(draw(F.col("s_suppkey"), "lake_oon") < 1500, "OON").otherwise("INN").alias("network_status"))
    return bad_provider_pick(p)


def lake_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    k = F.col("c_custkey")
    return c.select(k.alias("member_id"), F.pmod(k, F.lit(90)).cast("int").alias("age"),
                    F.when(F.pmod(k, F.lit(2)) == 0, "F").otherwise("M").alias("sex"),
                    (F.lit(40) + F.pmod(k, F.lit(25)) * 10).cast("int").alias("risk_score_e2"),
                    F.col("c_nationkey").alias("state"),
                    F.format_string("%03d", F.pmod(k, F.lit(1000))).alias("zip3"),
                    F.format_string("PLAN%02d", F.pmod(k, F.lit(12))).alias("plan_id"))


def lake_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim headers before anomalies: provider = supplier of the claim's first line (F22 label drawn here)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_linenumber", "l_partkey"])
    first = li.groupBy("l_orderkey").agg(
        F.min_by("l_suppkey", F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("provider_id"))
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    prov = lake_providers(spark, sf_dir)
    h = o.join(first, F.col("o_orderkey") == F.col("l_orderkey")).join(prov, "provider_id")
    ck = F.col("o_orderkey")
    d = F.to_date("o_orderdate")
    fraud = (draw(ck, "lake_fraud") < CLAIM_FRAUD_RATE_BP) | (
        (F.col("is_bad_provider") == 1) & (draw(ck, "lake_bad_fraud") < BAD_PROVIDER_FRAUD_BP))
    return h.select(
        ck.alias("claim_id"), F.col("o_custkey").alias("member_id"), "provider_id", "specialty",
        F.when(draw(ck, "lake_ctype") < 8600, "PROF").otherwise("INST").alias("claim_type"),
        weighted_category(draw(ck, "lake_pos"), [(str(p), w) for p, w in POS_WEIGHTS]).cast("int").alias("place_of_service"),
        d.alias("service_date"), "network_status", F.year(d).alias("year"), F.month(d).alias("month"),
        fraud.cast("int").alias("fraud_flag"),
        F.when(fraud, weighted_category(draw(ck, "lake_ftype"), FRAUD_TYPES)).alias("fraud_type"),
    )


def _proc_pick(specialty: Column, h: Column) -> Column:
    expr = None
    for spec, ws in PROC_WEIGHTS.items():
        pick = weighted_category(h, list(zip(CPT, ws)))
        expr = F.when(specialty == spec, pick) if expr is None else expr.when(specialty == spec, pick)
    return expr


def lake_lines_base(spark: SparkSession, sf_dir: str, header: DataFrame) -> DataFrame:
    """Lines priced with the fee schedule (P07) and member cost share."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                "l_extendedprice", "l_discount", "l_shipdate"])
    d = li.join(header.drop("fraud_type"), F.col("l_orderkey") == F.col("claim_id"))
    claims = exchange_by_encounter(d, li.select("l_orderkey", *LINE_ORDER[:2]), "l_orderkey", LINE_ORDER)
    d = claims.drop_parts(claims.lines.withColumn("line_num", claims.line_number()))
    lk = F.concat_ws("|", F.col("claim_id").cast("string"), F.col("line_num").cast("string"))
    d = d.withColumn("_lk", lk)
    noise = F.lit(80) + F.round(F.col("l_discount") * 100).cast("int") * 4
    unit = scale(fee_schedule(_proc_pick(F.col("specialty"), draw(F.col("_lk"), "lake_proc")), F.col("specialty"),
                              F.col("place_of_service")), noise, 100)
    d = d.withColumns({
        "proc_code": _proc_pick(F.col("specialty"), draw(F.col("_lk"), "lake_proc")),
        "units": F.greatest(F.pmod(F.col("l_quantity").cast("int"), F.lit(3)), F.lit(1)).cast("int"),
        "_unit_allowed": unit,
    })
    share = (F.when(F.col("network_status") == "OON", F.lit(OON_SHARE_E4)).otherwise(F.lit(INN_SHARE_E4))
             + F.pmod(draw(F.col("_lk"), "lake_share"), F.lit(1001)) - 500)
    share = F.least(F.greatest(share, F.lit(500)), F.lit(8000))
    mult = F.lit(1_050_000) + F.pmod(draw(F.col("_lk"), "lake_bmult"), F.lit(10000)) * 295  # U(1.05, 4.0) in 1e-6
    allowed = F.col("_unit_allowed") * F.col("units")
    return d.select(
        "claim_id", "line_num", "member_id", "provider_id", "service_date", "place_of_service", "specialty",
        "proc_code", "units",
        scale(F.col("_unit_allowed"), mult * F.col("units"), 1_000_000).alias("billed_amount"),
        allowed.alias("allowed_amount"),
        scale(allowed, F.lit(10000) - share, 10000).alias("paid_amount"),
        F.lit(1).alias("dx_pointer_primary"), F.col("fraud_flag").alias("is_fraud_line"), "year", "month", "_lk",
    )


def apply_claim_anomalies(lines: DataFrame, header: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F23-F27 on lines of labelled claims; returns (lines, duplicate headers)."""
    per = lines.groupBy("claim_id").agg(
        F.max("line_num").alias("_max_line"),
        F.min(F.struct(draw(F.col("_lk"), "lake_ex_pick").alias("h"), F.col("line_num").alias("n"))).alias("_pick"))
    types = header.select("claim_id", "fraud_type")
    d = lines.join(per, "claim_id").join(types, "claim_id")
    t = F.col("fraud_type")
    first = F.col("line_num") == 1
    ex = (t == "EXCESS_UNITS") & (F.col("line_num") == F.col("_pick.n"))
    r1 = F.lit(6) + F.pmod(draw(F.col("_lk"), "lake_ex_r1"), F.lit(12))
    r2 = F.lit(6) + F.pmod(draw(F.col("_lk"), "lake_ex_r2"), F.lit(12))
    new_units = F.least(F.greatest(F.col("units") * r1, F.lit(8)), F.lit(50))
    d = d.withColumn("_nu", new_units)
    d = d.withColumns({
        "proc_code": F.when((t == "UPCODE") & first, F.lit("99215"))
        .when((t == "UNBUNDLE") & first, F.lit("80053")).otherwise(F.col("proc_code")),
        "allowed_amount": F.when((t == "UPCODE") & first, scale(F.col("allowed_amount"), F.lit(145), 100))
        .when((t == "UNBUNDLE") & first, scale(F.col("allowed_amount"), F.lit(65), 100))
        .when(ex, round_div(F.col("allowed_amount") * F.col("_nu"),
                            F.greatest(F.floor(F.col("_nu") / r2).cast("bigint"), F.lit(1))))
        .otherwise(F.col("allowed_amount")),
        "billed_amount": F.when((t == "UPCODE") & first, scale(F.col("billed_amount"), F.lit(155), 100))
        .when((t == "UNBUNDLE") & first, scale(F.col("billed_amount"), F.lit(70), 100))
        .when(ex, scale(F.col("billed_amount"), F.lit(180), 100)).otherwise(F.col("billed_amount")),
        "paid_amount": F.when((t == "UPCODE") & first, scale(F.col("paid_amount"), F.lit(135), 100))
        .when(ex, scale(F.col("paid_amount"), F.lit(150), 100)).otherwise(F.col("paid_amount")),
        "units": F.when(ex, F.col("_nu")).otherwise(F.col("units")).cast("int"),
    })
    # added lines: phantom / unbundled lab on the first line; duplicate copies of every line
    kinds = (F.when(first & (t == "PHANTOM"), F.array(F.lit("orig"), F.lit("phantom")))
             .when(first & (t == "UNBUNDLE"), F.array(F.lit("orig"), F.lit("unbundle")))
             .otherwise(F.array(F.lit("orig"))))
    d = d.withColumn("_kind", F.explode(kinds))
    add_num = F.col("_max_line") + 1
    k = F.col("_kind")
    ph = k == "phantom"
    ub = k == "unbundle"
    d = d.withColumns({
        "line_num": F.when(ph | ub, add_num).otherwise(F.col("line_num")).cast("int"),
        "proc_code": F.when(ph, F.element_at(F.array(F.lit("45378"), F.lit("99215")),
                                              (F.pmod(draw(F.col("claim_id"), "lake_phantom"), F.lit(2)) + 1).cast("int")))
        .when(ub, F.lit("85025")).otherwise(F.col("proc_code")),
        "units": F.when(ph, F.lit(1)).otherwise(F.col("units")).cast("int"),
        "allowed_amount": F.when(ph, scale(F.col("allowed_amount"), F.lit(220), 100))
        .when(ub, scale(F.col("allowed_amount"), F.lit(85), 100)).otherwise(F.col("allowed_amount")),
        "billed_amount": F.when(ph, scale(F.col("billed_amount"), F.lit(270), 100))
        .when(ub, scale(F.col("billed_amount"), F.lit(90), 100)).otherwise(F.col("billed_amount")),
        "paid_amount": F.when(ph, scale(F.col("paid_amount"), F.lit(200), 100))
        .when(ub, scale(F.col("paid_amount"), F.lit(85), 100)).otherwise(F.col("paid_amount")),
    })
    dup = t == "DUPLICATE"
    d = d.withColumn("_copy", F.explode(F.when(dup, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    shift = F.pmod(draw(F.col("claim_id"), "lake_dup_day"), F.lit(3)).cast("int")
    c = F.col("_copy") == 1
    d = d.withColumns({
        "claim_id": F.when(c, F.col("claim_id") + DUPLICATE_ID_OFFSET).otherwise(F.col("claim_id")),
        "service_date": F.when(c, F.date_add("service_date", shift)).otherwise(F.col("service_date")),
        "is_fraud_line": F.when(c, F.lit(1)).otherwise(F.col("is_fraud_line")),
    })
    cols = ["claim_id", "line_num", "member_id", "provider_id", "service_date", "place_of_service", "specialty",
            "proc_code", "units", "billed_amount", "allowed_amount", "paid_amount", "dx_pointer_primary",
            "is_fraud_line", "year", "month"]
    dup_headers = header.filter(F.col("fraud_type") == "DUPLICATE").withColumns({
        "claim_id": F.col("claim_id") + DUPLICATE_ID_OFFSET,
        "service_date": F.date_add("service_date", F.pmod(draw(F.col("claim_id"), "lake_dup_day"), F.lit(3)).cast("int")),
    })
    return d.select(*cols), dup_headers


def header_totals(header: DataFrame, lines: DataFrame) -> DataFrame:
    """Sums per claim and line_count = max(line_num) (not a count), left-joined to the header."""
    t = lines.groupBy("claim_id").agg(
        F.sum("billed_amount").alias("_b"), F.sum("allowed_amount").alias("_a"), F.sum("paid_amount").alias("_p"),
        F.max("line_num").alias("line_count"))
    h = header.join(t, "claim_id", "left")
    return h.select("claim_id", "member_id", "provider_id", "claim_type", "place_of_service", "service_date",
                    "network_status", "year", "month", to_double(F.col("_b")).alias("total_billed"),
                    to_double(F.col("_a")).alias("total_allowed"), to_double(F.col("_p")).alias("total_paid"),
                    "line_count")


def dx_bridge(header: DataFrame) -> DataFrame:
    """K diagnoses per claim (1-4 professional, 3-9 institutional), ranks 1..k.

    Codes are drawn uniformly: the reference's weight list has one more entry
    than its code list, so it cannot be used as written.
    """
    k = F.when(F.col("claim_type") == "INST", F.lit(3) + F.pmod(draw(F.col("claim_id"), "lake_dx_k"), F.lit(7))) \
        .otherwise(F.lit(1) + F.pmod(draw(F.col("claim_id"), "lake_dx_k"), F.lit(4)))
    d = header.select("claim_id", "year", "month", F.explode(F.sequence(F.lit(1), k.cast("int"))).alias("dx_rank"))
    key = F.concat_ws("|", F.col("claim_id").cast("string"), F.col("dx_rank").cast("string"))
    code = F.element_at(F.array(*[F.lit(c) for c in ICD10]), (F.pmod(draw(key, "lake_dx"), F.lit(len(ICD10))) + 1).cast("int"))
    return d.select("claim_id", "dx_rank", code.alias("icd10_code"), "year", "month")


def labels(header: DataFrame, dup_headers: DataFrame) -> DataFrame:
    """Fraud labels: one row per labelled claim id (duplicates labelled too); K11 keeps the first per id."""
    base = header.filter(F.col("fraud_flag") == 1).select("claim_id", F.lit(1).alias("fraud_flag"), "fraud_type",
                                                          "year", "month")
    dups = dup_headers.select("claim_id", F.lit(1).alias("fraud_flag"), F.lit("DUPLICATE").alias("fraud_type"),
                              "year", "month")
    return distinct_labels(base.unionByName(dups))


def distinct_labels(lab: DataFrame) -> DataFrame:
    """The first label per claim id, with an explicit order (fraud_type), as a skew-safe aggregate."""
    g = lab.groupBy("claim_id").agg(F.min(F.struct("fraud_type", "fraud_flag", "year", "month")).alias("_f"))
    return g.select("claim_id", F.col("_f.fraud_flag").alias("fraud_flag"), F.col("_f.fraud_type").alias("fraud_type"),
                    F.col("_f.year").alias("year"), F.col("_f.month").alias("month"))


def member_months(spark: SparkSession, sf_dir: str, header: DataFrame, base_rate_e2: int = 35) -> DataFrame:
    """Month spine per member; expected claims = clip(.35 x risk, .02, 3); actual claims with 0 fill.

    The spine is a per-member ``explode(sequence(...))`` over the global month
    range (a one-row attach), not a cross join with a month table.
    """
    from claimlens.functions.scalar import attach
    m = lake_members(spark, sf_dir)
    span = header.agg(F.trunc(F.min("service_date"), "month").alias("_lo"), F.trunc(F.max("service_date"), "month").alias("_hi"))
    spine = attach(m, span).select(
        "member_id", "risk_score_e2",
        F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    actual = header.groupBy("member_id", F.trunc("service_date", "month").alias("month_start")).agg(
        F.count(F.lit(1)).alias("actual_claims"))
    expected_e4 = F.least(F.greatest(F.col("risk_score_e2") * base_rate_e2, F.lit(200)), F.lit(30000))
    return spine.join(actual, ["member_id", "month_start"], "left").select(
        "member_id", "month_start", (expected_e4.cast("double") / 10000.0).alias("expected_claims"),
        F.coalesce(F.col("actual_claims"), F.lit(0)).cast("bigint").alias("actual_claims"))


def build_lake(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four lake tables (money in cents on lines; header totals as DOUBLE)."""
    from claimlens.session import stage_table
    header = stage_table(lake_header(spark, sf_dir), "lake-header")
    base = lake_lines_base(spark, sf_dir, header)
    lines, dup_headers = apply_claim_anomalies(base, header)
    lines = stage_table(lines, "lake-lines")
    all_headers = header.unionByName(dup_headers)
    return {
        "header": header_totals(all_headers, lines),
        "lines": lines,
        "dx": dx_bridge(all_headers),
        "labels": labels(header, dup_headers),
        "raw_header": all_headers,
    }


def write_lake(tables: dict[str, DataFrame], path: str, replace_months: bool = False) -> None:
    """Hive-partitioned by (year, month), snappy.

    By default rows are appended, as the reference does.  With ``replace_months`` a month that the tables hold replaces
    what was written for it (dynamic partition overwrite) and other months stay, so a job that is run again, or whose
    input was mended, leaves every row once.
    """
    for name in ("header", "lines", "dx", "labels"):
        writer = tables[name].write.option("compression", "snappy").partitionBy("year", "month")
        if replace_months:
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.mode("append")
        writer.parquet(f"{path}/{name}")
