"""The v2 profile: professional and institutional lines priced by code pairs, five anomaly modes, replayed duplicates.

shaped star lines -> place, code pair (P23: weights met by an interval lookup, then a join on revenue code and procedure
with a missing procedure as empty text), units (P08), severity and age (P04, P05), amounts (P21, A03) -> candidates by the
class's propensity range (D03), one of five modes and its effects (F09, F11-F14) -> 70 % of the duplicates replayed
(F10) -> features and rules (G01-G07, R15).  Draws are hashes of the line; amounts are cents.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions.draws import draw, int_between, uniform_e6, weighted_category
from claimlens.functions.intervals import interval_lookup, weight_intervals
from claimlens.functions.money import round_div, scale
from claimlens.functions.sampling import hash32, hash_cut_offs, is_taken
from claimlens.operators.edits import paid_share
from claimlens.operators.profiles import RulesV2, features_v2, rules_v2
from claimlens.operators.shape import _pick, age_factor, clip_units, pos_flags, provider_type, severity_factor
from claimlens.plans.v6 import shaped_lines
from claimlens.session import stage_table
from claimlens.sources.catalogs import cents, local_table

# FIXED VALUES: professional codes (base amount, typical units, category).
PROFESSIONAL = [
    ("99212", "70.00", 1, "E&M"), ("99213", "95.00", 1, "E&M"), ("99214", "145.00", 1, "E&M"), ("99215", "210.00", 1, "E&M"),
    ("93000", "55.00", 1, "Cardiology"), ("71046", "85.00", 1, "Imaging"), ("80048", "28.00", 1, "Lab"),
    ("80053", "35.00", 1, "Lab"), ("83036", "25.00", 1, "Lab"), ("85025", "22.00", 1, "Lab"), ("84443", "30.00", 1, "Lab"),
    ("36415", "8.00", 1, "Lab"), ("90471", "28.00", 1, "Preventive"), ("90686", "32.00", 1, "Preventive"),
    ("90834", "120.00", 1, "Behavioral"), ("90837", "165.00", 1, "Behavioral"), ("97110", "40.00", 2, "Therapy"),
    ("97112", "45.00", 2, "Therapy"), ("97140", "38.00", 2, "Therapy"), ("11721", "60.00", 1, "Podiatry"),
    ("G0438", "160.00", 1, "Preventive"), ("G0439", "175.00", 1, "Preventive"),
]
# FIXED VALUES: institutional pairs (revenue code, procedure or none, base amount, typical units, category, weight).
INSTITUTIONAL = [
    ("0450", "99284", "850.00", 1, "ED", 0.22), ("0450", "99285", "1400.00", 1, "ED", 0.08),
    ("0510", "99281", "220.00", 1, "Clinic", 0.09), ("0510", "99282", "350.00", 1, "Clinic", 0.06),
    ("0360", "47562", "6500.00", 1, "OR", 0.06), ("0360", "27447", "12000.00", 1, "OR", 0.05),
    ("0762", None, "450.00", 6, "Observation", 0.10), ("0300", "80053", "140.00", 1, "Lab", 0.09),
    ("0300", "85025", "95.00", 1, "Lab", 0.08), ("0250", None, "75.00", 3, "Pharmacy", 0.08),
    ("0270", None, "60.00", 2, "Supplies", 0.05), ("0636", "J1885", "55.00", 1, "Drugs", 0.04),
]
# FIXED VALUES: code menus by specialty; others have the first.
MENUS = {
    "Primary Care": ["99212", "99213", "99214", "80048", "80053", "83036", "85025", "84443", "36415", "G0439", "90471", "90686"],
    "Internal Medicine": ["99213", "99214", "99215", "80053", "83036", "85025", "93000"],
    "Behavioral Health": ["90834", "90837", "99213", "99214"],
    "Cardiology": ["93000", "99214", "99215", "71046"],
    "Therapy": ["97110", "97112", "97140", "99213"],
    "Podiatry": ["11721", "99213", "99214"],
    "Urgent Care": ["99213", "99214", "71046", "80053", "85025"],
}
# FIXED VALUES: places of service and weights; modes and weights; propensity ranges by class (v2, v3); replayed share.
PROFESSIONAL_PLACES = [("11", 0.62), ("22", 0.17), ("02", 0.09), ("23", 0.12)]
FACILITY_PLACES = [("21", 0.22), ("22", 0.34), ("23", 0.44)]
V2_MODES = [("duplicate", 0.22), ("upcoding", 0.22), ("excessive_units", 0.20), ("unbundling", 0.16), ("high_cost_facility", 0.20)]
PROPENSITY_RANGES = {"low_risk": ("0.002", "0.010"), "medium_risk": ("0.02", "0.06"), "bad_actor": ("0.08", "0.18")}
V3_PROPENSITY_RANGES = {"low_risk": ("0.001", "0.010"), "medium_risk": ("0.015", "0.050"), "bad_actor": ("0.06", "0.16")}
REPLAYED_SHARE = 0.7
UPCODED_BASE = "210.00"

# The star's therapists are three specialties.
SPECIALTY_OF = {"Physical Therapy": "Therapy", "Occupational Therapy": "Therapy", "Speech Therapy": "Therapy"}

PRICES = T.StructType([T.StructField("revenue_code", T.StringType()), T.StructField("service_code", T.StringType()),
                       T.StructField("base_cents", T.LongType()), T.StructField("typical_units", T.IntegerType()),
                       T.StructField("category", T.StringType())])
PAIRS = T.StructType([T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType()),
                      T.StructField("pair_revenue", T.StringType()), T.StructField("pair_service", T.StringType())])


def _d(salt: str) -> Column:
    return draw(F.col("line_key"), salt)


def _times(amount: Column | str, salt: str, lo: str, hi: str) -> Column:
    return scale(F.col(amount) if isinstance(amount, str) else amount, uniform_e6(_d(salt), lo, hi), 1_000_000)


def price_table(spark: SparkSession) -> DataFrame:
    """Both catalogues under one key, (revenue code, procedure); professional codes have no revenue code."""
    rows = [("", code, cents(base), units, category) for code, base, units, category in PROFESSIONAL]
    rows += [(rev, code or "", cents(base), units, category) for rev, code, base, units, category, _ in INSTITUTIONAL]
    return local_table(spark, rows, PRICES)


def pair_intervals(spark: SparkSession) -> DataFrame:
    """The institutional pairs, each with its share of the draw's range."""
    spans = weight_intervals([r[5] for r in INSTITUTIONAL])
    return local_table(spark, [(lo, hi, r[0], r[1] or "") for (lo, hi), r in zip(spans, INSTITUTIONAL)], PAIRS)


def provider_propensity_range(provider_class: Column, provider: Column, ranges: dict = PROPENSITY_RANGES) -> Column:
    """D03 in its range form, in 1e-8: clean 0, other classes uniform in their range, one draw a provider."""
    h = draw(provider, "v2_propensity")
    expr = F.lit(0).cast("bigint")
    for name, (lo, hi) in ranges.items():
        start, step = int(Decimal(lo) * 10 ** 8), int((Decimal(hi) - Decimal(lo)) * 10 ** 4)
        expr = F.when(provider_class == name, F.lit(start) + h * step).otherwise(expr)
    return expr


def v2_base(spark: SparkSession, shaped: DataFrame) -> DataFrame:
    """Lines of the two families with codes, units and amounts, before seeding."""
    family = F.when(provider_type(F.col("provider_specialty")) == "facility", "institutional").otherwise("professional")
    specialty = F.col("provider_specialty")
    for name, v2_name in SPECIALTY_OF.items():
        specialty = F.when(F.col("provider_specialty") == name, v2_name).otherwise(specialty)
    menu = _pick(MENUS["Primary Care"], F.pmod("l_partkey", F.lit(len(MENUS["Primary Care"]))))
    for name, codes in list(MENUS.items())[1:]:
        menu = F.when(specialty == name, _pick(codes, F.pmod("l_partkey", F.lit(len(codes))))).otherwise(menu)
    df = shaped.select(
        "enc_key", "claim_line_no", "line_key", "member_id", "member_age", "member_gender", "chronic_score", "provider_id",
        "provider_specialty", "provider_class", "service_date", "diagnosis_code", "disc_e2", family.alias("claim_family"),
        menu.alias("_menu"), _d("v2_pair").cast("int").alias("_pair"))
    is_facility = F.col("claim_family") == "institutional"
    df = interval_lookup(df, "_pair", F.broadcast(pair_intervals(spark)))                      # 12 intervals
    df = df.withColumns({
        "revenue_code": F.when(is_facility, F.col("pair_revenue")).otherwise(""),
        "service_code": F.when(is_facility, F.col("pair_service")).otherwise(F.col("_menu")),
        "place_of_service": F.when(is_facility, weighted_category(_d("v2_pos"), FACILITY_PLACES))
        .otherwise(weighted_category(_d("v2_pos"), PROFESSIONAL_PLACES)),
    }).drop("_menu", "_pair", "pair_revenue", "pair_service")
    df = df.join(F.broadcast(price_table(spark)), ["revenue_code", "service_code"])            # 34 codes
    spread = F.col("typical_units") - 1 + F.pmod(_d("v2_units"), F.lit(3))
    telehealth, inpatient, emergency = pos_flags(F.col("place_of_service"))
    df = df.withColumns({
        "units": F.when(is_facility, clip_units(spread, 12)).otherwise(clip_units(spread, 6)),
        "telehealth_flag": telehealth, "inpatient_flag": inpatient, "emergency_flag": emergency,
        "provider_propensity": provider_propensity_range(F.col("provider_class"), F.col("provider_id")),
    })
    noise_e2 = F.lit(80) + F.col("disc_e2") * 4
    severity = severity_factor(F.col("claim_family"), F.col("chronic_score"), F.col("place_of_service"), F.lit(""), profile="v2")
    factor = F.col("units") * noise_e2 * severity * age_factor(F.col("member_age"), step_e4=25)
    df = df.withColumn("allowed_amount", round_div(F.col("base_cents") * factor, 10_000_000_000)).drop("disc_e2")
    return df.withColumns({
        "billed_amount": _times("allowed_amount", "v2_billed", "1.08", "1.50"),
        "paid_amount": paid_share(F.col("allowed_amount"), F.lit(False), F.col("line_key"), "0.72", "1.00", "v2_paid"),
    })


def seed_v2(df: DataFrame, propensity_mult: int = 1) -> DataFrame:
    """F09 (five modes), F11-F14: candidates by their provider's propensity, one mode each, and its effects."""
    # a draw is 1e-4 of the range, a propensity 1e-8
    candidate = _d("v2_fraud") * 10_000 < F.col("provider_propensity") * propensity_mult
    df = df.withColumn("fraud_type", F.when(candidate, weighted_category(_d("v2_mode"), V2_MODES)).otherwise("none"))
    facility = F.col("claim_family") == "institutional"
    mode = lambda name: F.col("fraud_type") == name
    up_office, up_or = mode("upcoding") & ~facility, mode("upcoding") & facility
    units, unbundled, costly = mode("excessive_units"), mode("unbundling"), mode("high_cost_facility")
    base, old = F.col("base_cents"), F.col("paid_amount")
    df = df.withColumns({
        "fraud_label": (F.col("fraud_type") != "none").cast("int"),
        "service_code": F.when(up_office, "99215").when(unbundled & ~facility, "36415").otherwise(F.col("service_code")),
        "revenue_code": F.when(up_or, "0360").when(unbundled & facility, "0300").otherwise(F.col("revenue_code")),
        "category": F.when(up_office, "E&M").when(up_or, "OR").when(unbundled, "Lab").otherwise(F.col("category")),
        "units": F.when(up_office, F.lit(1)).when(units, F.when(facility, int_between(_d("v2_ex_u"), 12, 34))
                                                  .otherwise(int_between(_d("v2_ex_u"), 8, 19))).otherwise(F.col("units")).cast("int"),
    })
    df = df.withColumn("_allowed", (
        F.when(up_office, _times(F.lit(cents(UPCODED_BASE)), "v2_up_a", "1.00", "1.25"))
        .when(up_or, _times("allowed_amount", "v2_or_a", "2", "3"))
        .when(units, _times(base * F.col("units"), "v2_ex_a", "1.00", "1.35"))
        .when(costly, _times("allowed_amount", "v2_hc_a", "1.6", "3.2")).otherwise(F.col("allowed_amount"))))
    return df.withColumns({
        "allowed_amount": F.col("_allowed"),
        "billed_amount": (F.when(up_office, _times("_allowed", "v2_up_b", "1.25", "1.65"))
                          .when(up_or, _times("billed_amount", "v2_or_b", "2", "3"))
                          .when(units, _times("_allowed", "v2_ex_b", "1.2", "1.7"))
                          .when(unbundled, _times("billed_amount", "v2_un_b", "1.2", "1.6"))
                          .when(costly, _times("billed_amount", "v2_hc_b", "1.8", "3.4")).otherwise(F.col("billed_amount"))),
        "paid_amount": (F.when(up_office, _times("_allowed", "v2_up_p", "0.8", "1.0"))
                        .when(up_or, _times(old, "v2_or_p", "1.7", "2.6"))
                        .when(units, _times("_allowed", "v2_ex_p", "0.8", "1.0"))
                        .when(unbundled, _times(old, "v2_un_p", "1.05", "1.25"))
                        .when(costly, _times(old, "v2_hc_p", "1.3", "2.4")).otherwise(old)),
    }).drop("_allowed")


def replay_duplicates(df: DataFrame, share: float = REPLAYED_SHARE) -> DataFrame:
    """max(1, floor(share * n)) of the duplicate-mode lines once more, under claim ids of their own."""
    duplicate = F.col("fraud_type") == "duplicate"
    h, k = hash32(F.col("line_key"), "v2_replay"), F.col("line_key").cast("string")
    keyed = df.where(duplicate).select(F.lit(1).alias("_all"), h.alias("_h"), k.alias("_k"))
    cut = hash_cut_offs(keyed, ["_all"], lambda n: F.greatest(F.floor(n * F.lit(share)), F.lit(1)), F.lit(share)).first()   # one row
    taken = duplicate & is_taken(h, k, F.lit(cut["_cut_h"]), F.lit(cut["_cut_k"])) if cut else F.lit(False)
    prefix = F.explode(F.when(taken, F.array(F.lit("V"), F.lit("VR"))).otherwise(F.array(F.lit("V"))))
    return df.withColumn("_prefix", prefix).withColumn("claim_id", F.concat("_prefix", "line_key")).drop("_prefix")


def v2_lines(spark: SparkSession, sf_dir: str, propensity_mult: int = 2) -> DataFrame:
    """The seeded v2 line table (written once: its cut-off, features and rules read it)."""
    seeded = stage_table(seed_v2(v2_base(spark, shaped_lines(spark, sf_dir)), propensity_mult), "v2-seeded")
    return replay_duplicates(seeded)


def v2_scored(lines: DataFrame, rules: RulesV2 = RulesV2()) -> DataFrame:
    """R15 on v2's own lines."""
    return rules_v2(features_v2(lines), rules)
