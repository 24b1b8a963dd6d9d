"""Pricing of the first script and of v3's pharmacy lines, and providers' propensities by range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions.draws import draw, uniform_e6, weighted_category
from claimlens.functions.money import round_div, scale
from claimlens.operators.edits import paid_share
from claimlens.operators.shape import _pick, age_factor, class_from_key, clip_units, pos_flags, severity_factor
from claimlens.plans.v2 import SPECIALTY_OF, V3_PROPENSITY_RANGES, price_table, provider_propensity_range
from claimlens.sources.catalogs import cents, local_table

# FIXED VALUES: the first script's code menus by specialty (others: the last), places of service and weights.
FD_MENUS = {
    "Primary Care": ["99213", "99214", "80053", "83036", "85025", "93000", "G0439"],
    "Behavioral Health": ["90834", "99213", "99214"],
    "Cardiology": ["93000", "99214", "99215", "71046"],
    "Therapy": ["97110", "99213"],
    "Podiatry": ["11721", "99213"],
}
FD_OTHER_MENU = ["99213", "99214", "80053", "85025"]
FD_PLACES = [("11", 0.65), ("22", 0.15), ("02", 0.10), ("21", 0.10)]
# FIXED VALUES: v3's pharmacy products (ndc, name, base amount of 30 days, type) and days supplied.
V3_PRODUCTS = [
    ("00093-7424", "METFORMIN_500MG", "14.00", "generic"), ("00093-1047", "LISINOPRIL_10MG", "9.00", "generic"),
    ("59762-3720", "ATORVASTATIN_20MG", "11.00", "generic"), ("00054-4727", "ALBUTEROL_HFA", "55.00", "brand"),
    ("00781-1506", "OZEMPIC_1MG", "935.00", "brand"), ("50458-0578", "ELIQUIS_5MG", "590.00", "brand"),
    ("00002-8215", "HUMALOG_KWIKPEN", "620.00", "brand"), ("0591-0461", "AMOXICILLIN_500MG", "12.00", "generic"),
]
V3_DAYS = ["30", "30", "30", "90"]

PRODUCTS = T.StructType([T.StructField("product", T.IntegerType()), T.StructField("ndc11", T.StringType()),
                         T.StructField("drug_name", T.StringType()), T.StructField("base_cents", T.LongType()),
                         T.StructField("drug_type", T.StringType())])


def _d(salt: str) -> Column:
    return draw(F.col("line_key"), salt)


def _times(amount: str, salt: str, lo: str, hi: str) -> Column:
    return scale(F.col(amount), uniform_e6(_d(salt), lo, hi), 1_000_000)


def fd_lines(spark: SparkSession, shaped: DataFrame) -> DataFrame:
    """The first script's base lines: code by specialty, place, units 1 to 6 (P08), its severity and age steps (P04, P05),
    billed and paid shares (P21, A03).  All providers are professionals there."""
    specialty = F.col("provider_specialty")
    for name, fd_name in SPECIALTY_OF.items():
        specialty = F.when(F.col("provider_specialty") == name, fd_name).otherwise(specialty)
    menu = _pick(FD_OTHER_MENU, F.pmod("l_partkey", F.lit(len(FD_OTHER_MENU))))
    for name, codes in FD_MENUS.items():
        menu = F.when(specialty == name, _pick(codes, F.pmod("l_partkey", F.lit(len(codes))))).otherwise(menu)
    prices = price_table(spark).where("revenue_code = ''").drop("revenue_code")
    df = shaped.select("line_key", "member_id", "provider_id", "service_date", "diagnosis_code", "member_age", "chronic_score",
                       "disc_e2", menu.alias("service_code"), weighted_category(_d("fd_pos"), FD_PLACES).alias("place_of_service"))
    df = df.join(F.broadcast(prices), "service_code")             # 22 codes
    telehealth, inpatient, _ = pos_flags(F.col("place_of_service"))
    df = df.withColumns({"units": clip_units(F.col("typical_units") - 1 + F.pmod(_d("fd_units"), F.lit(3))),
                         "telehealth_flag": telehealth, "inpatient_flag": inpatient})
    severity = severity_factor(F.lit("professional"), F.col("chronic_score"), F.col("place_of_service"), F.lit(""), profile="fd")
    factor = F.col("units") * (F.lit(80) + F.col("disc_e2") * 4) * severity * age_factor(F.col("member_age"))
    df = df.withColumn("allowed_amount", round_div(F.col("base_cents") * factor, 10_000_000_000))
    return df.withColumns({
        "billed_amount": _times("allowed_amount", "fd_billed", "1.10", "1.45"),
        "paid_amount": paid_share(F.col("allowed_amount"), F.lit(False), F.col("line_key"), "0.85", "1.00", "fd_paid"),
    })


def v3_pharmacy_lines(spark: SparkSession, shaped: DataFrame) -> DataFrame:
    """v3's pharmacy pricing: a product, 30 or 90 days as units, 90 days at 2.2 to 2.8 times the base, a dispensing margin."""
    rows = [(k, ndc, name, cents(base), kind) for k, (ndc, name, base, kind) in enumerate(V3_PRODUCTS)]
    products = F.broadcast(local_table(spark, rows, PRODUCTS))    # 8 rows
    df = shaped.where("claim_family = 'pharmacy'").select("line_key", "member_id", "provider_id", "service_date", F.pmod(
        "l_partkey", F.lit(len(rows))).cast("int").alias("product"), _pick(V3_DAYS, F.pmod(_d("v3_days"), F.lit(4))).cast("int").alias("units"))
    df = df.join(products, "product")
    long = F.when(F.col("units") == 90, uniform_e6(_d("v3_ninety"), "2.2", "2.8")).otherwise(F.lit(1_000_000))
    return df.withColumn("billed_amount", round_div(F.col("base_cents") * long * uniform_e6(_d("v3_margin"), "1.0", "1.12"), 10 ** 12))


def provider_propensities(supplier: DataFrame) -> DataFrame:
    """D03 by provider: the ranges of v2 and of v3, from the same draw."""
    provider, cls = F.format_string("P%06d", F.col("s_suppkey") + 1), class_from_key(F.col("s_suppkey"))
    out = supplier.select(provider.alias("provider_id"), cls.alias("provider_class"))
    e8 = lambda c: c.cast("double") / F.lit(1e8)
    return out.select("*", e8(provider_propensity_range(F.col("provider_class"), F.col("provider_id"))).alias("v2_propensity"),
                      e8(provider_propensity_range(F.col("provider_class"), F.col("provider_id"), V3_PROPENSITY_RANGES)).alias("v3_propensity"))
