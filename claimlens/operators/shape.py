"""Dimension and line projections (D01-D06, P01-P24) and the star adapter.

The line table is built from lineitem (one billed service line), orders (one
encounter) and customer (the member).  Provider facts are a pure function of the
supplier key, so no provider join is needed on the hot path.

Physical plan (see README): orders is joined to customer first (orders is ~1/4
of lineitem), then lineitem is joined to that result on the order key.  The big
table is shuffled once, by order key, and every per-encounter window below
(line numbering, facility presence, coding edits) reuses that distribution.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions.draws import draw, draw_key, line_draw, numbered, uniform_e6, weighted_category, with_digests
from claimlens.functions.money import round_div, scale
from claimlens.operators.numbering import GIANT, exchange_by_encounter
from claimlens.sources import catalogs as C

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount"]


def _case(col: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def _pick(items: list[str], idx: Column) -> Column:
    """items[idx] (0-based) as a literal array lookup; stays inside codegen."""
    return F.element_at(F.array(*[F.lit(x) for x in items]), (idx + 1).cast("int"))


def _e2(x: str) -> int:
    """A rate such as "0.25" in units of 1e-2."""
    return int(Decimal(x) * 100)


# ----------------------------------------------------------------------------- D rows

def member_benefits(plan: Column) -> tuple[Column, Column]:
    """Plan -> (annual deductible in cents, coinsurance in 1e-2)."""
    ded = _case(plan, {k: C.cents(v[0]) for k, v in C.PLAN_BENEFITS.items()}, C.cents(C.PLAN_DEFAULT[0])).cast("bigint")
    coins = _case(plan, {k: _e2(v[1]) for k, v in C.PLAN_BENEFITS.items()}, _e2(C.PLAN_DEFAULT[1])).cast("int")
    return ded, coins


def high_risk_member(age: Column, chronic: Column) -> Column:
    """Age >= 70 or chronic >= 4."""
    return ((age >= 70) | (chronic >= 4)).cast("int")


def provider_propensity(cls: Column) -> Column:
    """D03 (v6 form)."""
    return _case(cls, dict(C.CLASS_PROPENSITY), C.PROPENSITY_DEFAULT).cast("double")


def provider_discount(specialty: Column) -> Column:
    """D04 in 1e-2: Hospital 38, Pharmacy 22, Administration 10, else 28."""
    return _case(specialty, {k: _e2(v) for k, v in C.SPECIALTY_DISCOUNT.items()}, _e2(C.DISCOUNT_DEFAULT)).cast("int")


def provider_type(specialty: Column, facility_specialties=("Hospital",)) -> Column:
    """Facility for Hospital (v2) or Hospital/DME (v3), else professional."""
    return F.when(specialty.isin(*facility_specialties), "facility").otherwise("professional")


def specialty_from_key(suppkey: Column) -> Column:
    return _pick(C.SPECIALTY_BY_MOD, F.pmod(suppkey, F.lit(15)))


def class_from_key(suppkey: Column) -> Column:
    return _pick(C.CLASS_BY_MOD, F.pmod(suppkey, F.lit(20)))


def member_columns(k: Column, plan: Column) -> dict[str, Column]:
    """What follows from the member's key and plan; money in cents."""
    ded, coins = member_benefits(plan)
    return {
        "member_id": numbered("M", k + 1, 7),
        "member_age": F.pmod(k, F.lit(90)).cast("int"),
        "member_gender": F.when(F.pmod(k, F.lit(100)) < 53, "F").otherwise("M"),
        "chronic_score": F.pmod(k, F.lit(6)).cast("int"),
        "annual_deductible": ded,
        "coinsurance_rate": coins,
        "deductible_remaining_start": round_div(ded * (F.pmod(k, F.lit(86)) + 15), 100),
    }


def members_from_customer(customer: DataFrame) -> DataFrame:
    """Member dimension (v6 shape) derived from the customer table; money in cents."""
    k, plan = F.col("c_custkey"), _case(F.col("c_mktsegment"), C.PLAN_BY_SEGMENT, C.PLAN_OTHER)
    return customer.select(k.alias("member_key"), plan.alias("plan_type"), F.col("c_nationkey").alias("member_state"),
                           *[c.alias(name) for name, c in member_columns(k, plan).items()])


def provider_columns(k: Column, spec: Column, cls: Column) -> dict[str, Column]:
    """What follows from the supplier's key, and the specialty and class that its key gives."""
    return {
        "provider_id": numbered("P", k + 1, 6),
        "provider_specialty": spec,
        "provider_class": cls,
        "provider_fraud_propensity": provider_propensity(cls),
        "contract_discount_rate": provider_discount(spec),
    }


def encounter_columns(linked: Column, etype0: Column, spec: Column, enc_key: Column, line_no: Column) -> dict[str, Column]:
    """A linked line's encounter is a professional one of its own within the facility's episode."""
    own = numbered("E", enc_key, 9)
    return {
        "encounter_type": F.when(linked, F.concat(F.lit("linked_"), F.lower(F.regexp_replace(spec, " ", "_")))).otherwise(etype0),
        "episode_id": numbered("EP", enc_key, 9),
        "encounter_id": F.when(linked, F.concat(numbered("LE", enc_key, 9), numbered("", line_no, 3))).otherwise(own),
        "parent_encounter_id": F.when(linked, own).otherwise(F.lit("")),
    }


def diagnosis_code(partkey: Column) -> Column:
    return _pick(C.DX_CODES, F.pmod(partkey, F.lit(len(C.DX_CODES))))


def catalogue_columns(family: Column, etype0: Column, code: Column, qty: Column) -> dict[str, Column]:
    """Place of service, revenue code and drug of a line that its code's catalogue row (``cat_`` columns) was joined to."""
    pos = (F.when(etype0 == "ed_facility", "23").when(etype0 == "inpatient_facility", "21")
           .when(family == "pharmacy", "01").when(etype0 == "admin", "99")
           .when(etype0 == "member_submitted", "11").otherwise(F.col("cat_pos")))
    days = F.when(family == "pharmacy", F.when(F.col("cat_drug_type") == "controlled", F.pmod(qty, F.lit(21)) + 10)
                  .otherwise(F.col("cat_days_supply")))
    return {
        "place_of_service": pos,
        "revenue_code": F.coalesce(F.col("cat_revenue_code"), F.lit("")),
        "days_supply": days.cast("int"),
        "drug_name": F.col("cat_drug_name"),
        "drug_type": F.col("cat_drug_type"),
        "ndc": F.when(family == "pharmacy", code),
    }


# ----------------------------------------------------------------------------- P rows

def encounter_type(specialty: Column, enc_key: Column) -> Column:
    """Hospital -> ED .55 / inpatient .45; Pharmacy; Administration; Primary Care .04 member-submitted."""
    hosp = F.when(draw(enc_key, "etype") < 5500, "ed_facility").otherwise("inpatient_facility")
    return (F.when(specialty == "Hospital", hosp)
            .when(specialty == "Pharmacy", "pharmacy")
            .when(specialty == "Administration", "admin")
            .when((specialty == "Primary Care") & (draw(enc_key, "msub") < 400), "member_submitted")
            .otherwise("professional"))


def claim_family(etype: Column, profile: str = "v6") -> Column:
    """Family by encounter type; v3 files member_submitted under professional."""
    msub = "professional" if profile == "v3" else "member_submitted"
    return (F.when(etype.isin("inpatient_facility", "ed_facility"), "institutional")
            .when(etype == "pharmacy", "pharmacy")
            .when(etype == "admin", "administrative")
            .when(etype == "member_submitted", msub)
            .otherwise("professional"))


def pos_flags(pos: Column) -> tuple[Column, Column, Column]:
    """Telehealth (02), inpatient (21), emergency (23)."""
    return (pos == "02").cast("int"), (pos == "21").cast("int"), (pos == "23").cast("int")


def severity_factor(family: Column, chronic: Column, pos: Column, etype: Column, profile: str = "v6") -> Column:
    """P04 in 1e-4: professional 1+.035c+.15(POS21); institutional 1+.05c+.35(inpatient) (v6)."""
    c = chronic.cast("bigint")

    def ind(cond: Column, e4: int) -> Column:
        return F.when(cond, F.lit(e4)).otherwise(F.lit(0))

    if profile == "v6":
        prof = 10000 + c * 350 + ind(pos == "21", 1500)
        inst = 10000 + c * 500 + ind(etype == "inpatient_facility", 3500)
    elif profile == "v3":
        prof = 10000 + c * 350 + ind(pos == "21", 1500)
        inst = 10000 + c * 500 + ind(pos == "21", 3000)
    elif profile == "v2":
        prof = 10000 + c * 400 + ind(pos == "21", 3500) + ind(pos == "23", 800)
        inst = prof
    else:  # fd
        prof = 10000 + c * 300 + ind(pos == "21", 2500)
        inst = prof
    return (F.when(family == "institutional", inst)
            .when(family == "professional", prof)
            .otherwise(F.lit(10000))).cast("bigint")


def age_factor(age: Column, step_e4: int = 20) -> Column:
    """P05 in 1e-4: 1 + max(age - 50, 0) * step (fd .002 -> 20, v2 .0025 -> 25)."""
    return (F.lit(10000) + F.greatest(age - 50, F.lit(0)) * step_e4).cast("bigint")


def clip_units(units: Column, hi: int = 6) -> Column:
    """max(1, units) clipped to 1..hi."""
    return F.least(F.greatest(units, F.lit(1)), F.lit(hi)).cast("int")


def contract_rate(allowed: Column, specialty: Column, discount_e2: Column) -> Column:
    """round(allowed * (1 - d), 2); d = .35 for Hospital, else provider discount (null -> .25)."""
    d = F.when(specialty == "Hospital", F.lit(_e2(C.HOSPITAL_CONTRACT_DISCOUNT))).otherwise(
        F.coalesce(discount_e2, F.lit(_e2(C.MISSING_DISCOUNT))))
    return scale(allowed, 100 - d, 100)


# FIXED VALUES: rate factor of each contract (1e-2) and the share of it paid on member-submitted lines.
CONTRACT_FACTORS = {"COMM_A": 100, "COMM_B": 92, "COMM_C": 85, "MEDICARE_LIKE": 78, "OON": 55}
MEMBER_SUBMITTED_SHARE = ("0.85", "1.00")


def contract_reprice(billed: Column, contract_id: Column, etype: Column, h: Column) -> tuple[Column, Column]:
    """P10: (contract that applies, contracted allowed amount).

    Member-submitted lines are out of network and get a drawn share of that rate; negative billed amounts (reversals)
    pass through unscaled; an unknown contract gives null.
    """
    member = F.coalesce(etype == "member_submitted", F.lit(False))
    contract = F.when(member, F.lit("OON")).otherwise(contract_id)
    factor = F.lit(None).cast("bigint")
    for name, e2 in CONTRACT_FACTORS.items():
        factor = F.when(contract == name, F.lit(e2).cast("bigint")).otherwise(factor)
    share = F.when(member, uniform_e6(h, *MEMBER_SUBMITTED_SHARE)).otherwise(F.lit(1_000_000).cast("bigint"))
    return contract, F.when(billed < 0, billed).otherwise(round_div(billed * factor * share, 100_000_000))


def billed_amount(allowed: Column, contract: Column, family: Column, qty: Column) -> Column:
    """max(allowed, contract) x multiplier; institutional 1.8..4.5, else 1.15..2.8 (by quantity)."""
    q = qty.cast("bigint")
    mult_e3 = F.when(family == "institutional", 1800 + 54 * q).otherwise(1150 + 33 * q)
    return scale(F.greatest(allowed, contract), mult_e3, 1000)


def denial_assignment(family: Column, line_key: Column) -> tuple[Column, Column]:
    """P12 (v6): status and reason; reason "" when paid."""
    thr = _case(family, {k: int(v * 10000) for k, v in C.DENIAL_RATE.items()}, int(C.DENIAL_DEFAULT * 10000))
    denied = line_draw("deny") < thr
    status = F.when(denied, "denied").otherwise("paid")
    reason = F.when(denied, _pick(C.DENIAL_REASONS, F.pmod(line_draw("reason"), F.lit(len(C.DENIAL_REASONS))))).otherwise("")
    return status, reason


def payment_type(line_key: Column) -> Column:
    """Check .18, electronic .72, checkless .10."""
    return weighted_category(line_draw("pay"), C.PAYMENT_TYPES)


def code_key(family: Column, ndc: Column, revenue: Column, code: Column, with_pharmacy: bool = True) -> Column:
    """Ndc for pharmacy, revenue code for institutional, else procedure code."""
    expr = F.when(family == "institutional", revenue)
    if with_pharmacy:
        expr = F.when(family == "pharmacy", ndc).when(family == "institutional", revenue)
    return expr.otherwise(code)


def claim_key(encounter: Column, provider: Column, family: Column) -> Column:
    """Encounter | provider | family."""
    return F.concat_ws("|", encounter, provider, family)


def safe_flag(c: Column) -> Column:
    """A number as text or not, truncated; bad, missing or non-finite values -> 0."""
    number = c.cast("string").try_cast("double")
    fits = F.abs(number) < F.lit(2.0 ** 31)                       # false for infinities, null or false for NaN below
    return F.when(fits & ~F.isnan(number), number.try_cast("int")).otherwise(F.lit(0)).cast("int")


def flag(df: DataFrame, name: str) -> Column:
    """P19 on a column of ``df``, whatever its type; 0 where the table has no such column."""
    if name not in df.columns:
        return F.lit(0)
    if isinstance(df.schema[name].dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType)):
        return F.coalesce(F.col(name).cast("int"), F.lit(0))
    return safe_flag(F.col(name))


def service_code(etype: Column, specialty: Column, partkey: Column) -> Column:
    """Code chosen from the menu of the line's specialty / encounter type."""
    idx = lambda n: F.pmod(partkey, F.lit(n))
    prof = None
    for spec, codes in C.SPECIALTY_CODES.items():
        pick = _pick(codes, idx(len(codes)))
        prof = F.when(specialty == spec, pick) if prof is None else prof.when(specialty == spec, pick)
    prof = prof.otherwise(F.lit(C.DEFAULT_CODES[0]))
    drugs = [d[0] for d in C.DRUGS]
    return (F.when(etype == "ed_facility", _pick(C.ED_CODES, idx(len(C.ED_CODES))))
            .when(etype == "inpatient_facility", _pick(C.INPATIENT_CODES, idx(len(C.INPATIENT_CODES))))
            .when(etype == "pharmacy", _pick(drugs, idx(len(drugs))))
            .when(etype == "admin", F.lit("ADMIN001"))
            .when(etype == "member_submitted", F.lit("MSUB001"))
            .otherwise(prof))


LINKED_NAMES = [s for s, _ in C.LINKED_SPECIALTIES]


# ----------------------------------------------------------------------------- K03

def claims_from_star(spark: SparkSession, tables: dict[str, DataFrame], giant: int = GIANT,
                     cut: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Shaped, priced and adjudication-ready claim lines (before seeding).

    Internal columns kept for downstream operators: ``enc_key`` (order key),
    ``line_key`` (draw key), ``mue_limit``, ``qty``.  Encounters of more than ``giant`` lines are
    numbered in parts (see operators.numbering); they are looked for while the plan is built.
    ``cut`` goes between the steps that work out a line's columns (``session.code_cut``, or nothing).
    """
    li, orders, customer = tables["lineitem"], tables["orders"], tables["customer"]
    members = members_from_customer(customer)
    enc = orders.select(F.col("o_orderkey"), F.col("o_custkey")).join(
        members, F.col("o_custkey") == F.col("member_key"))
    # The per-encounter windows need the lines clustered by order key anyway; placing that one
    # exchange right after the join shuffles the narrow joined rows (not the wide computed
    # ones) and runs all per-line expression work after it, in parallel.
    joined = li.join(enc, F.col("l_orderkey") == F.col("o_orderkey"))
    encounters = exchange_by_encounter(joined, li.select("l_orderkey", *LINE_ORDER[:2]), "l_orderkey", LINE_ORDER, giant)
    base = encounters.lines
    spec = specialty_from_key(F.col("l_suppkey"))
    cls = class_from_key(F.col("l_suppkey"))
    ek = F.col("l_orderkey").cast("string")
    etype0 = encounter_type(spec, ek)

    # The lines are sorted once, for their numbers and before they get wider: the flags' windows take that order.
    pre = base.withColumn("claim_line_no", encounters.line_number()).select(
        "*", spec.alias("_spec"), cls.alias("_cls"), etype0.alias("etype0"),
    ).withColumn("_code0", service_code(F.col("etype0"), F.col("_spec"), F.col("l_partkey")))
    # X01 context: does the encounter bill a panel?  Seeding never rewrites panel codes
    # (upcoding only shifts E&M levels), so this equals the check on the seeded codes.
    pre = encounters.flags(cut(pre), enc_has_facility=F.col("etype0").isin("ed_facility", "inpatient_facility"),
                           enc_has_panel=F.col("_code0").isin("80053", "85025"))
    df = pre.select(
        F.col("l_orderkey").alias("enc_key"),
        "claim_line_no", "l_partkey", "l_suppkey", "member_key",
        F.col("l_quantity").cast("int").alias("qty"),
        F.round(F.col("l_discount") * 100).cast("int").alias("disc_e2"),
        F.to_date("l_shipdate").alias("service_date"),
        "member_id", "member_age", "member_gender", "chronic_score", "plan_type",
        "annual_deductible", "coinsurance_rate", "deductible_remaining_start",
        *[c.alias(name) for name, c in provider_columns(F.col("l_suppkey"), F.col("_spec"), F.col("_cls")).items()],
        "etype0",
        "enc_has_facility", "enc_has_panel",
        F.col("_code0").alias("_code0"),
    )

    linked = ((F.col("etype0") == "professional") & F.col("provider_specialty").isin(*LINKED_NAMES)
              & (F.col("enc_has_facility") == 1))
    df = df.select("*", linked.cast("int").alias("linked_facility_claim")).select(
        "*",
        *[c.alias(name) for name, c in encounter_columns(
            F.col("linked_facility_claim") == 1, F.col("etype0"), F.col("provider_specialty"), F.col("enc_key"),
            F.col("claim_line_no")).items()],
        claim_family(F.col("etype0")).alias("claim_family"),
        F.col("_code0").alias("service_code"),
        draw_key("enc_key", "claim_line_no").alias("line_key"),
        diagnosis_code(F.col("l_partkey")).alias("diagnosis_code"),
    ).drop("_code0")

    cat = F.broadcast(service_catalog_df(spark))
    df = df.join(cat, df.service_code == cat.code, "left").drop("code")
    df = cut(with_digests(df))

    fam = F.col("claim_family")
    units = F.when(fam.isin("professional", "institutional"), F.pmod(F.col("qty"), F.lit(5)) + 1).otherwise(F.lit(1))
    df = df.select("*", units.cast("int").alias("units"), *[c.alias(name) for name, c in catalogue_columns(
        fam, F.col("etype0"), F.col("service_code"), F.col("qty")).items()])
    noise_e2 = F.lit(80) + F.col("disc_e2") * 4
    sev_e4 = severity_factor(fam, F.col("chronic_score"), F.col("place_of_service"), F.col("etype0"))
    allowed = scale(F.col("base_cents"), F.col("units") * sev_e4 * noise_e2, 1_000_000)
    df = df.withColumn("allowed_amount", allowed)
    df = df.withColumn("contract_rate", contract_rate(F.col("allowed_amount"), F.col("provider_specialty"),
                                                      F.col("contract_discount_rate")))
    df = df.withColumn("billed_amount", billed_amount(F.col("allowed_amount"), F.col("contract_rate"), fam, F.col("qty")))
    status, reason = denial_assignment(fam, F.col("line_key"))
    df = df.select(
        "*",
        status.alias("claim_status"),
        reason.alias("denial_reason"),
        payment_type(F.col("line_key")).alias("payment_type"),
    )
    return cut(df)


def service_catalog_df(spark: SparkSession) -> DataFrame:
    return C.service_catalog(spark)
