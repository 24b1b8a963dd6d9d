"""Hand-made frames at the rule thresholds (FIXTURES.md section 5)."""

import datetime as dt

from pyspark.sql import functions as F

from claimlens.functions.money import ratio4, round_div
from claimlens.functions.sampling import quota_fraction, select_by_hash_quota
from claimlens.operators.edits import adjudicate, apply_edits
from claimlens.operators.rules import RulesV6, apply_rules_v6


def _rule_frame(spark, rows):
    cols = ["line_id", "duplicate_signature_count", "provider_day_claim_count", "billed_to_contract_ratio",
            "contract_to_allowed_ratio", "external_edit_flag", "claim_status", "provider_class", "service_code",
            "provider_to_code_ratio", "claim_family", "upcoding_signal", "member_submit_outlier_signal",
            "pricing_error_signal", "egregious_charge_signal"]
    return spark.createDataFrame(rows, cols)


def test_rule_thresholds(spark):
    base = dict(dup=1, day=1, btc=1.0, cta=0.7, edit=0, status="paid", cls="clean", code="99213", ptc=1.0,
                fam="professional", up=0, mem=0, pr=0, eg=0)

    def row(lid, **kw):
        d = {**base, **kw}
        return (lid, d["dup"], d["day"], d["btc"], d["cta"], d["edit"], d["status"], d["cls"], d["code"], d["ptc"],
                d["fam"], d["up"], d["mem"], d["pr"], d["eg"])

    rows = [
        row("vol29", day=29), row("vol30", day=30), row("vol31", day=31),
        row("egr_under", btc=5.9999), row("egr_at", btc=6.0),
        row("price_under", cta=1.1499), row("price_at", cta=1.15),
        row("upc_119", code="99215", ptc=1.19), row("upc_120", code="99215", ptc=1.20), row("upc_signal", up=1),
        row("signal_only", pr=1), row("score1", dup=1, edit=1),
        row("egr_bad", btc=7.0, cls="bad_actor"), row("egr_clean", btc=7.0, cls="clean"),
        row("edit_inst_clean", edit=1, fam="institutional", cls="clean"),
        row("edit_inst_low", edit=1, fam="institutional", cls="low_risk"),
        row("multi", dup=2, btc=7.0, cta=1.2),
    ]
    out = {r.line_id: r for r in apply_rules_v6(_rule_frame(spark, rows), RulesV6()).collect()}
    assert [out[k].rule_provider_volume for k in ("vol29", "vol30", "vol31")] == [0, 1, 1]
    assert (out["egr_under"].rule_egregious_billed, out["egr_at"].rule_egregious_billed) == (0, 1)
    assert (out["price_under"].rule_price_above_contract, out["price_at"].rule_price_above_contract) == (0, 1)
    assert (out["upc_119"].rule_upcoding_pattern, out["upc_120"].rule_upcoding_pattern,
            out["upc_signal"].rule_upcoding_pattern) == (0, 1, 1)
    assert out["signal_only"].flagged_for_review == 1 and out["signal_only"].rule_primary_reason_detected == "no_rule"
    assert out["score1"].rule_score == 1 and out["score1"].flagged_for_review == 0
    assert out["egr_bad"].flagged_for_review == 1 and out["egr_clean"].flagged_for_review == 0
    assert out["edit_inst_clean"].flagged_for_review == 0 and out["edit_inst_low"].flagged_for_review == 1
    assert out["multi"].rule_primary_reason_detected == "duplicate_signature" and out["multi"].rule_score == 3


def test_ratio_rounding_is_exact(spark):
    # cents: 599.99/100.00 = 5.9999; 1.15 boundary; floor of the denominator at 1.00
    df = spark.createDataFrame([(59999, 10000), (11500, 10000), (1500, 50), (-700, 10000)], ["n", "d"])
    got = [r.r for r in df.select(ratio4(F.col("n"), F.col("d")).alias("r")).collect()]
    assert got == [5.9999, 1.15, 15.0, -0.07]
    half = spark.createDataFrame([(5,), (-5,), (15,)], ["x"]).select(round_div(F.col("x"), 10).alias("q"))
    assert [r.q for r in half.collect()] == [1, -1, 2]


def test_adjudication_edges(spark):
    rows = [
        ("jan1", dt.date(2025, 1, 1), 100000, 50000, 20, "paid"),     # remaining > contract: all deductible
        ("dec31", dt.date(2025, 12, 31), 100000, 50000, 20, "paid"),  # remaining nearly gone
        ("leap", dt.date(2024, 2, 29), 1000, 50000, 25, "paid"),
        ("denied", dt.date(2025, 6, 1), 100000, 50000, 20, "denied"),
    ]
    df = spark.createDataFrame(rows, ["k", "service_date", "contract_rate", "deductible_remaining_start",
                                      "coinsurance_rate", "claim_status"])
    out = {r.k: r for r in adjudicate(df).collect()}
    j = out["jan1"]
    assert j.applied_to_deductible == round(50000 * (1 - 1 / 365 * 0.9)) and \
        j.applied_to_deductible + j.coinsurance_amount + j.paid_amount == 100000
    d = out["dec31"]
    assert d.applied_to_deductible == 5000  # 50000 * (1 - 365/365*0.9)
    assert d.coinsurance_amount == 19000 and d.paid_amount == 76000
    lp = out["leap"]
    assert lp.applied_to_deductible == 1000 and lp.paid_amount + lp.coinsurance_amount == 0
    dn = out["denied"]
    assert (dn.applied_to_deductible, dn.coinsurance_amount, dn.paid_amount) == (0, 0, 0)


def test_coding_edits(spark):
    rows = [
        (1, "E1", "36415", 1, None), (1, "E1", "80053", 1, None),    # venipuncture with a panel
        (2, "E2", "36415", 1, None),                                   # alone
        (3, "E3", "85025", 1, None), (4, "E4", "36415", 1, None),      # panel on another encounter
        (5, "E5", "97110", 4, 4), (5, "E5", "97112", 5, 4),            # at and over the limit
        (6, "E6", "99213", 50, None),                                  # no limit
    ]
    df = spark.createDataFrame(rows, "enc_key long, encounter_id string, service_code string, units int, mue_limit int")
    out = [(r.enc_key, r.service_code, r.ncci_like_edit_flag, r.mue_like_edit_flag, r.external_edit_flag)
           for r in apply_edits(df).orderBy("enc_key", "service_code").collect()]
    assert out == [
        (1, "36415", 1, 0, 1), (1, "80053", 0, 0, 0), (2, "36415", 0, 0, 0), (3, "85025", 0, 0, 0),
        (4, "36415", 0, 0, 0), (5, "97110", 0, 0, 0), (5, "97112", 0, 1, 1), (6, "99213", 0, 0, 0)]


def test_hash_quota_matches_brute_force(spark):
    from pyspark.sql import Window
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey").alias("k"),
        (F.col("l_orderkey") % 3).alias("g"))
    got = select_by_hash_quota(df, ["g"], quota_fraction(df, ["g"], 0.3), F.col("k"), "split", "sel")
    got = {(r.k, r.g) for r in got.filter("sel = 1").collect()}
    h = F.conv(F.substring(F.md5(F.concat(F.col("k"), F.lit("|split"))), 1, 8), 16, 10).cast("bigint")
    n = df.groupBy("g").count()
    rk = df.withColumn("h", h).withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("h", "k")))
    want = rk.join(n, "g").filter(F.col("r") <= F.floor(F.col("count") * 0.3))
    want = {(r.k, r.g) for r in want.collect()}
    assert got == want and len(got) > 0


def test_contract_reprice_edges(spark):
    from claimlens.operators.shape import contract_reprice
    rows = [(10_000, "COMM_B", "professional"), (-10_000, "COMM_B", "professional"), (0, "OON", "professional"),
            (10_000, "COMM_A", "member_submitted"), (10_000, "OTHER", "professional"), (10_001, "COMM_C", None),
            (None, "COMM_A", "professional")]
    df = spark.createDataFrame(rows, "billed long, contract string, etype string")
    contract, allowed = contract_reprice(F.col("billed"), F.col("contract"), F.col("etype"), F.lit(5000).cast("bigint"))
    got = [tuple(r) for r in df.select(contract.alias("c"), allowed.alias("a")).collect()]
    assert got == [("COMM_B", 9200), ("COMM_B", -10_000), ("OON", 0), ("OON", 5088), ("OTHER", None), ("COMM_C", 8501),
                   ("COMM_A", None)]
