"""Summaries in code (J01-J17) and documented summaries.

All are hash aggregates over the line table (partial aggregation before the
shuffle, so hot keys are cheap).  Money sums stay DECIMAL until the final
select.  Several distinct counts over one key set are computed as separate
two-level aggregates joined on one-row / small results rather than one
multi-distinct aggregate (which would triple the shuffled rows via Expand).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.money import mean_double, ratio4, sum_double, to_double
from claimlens.functions.scalar import attach, combine
from claimlens.operators.shape import claim_key

RISKY = ("medium_risk", "bad_actor")


def _rate(cond: Column) -> Column:
    """Share of rows where ``cond`` holds, as DOUBLE."""
    return F.sum(cond.cast("int")).cast("double") / F.count(F.lit(1)).cast("double")


def _mean_int(c: str) -> Column:
    return F.sum(F.col(c)).cast("double") / F.count(F.lit(1)).cast("double")


def _money_sum(c: str) -> Column:
    return sum_double(F.col(c))


def _money_mean(c: str) -> Column:
    return mean_double(F.sum(c), F.count(F.lit(1)))


def with_claim_key(df: DataFrame) -> DataFrame:
    return df.withColumn("claim_key", claim_key(F.col("encounter_id"), F.col("provider_id"), F.col("claim_family")))


# ----------------------------------------------------------------------------- J rows

def fraud_breakdown(df: DataFrame) -> DataFrame:
    """J01."""
    return df.groupBy("fraud_type", "claim_family").agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.col("count").desc(), "fraud_type", "claim_family")


def provider_summary(df: DataFrame) -> DataFrame:
    """J02."""
    return (df.groupBy("provider_id", "provider_specialty", "provider_class").agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(F.col("claim_status") == "paid").alias("paid_lines"),
        F.count_if(F.col("claim_status") == "denied").alias("denied_lines"),
        _mean_int("fraud_label").alias("fraud_rate"),
        _money_mean("contract_rate").alias("avg_contract"),
        _money_mean("billed_amount").alias("avg_billed"),
        _money_mean("paid_amount").alias("avg_paid"),
        _mean_int("flagged_for_review").alias("flagged_rate"),
    ).orderBy(F.col("fraud_rate").desc(), F.col("flagged_rate").desc(), F.col("avg_billed").desc(), "provider_id"))


def family_financials(df: DataFrame) -> DataFrame:
    """J03."""
    return df.groupBy("claim_family", "claim_status", "payment_type").agg(
        F.count(F.lit(1)).alias("lines"),
        _money_sum("billed_amount").alias("billed_total"),
        _money_sum("contract_rate").alias("contract_total"),
        _money_sum("paid_amount").alias("paid_total"),
        _money_sum("applied_to_deductible").alias("deductible_total"),
        _money_sum("coinsurance_amount").alias("coinsurance_total"),
    )


def claim_level(df: DataFrame) -> DataFrame:
    """Per claim key, max label and max flag."""
    return with_claim_key(df).groupBy("claim_key").agg(
        F.max("fraud_label").alias("claim_fraud"), F.max("flagged_for_review").alias("claim_flag"))


def encounter_level(df: DataFrame) -> DataFrame:
    """J05."""
    return df.groupBy("encounter_id").agg(
        F.max("fraud_label").alias("encounter_fraud"), F.max("flagged_for_review").alias("encounter_flag"))


def level_totals(df: DataFrame, **line_sums: Column) -> DataFrame:
    """One row: lines, claims and encounters with their labels and flags, from one nested pass over the lines.

    Lines are summed by claim (encounter, provider, family), claims by encounter, encounters in all.  For each level
    ``<level>_n`` counts its units, ``_f`` those with a label, ``_p`` those with a flag, ``_fp`` those with both;
    ``line_sums`` adds sums of 0/1 columns over the lines.
    """
    y, p = F.col("fraud_label"), F.col("flagged_for_review")
    both = lambda a, b: (F.col(a) * F.col(b)).cast("bigint")
    line = ["line_n", "line_f", "line_p", "line_fp", *line_sums]
    claims = df.select("encounter_id", "provider_id", "claim_family", y, p, *[c.cast("int").alias(k) for k, c in line_sums.items()]) \
        .groupBy("encounter_id", "provider_id", "claim_family").agg(
            F.count(F.lit(1)).alias("line_n"), F.sum(y).alias("line_f"), F.sum(p).alias("line_p"), F.sum(y * p).alias("line_fp"),
            *[F.sum(k).alias(k) for k in line_sums], F.max(y).alias("f"), F.max(p).alias("p"))
    encounters = claims.groupBy("encounter_id").agg(
        *[F.sum(k).alias(k) for k in line], F.count(F.lit(1)).alias("claim_n"), F.sum("f").alias("claim_f"), F.sum("p").alias("claim_p"),
        F.sum(both("f", "p")).alias("claim_fp"), F.max("f").alias("f"), F.max("p").alias("p"))
    return encounters.agg(
        *[F.sum(k).alias(k) for k in [*line, "claim_n", "claim_f", "claim_p", "claim_fp"]], F.count(F.lit(1)).alias("encounter_n"),
        F.sum("f").alias("encounter_f"), F.sum("p").alias("encounter_p"), F.sum(both("f", "p")).alias("encounter_fp"))


def _share(part: str, whole: str) -> Column:
    return F.col(part).cast("double") / F.col(whole).cast("double")


LEVELS = ("line", "claim", "encounter")


def _level_rates() -> list[Column]:
    """Fraud and flag rates at line, claim and encounter level from :func:`level_totals`."""
    return [_share(f"{v}_{k}", f"{v}_n").alias(f"{v}_{name}_rate") for v in LEVELS for k, name in (("f", "fraud"), ("p", "flag"))]


def distinct_counts(df: DataFrame, **columns: str) -> DataFrame:
    """One row with the distinct values (null is one) of several columns, in one pass: pairs (column, value) are grouped once."""
    pairs = F.array(*[F.struct(F.lit(name).alias("_k"), F.col(c).cast("string").alias("_v")) for name, c in columns.items()])
    seen = df.select(F.inline(pairs)).distinct()
    return seen.agg(*[F.count_if(F.col("_k") == name).alias(name) for name in columns])


def _line_shares() -> dict[str, Column]:
    return {"denial_rate": F.col("claim_status") == "denied", "pharmacy_share": F.col("claim_family") == "pharmacy",
            "institutional_share": F.col("claim_family") == "institutional",
            "linked_facility_professional_share": F.col("linked_facility_claim")}


def _long_metrics(one: DataFrame, names: list[str]) -> DataFrame:
    """(metric, value) rows; counts as they are, rates rounded to 6."""
    counts = {"rows", "unique_members", "unique_providers", "unique_encounters"}
    stack = ", ".join(f"'{n}', " + (f"CAST({n} AS DOUBLE)" if n in counts else f"ROUND({n}, 6)") for n in names)
    return one.selectExpr(f"stack({len(names)}, {stack}) AS (metric, value)")


def dataset_metrics(df: DataFrame) -> DataFrame:
    """14 named metrics in long form (rates rounded to 6); two scans, for the levels and for the distinct counts."""
    shares = _line_shares()
    totals = level_totals(df, **shares).select(
        F.col("line_n").alias("rows"), F.col("encounter_n").alias("unique_encounters"), *_level_rates(),
        *[_share(name, "line_n").alias(name) for name in shares])
    one = combine(totals, distinct_counts(df, unique_members="member_id", unique_providers="provider_id"))
    return _long_metrics(one, [
        "rows", "unique_members", "unique_providers", "unique_encounters",
        *[f"{v}_{name}_rate" for v in LEVELS for name in ("fraud", "flag")], *shares])


def dataset_metrics_v5(df: DataFrame) -> DataFrame:
    """The 10-metric v5 form."""
    shares = _line_shares()
    base = df.agg(F.count(F.lit(1)).alias("rows"), _mean_int("fraud_label").alias("fraud_rate"),
                  _mean_int("flagged_for_review").alias("flag_rate"),
                  *[(F.sum(c.cast("int")).cast("double") / F.count(F.lit(1)).cast("double")).alias(name) for name, c in shares.items()])
    one = combine(base, distinct_counts(df, unique_members="member_id", unique_providers="provider_id",
                                        unique_encounters="encounter_id"))
    return _long_metrics(one, ["rows", "unique_members", "unique_providers", "unique_encounters", "fraud_rate", "flag_rate", *shares])


def calibration_summary(df: DataFrame) -> DataFrame:
    """Is the review queue larger than the true anomaly set, per level?"""
    r = level_totals(df).select(*_level_rates())
    rows = r.selectExpr(
        "stack(3, 'line', line_fraud_rate, line_flag_rate, 'claim', claim_fraud_rate, claim_flag_rate, "
        "'encounter', encounter_fraud_rate, encounter_flag_rate) AS (level, fraud_rate, flag_rate)")
    rows = rows.select("level", F.round("fraud_rate", 6).alias("fraud_rate"), F.round("flag_rate", 6).alias("flag_rate"))
    return rows.select(
        "level", "fraud_rate", "flag_rate",
        F.round(F.col("flag_rate") - F.col("fraud_rate"), 6).alias("flag_minus_fraud"),
        (F.col("flag_rate") > F.col("fraud_rate")).alias("flag_rate_exceeds_fraud_rate"),
    )


def rule_reason_summary(df: DataFrame) -> DataFrame:
    """J09."""
    return df.groupBy("rule_primary_reason_detected", "flagged_for_review").agg(F.count(F.lit(1)).alias("count"))


def detection_by_fraud_type(df: DataFrame) -> DataFrame:
    """J10."""
    return df.groupBy("fraud_type").agg(
        F.count(F.lit(1)).alias("lines"),
        _mean_int("flagged_for_review").alias("flagged_rate"),
        _mean_int("rule_score").alias("avg_rule_score"),
    )


def member_provider_history(df: DataFrame) -> DataFrame:
    """J11."""
    return df.groupBy("member_id", "provider_id").agg(
        F.min("service_date").alias("first_service_date"),
        F.max("service_date").alias("last_service_date"),
        F.count(F.lit(1)).alias("line_count"),
        _money_sum("paid_amount").alias("paid_total"),
    ).withColumn("days_between_first_last", F.datediff("last_service_date", "first_service_date"))


def claim_status_reason(df: DataFrame) -> DataFrame:
    """J12."""
    return df.groupBy("claim_status", "denial_reason").agg(F.count(F.lit(1)).alias("count"))


def provider_summary_simple(df: DataFrame) -> DataFrame:
    """Lines, mean allowed, fraud rate, busiest day, mean score per provider."""
    daily = df.groupBy("provider_id", "service_date").agg(F.count(F.lit(1)).alias("_n"))
    peak = daily.groupBy("provider_id").agg(F.max("_n").alias("max_day_volume"))
    agg = df.groupBy("provider_id", "provider_specialty", "provider_class").agg(
        F.count(F.lit(1)).alias("lines"),
        _money_mean("allowed_amount").alias("avg_allowed"),
        _mean_int("fraud_label").alias("fraud_rate"),
        _mean_int("rule_score").alias("avg_rule_score"),
    )
    return agg.join(peak, "provider_id")


def top_suspicious_providers(df: DataFrame, k: int = 10) -> DataFrame:
    """First k of J13 by fraud rate, mean score and mean allowed amount (then provider)."""
    return provider_summary_simple(df).orderBy(
        F.col("fraud_rate").desc(), F.col("avg_rule_score").desc(), F.col("avg_allowed").desc(), "provider_id").limit(k)


def top_suspicious_providers_fd(df: DataFrame, k: int = 10) -> DataFrame:
    """J14, the first script's order: fraud rate, mean allowed amount, busiest day (then provider)."""
    return provider_summary_simple(df).orderBy(
        F.col("fraud_rate").desc(), F.col("avg_allowed").desc(), F.col("max_day_volume").desc(), "provider_id").limit(k)


def top_counts(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k most frequent values of a column (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), col).limit(k)


def fraud_breakdown_label(df: DataFrame) -> DataFrame:
    """J15a."""
    return df.groupBy("fraud_type", "fraud_label").agg(F.count(F.lit(1)).alias("count"))


def rule_reason_by_label(df: DataFrame) -> DataFrame:
    """J15b."""
    return df.groupBy("rule_primary_reason_detected", "fraud_label").agg(F.count(F.lit(1)).alias("count"))


def rule_recall_within_type(df: DataFrame) -> DataFrame:
    """N, caught, mean score and recall per type (0 when n = 0)."""
    g = df.groupBy("fraud_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("flagged_for_review").cast("bigint").alias("caught"),
        F.sum("rule_score").cast("bigint").alias("_score"),
    )
    return g.select("fraud_type", "n", "caught",
                    (F.col("_score").cast("double") / F.col("n").cast("double")).alias("avg_rule_score"),
                    F.when(F.col("n") > 0, F.col("caught").cast("double") / F.col("n").cast("double"))
                    .otherwise(F.lit(0.0)).alias("recall"))


def provider_rollup(df: DataFrame) -> DataFrame:
    """Lines, fraud, flagged, allowed sum, busiest day and rates per provider."""
    daily = df.groupBy("provider_id", "service_date").agg(F.count(F.lit(1)).alias("_n"))
    peak = daily.groupBy("provider_id").agg(F.max("_n").alias("max_day_lines"))
    agg = df.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("fraud_label").cast("bigint").alias("fraud_lines"),
        F.sum("flagged_for_review").cast("bigint").alias("flagged_lines"),
        F.sum("allowed_amount").alias("allowed_total"),
    )
    return agg.join(peak, "provider_id").select(
        "provider_id", "lines", "fraud_lines", "flagged_lines",
        to_double(F.col("allowed_total")).alias("allowed_total"), "max_day_lines",
        (F.col("fraud_lines") / F.col("lines")).alias("fraud_rate"),
        (F.col("flagged_lines") / F.col("lines")).alias("flag_rate"))


# ----------------------------------------------------------------------------- N rows

def distinct_per(df: DataFrame, keys: list[str], **columns: str) -> DataFrame:
    """Distinct non-null values of several columns per key, in one pass: (keys, column, value) are grouped once (skew-safe)."""
    pairs = F.array(*[F.struct(F.lit(name).alias("_k"), F.col(c).cast("string").alias("_v")) for name, c in columns.items()])
    seen = df.select(*keys, F.inline(pairs)).distinct()
    return seen.groupBy(*keys).agg(*[F.count_if((F.col("_k") == name) & F.col("_v").isNotNull()).alias(name) for name in columns])


def family_profile(df: DataFrame) -> DataFrame:
    """N01."""
    d = with_claim_key(df)
    agg = d.groupBy("claim_family").agg(
        F.count(F.lit(1)).alias("line_count"),
        _money_sum("billed_amount").alias("billed_total"),
        _money_sum("allowed_amount").alias("allowed_total"),
        _money_sum("paid_amount").alias("paid_total"),
        _money_mean("billed_amount").alias("avg_billed"),
        _money_mean("paid_amount").alias("avg_paid"),
        _mean_int("fraud_label").alias("fraud_rate"),
        _rate(F.col("claim_status") == "denied").alias("denial_rate"),
    )
    return agg.join(distinct_per(d, ["claim_family"], claim_count="claim_key"), "claim_family")


def provider_profile(df: DataFrame) -> DataFrame:
    """N02."""
    d = with_claim_key(df)
    keys = ["provider_id"]
    agg = d.groupBy("provider_id", "provider_specialty", "provider_class").agg(
        F.count(F.lit(1)).alias("line_count"),
        _money_mean("billed_amount").alias("avg_billed"),
        _money_mean("paid_amount").alias("avg_paid"),
        _mean_int("fraud_label").alias("fraud_rate"),
        _mean_int("flagged_for_review").alias("flag_rate"),
        _rate(F.col("claim_status") == "denied").alias("denial_rate"),
        F.min("service_date").alias("first_service_date"),
        F.max("service_date").alias("last_service_date"),
    )
    return agg.join(distinct_per(d, keys, claim_count="claim_key", member_count="member_id"), keys)


def fraud_profile(df: DataFrame) -> DataFrame:
    """N03."""
    d = with_claim_key(df)
    keys = ["fraud_type"]
    agg = d.groupBy("fraud_type").agg(
        F.count(F.lit(1)).alias("line_count"),
        _money_mean("billed_amount").alias("avg_billed"),
        _money_mean("paid_amount").alias("avg_paid"),
    )
    return agg.join(distinct_per(d, keys, claim_count="claim_key", provider_count="provider_id", member_count="member_id"), keys)


def reason_precision(df: DataFrame) -> DataFrame:
    """Flag count, share of all flags, true fraud and precision per detected reason."""
    g = df.filter(F.col("flagged_for_review") == 1).groupBy("rule_primary_reason_detected").agg(
        F.count(F.lit(1)).alias("flag_count"), F.sum("fraud_label").cast("bigint").alias("true_fraud_count"))
    total = g.agg(F.sum("flag_count").alias("_all"))  # one row
    return attach(g, total).select(
        "rule_primary_reason_detected", "flag_count",
        (F.col("flag_count") / F.col("_all")).alias("share_of_all_flags"),
        "true_fraud_count",
        (F.col("true_fraud_count") / F.col("flag_count")).alias("precision_within_reason"))


def relationship_profile(df: DataFrame) -> DataFrame:
    """Per member-provider pair."""
    d = with_claim_key(df)
    keys = ["member_id", "provider_id"]
    agg = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("line_count"),
        _money_sum("paid_amount").alias("paid_total"),
        _money_mean("paid_amount").alias("avg_paid"),
    )
    d = d.withColumn("_type", F.when(F.col("fraud_type") != "none", F.col("fraud_type")))
    return agg.join(distinct_per(d, keys, claim_count="claim_key", distinct_fraud_types="_type"), keys)


def status_profile(df: DataFrame) -> DataFrame:
    """Lines, share of all lines and sums per status and reason."""
    g = df.groupBy("claim_status", "denial_reason").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("billed_amount").alias("_b"), F.sum("paid_amount").alias("_p"))
    total = g.agg(F.sum("line_count").alias("_all"))
    return attach(g, total).select(
        "claim_status", "denial_reason", "line_count",
        (F.col("line_count") / F.col("_all")).alias("share_of_lines"),
        to_double(F.col("_b")).alias("billed_total"), to_double(F.col("_p")).alias("paid_total"))


def dataset_profile(df: DataFrame) -> DataFrame:
    """One-row profile in long form."""
    d = with_claim_key(df)
    base = df.agg(
        F.count(F.lit(1)).alias("lines"),
        _mean_int("fraud_label").alias("fraud_rate"),
        _rate(F.col("claim_status") == "denied").alias("denial_rate"),
        _rate(F.col("claim_status") == "paid").alias("paid_rate"),
        _money_mean("billed_amount").alias("avg_billed"),
        _money_mean("allowed_amount").alias("avg_allowed"),
        _money_mean("paid_amount").alias("avg_paid"),
    )
    one = combine(base, distinct_counts(d, claims="claim_key", encounters="encounter_id", members="member_id",
                                        providers="provider_id"))
    names = ["lines", "claims", "encounters", "members", "providers", "fraud_rate", "denial_rate", "paid_rate",
             "avg_billed", "avg_allowed", "avg_paid"]
    stack = ", ".join(f"'{n}', ROUND(CAST({n} AS DOUBLE), 6)" for n in names)
    return one.selectExpr(f"stack({len(names)}, {stack}) AS (metric, value)")


def denial_clusters(df: DataFrame) -> DataFrame:
    """Denial rate by family x reason (share of the family's lines)."""
    fam = df.groupBy("claim_family").agg(F.count(F.lit(1)).alias("family_lines"))
    den = df.filter(F.col("claim_status") == "denied").groupBy("claim_family", "denial_reason").agg(
        F.count(F.lit(1)).alias("denied_lines"))
    return den.join(fam, "claim_family").withColumn(
        "denial_rate", F.col("denied_lines") / F.col("family_lines"))


def fraud_concentration(df: DataFrame, k: int = 3) -> DataFrame:
    """Share of a type's labelled lines held by its top-k providers.

    The rank runs over the (type, provider) aggregate; ``row_number() <= k`` lets
    Spark insert a per-partition group limit before the window's shuffle.
    """
    per = df.filter(F.col("fraud_label") == 1).groupBy("fraud_type", "provider_id").agg(F.count(F.lit(1)).alias("n"))
    tot = per.groupBy("fraud_type").agg(F.sum("n").alias("type_lines"))
    w = Window.partitionBy("fraud_type").orderBy(F.col("n").desc(), F.col("provider_id"))
    top = per.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).groupBy("fraud_type").agg(
        F.sum("n").alias("top_k_lines"))
    return top.join(tot, "fraud_type").select(
        "fraud_type", "top_k_lines", "type_lines", (F.col("top_k_lines") / F.col("type_lines")).alias("top_k_share"))


def specialty_suspicion(df: DataFrame) -> DataFrame:
    """N10."""
    return df.groupBy("provider_specialty").agg(
        F.count(F.lit(1)).alias("lines"),
        _mean_int("flagged_for_review").alias("flag_rate"),
        _mean_int("fraud_label").alias("fraud_rate"))


def persistent_relationships(df: DataFrame, k: int = 2) -> DataFrame:
    """Member-provider pairs flagged on at least k distinct dates, with the span."""
    days = df.filter(F.col("flagged_for_review") == 1).select("member_id", "provider_id", "service_date").distinct()
    g = days.groupBy("member_id", "provider_id").agg(
        F.count(F.lit(1)).alias("flagged_dates"),
        F.min("service_date").alias("first_flagged_date"),
        F.max("service_date").alias("last_flagged_date"))
    return g.filter(F.col("flagged_dates") >= k).withColumn(
        "span_days", F.datediff("last_flagged_date", "first_flagged_date"))


def episode_summary(df: DataFrame) -> DataFrame:
    """Facility and linked professional lines and dollars side by side per episode."""
    inst = F.col("claim_family") == "institutional"
    prof = F.col("linked_facility_claim") == 1
    zero = F.lit(0).cast("bigint")
    g = df.groupBy("episode_id").agg(
        F.count_if(inst).alias("facility_lines"),
        sum_double(F.when(inst, F.col("billed_amount")).otherwise(zero)).alias("facility_billed"),
        sum_double(F.when(inst, F.col("paid_amount")).otherwise(zero)).alias("facility_paid"),
        F.count_if(prof).alias("professional_lines"),
        sum_double(F.when(prof, F.col("billed_amount")).otherwise(zero)).alias("professional_billed"),
        sum_double(F.when(prof, F.col("paid_amount")).otherwise(zero)).alias("professional_paid"),
        F.max("flagged_for_review").alias("episode_flag"),
        F.max("fraud_label").alias("episode_fraud"),
    )
    return g.filter(F.col("facility_lines") > 0)


def dictionary_fields(df: DataFrame) -> DataFrame:
    """Derived dictionary fields per line."""
    from claimlens.operators.shape import contract_rate as p09
    d = with_claim_key(df)
    per_claim = d.groupBy("claim_key").agg(F.count(F.lit(1)).alias("service_line_count"))
    expected = p09(F.col("allowed_amount"), F.col("provider_specialty"), F.col("contract_discount_rate"))
    out = d.join(per_claim, "claim_key").withColumn("_exp", expected)
    return out.select(
        "line_id",
        to_double(F.col("applied_to_deductible") + F.col("coinsurance_amount")).alias("member_liability_amount"),
        ratio4(F.col("billed_amount"), F.col("allowed_amount")).alias("charge_to_allowed_ratio"),
        ratio4(F.col("allowed_amount"), F.col("contract_rate")).alias("allowed_to_contract_ratio"),
        "service_line_count",
        F.col("rule_duplicate").alias("duplicate_flag"),
        F.col("rule_egregious_billed").alias("egregious_charge_flag"),
        to_double(F.col("_exp")).alias("expected_contract_rate"),
        to_double(F.greatest(F.col("contract_rate") - F.col("_exp"), F.lit(0))).alias("pricing_error_amount"),
        (F.col("contract_rate") != F.col("_exp")).cast("int").alias("contract_mismatch_flag"),
    )
