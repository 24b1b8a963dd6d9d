
import pandas as pd


def test_counts_sum_to_total(lines_pdf):
    n = len(lines_pdf)
    for keys in (["fraud_type", "claim_family"], ["rule_primary_reason_detected", "flagged_for_review"],
                 ["claim_status", "denial_reason"], ["fraud_type"], ["claim_family", "claim_status", "payment_type"]):
        assert lines_pdf.groupby(keys).size().sum() == n


def test_denied_lines_pay_nothing(lines_pdf):
    d = lines_pdf[lines_pdf.claim_status == "denied"]
    assert (d.paid_amount == 0).all() and (d.applied_to_deductible == 0).all() and (d.coinsurance_amount == 0).all()


def test_strong_signal_types_always_flagged(lines_pdf):
    rate = lines_pdf.groupby("fraud_type").flagged_for_review.mean()
    for t in ("pricing_error", "egregious_billing", "duplicate_billing", "upcoding", "member_reimbursement_abuse"):
        if t in rate:
            assert rate[t] == 1.0, t


def test_family_restrictions(lines_pdf):
    fam = lines_pdf.groupby("fraud_type").claim_family.unique()
    if "member_reimbursement_abuse" in fam:
        assert set(fam["member_reimbursement_abuse"]) == {"member_submitted"}
    for t in ("excessive_units", "upcoding"):
        if t in fam:
            assert set(fam[t]) == {"professional"}


def test_paid_plus_member_share_is_contract(lines_pdf):
    p = lines_pdf[lines_pdf.claim_status == "paid"]
    total = (p.paid_amount + p.applied_to_deductible + p.coinsurance_amount).round(2)
    assert ((total - p.contract_rate).abs() <= 0.011).all()


def test_flag_rate_exceeds_fraud_rate(spark):
    import __spark_entry__ as E
    cal = E.entry(spark).toPandas()
    assert cal.flag_rate_exceeds_fraud_rate.all()
    assert ((cal.flag_rate - cal.fraud_rate).round(6) == cal.flag_minus_fraud).all()


def test_no_rule_means_no_rule_fired(lines_pdf):
    rules = [c for c in lines_pdf.columns if c.startswith("rule_") and c not in (
        "rule_score", "rule_primary_reason", "rule_primary_reason_detected")]
    s = lines_pdf[lines_pdf.rule_primary_reason_detected == "no_rule"]
    assert len(s) and (s[rules].sum(axis=1) == 0).all()


def test_line_ids_unique(lines_pdf):
    assert lines_pdf.line_id.is_unique
    assert isinstance(lines_pdf, pd.DataFrame)
