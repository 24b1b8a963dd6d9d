"""Physical-plan checks: scans read only the needed columns and filters reach the scan."""

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_scan_is_pruned(spark):
    from claimlens.plans.queries import all_queries
    p = _plan(all_queries()["fraud_breakdown"](spark, SF_SMALL))
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert scans and all("[claim_family" in s and "fraud_type" in s and "line_id" not in s for s in scans)


def test_filter_reaches_scan(spark):
    from claimlens.plans.queries import all_queries
    p = _plan(all_queries()["persistent_relationships"](spark, SF_SMALL))
    assert "(flagged_for_review" in p and "DataFilters: [isnotnull(flagged_for_review" in p


def test_shaping_reads_only_used_lineitem_columns(spark):
    from claimlens.plans.queries import all_queries
    p = _plan(all_queries()["claims_from_star"](spark, SF_SMALL))
    li = [line for line in p.splitlines() if "FileScan parquet" in line and "l_orderkey" in line]
    assert li and all("l_returnflag" not in s and "l_tax" not in s for s in li)


def test_features_aggregate_each_key_set_once(spark, lines):
    from claimlens.operators.features import V6_SIGNATURE, group_features
    base = lines.select("line_id", *V6_SIGNATURE)
    p = _plan(group_features(base, [
        (V6_SIGNATURE, {"duplicates": ("count", "")}),
        (["provider_id", "service_date"], {"day_lines": ("count", "")}),
        (["provider_id"], {"provider_mean": ("cents", "contract_rate")}),
        (["service_code"], {"code_mean": ("cents", "contract_rate")})]))
    initial = p.split("== Initial Plan ==")[-1]
    assert "Expand" not in initial
    # the lines themselves, the signature, the provider-day (read again for the provider's mean) and the code
    assert initial.count("FileScan parquet") <= 5


def test_exact_integer_rounding_beyond_doubles(spark):
    from pyspark.sql import functions as F
    from claimlens.functions.money import round_div
    n = 2 ** 53 + 1
    got = spark.range(1).select(round_div(F.lit(3 * n), 3).alias("a"), round_div(F.lit(-7), 2).alias("b")).first()
    assert (got.a, got.b) == (n, -4)


def _only(columns, df):
    return df.select(*[c for c in df.columns if c in set(columns)])


def test_queries_name_every_column_that_they_read(spark, lines, monkeypatch):
    """Every query on the scored lines can be built from the columns that it asks for."""
    from claimlens.plans import queries as Q
    asked = {}

    def narrow(spark, sf_dir, columns, cfg):
        asked[name] = set(columns)
        return _only(columns, lines)

    monkeypatch.setattr(Q, "lines_with", narrow)
    registry = Q.all_queries()
    names = [*Q.LINE_PROJECTIONS, *Q.SUMMARIES, "review_queue", "merge_provider_partials", "merge_counts", "merge_confusion",
             "merge_detection", "chunk_manifest", "union_families", "dictionary_fields", "top_suspicious_providers",
             "top_suspicious_providers_fd", "top_fraud_types", "top_rule_reasons", "line_flags"]
    for name in names:
        assert registry[name](spark, SF_SMALL).columns
    assert set(asked) == set(names)
    assert max(len(c) for c in asked.values()) <= 16              # out of 68


def test_lines_of_some_columns_equal_the_whole_table(spark, lines, monkeypatch):
    from claimlens.plans import v6
    from claimlens.plans.queries import LINE_PROJECTIONS
    monkeypatch.setattr(v6, "_MATERIALIZED", {})
    monkeypatch.setattr(v6, "_SEEDED", {})
    monkeypatch.setattr(v6, "_SOME_COLUMNS", {})
    columns = [*LINE_PROJECTIONS["rules_v6"], *LINE_PROJECTIONS["detection_features"][1:], "member_age"]
    some = v6.lines_with(spark, SF_SMALL, columns)
    assert sorted(some.columns) == sorted(columns)                # no other column was written
    assert not v6._SEEDED and not v6._MATERIALIZED
    whole = lines.select(*columns)
    some = some.select(*columns)
    assert some.count() == whole.count() and some.exceptAll(whole).isEmpty()
    assert v6.lines_with(spark, SF_SMALL, columns[:3]).columns == v6.lines_with(spark, SF_SMALL, columns).columns
    assert "denial_reason" in v6.lines_with(spark, SF_SMALL, ["denial_reason"]).columns and v6._MATERIALIZED


def test_v3_lines_of_some_columns_equal_the_whole_table(spark):
    from claimlens.plans.v3 import V3_RULES, v3_lines
    columns = ["line_id", *V3_RULES, "rule_score", "rule_primary_reason", "duplicate_signature_count", "provider_avg_allowed", "units"]
    some = v3_lines(spark, SF_SMALL, columns=columns)
    assert "member_gender" not in some.columns
    whole = v3_lines(spark, SF_SMALL)
    assert "member_gender" in whole.columns
    assert some.count() == whole.count() and some.select(*columns).exceptAll(whole.select(*columns)).isEmpty()


def test_v3_quantile_does_not_read_the_features(spark, monkeypatch):
    """The 98th percentile is taken from the lines before the features' joins."""
    from claimlens.plans import v3
    read = []
    real = v3.exact_quantile
    monkeypatch.setattr(v3, "exact_quantile", lambda df, *a, **k: read.append(df.columns) or real(df, *a, **k))
    v3.v3_lines(spark, SF_SMALL, columns=["line_id"])
    assert len(read) == 1 and "duplicate_signature_count" not in read[0]


def test_provider_days_are_exchanged_once(spark, lines):
    """The provider's mean comes to the provider's days by a broadcast, so these keep the exchange that the lines meet."""
    from claimlens.operators.features import V6_SIGNATURE, group_features
    days = group_features(lines.select("line_id", *V6_SIGNATURE), [
        (["provider_id", "service_date"], {"day_lines": ("count", "")}),
        (["provider_id"], {"provider_mean": ("cents", "contract_rate")})])
    initial = _plan(days).split("== Initial Plan ==")[-1]
    assert initial.count("Exchange hashpartitioning") <= 2        # the days, and the lines where these are many


def test_features_of_null_keys(spark):
    from claimlens.operators.features import group_features
    rows = spark.createDataFrame([(1, "a", "x", 100), (2, "a", "x", 300), (3, "a", "y", 500), (4, None, "x", 700), (5, None, None, 900),
                                  (6, "b", None, 50)], "id int, provider_id string, day string, cents bigint")
    got = group_features(rows, [(["provider_id", "day"], {"n": ("count", "")}), (["provider_id"], {"mean": ("cents", "cents")})])
    assert sorted(map(tuple, got.select("id", "n", "mean").collect())) == [
        (1, 2, 3.0), (2, 2, 3.0), (3, 1, 3.0), (4, None, None), (5, None, None), (6, None, None)]


def test_lines_are_sorted_once_for_their_encounter(spark):
    """The number's window sorts the exchanged lines, narrow as they are; the flags' window takes that order."""
    from claimlens.plans.v6 import shaped_lines
    steps = [line for line in _plan(shaped_lines(spark, SF_SMALL)).splitlines() if "l_orderkey" in line]
    windows = [i for i, line in enumerate(steps) if "- Window [" in line]
    sorts = [i for i, line in enumerate(steps) if "- Sort [" in line]
    assert len(windows) == 2 and "row_number()" in steps[windows[1]]
    assert not [i for i in sorts if i < windows[1]] and "l_linenumber" in steps[sorts[0]]
