"""Mechanisms behind the claims operators: quotas, giant encounters, streams, prefix sums, interval lookups, re-runs."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def _hash(key, salt):
    return int(hashlib.md5(f"{key}|{salt}".encode()).hexdigest()[:8], 16)


# --- quotas ------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("share", [None, 0.3])
def test_quota_by_cut_off(spark, share):
    """Groups of very different sizes, a null group, tiny quotas: the same rows as a ranking of everything."""
    from claimlens.functions.sampling import fraction_of, select_by_hash_quota
    rows = [(f"k{i}", "a" if i < 4000 else "b" if i < 4010 else None) for i in range(4500)]
    df = spark.createDataFrame(rows, "k string, g string").repartition(5)
    got = select_by_hash_quota(df, ["g"], fraction_of(0.3), F.col("k"), "salt", "sel", share=share)
    assert "Window" not in _plan(got) and "Exchange hashpartitioning(g" not in _plan(got)
    want = set()
    for g in ("a", "b", None):
        keys = sorted((k for k, x in rows if x == g), key=lambda k: (_hash(k, "salt"), k))
        want |= set(keys[:int(0.3 * len(keys))])
    assert {r.k for r in got.collect() if r.sel} == want and got.count() == len(rows)


def test_appended_kinds_in_one_pass(spark):
    """Five kinds: the histogram, its edge rows and one pass over the lines; no line is exchanged or ranked."""
    from claimlens.operators.seed_fd import FD_RATES, append_fixed_rate
    from claimlens.plans.v6 import shaped_lines
    from claimlens.session import stage_table
    from claimlens.sources.tables import read_table
    lines = stage_table(shaped_lines(spark, SF_SMALL).select(
        "line_key", "provider_id", "service_code", "units", "base_cents", "allowed_amount", "billed_amount"), "test-fd")
    out = append_fixed_rate(lines, read_table(spark, SF_SMALL, "supplier", ["s_suppkey"]))
    plan = _plan(out)
    assert plan.count("line_key") and sum("FileScan parquet" in x and "line_key" in x for x in plan.splitlines()) == 1
    assert "hashpartitioning" not in plan
    n, counts = lines.count(), {r.fraud_type: r["count"] for r in out.groupBy("fraud_type").count().collect()}
    assert counts == {k: int(n * round(r * 1e6)) // 10 ** 6 * (2 if k == "unbundling" else 1) for k, r in FD_RATES.items()}


def test_chunk_sample_reads_lines_once(spark, lines):
    from claimlens.sources.sinks import sample_per_chunk
    got = sample_per_chunk(lines, 128, 100, 500).select("line_id", "chunk_id").collect()
    groups = {}
    for r in lines.select("line_id", "enc_key").collect():
        groups.setdefault(r.enc_key // 128, []).append(r.line_id)
    first = [k for ids in groups.values() for k in sorted(ids, key=lambda k: (_hash(k, "sample"), k))[:100]]
    want = sorted(first, key=lambda k: (_hash(k, "sample_total"), k))[:500]
    assert {r.line_id for r in got} == set(want) and len(got) == 500 < len(first)


def test_share_sample_is_repeatable(spark, lines):
    from claimlens.functions.sampling import sample_shares
    take = lambda df: {r.line_id for r in sample_shares(df, "claim_family", {"professional": 0.2}, F.col("line_id"), "s", 0.6).collect()}
    one = take(lines)
    assert one == take(lines.repartition(7)) and "Exchange" not in _plan(
        sample_shares(lines, "claim_family", {"professional": 0.2}, F.col("line_id"), "s", 0.6))
    for family, share in (("professional", 0.2), ("institutional", 0.6)):
        ids = [r.line_id for r in lines.where(F.col("claim_family") == family).select("line_id").collect()]
        assert abs(sum(i in one for i in ids) / len(ids) - share) < 4 * (share * (1 - share) / len(ids)) ** 0.5


# --- giant encounters --------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed_star(spark):
    """The star tables with a third of all lines in one order, many of them with the same line number."""
    from claimlens.sources.tables import star_tables
    t = star_tables(spark, SF_SMALL)
    orders = [r.o_orderkey for r in t["orders"].select("o_orderkey").orderBy("o_orderkey").limit(1).collect()]
    hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(3)) == 0
    number = F.when(hot, F.when(F.pmod("l_partkey", F.lit(4)) == 0, F.lit(5)).otherwise(F.pmod(F.xxhash64("l_partkey", "l_suppkey", "l_linenumber"), F.lit(3000))))
    t["lineitem"] = t["lineitem"].withColumns({
        "l_linenumber": F.coalesce(number, F.col("l_linenumber")).cast(t["lineitem"].schema["l_linenumber"].dataType),
        "l_orderkey": F.when(hot, F.lit(orders[0])).otherwise(F.col("l_orderkey"))})
    return t


def test_giant_encounter_has_the_same_numbers(spark, skewed_star):
    from claimlens.operators.shape import claims_from_star
    columns = ["enc_key", "claim_line_no", "provider_id", "service_code", "encounter_type", "encounter_id", "enc_has_facility",
               "enc_has_panel", "allowed_amount", "claim_status"]
    plain, parted = (claims_from_star(spark, skewed_star, giant=n).select(*columns).collect() for n in (10 ** 9, 100))
    assert sorted(map(tuple, plain)) == sorted(map(tuple, parted))
    assert max(r.claim_line_no for r in parted) > len(parted) // 4


def test_giant_encounter_is_spread(spark, skewed_star):
    from claimlens.operators.numbering import exchange_by_encounter
    from claimlens.operators.shape import LINE_ORDER
    li = skewed_star["lineitem"]
    e = exchange_by_encounter(li, li.select("l_orderkey", *LINE_ORDER[:2]), "l_orderkey", LINE_ORDER, giant=100)
    most, n = e.lines.groupBy(*e.keys).count().agg(F.max("count")).first()[0], li.count()
    assert e.parted and most < n / 6                              # a quarter of the giant's lines share one line number
    small = exchange_by_encounter(li, li.select("l_orderkey", *LINE_ORDER[:2]), "l_orderkey", LINE_ORDER)
    assert not small.parted and small.keys == ["l_orderkey"]


# --- features, levels, quantile, AUC -----------------------------------------------------------------------------------

def test_signatures_join_repeats_only(spark):
    from claimlens.operators.features import duplicate_counts
    rows = [(1, "x")] * 3 + [(2, "y"), (None, "z"), (None, "z"), (None, None)]
    got = duplicate_counts(spark.createDataFrame(rows, "a int, b string"), ["a", "b"], "n").collect()
    assert sorted((r.a is None, r.b or "", r.n) for r in got) == [(False, "x", 3)] * 3 + [(False, "y", 1), (True, "", 1), (True, "z", 2), (True, "z", 2)]


def test_levels_and_metrics_in_few_scans(spark, lines):
    from claimlens.operators import summaries as S
    from claimlens.operators.evaluate import rule_vs_label_by_level
    scans = lambda df: sum("FileScan parquet" in x for x in _plan(df).splitlines())
    assert scans(S.dataset_metrics(lines)) <= 2 and scans(S.calibration_summary(lines)) == 1
    assert scans(rule_vs_label_by_level(lines)) == 1 and scans(S.provider_profile(lines)) == 2


@pytest.mark.parametrize("values", [[5], [-7, 3], [0, 0, 0, 9], list(range(-3000, 3000, 7)), [1 << 40, -(1 << 40), 5, 6, 1 << 41]])
def test_exact_quantile(spark, values):
    from claimlens.functions.quantile import exact_quantile
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x long")
    for p in (0.0, 0.37, 0.5, 0.98, 1.0):
        assert exact_quantile(df, "x", p).first().q == pytest.approx(float(np.quantile(np.array(values, float), p)), rel=1e-12)
    assert exact_quantile(df.where("x is null"), "x", 0.5).first().q is None


def test_auc_of_a_continuous_score(spark):
    """Equal to MLlib's evaluator, over several range partitions."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from claimlens.operators.evaluate import roc_auc
    r = np.random.default_rng(4)
    y = r.integers(0, 2, 3000)
    s = np.where(r.random(3000) < 0.1, 0.5, r.normal(size=3000) + 0.7 * y)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "fraud_label int, p double")
    df = df.withColumn("fraud_label", F.col("fraud_label").cast("int"))
    want = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="fraud_label", numBins=0).evaluate(df)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert roc_auc(df, score="p").first().roc_auc == pytest.approx(want, abs=1e-8)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert roc_auc(df.where("fraud_label = 1"), score="p").first().roc_auc is None


# --- flags, readers, lookups -------------------------------------------------------------------------------------------

def test_flags_of_any_kind(spark):
    from claimlens.operators.shape import flag
    texts = ["1", " 1 ", "1.0", "0", "", None, "n/a", "inf", "NaN", "1e0", "2.9", "-1", "99999999999999999999"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, f string")
    got = [r.v for r in df.select("k", flag(df, "f").alias("v")).orderBy("k").collect()]
    assert got == [1, 1, 1, 0, 0, 0, 0, 0, 0, 1, 2, -1, 0]
    assert [r[0] for r in df.select(flag(df, "absent")).distinct().collect()] == [0]


def test_manifest_names_the_files(spark, lines, tmp_path):
    from claimlens.sources.sinks import file_manifest, write_lines
    from claimlens.sources.tables import read_lines
    path = str(tmp_path / "lines")
    write_lines(lines.select("line_id", "enc_key", "service_date"), path, 512)
    schema = "line_id string, service_date date, later_column double, chunk_id bigint"
    df = read_lines(spark, path, schema, file_column="file")
    rows = file_manifest(df).collect()
    on_disk = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "lines").rglob("*.parquet")}
    assert {f"chunk_id={r.chunk_number}/{r.file_name}" for r in rows} == on_disk and {r.format for r in rows} == {"parquet"}
    assert sum(r.row_count for r in rows) == lines.count() and df.where("later_column is not null").count() == 0


def test_interval_lookup(spark):
    from claimlens.functions.intervals import interval_lookup, weight_intervals
    spans = weight_intervals([0.5, 0.0, 0.25, 0.25])
    assert spans == [(0, 5000), (5000, 5000), (5000, 7500), (7500, 10000)]
    table = spark.createDataFrame([(lo, hi, k) for k, (lo, hi) in enumerate(spans)], "lo int, hi int, name int")
    df = spark.createDataFrame([(p,) for p in (0, 4999, 5000, 7499, 7500, 9999, 10000)], "p int")
    got = interval_lookup(df, "p", table, how="left")
    assert {r.p: r.name for r in got.collect()} == {0: 0, 4999: 0, 5000: 2, 7499: 2, 7500: 3, 9999: 3, 10000: None}
    assert "NestedLoop" not in _plan(got)


def test_lake_month_written_twice(spark, tmp_path):
    from claimlens.plans.lake import write_lake
    make = lambda rows: {n: spark.createDataFrame(rows, "id int, year int, month int") for n in ("header", "lines", "dx", "labels")}
    path = str(tmp_path / "lake")
    write_lake(make([(1, 2024, 1), (2, 2024, 2), (3, 2024, 2)]), path, replace_months=True)
    write_lake(make([(2, 2024, 2), (4, 2024, 2)]), path, replace_months=True)
    for n in ("header", "labels"):
        assert sorted((r.id, r.month) for r in spark.read.parquet(f"{path}/{n}").collect()) == [(1, 1), (2, 2), (4, 2)]
    write_lake(make([(4, 2024, 2)]), path)                        # the reference's form appends
    assert spark.read.parquet(f"{path}/header").count() == 4


# --- streams -----------------------------------------------------------------------------------------------------------

def test_streamed_totals_after_a_restart(spark, lines, tmp_path):
    """Half of the chunk files, a new query on the same checkpoint for the rest: the batch merges' totals."""
    from claimlens.operators.features import with_chunk_id
    from claimlens.streaming import incremental as I
    df = with_chunk_id(lines, 256).select("chunk_id", "enc_key", "fraud_type", "fraud_label", "flagged_for_review", "rule_score")
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    for k, (state, report, merge) in enumerate([
            (I.counts_state, lambda x: x, lambda d: I.merge_counts(d, "fraud_type")), (I.confusion_state, lambda x: x, I.merge_confusion),
            (I.detection_state, I.detection_report, I.merge_detection)]):
        source, folder = str(tmp_path / f"in{k}"), str(tmp_path / f"out{k}")
        half = df.where("chunk_id % 2 = 0")
        half.repartition(3).write.mode("append").parquet(source)
        assert same(report(I.stream_totals(spark, source, folder, state, files_per_trigger=1)), merge(half))
        df.where("chunk_id % 2 = 1").repartition(3).write.mode("append").parquet(source)
        assert same(report(I.stream_totals(spark, source, folder, state, files_per_trigger=2)), merge(df))
        assert same(report(I.stream_totals(spark, source, folder, state)), merge(df))      # nothing new: the last totals


def test_staged_tables_go(spark, tmp_path):
    """Staged tables lie in the application's folder of the shared directory and can be removed as a whole."""
    import os
    from claimlens.session import checkpoint_dir, stage_table, staging_folder
    df = stage_table(spark.range(5), "some")
    folder = staging_folder(spark).replace("file:", "")
    assert spark.sparkContext.applicationId in folder and folder.startswith(checkpoint_dir(spark).replace("file:", "").rstrip("/"))
    assert any(name.startswith("some-") for name in os.listdir(folder)) and df.count() == 5


def test_staged_tables_are_written_small(spark):
    """Staged tables are written with zstd, whatever the session's codec."""
    from claimlens.session import stage_table
    files = stage_table(spark.range(5), "small").inputFiles()
    assert files and all(name.endswith(".zstd.parquet") for name in files)


def test_samples_and_streams_move_only_their_columns(spark, lines, monkeypatch):
    """Neither the candidates of a sample nor the chunk files of the provider rollup hold whole lines."""
    from claimlens.plans import queries as Q
    from claimlens.sources import sinks
    from claimlens.streaming import incremental
    seen = {}
    sample, write = sinks.sample_per_chunk, incremental.write_chunks
    monkeypatch.setattr(sinks, "sample_per_chunk", lambda df, *a: seen.update(sample=df.columns) or sample(df, *a))
    monkeypatch.setattr(incremental, "write_chunks", lambda df, *a: seen.update(stream=df.columns) or write(df, *a))
    chunks = lines.groupBy((lines.enc_key / Q.CHUNK_SIZE).cast("bigint")).count().collect()
    want = min(sum(min(r[1], Q.SAMPLE_PER_CHUNK) for r in chunks), Q.SAMPLE_TOTAL)
    assert Q.sample_per_chunk_q(spark, SF_SMALL).count() == want
    assert Q.stream_provider_rollup_q(spark, SF_SMALL).agg({"lines": "sum"}).first()[0] == lines.count()
    assert set(seen["sample"]) == {"line_id", "enc_key", "fraud_type"}
    assert set(seen["stream"]) == {"enc_key", *incremental.ROLLUP_COLUMNS}
