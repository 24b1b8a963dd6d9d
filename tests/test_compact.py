"""Lines in compact form: the same rows as the whole table's, narrow where they are exchanged, and in code that is compiled."""

from conftest import SF_SMALL

HUGE = 8000          # bytes of a method that HotSpot does not compile


def _largest_method(df) -> int:
    spark, name = df.sparkSession, "spark.sql.adaptive.enabled"
    was = spark.conf.get(name)
    spark.conf.set(name, "false")                                 # an adaptive plan shows its code only after it ran
    try:
        stages = df.select("*")._jdf.queryExecution().debug().codegenToSeq()
        return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))
    finally:
        spark.conf.set(name, was)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(df) -> list[str]:
    return [line for line in _plan(df).splitlines() if "FileScan parquet" in line]


def _fresh(monkeypatch):
    """As in a session's first query: no line table is written yet."""
    from claimlens.plans import extra, queries, v6
    for module, name in ((v6, "_MATERIALIZED"), (v6, "_SEEDED"), (v6, "_SOME_COLUMNS"), (extra, "_WRITTEN"), (queries, "_FD")):
        monkeypatch.setattr(module, name, {})


def test_unfolded_lines_equal_the_scored_table(spark, lines, monkeypatch):
    from claimlens.plans.v6 import final_projection, whole_lines
    _fresh(monkeypatch)
    whole, unfolded = final_projection(lines), final_projection(whole_lines(spark, SF_SMALL))
    assert unfolded.schema.simpleString() == whole.schema.simpleString() and unfolded.count() == whole.count()
    assert unfolded.exceptAll(whole).isEmpty()


def test_v5_lines_are_exchanged_in_compact_form(spark, monkeypatch):
    from claimlens.plans.queries import all_queries
    _fresh(monkeypatch)
    df = all_queries()["v5_lines"](spark, SF_SMALL)
    scans = _scans(df)
    assert scans and not [s for s in scans if "episode_id" in s or "member_gender" in s or "drug_name" in s]
    assert _largest_method(df) <= HUGE


def test_compact_lines_are_compiled(spark):
    from claimlens.plans.v6 import compact_lines
    assert _largest_method(compact_lines(spark, SF_SMALL)) <= HUGE


def test_numbered_equals_format_string(spark):
    from pyspark.sql import functions as F
    from claimlens.functions.draws import numbered
    df = spark.createDataFrame([(0,), (7,), (999,), (1000,), (123456789012,), (-5,), (-1234,), (None,)], "n bigint")
    rows = df.select(numbered("P", F.col("n"), 3).alias("a"), F.format_string("P%03d", "n").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_lines_without_a_provider_are_one_provider(spark, tmp_path):
    """As in the whole table, where their provider id is one text."""
    from claimlens.operators.features import group_features_v6
    from claimlens.plans.v6 import NO_KEY
    from pyspark.sql import functions as F
    rows = [(1, None), (2, None), (3, 4), (4, 4), (5, 5)]
    df = spark.createDataFrame([(i, 1, p, "c", 100, 100, 100) for i, p in rows],
                               "line int, member_key bigint, l_suppkey bigint, service_code string, contract_rate bigint, "
                               "allowed_amount bigint, billed_amount bigint").withColumn("service_date", F.lit("2020-01-01").cast("date"))
    df = df.withColumn("provider_key", F.coalesce("l_suppkey", F.lit(NO_KEY)))
    got = group_features_v6(df, member="member_key", provider="provider_key")
    assert {r.line: (r.provider_day_claim_count, r.duplicate_signature_count) for r in got.collect()} == {
        1: (2, 2), 2: (2, 2), 3: (2, 2), 4: (2, 2), 5: (1, 1)}


def test_line_files_are_unfolded_in_their_chunks_order(spark, monkeypatch):
    """The wide rows of both versions come from narrow ones that are in order already: no scan, exchange or sort above has them."""
    import re
    from pyspark.sql import DataFrameWriter
    from claimlens.plans import extra
    _fresh(monkeypatch)
    plans, real = [], DataFrameWriter.parquet

    def parquet(self, path, *a, **k):
        if "line-files" in path:
            plans.append(_plan(self._df))
        return real(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    got = extra.read_lines_q(spark, SF_SMALL)
    assert len(plans) == 2 and got.count() > 0
    for plan in plans:
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
        assert len(scans) == 1 and not re.search("episode_id|member_gender|drug_name", scans[0])
        steps = [line.split("- ", 1)[-1].split("(")[0] for line in plan.splitlines()]
        assert sum(s.startswith("Exchange") for s in steps) == 1 and sum(s.startswith("Sort [") for s in steps) == 1


def test_first_scripts_base_and_copies_are_compiled(spark, monkeypatch):
    from claimlens.operators.seed_fd import FD_CARRIED, append_fixed_rate
    from claimlens.plans import queries as Q
    from claimlens.session import stage_table
    from claimlens.sources.tables import read_table
    _fresh(monkeypatch)
    base = Q._fd_base(spark, SF_SMALL)
    assert _largest_method(base) <= HUGE
    copies = append_fixed_rate(stage_table(base, "test-base"), read_table(spark, SF_SMALL, "supplier", ["s_suppkey"]), FD_CARRIED)
    explode = [line for line in _plan(copies).splitlines() if "Generate explode" in line]
    assert explode and not [line for line in explode if "lambda" in line]


def test_taken_rows_with_nulls_and_ties(spark):
    from pyspark.sql import functions as F
    from claimlens.functions.sampling import is_taken
    h, k, cut_h, cut_k = (F.col(c) for c in ("h", "k", "ch", "ck"))
    rows = [(i, *r) for i, r in enumerate([(1, "a", 2, "b"), (2, "a", 2, "b"), (2, "b", 2, "b"), (2, "c", 2, "b"), (3, "a", 2, "b"),
                                          (1, "a", None, None), (None, None, 2, "b"), (1, "z", 2, "b")])]
    df = spark.createDataFrame(rows, "i int, h bigint, k string, ch bigint, ck string")
    got = {r.i: r.t for r in df.select("i", is_taken(h, k, cut_h, cut_k).alias("t")).collect()}
    assert [got[i] for i in range(len(rows))] == [True, True, True, False, False, False, False, True]
