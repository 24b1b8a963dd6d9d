"""Properties of the claim lake and of the incremental / streaming rollups."""

from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_lake_header_totals_match_lines(spark):
    from claimlens.plans.queries import all_queries
    q = all_queries()
    header = q["lake_header"](spark, SF_SMALL).toPandas().set_index("claim_id")
    lines = q["lake_lines"](spark, SF_SMALL).toPandas()
    per = lines.groupby("claim_id").agg(n=("line_num", "max"), b=("billed_amount", "sum"))
    joined = header.join(per, how="inner")
    assert (joined.line_count == joined.n).all()
    assert ((joined.total_billed - joined.b).abs() < 0.011).all()
    # every duplicate claim has a label and its original is labelled too
    labels = q["lake_labels"](spark, SF_SMALL).toPandas()
    dups = labels[labels.claim_id >= 10 ** 12]
    assert set(dups.claim_id - 10 ** 12) <= set(labels.claim_id)


def test_lake_dx_ranks_are_dense(spark):
    from claimlens.plans.queries import all_queries
    dx = all_queries()["lake_dx_bridge"](spark, SF_SMALL)
    g = dx.groupBy("claim_id").agg(F.max("dx_rank").alias("k"), F.count(F.lit(1)).alias("n")).toPandas()
    assert (g.k == g.n).all() and g.k.between(1, 9).all()


def test_chunk_merge_equals_one_shot(spark):
    """Merged chunk partials equal the one-shot aggregate for every sum (SURVEY 5(d))."""
    from claimlens.plans.queries import all_queries
    q = all_queries()
    merged = q["merge_provider_partials"](spark, SF_SMALL).toPandas().set_index("provider_id").sort_index()
    one = q["provider_rollup"](spark, SF_SMALL).toPandas().set_index("provider_id").sort_index()
    assert list(merged.index) == list(one.index)
    for c in ("lines", "fraud_lines", "flagged_lines"):
        assert (merged[c] == one[c]).all(), c
    assert ((merged.allowed_total - one.allowed_total).abs() < 1e-6).all()
    assert (merged.max_day_lines <= one.max_day_lines).all()  # chunk peaks never exceed the global peak


def test_streaming_rollup_equals_batch_merge(spark):
    from claimlens.plans.queries import all_queries
    q = all_queries()
    s = q["stream_provider_rollup"](spark, SF_SMALL).toPandas().sort_values("provider_id").reset_index(drop=True)
    b = q["merge_provider_partials"](spark, SF_SMALL).toPandas().sort_values("provider_id").reset_index(drop=True)
    assert s[["provider_id", "lines", "fraud_lines", "flagged_lines", "max_day_lines"]].equals(
        b[["provider_id", "lines", "fraud_lines", "flagged_lines", "max_day_lines"]])


def test_exact_quantile_matches_percentile(spark):
    from claimlens.functions.quantile import exact_quantile
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        (F.col("l_extendedprice") * 100).cast("bigint").alias("x"))
    for p in (0.0, 0.3, 0.98, 1.0):
        got = exact_quantile(df, "x", p).collect()[0].q
        want = df.select(F.percentile("x", p)).collect()[0][0]
        assert abs(got - want) <= 1e-6 * max(1.0, abs(want)), p


def test_replayed_batch_replaces_its_partials(spark, lines, tmp_path):
    from claimlens.operators.features import with_chunk_id
    from claimlens.streaming.incremental import merge_provider_partials, write_partials
    batches = [with_chunk_id(lines, 512).filter(F.pmod("chunk_id", F.lit(2)) == k) for k in (0, 1)]
    path = str(tmp_path / "partials")
    for k, batch in enumerate(batches):
        write_partials(batch, k, path)
    once = sorted(map(tuple, merge_provider_partials(spark.read.parquet(path)).collect()))
    write_partials(batches[1], 1, path)
    assert sorted(map(tuple, merge_provider_partials(spark.read.parquet(path)).collect())) == once


def test_isolation_forest_samples_and_scores(spark):
    from claimlens.operators.models import isolation_forest
    from claimlens.plans.queries import feature_vector_q
    few = isolation_forest(feature_vector_q(spark, "/root/testdata/sf0.001").limit(2000), n_trees=20, sample_size=64).toPandas()
    assert len(few) == 2000 and few.anomaly_score.between(0, 1).all()
    assert few.anomaly_score.min() < 0.5                       # ordinary points are below one half
    assert few.anomaly.mean() <= 0.08 and few.anomaly.sum() > 0


def test_isolation_path_lengths_equal_a_walk_of_each_row():
    import numpy as np
    import pandas as pd
    from claimlens.operators import models as M
    rng, names = np.random.default_rng(7), list("abc")
    frames = [pd.DataFrame(np.round(rng.lognormal(size=(n, 3)), 1), columns=names).assign(tree_id=t) for t, n in enumerate((64, 64, 5, 1, 64))]
    frames[4][names] = 1.0                                        # nothing to split: the root is a leaf
    nodes = pd.concat([M._grow(f, names, 6) for f in frames], ignore_index=True)
    x = np.round(rng.lognormal(size=(200, 3)), 1)
    x[0, 1], x[1, 0] = np.nan, np.inf
    total = np.zeros(len(x))
    for _, tree in nodes.groupby("tree_id"):
        rows = {r.node_id: r for r in tree.itertuples()}
        for i, values in enumerate(x):
            node, depth = rows[0], 0
            while node.feature >= 0:
                node, depth = rows[node.left if values[node.feature] < node.threshold else node.right], depth + 1
            total[i] += depth + M._c(float(node.size))
    assert (M._path_lengths(x, M._complete_trees(nodes)) == total).all()


def test_performance_table_predicts_each_row_once(spark):
    from claimlens.operators.models import performance_rows
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = spark.createDataFrame([(i % 2, int(i % 3 == 0), i / 40) for i in range(40)], "fraud_label int, prediction int, fraud_probability double")
    lines = rows.withColumnRenamed("prediction", "rule_pred")
    table = performance_rows(lines, rows.mapInPandas(count, rows.schema), rows.withColumnRenamed("prediction", "anomaly")).toPandas()
    assert len(table) == 3 and table["roc_auc"].notna().sum() == 1
    assert seen.value == 40


def test_first_script_detects_its_own_copies(spark):
    """Features, rules and models of the first script see the base lines and all five kinds of appended copies."""
    from claimlens.plans import queries as Q
    folder = "/root/testdata/sf0.001"
    base, copies = Q.claims_from_star(spark, folder).count(), Q.append_fixed_rate_q(spark, folder).count()
    rows = Q.rules_fd_appended_q(spark, folder).toPandas()
    assert len(rows) == base + copies and rows["line_id"].is_unique
    assert set(rows["fraud_type"]) == {"none", "duplicate_billing", "excessive_units", "upcoding", "unbundling", "provider_outlier"}
    assert (rows.loc[rows["fraud_type"] == "duplicate_billing", "rule_duplicate"] == 1).all()
    assert (rows.loc[rows["fraud_type"] == "excessive_units", "rule_excessive_units"] == 1).all()
    inputs = Q._fd_model_input(spark, folder)                     # what both forests and the table read
    assert (inputs.count(), inputs.where("fraud_label = 1").count()) == (base + copies, copies)
