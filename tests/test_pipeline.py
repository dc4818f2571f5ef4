"""Splits, versions, fingerprint, models and streaming on sf0.001."""

import math

import pytest
from pyspark.sql import functions as F

from ebbflow.functions import constants as K
from ebbflow.operators import features as FE
from ebbflow.operators import fingerprint as FP
from ebbflow.operators import metrics as M
from ebbflow.operators import models as ML
from ebbflow.operators import split as S
from ebbflow.session import scratch_path
from ebbflow.sources import fixtures as fx
from ebbflow.sources import versions as V


@pytest.fixture(scope="module")
def raw(spark, sf):
    return fx.subscribers(spark, sf, keyed=True).cache()


def test_split_is_exact_stratified_and_reproducible(raw):
    a = S.stratified_split(raw)
    counts = {(r.churned, r.split): r["count"] for r in a.groupBy("churned", "split").count().collect()}
    sizes = {y: counts.get((y, "test"), 0) + counts.get((y, "train"), 0) for y in (0, 1)}
    assert {y: counts.get((y, "test"), 0) for y in (0, 1)} == S.side_quotas(sizes, K.TEST_SIZE)
    assert sum(n for (_, side), n in counts.items() if side == "test") == math.ceil(150 * K.TEST_SIZE)
    b = S.stratified_split(raw.repartition(5))
    assert sorted(a.select("row_id", "split").collect()) == sorted(b.select("row_id", "split").collect())


def test_folds_balanced(raw):
    f = S.kfold_assign(raw)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert len(sizes) == K.N_FOLDS and max(sizes) - min(sizes) <= 1


def test_label_required(spark):
    df = spark.createDataFrame([(1, 2)], "feature1 int, feature2 int")
    with pytest.raises(ValueError):
        S.stratified_split(df.withColumn("row_id", F.lit(1)))


def test_processed_has_no_nulls_and_binary_domains(raw):
    p = FE.process_features(raw)
    row = p.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(p.columns)]).collect()[0]
    assert sum(row) == 0
    assert {r[0] for r in p.select("contract_type").distinct().collect()} <= {0, 1, 2}
    assert "account_id" not in p.columns and p.columns[-1] == K.LABEL


def test_versions_latest_and_missing(spark, raw):
    root = scratch_path(spark, "t-store")
    with pytest.raises(FileNotFoundError):
        V.latest_version(spark, root, "processed")
    V.write_version(raw.limit(10), root, "processed")
    r2 = V.write_version(raw, root, "processed")
    assert V.latest_version(spark, root, "processed") == r2["version"]
    assert V.read_version(spark, root, "processed").count() == raw.count()


def test_fingerprint_stable_and_sensitive(raw):
    a = FP.fingerprint_row(raw)["fingerprint"]
    assert FP.fingerprint_row(raw.repartition(3))["fingerprint"] == a
    assert FP.fingerprint_row(raw.withColumn("extra", F.lit(1)))["fingerprint"] != a


def test_logistic_model_scores_and_errors(spark, raw):
    st = FE.fit_features(raw)
    d = S.stratified_split(FE.transform_features(raw, st))
    m = ML.fit_model(d.where(F.col("split") == "train"), st.feature_names, "logistic", max_iter=50)
    s = ML.score(m, d.where(F.col("split") == "test"))
    r = M.ranking_auc(s).collect()[0]
    assert 0.0 <= r.roc_auc <= 1.0 and r.n == d.where(F.col("split") == "test").count()
    with pytest.raises(ValueError):
        ML.estimator("nope", 10)
    with pytest.raises(ValueError):
        ML.fit_model(d.drop(K.LABEL), st.feature_names)


def test_stream_ingest_equals_batch(spark, sf):
    from ebbflow.sources import files
    from ebbflow.streaming import jobs as J
    raw = fx.subscribers(spark, sf)
    src, sink, ck = (scratch_path(spark, n) for n in ("t-in", "t-out", "t-ck"))
    files.write_csv(raw.repartition(3), src)
    J.stream_ingest(spark, src, sink, ck).awaitTermination()
    got = spark.read.parquet(sink).drop("source_file", "_corrupt_record")
    exp = FE.clean_all(raw)
    assert got.exceptAll(exp.select(*got.columns)).count() == 0
    assert got.count() == exp.count()


def test_workflow_end_to_end(spark, raw):
    from ebbflow import workflows as W
    root = scratch_path(spark, "t-flow")
    W.process_job(raw, root)
    W.split_job(spark, root)
    mp = W.train_job(spark, root, "logistic", max_iter=30)
    ev = W.evaluate_job(spark, root, mp).collect()[0]
    assert 0.1 <= ev.threshold <= 0.9 and 0.0 <= ev.roc_auc <= 1.0
    scores = W.score_job(raw, mp)
    assert scores.count() == raw.count()
    assert W.metric_trend(spark, root).count() == len(ev)
    kinds = {r.kind for r in W.pipeline_status(spark, root).collect()}
    assert kinds == {"processed", "splits", "models", "metrics"}


def test_kfold_marks_one_best_and_saves_it(spark, raw):
    st = FE.fit_features(raw)
    folded = S.kfold_assign(FE.transform_features(raw, st), n_folds=3)
    path = scratch_path(spark, "t-best")
    res = ML.kfold_train(folded, st.feature_names, "logistic", n_folds=3, best_model_path=path, max_iter=20)
    rows = {r.fold: r for r in res.collect()}
    assert set(rows) == {"1", "2", "3", "mean", "std"}
    assert sum(1 for f in "123" if rows[f].is_best) == 1
    assert rows["mean"].n == raw.count()
    assert ML.load_model(path) is not None


def test_confusion_cells_sum_to_n(spark, sf):
    sc = fx.scored(spark, sf)
    r = M.confusion(sc).collect()[0]
    assert r.tn + r.fp + r.fn + r.tp == sc.count()


def test_profile_job_writes_every_block(spark, raw):
    from ebbflow import workflows as W
    out = scratch_path(spark, "t-profile")
    paths = W.profile_job(raw.drop("row_id"), out)
    assert spark.read.parquet(paths["columns"]).collect()[0].n_rows == raw.count()
    assert spark.read.option("header", True).csv(paths["summary_csv"]).count() > 0


def test_group_split_keeps_repeated_accounts_together(spark, raw):
    dup = raw.unionByName(raw.limit(20).withColumn("row_id", F.col("row_id") + 100000))
    sp = S.stratified_split_by_group(dup, "account_id")
    per = sp.groupBy("account_id").agg(F.countDistinct("split").alias("k"))
    assert per.where(F.col("k") > 1).count() == 0
    assert sp.count() == dup.count()


def _rounded_rows(df):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("op", ["numeric_stats", "churn_by_feature", "categorical_stats", "histogram"])
def test_profile_results_ignore_partitioning(raw, op):
    from ebbflow.operators import profile as P
    base = raw.drop("row_id")
    a = getattr(P, op)(base)
    b = getattr(P, op)(base.repartition(7, "account_id"))
    assert _rounded_rows(a) == _rounded_rows(b)


def test_metrics_ignore_partitioning(spark, sf):
    sc = fx.scored(spark, sf)
    for f in (M.ranking_auc, M.threshold_sweep, M.roc_curve_points):
        assert _rounded_rows(f(sc)) == _rounded_rows(f(sc.repartition(5, "p")))


def test_distinct_counts_are_exact_for_id_columns(raw):
    from ebbflow.operators import profile as P
    prof = {r.column_name: r.n_distinct for r in P.column_profile(raw.drop("row_id")).collect()}
    assert prof["account_id"] == raw.count() and prof["gender"] == 2


def test_side_quotas_follow_the_total():
    assert sum(S.side_quotas({0: 7, 1: 7}, 0.2).values()) == 3
    assert S.side_quotas({0: 2, 1: 2}, 0.2) == {0: 1, 1: 0}
    assert S.side_quotas({0: 80, 1: 20, None: 5}, 0.2) == {0: 16, 1: 4, None: 1}
    assert S.side_quotas({}, 0.2) == {}


def test_fold_sizes_balance():
    for sizes in ({0: 7, 1: 9}, {0: 1, 1: 1, 2: 1}, {0: 100, 1: 33, None: 4}):
        per = S.fold_sizes(sizes, 5)
        assert {c: sum(n) for c, n in per.items()} == sizes
        totals = [sum(n[f] for n in per.values()) for f in range(5)]
        assert max(totals) - min(totals) <= 1
        assert all(max(n) - min(n) <= 1 for n in per.values())


def test_null_labels_and_keys_keep_their_rows(spark):
    d = spark.range(1, 201).select(F.col("id").alias("row_id"),
                                   F.when(F.col("id") % 10 != 0, (F.col("id") % 3 == 0).cast("int")).alias("churned"),
                                   F.when(F.col("id") % 7 != 0, F.concat(F.lit("A"), F.col("id") % 20)).alias("account_id"))
    assert S.stratified_split(d).where("split = 'test'").count() == 40
    folds = S.kfold_assign(d)
    assert folds.count() == 200 and folds.where("fold IS NULL").count() == 0
    by = S.stratified_split_by_group(d, "account_id")
    assert by.count() == 200 and by.where("split IS NULL").count() == 0
    empty = S.stratified_split(d.limit(0))
    assert empty.count() == 0 and S.kfold_assign(d.limit(0)).count() == 0


def test_split_is_a_projection(raw):
    plan = S.stratified_split(raw.select("row_id", "churned").where("row_id > 0"))._jdf.queryExecution().executedPlan().toString()
    base = raw.select("row_id", "churned").where("row_id > 0")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == base.count("Exchange") and "Window" not in plan


def test_missing_feature_scores_null(spark, raw):
    from ebbflow.streaming import jobs as J
    st = FE.fit_features(raw)
    d = S.stratified_split(FE.transform_features(raw, st))
    m = ML.fit_model(d.where(F.col("split") == "train"), st.feature_names, "logistic", max_iter=20)
    mp = scratch_path(spark, "t-model-null")
    m.write().save(mp)
    gone = raw.withColumn("monthly_fee", F.when(F.col("row_id") % 2 == 0, F.col("monthly_fee")))
    out = J.score_frame(gone, st, mp)
    assert out.where("(row_id % 2 = 1) <> (probability IS NULL AND prediction IS NULL)").count() == 0


def test_csv_columns_come_from_the_header(spark):
    from ebbflow.sources import files
    path = scratch_path(spark, "t-upload")
    rows = ['churned,account_id,gender', '1.0,"a ""b"", c",Male', 'True,x,Female', '0,NAN,nan', 'oops,y,Male', '1,z']
    spark.createDataFrame([("\n".join(rows),)], "value string").coalesce(1).write.text(path)
    got = {r.account_id: r for r in files.read_subscribers_csv(spark, path, corrupt=True).collect()}
    assert got['a "b", c'].churned == 1 and got["x"].churned == 1 and got["NAN"].churned == 0
    assert got["NAN"].gender is None and got["y"].churned is None and got["x"].gender == "Female"
    assert got["x"].seniorcitizen is None and got["x"].monthly_fee is None
    assert [k for k, r in got.items() if r[files.CORRUPT] is not None] == ["z"]


def test_row_keys_follow_the_content(spark, raw):
    from ebbflow.sources import files
    plain = raw.drop("row_id")
    twice = plain.unionByName(plain.limit(20))
    a, b = files.with_row_key(twice), files.with_row_key(twice.repartition(7))
    assert a.select("row_id").distinct().count() == twice.count()
    assert a.exceptAll(b).count() == 0 and S.stratified_split(a).count() == twice.count()


def test_flow_from_a_raw_file(spark, raw):
    from ebbflow import workflows as W
    from ebbflow.sources import files
    path, root = scratch_path(spark, "t-raw-csv"), scratch_path(spark, "t-raw-flow")
    files.write_csv(raw.drop("row_id"), path)
    W.process_job(files.read_subscribers_csv(spark, path), root)
    W.split_job(spark, root)
    mp = W.train_job(spark, root, "logistic", max_iter=20)
    assert 0.0 <= W.evaluate_job(spark, root, mp).collect()[0].roc_auc <= 1.0
    assert {r.model for r in W.metric_trend(spark, root).collect()} == {mp.rsplit("/", 1)[-1]}


def test_csv_quoted_line_breaks_need_the_option(spark):
    from ebbflow.sources import files
    path = scratch_path(spark, "t-upload-lines")
    spark.createDataFrame([('account_id,churned\n"a\nb",1',)], "value string").coalesce(1).write.text(path)
    rows = files.read_subscribers_csv(spark, path, multi_line=True).collect()
    assert [(r.account_id, r.churned) for r in rows] == [("a\nb", 1)]


def test_calibrator_is_kept_and_applied(spark, sf):
    sc = fx.scored(spark, sf)
    cal = ML.fit_platt(sc.where("row_id % 2 = 0"))
    path = scratch_path(spark, "t-platt")
    cal.write().save(path)
    out = ML.apply_platt(ML.load_model(path), sc.where("row_id % 2 = 1").unionByName(
        spark.createDataFrame([(-1, 1, None)], sc.schema)))
    assert out.where("p IS NOT NULL AND NOT p_cal BETWEEN 0 AND 1").count() == 0
    assert out.where("p IS NULL").select("p_cal").collect()[0][0] is None


def test_stream_score_equals_batch_score(spark, raw):
    from ebbflow.streaming import jobs as J
    st = FE.fit_features(raw)
    d = S.stratified_split(FE.transform_features(raw, st))
    m = ML.fit_model(d.where(F.col("split") == "train"), st.feature_names, "logistic", max_iter=20)
    mp = scratch_path(spark, "t-model")
    m.write().save(mp)
    src, sink, ck = (scratch_path(spark, n) for n in ("t-raw", "t-scores", "t-ck-s"))
    raw.repartition(3).write.parquet(src)
    J.stream_score(spark, src, sink, ck, st, mp, raw.schema).awaitTermination()
    got = {r.row_id: (round(r.probability, 12), r.prediction) for r in spark.read.parquet(sink).collect()}
    exp = {r.row_id: (round(r.probability, 12), r.prediction) for r in J.score_frame(raw, st, mp).collect()}
    assert got == exp and len(got) == raw.count()


def test_payload_round_trip_reads_examples(spark, raw):
    from ebbflow.sources import files
    rows = files.payload_round_trip(spark, raw).collect()
    assert sorted(r.name for r in rows) == ["high_risk_customer", "low_risk_customer", "medium_risk_customer"]
    assert "churned" not in rows[0].asDict() and "account_id" not in rows[0].asDict()
