"""Commit by manifest, metric log, retrain rule, out-of-fold encoding, stream monitor, blocked correlations."""

import datetime as dt
import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ebbflow import workflows as W
from ebbflow.operators import comoments as CO
from ebbflow.operators import monitor as MO
from ebbflow.operators import profile as P
from ebbflow.operators import split as S
from ebbflow.session import scratch_path
from ebbflow.sources import fixtures as fx
from ebbflow.sources import metric_log as LOG
from ebbflow.sources import versions as V
from ebbflow.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def test_a_version_exists_with_its_texts_or_not_at_all(spark, monkeypatch):
    root = scratch_path(spark, "t-manifest")
    d = spark.range(10).withColumn("split", F.lit("a"))
    first = V.write_version(d, root, "processed", texts={"state": "one"}, partition_by=("split",))
    assert (first["n_files"], first["n_bytes"] > 0) == (V._data_files(spark, first["path"])[0], True)

    def crash(*a):
        raise RuntimeError("writer lost")
    with monkeypatch.context() as m:
        m.setattr(V, "write_text", crash)  # after the data, before the state
        with pytest.raises(RuntimeError):
            V.write_version(d.limit(3), root, "processed", texts={"state": "two"})
    with monkeypatch.context() as m:
        m.setattr(V, "_commit", crash)  # after data and state, before the record
        with pytest.raises(RuntimeError):
            V.write_version(d.limit(4), root, "processed", texts={"state": "three"})
    assert V.latest_version(spark, root, "processed") == first["version"]
    assert V.read_version(spark, root, "processed").count() == 10
    assert V.read_text(spark, f"{first['path']}/_state") == "one"
    assert V.read_versions(spark, root, "processed", "id long").count() == 10
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert V.vacuum(spark, root, "processed", now - dt.timedelta(hours=1)) == []  # may still be written
    assert len(V.vacuum(spark, root, "processed", now + dt.timedelta(minutes=1))) == 2
    assert V.vacuum(spark, root, "nothing", now) == [] and V.read_version(spark, root, "processed").count() == 10
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, root, "processed", "v_unknown")


def test_a_version_that_lost_files_is_not_read(spark):
    root = scratch_path(spark, "t-lost")
    rec = V.write_version(spark.range(10).repartition(3), root, "processed")
    spark.range(1).write.mode("append").parquet(rec["path"])  # files that the record does not know
    with pytest.raises(IOError):
        V.read_version(spark, root, "processed")


def test_log_numbers_runs_and_shows_the_change(spark):
    root = scratch_path(spark, "t-log")
    assert LOG.history(spark, root).count() == 0
    for k, auc in enumerate((0.7, 0.8, 0.75)):
        LOG.append(LOG.evaluation_rows(spark.createDataFrame([(auc, k)], "roc_auc double, n long"), f"m{k}"), root)
        if k != 1:
            folds = spark.createDataFrame([("1", auc, 0.5, 9), ("mean", auc, 0.5, 9)], "fold string, roc_auc double, pr_auc double, n long")
            LOG.append(LOG.kfold_rows(folds, f"k{k}"), root)
    got = {(r.run_kind, r.run, r.metric, r.fold): (r.model, r.value, r.previous) for r in LOG.history(spark, root).collect()}
    assert len(got) == 3 * 2 + 2 * 6
    assert got["evaluation", 3, "roc_auc", None] == ("m2", 0.75, 0.8) and got["evaluation", 1, "roc_auc", None][2] is None
    assert got["kfold", 2, "roc_auc", "mean"] == ("k2", 0.75, 0.7) and got["kfold", 1, "n", "1"] == ("k0", 9.0, None)


def test_retrain_job_reads_the_last_training_known(spark):
    raw = fx.subscribers(spark, SF, keyed=True)
    root = scratch_path(spark, "t-retrain")
    W.process_job(raw, root)
    W.split_job(spark, root)
    mp = W.train_job(spark, root, "gbt", rounds=3, depth=2)
    W.evaluate_job(spark, root, mp)
    W.kfold_job(spark, root, "gbt", 3, rounds=2, depth=2)
    log = W.metric_trend(spark, root).collect()
    assert {(r.run_kind, r.fold) for r in log if r.metric == "roc_auc"} == {("evaluation", None)} | {("kfold", f) for f in ("1", "2", "3", "mean", "std")}
    current = V.read_version(spark, root, "splits").where("split = 'test'").drop("split")
    today = dt.datetime.now(dt.timezone.utc).date()
    got = {days: W.retrain_job(spark, root, mp, current, ["monthly_fee"], today + dt.timedelta(days=days)).first() for days in (-1, 0, 100)}
    assert got[-1].last_trained is None and got[-1].due is None and not got[-1].date_fired
    assert got[0].last_trained == today and not got[0].date_fired and got[0].auc_baseline is not None
    assert got[100].date_fired and got[100].retrain and got[100].max_psi == got[0].max_psi


def test_decision_of_one_period_fires_nothing(spark):
    d = spark.createDataFrame([("baseline", 1, 0.5, 1.0), ("baseline", 0, None, 2.0)], "side string, y int, p double, x double")
    none = spark.createDataFrame([(None,)], "last_trained date")
    r = MO.retrain_decision(d, ["x"], none, dt.date(2024, 1, 1)).first()
    assert r.auc_baseline is None and r.churn_rate_baseline == 0.5 and r.retrain is False
    assert MO.retrain_decision(d.where("false"), ["x"], none, dt.date(2024, 1, 1)).first().retrain is False


def test_no_row_sees_its_own_label(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(0, 2)), int(rng.integers(1, 4)), str(rng.choice(["a", "b", "c"])), "x" if i else "only once") for i in range(60)]
    rows += [(100, None, 2, "a", None), (101, 1, 2, None, "x")]
    train = spark.createDataFrame(rows, "row_id long, churned int, fold int, u string, v string").repartition(4)
    test = spark.createDataFrame([(200, "a", "never seen"), (201, None, "only once")], "row_id long, u string, v string")
    enc = MO.fit_target_encoding_folds(train, ["u", "v"])
    whole = train.unionByName(test, allowMissingColumns=True)
    got = {r.row_id: r for r in MO.apply_target_encoding_folds(whole, enc, ["u", "v"], train).collect()}
    m = MO.TE_SMOOTHING

    def code(col, value, fold):
        own = [r for r in rows if r[1] is not None and r[2] != fold]
        prior = np.mean([r[1] for r in own])
        y = [r[1] for r in own if r[col] == value and value is not None]
        return (sum(y) + m * prior) / (len(y) + m)
    for r in rows:
        assert got[r[0]].u_te == pytest.approx(code(3, r[3], r[2])) and got[r[0]].v_te == pytest.approx(code(4, r[4], r[2])), r
    assert got[200].u_te == pytest.approx(code(3, "a", None)) and got[200].v_te == pytest.approx(code(4, None, None))
    assert got[201].u_te == pytest.approx(code(3, None, None)) and got[201].v_te == pytest.approx(code(4, "only once", None))
    # flipping the labels of one fold changes no code of its own rows
    flipped = train.withColumn("churned", F.when(F.col("fold") == 2, 1 - F.col("churned")).otherwise(F.col("churned")))
    again = {r.row_id: r.u_te for r in MO.apply_target_encoding_folds(flipped, MO.fit_target_encoding_folds(flipped, ["u"]), ["u"], flipped).collect()}
    assert all(again[r[0]] == pytest.approx(got[r[0]].u_te) for r in rows if r[2] == 2)
    assert any(abs(again[r[0]] - got[r[0]].u_te) > 1e-6 for r in rows if r[2] != 2)
    alone = train.where("fold = 1")
    one = MO.apply_target_encoding_folds(alone, MO.fit_target_encoding_folds(alone, ["u"]), ["u"], alone)
    assert {r.u_te for r in one.collect()} == {None}  # nothing else to learn from
    assert MO.fit_target_encoding_folds(train.where("false"), ["u"]).count() == 0


def test_running_totals_follow_the_batches(spark):
    raw = fx.subscribers(spark, SF)
    base = MO.fit_drift_baseline(raw, ["monthly_fee", "months_with_provider"])
    assert MO.DriftBaseline.from_json(base.to_json()) == base
    parts = [raw.where("monthly_fee < 60"), raw.where("monthly_fee >= 60"), raw.limit(0), raw]
    before, seen = None, defaultdict(lambda: [0, 0])
    for k, part in enumerate(parts):
        out = J.batch_quality(part, k, before, base)
        rows = {r.column_name: r for r in out.collect()}
        nulls = part.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in raw.columns]).first()
        n = part.count()
        for c in raw.columns:
            seen[c][0] += nulls[c]
            seen[c][1] += n
            assert (rows[c].n_null, rows[c].n_rows, rows[c].running_null, rows[c].running_rows) == (nulls[c], n, *seen[c])
            assert (rows[c].psi is not None) == (c in base.columns and n > 0) and (rows[c].alert is None) == (c not in base.columns)
        want = {r.column_name: r.psi for r in MO.psi(raw, part, list(base.columns)).collect()}
        assert all(rows[c].psi == (pytest.approx(want[c], abs=1e-9) if n else want[c]) for c in base.columns)
        before = spark.createDataFrame(out.collect(), J.QUALITY_SCHEMA)
    assert rows["monthly_fee"].psi == pytest.approx(0, abs=1e-12) and not rows["monthly_fee"].alert


def test_a_batch_run_again_counts_once(spark):
    from ebbflow.sources import files
    raw = fx.subscribers(spark, SF)
    src, sink, ck = (scratch_path(spark, n) for n in ("t-q-in", "t-q-out", "t-q-ck"))
    files.write_csv(raw.repartition(3), src)
    J.stream_quality(spark, src, sink, ck, max_files=1).awaitTermination()
    out = spark.read.schema(J.QUALITY_SCHEMA).parquet(sink)
    first = sorted(map(str, out.where("batch_id = 1").collect()))
    part = raw.limit(7)
    J.batch_quality(part, 1, J._state_before(spark, sink, 1)).drop("batch_id").write.mode("overwrite").parquet(f"{sink}/batch_id=1")
    rows = spark.read.schema(J.QUALITY_SCHEMA).parquet(sink)
    zero = {r.column_name: r.running_rows for r in rows.where("batch_id = 0").collect()}
    assert {r.column_name: r.running_rows for r in rows.where("batch_id = 1").collect()} == {c: n + 7 for c, n in zero.items()}
    assert len(first) == len(raw.columns) and rows.select("batch_id").distinct().count() == 3


@pytest.mark.parametrize("block", [2, 64])
def test_correlations_of_blocks_equal_pandas(spark, monkeypatch, block):
    monkeypatch.setattr(CO, "BLOCK", block)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 7)) * 10.0 ** np.arange(7) + 1e9 * (np.arange(7) == 3)
    x[:, 1] += x[:, 0] * 5
    x[:, 5] = 4.25  # constant
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:-1, 6] = np.nan  # one value
    pdf = pd.DataFrame(x, columns=[f"c {i}" for i in range(7)])
    df = spark.createDataFrame(pdf).repartition(6)
    got = {(r.i, r.j): r.correlation for r in P.correlation_matrix(df).collect()}
    want = pdf.corr(min_periods=2).to_numpy()
    assert len(got) == 49
    for (i, j), r in got.items():
        if 5 in (i, j) or 6 in (i, j):
            assert r is None, (i, j)
        else:
            assert r == pytest.approx(want[i, j], abs=1e-9 if 3 not in (i, j) else 1e-6), (i, j)
    empty = P.correlation_matrix(df.where("false")).collect()
    assert len(empty) == 49 and all(r.correlation is None for r in empty)


def test_many_columns_still_compile(spark):
    d = spark.range(50).select(*[(F.sin(F.col("id") * (k + 1))).alias(f"x{k}") for k in range(150)])
    got = P.correlation_matrix(d)
    assert got.count() == 150 * 150
    x = np.sin(np.arange(50)[:, None] * np.arange(1, 151))
    r = {(r.i, r.j): r.correlation for r in got.where("i < 3 AND j > 147").collect()}
    assert all(v == pytest.approx(np.corrcoef(x[:, i], x[:, j])[0, 1], abs=1e-9) for (i, j), v in r.items())


NO_SQL = sorted(set(E.queries()) - set(E.oracle_sql()))
OWN = [n for n in NO_SQL if n != "pipeline" and not n.startswith("op")]


@pytest.mark.parametrize("name", OWN)
def test_query_without_sql_runs(spark, name):
    """Every query that SQL cannot repeat gives rows, twice the same where it has no clock in it."""
    rows = E.queries()[name](spark, SF).collect()
    assert rows and all(len(r) == len(rows[0]) for r in rows)
    if "p" in rows[0].asDict():
        assert all(r.p is None or 0 <= r.p <= 1 for r in rows)
    for c in ("roc_auc", "pr_auc", "mean_roc_auc"):
        if c in rows[0].asDict():
            assert all(r[c] is None or 0 <= r[c] <= 1 and math.isfinite(r[c]) for r in rows)


def test_folds_and_sides_of_the_catalog_are_independent(spark):
    q = E.queries()
    d = q["stratified_split"](spark, "/root/testdata/sf0.01").join(q["kfold_assign"](spark, "/root/testdata/sf0.01").select("row_id", "fold"), "row_id")
    n = {(r.split, r.fold): r["count"] for r in d.groupBy("split", "fold").count().collect()}
    assert len(n) == 2 * 5 and min(n.values()) > 30, n
    cap = q["stratified_cap_sample"](spark, "/root/testdata/sf0.01").join(S.stratified_split(fx.subscribers(
        spark, "/root/testdata/sf0.01", keyed=True)).select("row_id", "split"), "row_id")
    sides = {r.split: r["count"] for r in cap.groupBy("split").count().collect()}
    assert sides["train"] > 2 * sides["test"] > 0, sides
