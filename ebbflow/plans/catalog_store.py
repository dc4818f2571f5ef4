"""Catalog: versioned feature tables, splits, metric history, fingerprint."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import features as FE
from ..operators import fingerprint as FP
from ..operators import metrics as M
from ..operators import split as S
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import metric_log as LOG
from ..sources import versions as V
from .catalog_metrics import evaluate_sql
from .catalog_split import fold_metrics_sql, kfold_metrics
from .registry import ORACLE, query
from .sqltext import prep_cte, q


def _root(spark):
    return scratch_path(spark, "store")


@query("write_processed")
def write_processed(spark, sf):
    """Feature table written as a new version; returns the version record."""
    root = _root(spark)
    rec = V.write_version(FE.process_features(fx.subscribers(spark, sf, keyed=True)), root, "processed")
    return V.list_versions(spark, root, "processed").select("kind", "fingerprint", "n_rows", "n_columns", "columns")


@query("read_latest", prep_cte("encoded") + "SELECT * FROM encoded")
def read_latest(spark, sf):
    """Two versions written; the newest is found from the version records
    and read back through partition pruning."""
    root = _root(spark)
    raw = fx.subscribers(spark, sf, keyed=True)
    st = FE.fit_features(raw)
    V.write_version(FE.transform_features(raw.where(F.col("churned") == 1), st), root, "processed")
    V.write_version(FE.transform_features(raw, st), root, "processed")
    return V.read_version(spark, root, "processed")


@query("table_fingerprint")
def table_fingerprint(spark, sf):
    """Shape + schema + order-independent content hash of the raw table."""
    return FP.fingerprint(fx.subscribers(spark, sf))


@query("write_split", ORACLE.get("stratified_split"))
def write_split(spark, sf):
    """Split written partitioned by side; read back (one version)."""
    root = _root(spark)
    sp = S.stratified_split(fx.subscribers(spark, sf, keyed=True).select("row_id", "churned"))
    V.write_version(sp, root, "splits", partition_by=("split",))
    return V.read_version(spark, root, "splits").select("row_id", "churned", "split")


@query("read_split_test", None if ORACLE.get("stratified_split") is None else
       "SELECT row_id, churned FROM (" + ORACLE["stratified_split"] + ") WHERE split = 'test'")
def read_split_test(spark, sf):
    """One side of the latest split: the ``split`` filter prunes to one
    partition directory."""
    root = _root(spark)
    sp = S.stratified_split(fx.subscribers(spark, sf, keyed=True).select("row_id", "churned"))
    V.write_version(sp, root, "splits", partition_by=("split",))
    return V.read_version(spark, root, "splits").where(F.col("split") == "test").select("row_id", "churned")


_EVAL_METRICS = ["roc_auc", "accuracy", "precision", "recall", "f1_score", "brier_score", "threshold", "pr_auc",
                 "true_negatives", "false_positives", "false_negatives", "true_positives"]
# two runs of either kind: (threshold of the evaluation, folds of the cross-validation)
_RUNS = [(0.3, 3), (K.THRESHOLD_DEFAULT, K.N_FOLDS)]


def _metric_history_sql() -> str:
    parts = []
    for run, (thr, k) in enumerate(_RUNS, 1):
        ev, kf = f"({evaluate_sql(thr)}) e{run}", f"({fold_metrics_sql(k)}) k{run}"
        parts += [f"SELECT 'evaluation' AS run_kind, {run} AS run, {q(m)} AS metric, NULL AS fold, CAST({m} AS DOUBLE) AS value FROM {ev}"
                  for m in _EVAL_METRICS]
        parts += [f"SELECT 'kfold', {run}, {q(m)}, fold, CAST({m} AS DOUBLE) FROM {kf}" for m in LOG.KFOLD_METRICS]
    return ("WITH log AS (" + "\nUNION ALL ".join(parts) + ")\nSELECT run_kind, CAST(run AS INTEGER) AS run, metric, fold, value, previous, "
            "value - previous AS change FROM (SELECT *, lag(value) OVER (PARTITION BY run_kind, metric, fold ORDER BY run) AS previous FROM log)")


@query("metric_history", _metric_history_sql(), doubles=["value", "previous", "change"])
def metric_history(spark, sf):
    """Two evaluations and two cross-validations appended to the log, read
    back with the change of every metric and fold since the run before."""
    root = _root(spark)
    scored = fx.scored(spark, sf)
    for thr, k in _RUNS:
        LOG.append(LOG.evaluation_rows(M.evaluate_model(scored, thr).select(*_EVAL_METRICS), f"at {thr}"), root)
        LOG.append(LOG.kfold_rows(kfold_metrics(spark, sf, k), f"{k} folds"), root)
    return LOG.history(spark, root).select("run_kind", "run", "metric", "fold", "value", "previous", "change")


@query("pipeline_status")
def pipeline_status(spark, sf):
    """Process and split jobs write their versions; the status is the
    newest record per kind (the service's status report as a table)."""
    from .. import workflows as W
    root = _root(spark)
    W.process_job(fx.subscribers(spark, sf, keyed=True), root)
    W.split_job(spark, root)
    return W.pipeline_status(spark, root).drop("latest_version", "created_at", "path")
