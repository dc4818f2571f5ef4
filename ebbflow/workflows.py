"""User-level batch jobs: the profile -> process -> split -> train ->
evaluate -> k-fold -> score flow, each reading and writing versioned
tables under one root folder (on a cluster: below the shared
``spark.checkpoint.dir``).

Each job is a handful of distributed actions; nothing passes whole
through the driver except fitted scalars, category lists and metric rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import constants as K
from .operators import features as FE
from .operators import metrics as M
from .operators import models as ML
from .operators import monitor as MO
from .operators import profile as P
from .operators import split as S
from .sources import metric_log as LOG
from .sources import versions as V
from .sources.files import with_row_key


def profile_job(raw: DataFrame, out: str) -> dict[str, str]:
    """EDA tables written as Parquet (one folder per block) plus the long
    summary as CSV; returns the written paths."""
    blocks = {"columns": P.column_profile(raw), "missing": P.missing_values(raw),
              "numeric": P.numeric_stats(raw), "outliers": P.outliers_iqr(raw),
              "categorical": P.categorical_stats(raw), "top_categories": P.top_categories(raw),
              "correlations": P.correlation_matrix(raw), "churn_by_feature": P.churn_by_feature(raw),
              "histograms": P.histogram(raw), "box": P.box_stats(raw)}
    paths = {}
    for name, df in blocks.items():
        paths[name] = f"{out.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    summary = P.summary_long(raw)
    paths["summary_csv"] = f"{out.rstrip('/')}/summary_csv"
    paths["summary_json"] = f"{out.rstrip('/')}/summary_json"
    summary.write.mode("overwrite").option("header", True).csv(paths["summary_csv"])
    summary.write.mode("overwrite").json(paths["summary_json"])
    return paths


def process_job(raw: DataFrame, root: str) -> dict:
    """Fit the feature state, write the processed table as a new version
    and the state next to it.  Rows without a ``row_id`` get one from their
    content, so that a table read from a raw file can be split."""
    raw = raw if "row_id" in raw.columns else with_row_key(raw)
    st = FE.fit_features(raw)
    return V.write_version(FE.transform_features(raw, st), root, "processed", texts={"state": FE.state_to_json(st)})


def load_state(spark: SparkSession, root: str, kind: str = "processed", version: str | None = None) -> FE.FeatureState:
    version = version or V.latest_version(spark, root, kind)
    return FE.state_from_json(V.read_text(spark, f"{root.rstrip('/')}/{kind}/version={version}/_state"))


def split_job(spark: SparkSession, root: str, test_size: float = K.TEST_SIZE, seed: int = K.SEED) -> dict:
    d = V.read_version(spark, root, "processed")
    if "row_id" not in d.columns:
        raise ValueError("processed table needs a row_id key to split")
    sp = S.stratified_split(d, test_size=test_size, seed=seed)
    return V.write_version(sp, root, "splits", partition_by=("split",))


def train_job(spark: SparkSession, root: str, model_type: str = "random_forest", **params) -> str:
    """Fit on the latest split's train side; save the pipeline model as a
    new model version; returns its path."""
    st = load_state(spark, root)
    train = V.read_version(spark, root, "splits").where(F.col("split") == "train")
    model = ML.fit_model(train, st.feature_names, model_type, **params)
    version = V.new_version(model_type)
    path = f"{root.rstrip('/')}/models/{version}"
    model.write().save(path)
    V.write_text(spark, f"{path}/_state", FE.state_to_json(st))
    V.record_version(spark, root, "models", version, path, columns=st.feature_names)
    return path


def evaluate_job(spark: SparkSession, root: str, model_path: str, target_metric: str = "f1") -> DataFrame:
    """Tune the threshold on the training rows, evaluate the hold-out at
    it, append the tidy metrics as a new ``metrics`` version."""
    model = ML.load_model(model_path)
    sp = V.read_version(spark, root, "splits")
    from .session import work_dir
    work_dir(spark)
    tr = ML.score(model, sp.where(F.col("split") == "train"))
    thr = M.optimal_threshold(tr, target_metric).collect()[0]["threshold"]  # one pass: the sweep
    te = ML.score(model, sp.where(F.col("split") == "test")).checkpoint(eager=True)
    ev = M.evaluate_model(te, thr)
    LOG.append(LOG.evaluation_rows(ev, model_path.rstrip("/").rsplit("/", 1)[-1]), root)
    return ev


def kfold_job(spark: SparkSession, root: str, model_type: str = "random_forest", n_folds: int = K.N_FOLDS,
              **params) -> DataFrame:
    from .session import work_dir
    work_dir(spark)
    st = load_state(spark, root)
    d = V.read_version(spark, root, "processed")
    folded = S.kfold_assign(d, n_folds=n_folds).checkpoint(eager=True)
    best = f"{root.rstrip('/')}/models/{V.new_version('kfold_best')}"
    res = ML.kfold_train(folded, st.feature_names, model_type, n_folds=n_folds, best_model_path=best, **params)
    V.write_text(spark, f"{best}/_state", FE.state_to_json(st))
    version = best.rsplit("/", 1)[-1]
    V.record_version(spark, root, "models", version, best, columns=st.feature_names)
    V.write_version(res, root, "kfold")
    LOG.append(LOG.kfold_rows(res, version), root)
    return res


def score_job(raw: DataFrame, model_path: str, threshold: float = K.THRESHOLD_DEFAULT,
              key: str = "row_id") -> DataFrame:
    """Raw rows -> key, probability, prediction with the model's frozen
    feature state (the same path the streaming scorer takes)."""
    from .streaming.jobs import score_frame
    st = FE.state_from_json(V.read_text(raw.sparkSession, f"{model_path}/_state"))
    return score_frame(raw, st, model_path, threshold, key)


def metric_trend(spark: SparkSession, root: str) -> DataFrame:
    """All results of evaluations and cross-validations in time order, with
    the change since the run before (one row per run, metric and fold)."""
    return LOG.history(spark, root)


def retrain_job(spark: SparkSession, root: str, model_path: str, current: DataFrame, cols: list[str], as_of: dt.date) -> DataFrame:
    """The retrain decision for ``current`` processed rows (labelled): the
    model's ranking and the watched columns against the training side, and
    the date of the last recorded training known at ``as_of``."""
    model = ML.load_model(model_path)
    base = V.read_version(spark, root, "splits").where(F.col("split") == "train").drop("split")
    sides = [ML.with_probability(model, d, "_p").select(F.lit(side).alias("side"), F.col(K.LABEL).alias("y"), F.col("_p").alias("p"), *cols)
             for side, d in (("baseline", base), ("current", current))]
    return MO.retrain_decision(sides[0].unionByName(sides[1]), cols, V.last_created(spark, root, "models", as_of), as_of)


def pipeline_status(spark: SparkSession, root: str) -> DataFrame:
    """Latest processed table, split, model, metrics and k-fold versions."""
    return V.status(spark, root)
