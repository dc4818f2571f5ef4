"""Catalog: scaling, class weights, model fitting, scoring, k-fold.

Fits are rows-only checks (tests hold them against plain versions); the
deterministic pieces (scaling, weights, calibration) carry DuckDB oracles.
All fits use the full default settings.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import features as FE
from ..operators import logistic as LG
from ..operators import metrics as M
from ..operators import models as ML
from ..operators import split as S
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources.fixtures import oracle_cte
from .registry import query
from .sqltext import SPLIT_CASE, dbl, feature_names, ident, prep_cte, ranked_cte


def prepared(spark, sf, folds: bool = False):
    """Feature table with its split (and folds of all rows), checkpointed to
    the shared folder so fits and scoring re-read it instead of recomputing
    the lineage."""
    raw = fx.subscribers(spark, sf, keyed=True)
    st = FE.fit_features(raw)
    feats = FE.transform_features(raw, st)
    sp = S.stratified_split(feats)
    if folds:
        sp = S.kfold_assign(sp)
    scratch_path(spark, "ckpt")  # make sure a checkpoint folder is set
    return sp.checkpoint(eager=True), st


def train_folds(d):
    """The training side with folds of its own."""
    return S.kfold_assign(d.where(F.col("split") == "train"))


_FN = feature_names()


@query("standard_scale", prep_cte("encoded") + "SELECT row_id, " + ", ".join(
    f"CASE WHEN stddev_pop({ident(n)}) OVER () = 0 THEN 0.0 ELSE ({ident(n)} - avg({ident(n)}) OVER ()) / "
    f"stddev_pop({ident(n)}) OVER () END AS {ident(n)}" for n in _FN) + " FROM encoded", doubles=_FN)
def standard_scale(spark, sf):
    raw = fx.subscribers(spark, sf, keyed=True)
    st = FE.fit_features(raw)
    feats = FE.transform_features(raw, st).select("row_id", *[F.col(f"`{n}`").cast("double").alias(n)
                                                              for n in st.feature_names])
    return ML.standard_scale(feats, st.feature_names, keep=("row_id",))


@query("class_weights", prep_cte("cleaned").rstrip() + "\n" + (
    "SELECT churned, CAST(count(*) AS BIGINT) AS n_class, sum(count(*)) OVER () / (2.0 * count(*)) AS weight "
    "FROM subscribers_k GROUP BY churned"), doubles=["weight"])
def class_weights(spark, sf):
    return ML.class_weights(fx.subscribers(spark, sf, keyed=True))


@query("train_logistic")
def train_logistic(spark, sf):
    """Balanced L2 logistic regression (C=1 parity via regParam = 1/n);
    returns the coefficients on the scaled features."""
    d, st = prepared(spark, sf)
    m = ML.fit_model(d.where(F.col("split") == "train"), st.feature_names, "logistic")
    return ML.coefficients(m, st.feature_names)


@query("train_random_forest")
def train_random_forest(spark, sf):
    """Balanced random forest; returns hold-out scores (row_id, y, p)."""
    d, st = prepared(spark, sf)
    m = ML.fit_model(d.where(F.col("split") == "train"), st.feature_names, "random_forest")
    return ML.score(m, d.where(F.col("split") == "test"))


@query("train_gbt")
def train_gbt(spark, sf):
    """Gradient-boosted trees with the fixed positive-class weight;
    returns hold-out scores."""
    d, st = prepared(spark, sf)
    m = ML.fit_model(d.where(F.col("split") == "train"), st.feature_names, "gbt")
    return ML.score(m, d.where(F.col("split") == "test"))


@query("feature_importance")
def feature_importance(spark, sf):
    d, st = prepared(spark, sf)
    m = ML.fit_model(d.where(F.col("split") == "train"), st.feature_names, "random_forest")
    return ML.feature_importance(m, st.feature_names)


@query("score_batch")
def score_batch(spark, sf):
    """Model saved and loaded as one pipeline with the frozen feature
    state; raw rows scored through both."""
    d, st = prepared(spark, sf)
    m = ML.fit_model(d.where(F.col("split") == "train"), st.feature_names, "logistic")
    path = scratch_path(spark, "model")
    m.write().save(path)
    model = ML.load_model(path)
    raw = fx.subscribers(spark, sf, keyed=True)
    feats = FE.align_features(FE.transform_features(raw, FE.state_from_json(FE.state_to_json(st))),
                              st.feature_names, keep=("row_id", K.LABEL))
    return ML.score(model, feats)


@query("evaluate_holdout")
def evaluate_holdout(spark, sf):
    """The full batch flow: fit on train, tune the F1 threshold on the
    training rows, evaluate the hold-out at that threshold."""
    d, st = prepared(spark, sf)
    m = ML.fit_model(d.where(F.col("split") == "train"), st.feature_names, "random_forest")
    tr = ML.score(m, d.where(F.col("split") == "train"))
    thr = M.optimal_threshold(tr, "f1").collect()[0]["threshold"]  # one pass: the sweep
    # the hold-out scores feed several passes: score once, reliable checkpoint
    te = ML.score(m, d.where(F.col("split") == "test")).checkpoint(eager=True)
    return M.evaluate_model(te, thr)


@query("kfold_train")
def kfold_train(spark, sf):
    d, st = prepared(spark, sf, folds=True)
    return ML.kfold_train(d, st.feature_names, "random_forest", n_folds=K.N_FOLDS,
                          best_model_path=scratch_path(spark, "kfold-best"))


_SCORED_SIDES = (oracle_cte("subscribers_k", "scored").rstrip() + ",\n" + ranked_cte() + ",\n"
                 f"sp AS (SELECT s.row_id, s.y, s.p, {SPLIT_CASE} AS split, ln(least(greatest(s.p, {dbl(LG.PLATT_EPS)}), {dbl(1 - LG.PLATT_EPS)}) / "
                 f"(1 - least(greatest(s.p, {dbl(LG.PLATT_EPS)}), {dbl(1 - LG.PLATT_EPS)}))) AS z FROM ranked JOIN scored s ON s.row_id = ranked.row_id),\n"
                 "known AS (SELECT z, y FROM sp WHERE split = 'train' AND p IS NOT NULL AND y IS NOT NULL),\n" + LG.newton_line_sql("known") + "\n")


def _scored_sides(spark, sf):
    sides = S.stratified_split(fx.subscribers(spark, sf, keyed=True).select("row_id", K.LABEL)).select("row_id", "split")
    return fx.scored(spark, sf).join(sides, "row_id")


@query("platt_parameters", _SCORED_SIDES + "SELECT a AS slope, b AS intercept FROM line", doubles=["slope", "intercept"])
def platt_parameters(spark, sf):
    """Slope and intercept of the calibration of given scores: a Newton fit
    of two parameters, one aggregate a step."""
    cal = ML.fit_platt(_scored_sides(spark, sf).where(F.col("split") == "train"))
    return spark.createDataFrame([(float(cal.coefficients[0]), float(cal.intercept))], "slope double, intercept double")


@query("platt_scaled", _SCORED_SIDES + "SELECT row_id, y, p, CASE WHEN p IS NOT NULL THEN 1 / (1 + exp(-((SELECT a FROM line) * z + "
       "(SELECT b FROM line)))) END AS p_cal FROM sp WHERE split = 'test'", doubles=["p_cal"])
def platt_scaled(spark, sf):
    """Given scores of the hold-out, calibrated on those of the training side."""
    d = _scored_sides(spark, sf)
    cal = ML.fit_platt(d.where(F.col("split") == "train"))
    return ML.apply_platt(cal, d.where(F.col("split") == "test").select("row_id", "y", "p"))


@query("platt_calibration")
def platt_calibration(spark, sf):
    """Forest scores recalibrated by a line on their log-odds: every training
    row is scored by the forest that did not see its fold, the line is fitted
    on all of these scores, and the hold-out is scored by the forest of all
    training rows.  The six forests grow in the same passes."""
    d, st = prepared(spark, sf)
    oof, models = ML.kfold_scores(train_folds(d).checkpoint(eager=True), st.feature_names, "random_forest", whole=True)
    cal = ML.fit_platt(oof.checkpoint(eager=True))
    return ML.apply_platt(cal, ML.score(models[-1], d.where(F.col("split") == "test")))


@query("hyperparameter_grid")
def hyperparameter_grid(spark, sf):
    """Grid search over the logistic penalty, cross-validated inside the
    training side; one row per grid point with its mean ROC-AUC."""
    d, st = prepared(spark, sf)
    return ML.penalty_grid(train_folds(d).checkpoint(eager=True), st.feature_names, [1e-4, 1e-3, 1e-2])
