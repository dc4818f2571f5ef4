"""Model fitting and scoring.

The logistic model and the forest are one Spark ML ``PipelineModel``:
``VectorAssembler`` over the frozen feature list, ``StandardScaler``
(centred), classifier.  Boosted trees are second-order trees grown from
distributed histograms (``histogram_trees``); their thresholds need no
scaling.  Either is saved and loaded as a unit by batch and streaming jobs.
Class weights (balanced: ``n / (2 n_c)``) come from a two-row aggregate
joined back with a broadcast hint, so the fit stays one lazy plan.

Cross-validation fits all folds in the same passes: trees with the model as
one dimension of the histogram, logistic models (and a grid of penalties)
as one block of gradients and Hessians per scan (``logistic``).
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..session import path_exists, work_dir
from . import fitted
from . import histogram_trees as HT
from . import logistic as LG
from .metrics import ranking_auc

WEIGHT = "_w"
MODEL_KINDS = ("logistic", "random_forest", "gbt")
FOREST_ROWS = 1 << 16  # training rows of a task: each task of a pass also sends its own statistics of every node


def class_weights(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """Balanced weights ``n / (2 n_c)`` per class (one row per class)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    total = F.sum("n_class").over(Window.partitionBy(F.lit(0)))
    return c.select(label, F.col("n_class").cast("bigint"),
                    (total / (F.lit(2.0) * F.col("n_class"))).alias("weight"))


def with_weights(df: DataFrame, kind: str, label: str = K.LABEL) -> DataFrame:
    w = class_weights(df, label).select(label, F.col("weight").alias(WEIGHT))
    return df.join(F.broadcast(w), label)  # <= 2 rows


def estimator(kind: str, n_train: int, label: str = K.LABEL, seed: int = K.SEED, **params):
    """The Spark ML classifier by name; unknown names raise ``ValueError``."""
    common = dict(featuresCol="features", labelCol=label, weightCol=WEIGHT)
    if kind == "logistic":
        # sklearn C=1 with balanced weights (sum = n) is regParam = 1 / n
        return LogisticRegression(**common, regParam=params.get("reg", 1.0 / max(n_train, 1)),
                                  elasticNetParam=0.0, standardization=False,
                                  maxIter=params.get("max_iter", 1000), tol=params.get("tol", 1e-4))
    if kind == "random_forest":
        # a row's node in each tree is kept from level to level, not walked to from the root again
        return RandomForestClassifier(**common, numTrees=params.get("trees", 100),
                                      maxDepth=params.get("depth", 10), featureSubsetStrategy="sqrt",
                                      seed=seed, cacheNodeIds=True, checkpointInterval=-1)
    raise ValueError(f"Unknown model type: {kind}")


def spread(rows: DataFrame, cols: list[str]) -> DataFrame:
    """``cols`` of ``rows`` in even parts of at most about ``FOREST_ROWS`` rows, however
    they were dealt before; few rows stay as they are.  Rows are sorted within a part,
    so that a second run draws the same ones."""
    n = rows.count()
    if n <= FOREST_ROWS:
        return rows
    named = [F.col(f"`{c}`") for c in cols]
    return rows.select(*named).repartition(math.ceil(n / FOREST_ROWS)).sortWithinPartitions(*named)


def fit_model(train: DataFrame, feature_names: list[str], kind: str = "random_forest",
              label: str = K.LABEL, key: str = "row_id", **params) -> PipelineModel | fitted.Fitted:
    """Fit one model on ``train``: assemble -> centre/scale -> classifier, or boosted trees."""
    if label not in train.columns:
        raise ValueError(f"Target column '{label}' not found in dataframe")
    if kind == "gbt":
        return HT.fit(train, feature_names, HT.boosted_settings(**params), label, key)[0]
    tw = with_weights(train, kind, label)
    n = tw.count() if kind == "logistic" and "reg" not in params else 0
    kept = None
    if kind == "random_forest":
        dealt = spread(tw, [label, WEIGHT, *feature_names])
        if dealt is not tw:  # the fit reads its rows several times before it keeps its own form of them
            tw = kept = dealt.persist()
    stages = [VectorAssembler(inputCols=feature_names, outputCol="raw_features", handleInvalid="keep"),
              StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
              estimator(kind, n, label, **params)]
    try:
        return Pipeline(stages=stages).fit(tw)
    finally:
        if kept is not None:
            kept.unpersist()


def with_probability(model: PipelineModel | fitted.Fitted, df: DataFrame, name: str) -> DataFrame:
    """``df`` with the probability of class 1 under ``name`` (null where a feature is missing)."""
    if isinstance(model, fitted.Fitted):
        return df.withColumn(name, model.column())
    return model.transform(df).withColumn(name, probability(model))


def score(model: PipelineModel | fitted.Fitted, df: DataFrame, key: str = "row_id", label: str | None = K.LABEL) -> DataFrame:
    """``key, y, p``: probability of class 1 (``y`` only if labelled); null
    where a feature is missing."""
    cols = [F.col(key)]
    if label and label in df.columns:
        cols.append(F.col(label).cast("int").alias("y"))
    return with_probability(model, df, "_p").select(*cols, F.col("_p").alias("p"))


def probability(model: PipelineModel) -> Column:
    """Probability of class 1 in the model's output, null where one of its
    features is null or NaN (batch and stream share this rule)."""
    whole = F.lit(True)
    for c in model.stages[0].getInputCols():
        v = F.col(f"`{c}`")
        whole = whole & v.isNotNull() & ~F.isnan(v.cast("double"))
    return F.when(whole, vector_to_array("probability")[1])


def coefficients(model: PipelineModel, feature_names: list[str]) -> DataFrame:
    """Logistic coefficients (on the scaled features) plus the intercept."""
    lr = model.stages[-1]
    rows = [(n, float(c)) for n, c in zip(feature_names, lr.coefficients.toArray())]
    rows.append(("(intercept)", float(lr.intercept)))
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, coefficient double")


def feature_importance(model: PipelineModel | HT.TreeModel, feature_names: list[str]) -> DataFrame:
    """Tree-ensemble importances, one row per feature with its rank."""
    imp = model.importance() if isinstance(model, HT.TreeModel) else model.stages[-1].featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    ranked = sorted(zip(feature_names, (float(x) for x in imp)), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame([(n, v, i + 1) for i, (n, v) in enumerate(ranked)],
                                 "feature string, importance double, rank int")


def kfold_scores(folded: DataFrame, feature_names: list[str], kind: str = "random_forest", n_folds: int = K.N_FOLDS, label: str = K.LABEL,
                 fold_col: str = "fold", key: str = "row_id", whole: bool = False, **params) -> tuple[DataFrame, list[fitted.Fitted]]:
    """Held-out scores (key, fold, y, p) of every row, by the model fitted on
    the other folds, and the model of each fold; ``whole`` adds a last model
    fitted on all rows.

    All models are fitted in the same passes over one table (one scan a tree
    level or Newton step, not one for each fold)."""
    folds = list(range(1, n_folds + 1)) + [-1] * whole
    if kind == "logistic":
        many = LG.fit_models(folded, feature_names, [params["reg"]] if "reg" in params else None, label, fold_col, folds)
        models: list[fitted.Fitted] = [many.model(k) for k in range(len(folds))]
        p = LG.held_out_column(many, fold_col)[0]
    elif kind in ("gbt", "random_forest"):
        settings = HT.boosted_settings(**params) if kind == "gbt" else HT.forest_settings(len(feature_names), **params)
        models = HT.fit(folded, feature_names, settings, label, key, fold_col, folds)
        p = HT.held_out_column(models, folds, fold_col)
    else:
        raise ValueError(f"Unknown model type: {kind}")
    out = folded.select(F.col(key), F.col(fold_col).alias("fold"), F.col(label).cast("int").alias("y"), p.alias("p"))
    return out.withColumn("p", F.when(~F.isnan("p"), F.col("p"))), models


def fold_summary(per: DataFrame) -> DataFrame:
    """``fold, roc_auc, pr_auc, n, is_best`` rows with a ``mean`` and a population ``std`` row."""
    summ = per.agg(F.avg("roc_auc").alias("a"), F.stddev_pop("roc_auc").alias("b"),
                   F.avg("pr_auc").alias("c"), F.stddev_pop("pr_auc").alias("d"), F.sum("n").alias("n"))
    mean = summ.select(F.lit("mean").alias("fold"), F.col("a").alias("roc_auc"), F.col("c").alias("pr_auc"),
                       F.col("n").cast("bigint").alias("n"), F.lit(None).cast("boolean").alias("is_best"))
    std = summ.select(F.lit("std").alias("fold"), F.col("b").alias("roc_auc"), F.col("d").alias("pr_auc"),
                      F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("boolean").alias("is_best"))
    return per.unionByName(mean).unionByName(std)


def kfold_train(folded: DataFrame, feature_names: list[str], kind: str = "logistic",
                n_folds: int = K.N_FOLDS, label: str = K.LABEL, fold_col: str = "fold",
                best_model_path: str | None = None, key: str = "row_id", **params) -> DataFrame:
    """Per fold: ROC/PR-AUC and size of the rows scored by the model fitted on
    the other folds; ``is_best`` marks the first fold with the highest
    ROC-AUC, whose model is saved to ``best_model_path`` when given.  Plus
    ``mean`` and population ``std`` rows.  All folds are fitted and measured
    together: one set of passes, one grouped ranking."""
    scores, models = kfold_scores(folded, feature_names, kind, n_folds, label, fold_col, key, **params)
    work_dir(folded.sparkSession)
    scores = scores.checkpoint(eager=True)
    auc = {r["fold"]: r for r in ranking_auc(scores, ("fold",)).collect()}  # one row a fold
    rows, best = [], None
    for k in range(1, n_folds + 1):
        r = auc.get(k)
        a = r["roc_auc"] if r else None
        if a is not None and (best is None or a > auc[best]["roc_auc"]):
            best = k
        rows.append((str(k), a, r["pr_auc"] if r else None, int(r["n"]) if r else 0))
    if best_model_path and best is not None:
        models[best - 1].write().overwrite().save(best_model_path)
    per = folded.sparkSession.createDataFrame([(*r, r[0] == str(best)) for r in rows],
                                              "fold string, roc_auc double, pr_auc double, n bigint, is_best boolean")
    return fold_summary(per)


def penalty_grid(folded: DataFrame, feature_names: list[str], regs: list[float], n_folds: int = K.N_FOLDS, label: str = K.LABEL,
                 fold_col: str = "fold") -> DataFrame:
    """Per penalty: the mean over the folds of the held-out ROC-AUC (exact: no score binning).

    One set of Newton passes fits every (fold, penalty); one pass scores all."""
    many = LG.fit_models(folded, feature_names, regs, label, fold_col, list(range(1, n_folds + 1)))
    p = LG.held_out_column(many, fold_col)
    s = folded.select(F.col(fold_col).alias("fold"), F.col(label).cast("int").alias("y"), F.posexplode(p).alias("at", "p")).where(~F.isnan("p"))
    penalty = F.array(*[F.lit(float(r)) for r in regs])[F.col("at")].alias("reg_param")
    return ranking_auc(s, ("at", "fold")).groupBy("at").agg(F.avg("roc_auc").alias("mean_roc_auc")).select(penalty, "mean_roc_auc")


def fit_platt(scored: DataFrame, y: str = "y", p: str = "p") -> LG.LinearModel:
    """Logistic fit of ``y`` on the logit of ``p`` over rows the scoring
    models have not learned from (a held-out side, or the held-out scores of
    all folds); save and load it as any model."""
    known = scored.where(F.col(p).isNotNull() & F.col(y).isNotNull())
    a, b = LG.newton_line(known.select(LG.logit(F.col(p)).alias("z"), F.col(y).cast("double").alias("y")), "z", "y")
    return LG.LinearModel(["_logit"], [a], b)


def apply_platt(calibrator: LG.LinearModel, scored: DataFrame, p: str = "p") -> DataFrame:
    """Add the calibrated ``p_cal`` (null where ``p`` is)."""
    return scored.withColumn("_logit", LG.logit(F.col(p))).select(*scored.columns, calibrator.column().alias("p_cal"))


def load_model(path: str) -> PipelineModel | fitted.Fitted:
    spark = SparkSession.getActiveSession()
    return fitted.load(spark, path) if path_exists(spark, f"{path}/fitted") else PipelineModel.load(path)


def standard_scale(df: DataFrame, cols: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Centre and scale by the population std (a constant column becomes
    0).  Fit: one aggregate of 2 x len(cols) numbers (a scalar state, like
    every fitted value here); transform: one projection with literals."""
    st = df.agg(*[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(cols)],
                *[F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(cols)]).collect()[0]
    out = []
    for i, c in enumerate(cols):
        m, s = st[f"m{i}"], st[f"s{i}"]
        x = F.col(f"`{c}`")
        if s is None or s == 0:
            zero = F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
            out.append((zero if s == 0 else F.lit(None).cast("double")).alias(c))
        else:
            out.append(((x - F.lit(m)) / F.lit(s)).alias(c))
    return df.select(*[F.col(f"`{k}`") for k in keep], *out)
