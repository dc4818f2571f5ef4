"""Catalog: exact stratified split, stratified folds, capped samples,
example cohorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import split as S
from ..sources import fixtures as fx
from ..sources.fixtures import oracle_cte
from .registry import query
from .sqltext import SPLIT_CASE, fold_case, folds_cte, ranked_cte, scramble_sql

SUBK = oracle_cte("subscribers_k")
RANKED = SUBK.rstrip() + ",\n" + ranked_cte() + "\n"
FOLDED = SUBK.rstrip() + ",\n" + folds_cte() + "\n"


def _subs(spark, sf):
    return fx.subscribers(spark, sf, keyed=True)


@query("stratified_split", RANKED + f"SELECT row_id, churned, {SPLIT_CASE} AS split FROM ranked")
def stratified_split(spark, sf):
    return S.stratified_split(_subs(spark, sf).select("row_id", "churned"))


@query("split_summary", RANKED + (
    f"SELECT split, CAST(count(*) AS BIGINT) AS rows, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS ratio, "
    f"avg(churned) AS churn_rate FROM (SELECT churned, {SPLIT_CASE} AS split FROM ranked) GROUP BY split"),
    doubles=["ratio", "churn_rate"])
def split_summary(spark, sf):
    sp = S.stratified_split(_subs(spark, sf).select("row_id", "churned"))
    return S.split_summary(sp).select("split", F.col("rows").cast("bigint"), "ratio", "churn_rate")


@query("kfold_assign", FOLDED + f"SELECT row_id, churned, {fold_case()} AS fold FROM ranked")
def kfold_assign(spark, sf):
    return S.kfold_assign(_subs(spark, sf).select("row_id", "churned"))


@query("kfold_sizes", FOLDED + (
    "SELECT CAST(fold AS INTEGER) AS fold, CAST(count(*) AS BIGINT) AS rows, avg(churned) AS churn_rate FROM ("
    f"SELECT churned, {fold_case()} AS fold FROM ranked) GROUP BY fold"), doubles=["churn_rate"])
def kfold_sizes(spark, sf):
    f = S.kfold_assign(_subs(spark, sf).select("row_id", "churned"))
    return f.groupBy("fold").agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.avg("churned").alias("churn_rate"))


@query("kfold_within_train", SUBK.rstrip() + ",\n" + ranked_cte(name="sides") + ",\n"
       f"train AS (SELECT row_id, churned FROM (SELECT *, {SPLIT_CASE} AS split FROM sides) WHERE split = 'train'),\n"
       + folds_cte("train") + f"\nSELECT row_id, churned, {fold_case()} AS fold FROM ranked")
def kfold_within_train(spark, sf):
    """Folds inside the training side: what the grid search and the
    calibration are cross-fitted on."""
    sp = S.stratified_split(_subs(spark, sf).select("row_id", "churned"))
    return S.kfold_assign(sp.where(F.col("split") == "train").drop("split"))


@query("stratified_cap_sample", SUBK + (
    f"SELECT row_id, churned FROM subscribers_k QUALIFY row_number() OVER (PARTITION BY churned ORDER BY "
    f"{scramble_sql('row_id', K.SEED + S.CAP_SALT)}, row_id) <= {K.CAP_PER_CLASS}"))
def stratified_cap_sample(spark, sf):
    return S.cap_per_class(_subs(spark, sf).select("row_id", "churned"))


@query("cohort_high_risk", SUBK + "SELECT * FROM subscribers_k WHERE contract_type = 'Month-to-month' AND "
       "payment_method = 'Electronic check' AND churned = 1 ORDER BY row_id LIMIT 1")
def cohort_high_risk(spark, sf):
    return S.cohort_high_risk(_subs(spark, sf))


@query("cohort_low_risk", SUBK + "SELECT * FROM subscribers_k WHERE contract_type IN ('One year', 'Two year') AND "
       "payment_method IN ('Bank transfer (automatic)', 'Credit card (automatic)') AND churned = 0 AND "
       "months_with_provider > 24 ORDER BY row_id LIMIT 1")
def cohort_low_risk(spark, sf):
    return S.cohort_low_risk(_subs(spark, sf))


@query("cohort_medium_risk", SUBK + "SELECT * FROM subscribers_k WHERE contract_type = 'One year' AND "
       "months_with_provider BETWEEN 12 AND 36 ORDER BY row_id LIMIT 1")
def cohort_medium_risk(spark, sf):
    return S.cohort_medium_risk(_subs(spark, sf))


@query("cohort_export")
def cohort_export(spark, sf):
    """Three example cohorts as JSON feature documents (nulls omitted).
    Rows-only check: JSON text formatting differs between engines."""
    return S.cohort_export(_subs(spark, sf))


def fold_metrics_sql(k: int = K.N_FOLDS) -> str:
    return (oracle_cte("subscribers_k", "scored").rstrip() + ",\n" + folds_cte() + ",\n"
               f"fo AS (SELECT row_id, {fold_case(k)} AS fold FROM ranked),\n"
               "g AS (SELECT fold, s.p AS score, CAST(count_if(s.y = 1) AS DOUBLE) AS pos, CAST(count_if(s.y <> 1) AS DOUBLE) AS neg "
               "FROM scored s JOIN fo ON s.row_id = fo.row_id GROUP BY fold, s.p),\n"
               "r AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS tp0, coalesce(sum(neg) OVER w, 0) AS fp0, "
               "sum(pos) OVER (PARTITION BY fold) AS P, sum(neg) OVER (PARTITION BY fold) AS N FROM g "
               "WINDOW w AS (PARTITION BY fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),\n"
               "pf AS (SELECT fold, sum(pos * (N - (fp0 + neg) + 0.5 * neg)) / (max(P) * max(N)) AS roc_auc, "
               "sum(((tp0 + pos) / P - tp0 / P) * ((tp0 + pos) / (tp0 + pos + fp0 + neg) + "
               "CASE WHEN tp0 + fp0 = 0 THEN 1.0 ELSE tp0 / (tp0 + fp0) END) / 2) AS pr_auc, CAST(max(P) + max(N) AS BIGINT) AS n "
               "FROM r GROUP BY fold)\n"
               "SELECT CAST(fold AS VARCHAR) AS fold, roc_auc, pr_auc, n FROM pf UNION ALL "
               "SELECT 'mean', avg(roc_auc), avg(pr_auc), CAST(sum(n) AS BIGINT) FROM pf UNION ALL "
               "SELECT 'std', stddev_pop(roc_auc), stddev_pop(pr_auc), NULL FROM pf")

@query("kfold_metrics", fold_metrics_sql(), doubles=["roc_auc", "pr_auc"])
def kfold_metrics(spark, sf, n_folds: int = K.N_FOLDS):
    """Per-fold ROC/PR-AUC of a scored table with stratified folds, plus
    mean and population std — one grouped ranking pass for all folds."""
    from ..operators import metrics as M
    from ..operators import models as ML
    folds = S.kfold_assign(_subs(spark, sf).select("row_id", "churned"), n_folds=n_folds).select("row_id", "fold")
    sc = fx.scored(spark, sf).join(folds, "row_id")
    per = M.ranking_auc(sc, ("fold",)).select(F.col("fold").cast("string").alias("fold"), "roc_auc", "pr_auc",
                                               F.col("n").cast("bigint").alias("n"))
    return ML.fold_summary(per.withColumn("is_best", F.lit(None).cast("boolean"))).drop("is_best")


@query("stratified_split_by_account")
def stratified_split_by_account(spark, sf):
    """Whole-account split over a table where every account appears twice
    (the reference data repeat accounts); no account straddles the sides.
    Rows-only: the account scramble uses ``xxhash64``."""
    raw = _subs(spark, sf).select("row_id", "account_id", "churned")
    twice = raw.unionByName(raw.withColumn("row_id", -F.col("row_id")))
    return S.stratified_split_by_group(twice, "account_id")
