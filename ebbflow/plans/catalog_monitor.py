"""Catalog: drift, retrain trigger, smoothed target encoding, fuzzy
category repair (documented in the reference, built here as jobs).

Baseline vs current = the train vs test side of the exact stratified
split, so both periods come from the whole table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import monitor as MO
from ..operators import profile as P
from ..operators import split as S
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import versions as V
from ..sources.fixtures import oracle_cte
from .registry import query
from .sqltext import SPLIT_CASE, dbl, fold_case, folds_cte, prep_cte, q, ranked_cte

PSI_COLS = ["monthly_fee", "months_with_provider"]


def _split_raw(spark, sf):
    return S.stratified_split(fx.subscribers(spark, sf, keyed=True))


def _psi_sql(src: str) -> str:
    b = MO.PSI_BINS
    longs = "\nUNION ALL ".join(
        f"SELECT split AS side, {q(c)} AS column_name, CAST({c} AS DOUBLE) AS value FROM {src} WHERE {c} IS NOT NULL"
        for c in PSI_COLS)
    return (f"long AS ({longs}),\n"
            "rng AS (SELECT column_name, min(value) AS lo, max(value) AS hi FROM long WHERE side = 'train' GROUP BY column_name),\n"
            f"binned AS (SELECT l.column_name, side, CASE WHEN hi = lo THEN 0 ELSE least(greatest(CAST(floor((value - lo) / "
            f"((hi - lo) / {b})) AS INTEGER), 0), {b - 1}) END AS bin FROM long l JOIN rng r ON l.column_name = r.column_name),\n"
            "cnt AS (SELECT column_name, bin, count_if(side = 'train') AS nb, count_if(side = 'test') AS nc FROM binned GROUP BY column_name, bin),\n"
            "sh AS (SELECT column_name, greatest(nb / sum(nb) OVER (PARTITION BY column_name), "
            f"{dbl(MO.PSI_EPS)}) AS pb, greatest(nc / sum(nc) OVER (PARTITION BY column_name), {dbl(MO.PSI_EPS)}) AS pc FROM cnt),\n"
            f"drift AS (SELECT column_name, sum((pc - pb) * ln(pc / pb)) AS psi FROM sh GROUP BY column_name)")


_SPLIT_SRC = (oracle_cte("subscribers_k").rstrip() + ",\n" + ranked_cte() + ",\n"
              f"sp AS (SELECT *, {SPLIT_CASE} AS split FROM ranked),\n")


@query("drift_psi", _SPLIT_SRC + _psi_sql("sp") + f"\nSELECT column_name, psi, psi > {dbl(MO.PSI_ALERT)} AS alert FROM drift",
       doubles=["psi"])
def drift_psi(spark, sf):
    sp = _split_raw(spark, sf)
    return MO.psi(sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test"), PSI_COLS)


_AUC_BY_SIDE = (
    "g AS (SELECT split AS side, p AS score, CAST(count_if(y = 1) AS DOUBLE) AS pos, CAST(count_if(y <> 1) AS DOUBLE) AS neg "
    "FROM scored_sp GROUP BY split, p),\n"
    "r AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS tp0, coalesce(sum(neg) OVER w, 0) AS fp0, "
    "sum(pos) OVER (PARTITION BY side) AS P, sum(neg) OVER (PARTITION BY side) AS N FROM g "
    "WINDOW w AS (PARTITION BY side ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),\n"
    "auc AS (SELECT side, sum(pos * (N - (fp0 + neg) + 0.5 * neg)) / (max(P) * max(N)) AS roc_auc FROM r GROUP BY side),\n"
    "rate AS (SELECT split AS side, avg(y) AS churn_rate FROM scored_sp GROUP BY split)")


@query("retrain_trigger", oracle_cte("subscribers_k", "scored").rstrip() + ",\n" + ranked_cte() + ",\n"
       f"sp AS (SELECT *, {SPLIT_CASE} AS split FROM ranked),\n"
       "scored_sp AS (SELECT s.row_id, s.y, s.p, sp.split FROM scored s JOIN sp ON s.row_id = sp.row_id),\n"
       + _psi_sql("sp") + ",\n" + _AUC_BY_SIDE + "\n"
       "SELECT ab AS auc_baseline, ac AS auc_current, ab - ac AS auc_drop, mp AS max_psi, rb AS churn_rate_baseline, "
       f"rc AS churn_rate_current, rc - rb AS churn_drift, coalesce(ab - ac > {dbl(MO.AUC_DROP_ALERT)}, false) AS auc_fired, "
       f"coalesce(mp > {dbl(MO.PSI_ALERT)}, false) AS psi_fired, coalesce(abs(rc - rb) > {dbl(MO.CHURN_DRIFT_ALERT)}, false) "
       "AS churn_fired, auc_fired OR psi_fired OR churn_fired AS retrain FROM (SELECT "
       "(SELECT roc_auc FROM auc WHERE side = 'train') AS ab, (SELECT roc_auc FROM auc WHERE side = 'test') AS ac, "
       "(SELECT max(psi) FROM drift) AS mp, (SELECT churn_rate FROM rate WHERE side = 'train') AS rb, "
       "(SELECT churn_rate FROM rate WHERE side = 'test') AS rc)",
       doubles=["auc_baseline", "auc_current", "auc_drop", "max_psi", "churn_rate_baseline", "churn_rate_current",
                "churn_drift"])
def retrain_trigger(spark, sf):
    sp = _split_raw(spark, sf)
    sc = fx.scored(spark, sf).join(sp.select("row_id", "split"), "row_id")
    tr, te = sc.where(F.col("split") == "train"), sc.where(F.col("split") == "test")
    drift = MO.psi(sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test"), PSI_COLS)
    return MO.retrain_trigger(M.roc_auc(tr), M.roc_auc(te), drift,
                              P.churn_summary(tr, "y"), P.churn_summary(te, "y"))


# trainings as they were recorded; only what lies before the day of the decision is known then
TRAININGS = ["2024-01-15", "2024-05-20", "2024-11-02"]
AS_OF = dt.date(2024, 8, 25)
_DECISION_INPUTS = (
    oracle_cte("subscribers_k", "scored").rstrip() + ",\n" + ranked_cte() + ",\n"
    f"sp AS (SELECT *, {SPLIT_CASE} AS split FROM ranked),\n"
    "scored_sp AS (SELECT s.row_id, s.y, s.p, sp.split FROM scored s JOIN sp ON s.row_id = sp.row_id),\n"
    + _psi_sql("sp") + ",\n" + _AUC_BY_SIDE + ",\n"
    f"trained AS (SELECT max(d) AS last_trained FROM (VALUES {', '.join(f'(DATE {q(d)})' for d in TRAININGS)}) t(d) WHERE d <= DATE {q(str(AS_OF))})\n")


@query("retrain_quarterly", _DECISION_INPUTS +
       "SELECT ab AS auc_baseline, ac AS auc_current, ab - ac AS auc_drop, mp AS max_psi, rb AS churn_rate_baseline, "
       f"rc AS churn_rate_current, rc - rb AS churn_drift, DATE {q(str(AS_OF))} AS as_of, last_trained, "
       f"CAST(last_trained + INTERVAL {MO.RETRAIN_MONTHS} MONTH AS DATE) AS due, coalesce(ab - ac > {dbl(MO.AUC_DROP_ALERT)}, false) AS auc_fired, "
       f"coalesce(mp > {dbl(MO.PSI_ALERT)}, false) AS psi_fired, coalesce(abs(rc - rb) > {dbl(MO.CHURN_DRIFT_ALERT)}, false) "
       f"AS churn_fired, coalesce(DATE {q(str(AS_OF))} >= CAST(last_trained + INTERVAL {MO.RETRAIN_MONTHS} MONTH AS DATE), false) AS date_fired, "
       "auc_fired OR psi_fired OR churn_fired OR date_fired AS retrain FROM (SELECT "
       "(SELECT roc_auc FROM auc WHERE side = 'train') AS ab, (SELECT roc_auc FROM auc WHERE side = 'test') AS ac, "
       "(SELECT max(psi) FROM drift) AS mp, (SELECT churn_rate FROM rate WHERE side = 'train') AS rb, "
       "(SELECT churn_rate FROM rate WHERE side = 'test') AS rc, (SELECT last_trained FROM trained) AS last_trained)",
       doubles=["auc_baseline", "auc_current", "auc_drop", "max_psi", "churn_rate_baseline", "churn_rate_current",
                "churn_drift"])
def retrain_quarterly(spark, sf):
    """The decision with its date rule: the last training known on a day is
    read from the version records, and is due again three months later."""
    root = scratch_path(spark, "store")
    for d in TRAININGS:
        V.record_version(spark, root, "models", f"m_{d}", f"{root}/models/m_{d}", created_at=dt.datetime.fromisoformat(d))
    sp = _split_raw(spark, sf).select("row_id", "split", *PSI_COLS)
    both = fx.scored(spark, sf).join(sp, "row_id").withColumn("side", F.when(F.col("split") == "train", "baseline").otherwise("current"))
    return MO.retrain_decision(both, PSI_COLS, V.last_created(spark, root, "models", AS_OF), AS_OF)


TE_COLS = ["payment_method", "internet_plan"]


_TE_SRC = (prep_cte("imputed").rstrip() + ",\n" + ranked_cte("imputed") + ",\n"
           f"tr AS (SELECT * FROM ranked WHERE NOT ({SPLIT_CASE} = 'test')),\n"
           "long AS (" + "\nUNION ALL ".join(
               f"SELECT {q(c)} AS column_name, {c} AS value, churned AS y FROM tr WHERE {c} IS NOT NULL" for c in TE_COLS)
           + ")")
_TE_VALUE = f"(sum(y) + {MO.TE_SMOOTHING} * (SELECT avg(churned) FROM tr)) / (count(*) + {MO.TE_SMOOTHING})"


@query("target_encode_smoothed", _TE_SRC + "\n"
       "SELECT column_name, value, CAST(count(*) AS BIGINT) AS n, sum(y) / count(*) AS churn_rate, "
       f"{_TE_VALUE} AS encoding "
       "FROM long GROUP BY column_name, value", doubles=["churn_rate", "encoding"])
def target_encode_smoothed(spark, sf):
    """Fitted on the training side only (no leak into the hold-out)."""
    d = FE.impute_all(FE.clean_all(fx.subscribers(spark, sf, keyed=True)))
    tr = S.stratified_split(d).where(F.col("split") == "train")
    return MO.fit_target_encoding(tr, TE_COLS).drop("prior")


@query("target_encode_apply", _TE_SRC + f",\nenc AS (SELECT column_name, value, {_TE_VALUE} AS e FROM long GROUP BY ALL)\n"
       "SELECT r.row_id, " + ", ".join(f"coalesce(e{i}.e, (SELECT avg(churned) FROM tr)) AS {c}_te" for i, c in enumerate(TE_COLS))
       + " FROM ranked r " + " ".join(f"LEFT JOIN enc e{i} ON e{i}.column_name = {q(c)} AND e{i}.value = r.{c}"
                                      for i, c in enumerate(TE_COLS)), doubles=[f"{c}_te" for c in TE_COLS])
def target_encode_apply(spark, sf):
    """The encoding of the training side kept as a table, read back and
    applied to every row."""
    d = S.stratified_split(FE.impute_all(FE.clean_all(fx.subscribers(spark, sf, keyed=True))))
    path = scratch_path(spark, "target-encoding")
    MO.fit_target_encoding(d.where(F.col("split") == "train"), TE_COLS).write.parquet(path)
    enc = spark.read.parquet(path)
    return MO.apply_target_encoding(d, enc, TE_COLS).select("row_id", *[f"{c}_te" for c in TE_COLS])


_TE_FOLDS = (prep_cte("imputed").rstrip() + ",\n" + ranked_cte("imputed", name="sides") + ",\n"
             f"sp AS (SELECT *, {SPLIT_CASE} AS split FROM sides),\n"
             f"train AS (SELECT row_id, churned, {', '.join(TE_COLS)} FROM sp WHERE split = 'train'),\n" + folds_cte("train") + ",\n"
             f"tr AS (SELECT row_id, churned, {', '.join(TE_COLS)}, {fold_case()} AS fold FROM ranked),\n"
             "long AS (" + "\nUNION ALL ".join(f"SELECT {q(c)} AS column_name, {c} AS value, fold, churned AS y FROM tr WHERE {c} IS NOT NULL"
                                               for c in TE_COLS) + "),\n"
             "vf AS (SELECT column_name, value, fold, CAST(sum(y) AS DOUBLE) AS s, count(*) AS n FROM long GROUP BY ALL),\n"
             "tot AS (SELECT column_name, value, sum(s) AS s, sum(n) AS n FROM vf GROUP BY ALL),\n"
             "pf AS (SELECT fold, CAST(sum(churned) AS DOUBLE) AS s, count(*) AS n FROM tr GROUP BY fold),\n"
             "prior AS (SELECT fold, (sum(s) OVER () - s) / (sum(n) OVER () - n) AS pr FROM pf UNION ALL SELECT NULL, sum(s) / sum(n) FROM pf)\n")


def _te_code(c: str, i: int) -> str:
    m = MO.TE_SMOOTHING
    return (f"coalesce((t{i}.s - coalesce(o{i}.s, 0) + {m} * pr) / (t{i}.n - coalesce(o{i}.n, 0) + {m}), pr) AS {c}_te")


@query("target_encode_out_of_fold", _TE_FOLDS + "SELECT r.row_id, r.split, tr.fold, " + ", ".join(_te_code(c, i) for i, c in enumerate(TE_COLS))
       + " FROM sp r LEFT JOIN tr ON tr.row_id = r.row_id JOIN prior p ON p.fold IS NOT DISTINCT FROM tr.fold "
       + " ".join(f"LEFT JOIN tot t{i} ON t{i}.column_name = {q(c)} AND t{i}.value = r.{c} LEFT JOIN vf o{i} ON o{i}.column_name = {q(c)} "
                  f"AND o{i}.value = r.{c} AND o{i}.fold = tr.fold" for i, c in enumerate(TE_COLS)), doubles=[f"{c}_te" for c in TE_COLS])
def target_encode_out_of_fold(spark, sf):
    """Training rows coded by the other folds' labels, the hold-out by those
    of the whole training side; the fitted table is kept and read back."""
    d = S.stratified_split(FE.impute_all(FE.clean_all(fx.subscribers(spark, sf, keyed=True)))).select("row_id", K.LABEL, "split", *TE_COLS)
    tr = S.kfold_assign(d.where(F.col("split") == "train"))
    path = scratch_path(spark, "target-encoding-folds")
    MO.fit_target_encoding_folds(tr, TE_COLS).write.parquet(path)
    rows = tr.unionByName(d.where(F.col("split") == "test").withColumn("fold", F.lit(None).cast("int")))
    out = MO.apply_target_encoding_folds(rows, spark.read.parquet(path), TE_COLS, tr)
    return out.select("row_id", "split", "fold", *[f"{c}_te" for c in TE_COLS])


CANON_PLANS = ["DSL", "Fiber optic", "No"]


def _fuzzy_sql() -> str:
    ds = [f"levenshtein(internet_plan, {q(v)})" for v in CANON_PLANS]
    lst = f"least({', '.join(ds)})"
    whens = " ".join(f"WHEN {d} = {lst} THEN {q(v)}" for d, v in zip(ds, CANON_PLANS))
    return (oracle_cte("subscribers_k") + "SELECT row_id, internet_plan AS internet_plan_raw, CASE WHEN internet_plan IS NULL "
            f"THEN NULL WHEN {lst} > {MO.FUZZY_MAX_DISTANCE} THEN internet_plan {whens} END AS internet_plan FROM subscribers_k")


@query("fuzzy_category_map", _fuzzy_sql())
def fuzzy_category_map(spark, sf):
    d = fx.subscribers(spark, sf, keyed=True)
    return d.select("row_id", F.col("internet_plan").alias("internet_plan_raw"),
                    MO.fuzzy_repair(F.col("internet_plan"), CANON_PLANS).alias("internet_plan"))
