"""Catalog: classification metrics over the deterministic ``scored`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import num
from ..operators import metrics as M
from ..sources import fixtures as fx
from ..sources.fixtures import oracle_cte
from .registry import query
from .sqltext import dbl, q

SC = oracle_cte("scored")
THR = K.THRESHOLD_DEFAULT


def _scored(spark, sf):
    return fx.scored(spark, sf)


def _div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / CAST(({b}) AS DOUBLE) END"


def _cm(thr: float) -> str:
    return (f"cm AS (SELECT CAST(count_if(y <> 1 AND p < {dbl(thr)}) AS BIGINT) AS tn, "
            f"CAST(count_if(y <> 1 AND p >= {dbl(thr)}) AS BIGINT) AS fp, "
            f"CAST(count_if(y = 1 AND p < {dbl(thr)}) AS BIGINT) AS fn, "
            f"CAST(count_if(y = 1 AND p >= {dbl(thr)}) AS BIGINT) AS tp, "
            "CAST(count_if(p IS NULL OR y IS NULL) AS BIGINT) AS n_unscored FROM scored)")


_CM = _cm(THR)
_PRF = (f"{_div('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {_div('tp', 'tp + fp')} AS precision, "
        f"{_div('tp', 'tp + fn')} AS recall, {_div('2 * tp', '2 * tp + fp + fn')} AS f1_score")
# distinct scores, descending, with running counts strictly above
_RUN = ("g AS (SELECT p AS score, CAST(count_if(y = 1) AS DOUBLE) AS pos, CAST(count_if(y <> 1) AS DOUBLE) AS neg "
        "FROM scored GROUP BY p),\n"
        "r AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS tp0, coalesce(sum(neg) OVER w, 0) AS fp0, "
        "sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g "
        "WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))")
_AUC = ("auc AS (SELECT sum(pos * (N - (fp0 + neg) + 0.5 * neg)) / (max(P) * max(N)) AS roc_auc, "
        "sum(((tp0 + pos) / P - tp0 / P) * ((tp0 + pos) / (tp0 + pos + fp0 + neg) + "
        "CASE WHEN tp0 + fp0 = 0 THEN 1.0 ELSE tp0 / (tp0 + fp0) END) / 2) AS pr_auc FROM r)")


def _with(*ctes: str) -> str:
    return SC.rstrip() + ",\n" + ",\n".join(ctes) + "\n"


@query("metric_confusion", _with(_CM) + "SELECT tn, fp, fn, tp, n_unscored FROM cm")
def metric_confusion(spark, sf):
    return M.confusion(_scored(spark, sf), THR)


@query("metric_accuracy_prf", _with(_CM) + f"SELECT {_PRF} FROM cm",
       doubles=["accuracy", "precision", "recall", "f1_score"])
def metric_accuracy_prf(spark, sf):
    return M.accuracy_prf(_scored(spark, sf), THR)


@query("metric_brier", SC + "SELECT avg((p - y) * (p - y)) AS brier_score FROM scored", doubles=["brier_score"])
def metric_brier(spark, sf):
    return M.brier(_scored(spark, sf))


@query("metric_roc_auc", _with(_RUN, _AUC) + "SELECT roc_auc FROM auc", doubles=["roc_auc"])
def metric_roc_auc(spark, sf):
    return M.roc_auc(_scored(spark, sf))


@query("metric_pr_auc", _with(_RUN, _AUC) + "SELECT pr_auc FROM auc", doubles=["pr_auc"])
def metric_pr_auc(spark, sf):
    return M.pr_auc(_scored(spark, sf))


_REPORT = _with(_CM) + (
    f"SELECT '0' AS label, {_div('tn', 'tn + fn')} AS precision, {_div('tn', 'tn + fp')} AS recall, "
    f"{_div('2 * tn', '2 * tn + fn + fp')} AS f1_score, tn + fp AS support FROM cm UNION ALL "
    f"SELECT '1', {_div('tp', 'tp + fp')}, {_div('tp', 'tp + fn')}, {_div('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM cm UNION ALL "
    f"SELECT 'accuracy', NULL, NULL, {_div('tp + tn', 'tp + tn + fp + fn')}, tp + tn + fp + fn FROM cm UNION ALL "
    f"SELECT 'macro avg', ({_div('tn', 'tn + fn')} + {_div('tp', 'tp + fp')}) / 2, "
    f"({_div('tn', 'tn + fp')} + {_div('tp', 'tp + fn')}) / 2, "
    f"({_div('2 * tn', '2 * tn + fn + fp')} + {_div('2 * tp', '2 * tp + fp + fn')}) / 2, tp + tn + fp + fn FROM cm UNION ALL "
    f"SELECT 'weighted avg', {_div(f'({_div('tn', 'tn + fn')}) * (tn + fp) + ({_div('tp', 'tp + fp')}) * (tp + fn)', 'tp + tn + fp + fn')}, "
    f"{_div(f'({_div('tn', 'tn + fp')}) * (tn + fp) + ({_div('tp', 'tp + fn')}) * (tp + fn)', 'tp + tn + fp + fn')}, "
    f"{_div(f'({_div('2 * tn', '2 * tn + fn + fp')}) * (tn + fp) + ({_div('2 * tp', '2 * tp + fp + fn')}) * (tp + fn)', 'tp + tn + fp + fn')}, "
    "tp + tn + fp + fn FROM cm")


@query("metric_classification_report", _REPORT, doubles=["precision", "recall", "f1_score"])
def metric_classification_report(spark, sf):
    return M.classification_report(_scored(spark, sf), THR)


def evaluate_sql(thr: float) -> str:
    return _with(_cm(thr), _RUN, _AUC) + (
        f"SELECT roc_auc, {_PRF}, (SELECT avg((p - y) * (p - y)) FROM scored) AS brier_score, {dbl(thr)} AS threshold, "
        "pr_auc, tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives FROM cm, auc")


@query("evaluate_model", evaluate_sql(THR),
       doubles=["roc_auc", "accuracy", "precision", "recall", "f1_score", "brier_score", "pr_auc"])
def evaluate_model(spark, sf):
    return M.evaluate_model(_scored(spark, sf), THR)


_SWEEP = ("sw AS (" + "\nUNION ALL ".join(
    f"SELECT {dbl(t)} AS threshold, count_if(y = 1 AND p >= {dbl(t)}) AS tp, count_if(y <> 1 AND p >= {dbl(t)}) AS fp, "
    f"count_if(y = 1 AND p < {dbl(t)}) AS fn, count_if(y <> 1 AND p < {dbl(t)}) AS tn FROM scored"
    for t in K.threshold_grid()) + "),\n"
          f"sweep AS (SELECT threshold, {_div('tp', 'tp + fp')} AS precision, {_div('tp', 'tp + fn')} AS recall, "
          f"{_div('2 * tp', '2 * tp + fp + fn')} AS f1_score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, "
          "CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn FROM sw)")


@query("threshold_sweep", _with(_SWEEP) + "SELECT * FROM sweep", doubles=["precision", "recall", "f1_score"])
def threshold_sweep(spark, sf):
    return M.threshold_sweep(_scored(spark, sf))


def _optimal_sql(metric: str, col: str, floor: float | None = None) -> str:
    cond = f"{col} > 0" + (f" AND precision >= {dbl(floor)}" if floor is not None else "")
    return _with(_SWEEP) + (
        f"SELECT {q(metric)} AS target_metric, coalesce((SELECT threshold FROM sweep WHERE {cond} "
        f"ORDER BY {col} DESC, threshold ASC LIMIT 1), {dbl(K.THRESHOLD_DEFAULT)}) AS threshold, "
        f"coalesce((SELECT max({col}) FROM sweep WHERE {cond}), 0.0) AS score")


@query("optimal_threshold", _optimal_sql("f1", "f1_score"), doubles=["score"])
def optimal_threshold(spark, sf):
    return M.optimal_threshold(_scored(spark, sf), "f1")


@query("optimal_threshold_recall", _optimal_sql("recall", "recall"), doubles=["score"])
def optimal_threshold_recall(spark, sf):
    return M.optimal_threshold(_scored(spark, sf), "recall")


@query("threshold_min_precision", _optimal_sql("f1", "f1_score", 0.8), doubles=["score"])
def threshold_min_precision(spark, sf):
    """Stretch: best F1 subject to precision >= 0.80."""
    return M.optimal_threshold(_scored(spark, sf), "f1", min_precision=0.8)


def _segment_case() -> str:
    parts = []
    for name, _, lo, hi in K.CONFIDENCE_SEGMENTS:
        cond = " AND ".join(x for x in [f"p >= {dbl(lo)}" if lo is not None else "",
                                        f"p < {dbl(hi)}" if hi is not None else ""] if x)
        parts.append(f"WHEN {cond} THEN {q(name)}")
    return "CASE " + " ".join(parts) + " END"


@query("confidence_segments", SC + (
    "SELECT n.position, n.segment, n.range, CAST(s.count AS BIGINT) AS count, s.actual_churn_rate, s.predicted_churn_rate "
    "FROM (VALUES " + ", ".join(f"({i}, {q(nm)}, {q(rg)})" for i, (nm, rg, _, _) in enumerate(K.CONFIDENCE_SEGMENTS))
    + ") n(position, segment, range) LEFT JOIN (SELECT " + _segment_case() + " AS segment, count(*) AS count, "
    "avg(y) AS actual_churn_rate, avg(p) AS predicted_churn_rate FROM scored GROUP BY 1) s ON n.segment = s.segment"),
    doubles=["actual_churn_rate", "predicted_churn_rate"])
def confidence_segments(spark, sf):
    return M.confidence_segments(_scored(spark, sf))


@query("roc_curve_points", _with(_RUN) + (
    "SELECT 0.0 AS fpr, 0.0 AS tpr, CAST(NULL AS DOUBLE) AS threshold UNION ALL "
    "SELECT fpr, tpr, threshold FROM (SELECT (fp0 + neg) / N AS fpr, (tp0 + pos) / P AS tpr, score AS threshold, "
    "row_number() OVER (ORDER BY score DESC) AS k, count(*) OVER () AS m, "
    "lead(pos) OVER (ORDER BY score DESC) AS pos_next, lead(neg) OVER (ORDER BY score DESC) AS neg_next, pos, neg FROM r) t "
    "WHERE k = 1 OR k = m OR m <= 2 OR pos_next <> pos OR neg_next <> neg"), doubles=["fpr", "tpr", "threshold"])
def roc_curve_points(spark, sf):
    return M.roc_curve_points(_scored(spark, sf))


@query("pr_curve_points", _with(_RUN) + (
    "SELECT (tp0 + pos) / (tp0 + pos + fp0 + neg) AS precision, (tp0 + pos) / P AS recall, score AS threshold FROM r "
    "UNION ALL SELECT 1.0, 0.0, NULL"), doubles=["precision", "recall", "threshold"])
def pr_curve_points(spark, sf):
    return M.pr_curve_points(_scored(spark, sf))


def _score_hist_sql() -> str:
    b = K.HISTOGRAM_BINS
    return _with(
        "rng0 AS (SELECT y, min(p) AS lo, max(p) AS hi FROM scored GROUP BY y)",
        "rng AS (SELECT y, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM rng0)",
        f"a AS (SELECT s.y, p AS value, lo, hi, (hi - lo) / {b} AS step, least(CAST(floor((p - lo) * ({b} / (hi - lo))) AS INTEGER), {b - 1}) AS i0 "
        "FROM scored s JOIN rng r ON s.y = r.y)",
        "b AS (SELECT *, CASE WHEN value < i0 * step + lo THEN i0 - 1 ELSE i0 END AS i1 FROM a)",
        f"c AS (SELECT *, CASE WHEN value >= (i1 + 1) * step + lo AND i1 <> {b - 1} THEN i1 + 1 ELSE i1 END AS i2 FROM b)") + (
        f"SELECT y, i2 AS bin, i2 * step + lo AS bin_lo, CASE WHEN i2 = {b - 1} THEN hi ELSE (i2 + 1) * step + lo END AS bin_hi, "
        "CAST(count(*) AS BIGINT) AS count FROM c GROUP BY y, i2, lo, hi, step")


@query("score_histogram", _score_hist_sql(), doubles=["bin_lo", "bin_hi"])
def score_histogram(spark, sf):
    return M.score_histogram(_scored(spark, sf))


@query("confusion_shares", _with(_CM) + (
    "SELECT " + ", ".join(f"{_div(c, 'tn + fp + fn + tp')} AS {c}_share" for c in ("tn", "fp", "fn", "tp"))
    + f", {_div('tp', 'tp + fn')} AS captured_churn_rate FROM cm"),
    doubles=["tn_share", "fp_share", "fn_share", "tp_share", "captured_churn_rate"])
def confusion_shares(spark, sf):
    return M.confusion_shares(_scored(spark, sf), THR)


_G = K.QUALITY_GATES


@query("quality_gates", _with(_RUN, _AUC) + (
    "SELECT roc_auc, pr_auc, brier_score, coalesce(roc_auc > {a}, false) AS roc_auc_pass, "
    "coalesce(pr_auc > {b}, false) AS pr_auc_pass, coalesce(brier_score < {c}, false) AS brier_pass "
    "FROM auc, (SELECT avg((p - y) * (p - y)) AS brier_score FROM scored)").format(
        a=dbl(_G["roc_auc_min"]), b=dbl(_G["pr_auc_min"]), c=dbl(_G["brier_max"])),
    doubles=["roc_auc", "pr_auc", "brier_score"])
def quality_gates(spark, sf):
    return M.quality_gates(_scored(spark, sf))


@query("predict_threshold", SC + f"SELECT row_id, p AS probability, CAST(p >= {dbl(THR)} AS INTEGER) AS prediction FROM scored")
def predict_threshold(spark, sf):
    return M.predict_threshold(_scored(spark, sf), THR)


@query("prediction_match_rate", SC + (
    f"SELECT CAST(count(p + y) AS BIGINT) AS n, CAST(count_if(p IS NULL OR y IS NULL) AS BIGINT) AS n_unscored, CAST(count_if(CAST(p >= {dbl(THR)} AS INTEGER) = y) AS BIGINT) AS n_match, "
    f"avg(CAST(CAST(p >= {dbl(THR)} AS INTEGER) = y AS DOUBLE)) AS match_rate FROM scored"), doubles=["match_rate"])
def prediction_match_rate(spark, sf):
    return M.prediction_match_rate(_scored(spark, sf), THR)


# contract types, senior flag and first-year customers (who belong to no segment of the latter otherwise)
FIRST_YEAR = 12
_SEG_SRC = oracle_cte("scored", "subscribers_k").rstrip() + (
    ",\nj AS (SELECT s.y, s.p, k.* FROM scored s JOIN subscribers_k k ON s.row_id = k.row_id),\n"
    "seg AS (SELECT 'contract_type' AS dimension, contract_type AS segment, y, p FROM j WHERE contract_type IS NOT NULL "
    "UNION ALL SELECT 'seniorcitizen', CAST(seniorcitizen AS VARCHAR), y, p FROM j WHERE seniorcitizen IS NOT NULL "
    f"UNION ALL SELECT 'tenure', '0-{FIRST_YEAR}', y, p FROM j WHERE months_with_provider BETWEEN 0 AND {FIRST_YEAR}),\n")


@query("segment_auc", _SEG_SRC + (
    "g AS (SELECT dimension, segment, p AS score, CAST(count_if(y = 1) AS DOUBLE) AS pos, CAST(count_if(y <> 1) AS DOUBLE) AS neg "
    "FROM seg GROUP BY dimension, segment, p),\n"
    "r AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS tp0, coalesce(sum(neg) OVER w, 0) AS fp0, "
    "sum(pos) OVER (PARTITION BY dimension, segment) AS P, sum(neg) OVER (PARTITION BY dimension, segment) AS N FROM g "
    "WINDOW w AS (PARTITION BY dimension, segment ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))\n"
    "SELECT dimension, segment, CAST(max(P) + max(N) AS BIGINT) AS n, CASE WHEN max(P) > 0 AND max(N) > 0 THEN "
    "sum(pos * (N - (fp0 + neg) + 0.5 * neg)) / (max(P) * max(N)) END AS roc_auc, CASE WHEN max(P) > 0 THEN "
    "sum(((tp0 + pos) / P - tp0 / P) * ((tp0 + pos) / (tp0 + pos + fp0 + neg) + "
    "CASE WHEN tp0 + fp0 = 0 THEN 1.0 ELSE tp0 / (tp0 + fp0) END) / 2) END AS pr_auc FROM r GROUP BY dimension, segment"),
    doubles=["roc_auc", "pr_auc"])
def segment_auc(spark, sf):
    """N and ROC/PR-AUC by contract, senior flag and first year (scores
    joined to the subscriber attributes on the row key)."""
    seg = fx.subscribers(spark, sf, keyed=True).select("row_id", "contract_type", "seniorcitizen", "months_with_provider")
    j = _scored(spark, sf).join(seg, "row_id")
    first = F.when(num(F.col("months_with_provider")).between(0, FIRST_YEAR), f"0-{FIRST_YEAR}")
    return M.segment_auc(j, {"contract_type": F.col("contract_type"), "seniorcitizen": F.col("seniorcitizen"),
                             "tenure": first}).withColumn("n", F.col("n").cast("bigint"))
