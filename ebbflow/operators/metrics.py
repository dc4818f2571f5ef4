"""Classification metrics over a scored table ``(row_id, y, p)``.

Scale notes
* Threshold metrics are one aggregate of conditional counts (four per grid
  threshold); rows are never multiplied.
* Ranking metrics (ROC-AUC, PR-AUC, curves) first collapse to one row per
  distinct score, then use ``ordered.ordered_prefix`` for running sums, so
  no single task sees the whole score table.

Rows whose score is null or NaN, or whose label is null, are unscored: no
metric counts them, and ``confusion`` and ``prediction_match_rate`` report
how many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import num, safe_div
from .ordered import ordered_prefix


def one_row(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row results side by side: union
    them (missing columns null) and keep each column's non-null value.
    A handful of rows, no join."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in frames:
        cols += [c for c in f.columns if c not in cols]
    return u.agg(*[F.first(F.col(c), ignorenulls=True).alias(c) for c in cols])


def _y(df: DataFrame, y: str) -> F.Column:
    return F.col(y).cast("int")


def _p(p: str) -> F.Column:
    return num(F.col(p).cast("double"))


def _unscored(y: str, p: str) -> F.Column:
    return _p(p).isNull() | F.col(y).isNull()


def known(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """The rows that metrics count: score and label both present."""
    return scored.where(~_unscored(y, p))


def confusion(scored: DataFrame, threshold: float = K.THRESHOLD_DEFAULT,
              y: str = "y", p: str = "p") -> DataFrame:
    """TN, FP, FN, TP with the class predicted as ``p >= threshold``, and the
    rows in none of them (``n_unscored``)."""
    pred = _p(p) >= F.lit(float(threshold))
    pos = _y(scored, y) == 1
    return scored.agg(
        F.count_if(~pos & ~pred).alias("tn"), F.count_if(~pos & pred).alias("fp"),
        F.count_if(pos & ~pred).alias("fn"), F.count_if(pos & pred).alias("tp"),
        F.count_if(_unscored(y, p)).alias("n_unscored"))


def _prf(tn, fp, fn, tp) -> list:
    prec = safe_div(tp, tp + fp)
    rec = safe_div(tp, tp + fn)
    f1 = safe_div(2 * tp, 2 * tp + fp + fn)
    acc = safe_div(tp + tn, tp + tn + fp + fn)
    return [acc.alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
            f1.alias("f1_score")]


def accuracy_prf(scored: DataFrame, threshold: float = K.THRESHOLD_DEFAULT,
                 y: str = "y", p: str = "p") -> DataFrame:
    """Accuracy, precision, recall, F1; an undefined ratio is 0."""
    cm = confusion(scored, threshold, y, p)
    return cm.select(*_prf(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))


def brier(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return scored.agg(F.avg(F.pow(_p(p) - _y(scored, y), 2)).alias("brier_score"))


def score_groups(scored: DataFrame, keys: tuple[str, ...] = (), y: str = "y",
                 p: str = "p") -> DataFrame:
    """One row per distinct score (per key): positives and negatives."""
    pos = _y(scored, y) == 1
    return (known(scored, y, p).groupBy(*keys, F.col(p).cast("double").alias("score"))
            .agg(F.count_if(pos).alias("pos"), F.count_if(~pos).alias("neg")))


def score_prefix(scored: DataFrame, keys: tuple[str, ...] = (), y: str = "y",
                 p: str = "p") -> DataFrame:
    """Distinct scores in descending order with the counts strictly above
    (``pos_before``, ``neg_before``) and the group totals."""
    g = score_groups(scored, keys, y, p)
    return ordered_prefix(g, list(keys), ["score"], ["pos", "neg"], descending=True)


def _auc_terms(pre: DataFrame) -> DataFrame:
    P, N = F.col("pos_total"), F.col("neg_total")
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    tp0, fp0 = F.col("pos_before"), F.col("neg_before")
    # ROC: each positive beats the negatives below it, ties count half
    roc = F.col("pos") * (N - fp + 0.5 * F.col("neg"))
    # PR: trapezoid from the previous point; anchor (recall 0, precision 1)
    # try_divide: a class may be absent (P = 0); ANSI mode must not raise
    r1, r0 = F.try_divide(tp, P), F.try_divide(tp0, P)
    p1 = F.try_divide(tp, tp + fp)
    p0 = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(F.try_divide(tp0, tp0 + fp0))
    pr = (r1 - r0) * (p1 + p0) / 2
    return pre.select("*", roc.alias("_roc"), pr.alias("_pr"))


def _areas() -> list[F.Column]:
    return [F.sum("_roc").alias("_roc"), F.sum("_pr").alias("_pr"), F.max("pos_total").alias("_p"), F.max("neg_total").alias("_n")]


def _roc_area() -> F.Column:
    return F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.try_divide(F.col("_roc"), F.col("_p") * F.col("_n")))


def _pr_area() -> F.Column:
    return F.when(F.col("_p") > 0, F.col("_pr"))


def ranking_auc(scored: DataFrame, keys: tuple[str, ...] = (), y: str = "y",
                p: str = "p") -> DataFrame:
    """ROC-AUC (ties grouped) and PR-AUC (trapezoid over the precision-
    recall curve anchored at (0, 1)); null when a class is absent."""
    t = _auc_terms(score_prefix(scored, keys, y, p))
    out = (t.groupBy(*keys) if keys else t).agg(*_areas())
    return out.select(*keys, _roc_area().alias("roc_auc"), _pr_area().alias("pr_auc"), (F.col("_p") + F.col("_n")).alias("n"))


def roc_auc(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return ranking_auc(scored, (), y, p).select("roc_auc")


def pr_auc(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return ranking_auc(scored, (), y, p).select("pr_auc")


def classification_report(scored: DataFrame, threshold: float = K.THRESHOLD_DEFAULT,
                          y: str = "y", p: str = "p") -> DataFrame:
    """Per class precision/recall/F1/support, accuracy, macro and
    weighted averages — five rows from one aggregate."""
    cm = confusion(scored, threshold, y, p)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    # class 0 is "positive" when the roles swap
    p1, r1, f1 = safe_div(tp, tp + fp), safe_div(tp, tp + fn), safe_div(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = safe_div(tn, tn + fn), safe_div(tn, tn + fp), safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = safe_div(tp + tn, n)

    def row(label, pr, rc, f, s):
        return F.struct(F.lit(label).alias("label"), pr.cast("double").alias("precision"),
                        rc.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        s.cast("bigint").alias("support"))

    rows = [row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
            row("accuracy", F.lit(None), F.lit(None), acc, n),
            row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
            row("weighted avg", safe_div(p0 * s0 + p1 * s1, n), safe_div(r0 * s0 + r1 * s1, n),
                safe_div(f0 * s0 + f1 * s1, n), n)]
    return cm.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def evaluate_model(scored: DataFrame, threshold: float = K.THRESHOLD_DEFAULT,
                   y: str = "y", p: str = "p", keys: tuple[str, ...] = ()) -> DataFrame:
    """All headline metrics (confusion, PRF, Brier, AUCs) in one row, or one
    for each of ``keys``.  One grouping by distinct score feeds them all, so
    the scores are computed once."""
    t = _auc_terms(score_prefix(scored, keys, y, p))
    pos, neg, s = F.col("pos"), F.col("neg"), F.col("score")
    pred = s >= F.lit(float(threshold))
    cell = lambda c, n, name: F.coalesce(F.sum(F.when(c, n)), F.lit(0)).cast("bigint").alias(name)
    g = (t.groupBy(*keys) if keys else t).agg(
        cell(~pred, neg, "true_negatives"), cell(pred, neg, "false_positives"),
        cell(~pred, pos, "false_negatives"), cell(pred, pos, "true_positives"),
        F.sum(pos * F.pow(s - 1, 2) + neg * F.pow(s, 2)).alias("_loss"), *_areas())
    n = F.col("_p") + F.col("_n")
    tn, fp, fn, tp = (F.col(c) for c in ("true_negatives", "false_positives",
                                         "false_negatives", "true_positives"))
    return g.select(
        *keys, _roc_area().alias("roc_auc"), *_prf(tn, fp, fn, tp), F.try_divide(F.col("_loss"), n).alias("brier_score"),
        F.lit(float(threshold)).alias("threshold"), _pr_area().alias("pr_auc"),
        "true_negatives", "false_positives", "false_negatives", "true_positives")


# ----------------------------------------------------------- thresholds
def threshold_sweep(scored: DataFrame, grid: list[float] | None = None,
                    y: str = "y", p: str = "p") -> DataFrame:
    """Precision, recall and F1 at each grid threshold (default: the
    16-value grid 0.1, 0.15, ... 0.85).

    One aggregate: per threshold four conditional counts (4 x 16 counters
    per task, partial aggregation map-side), then the single result row is
    exploded into one row per threshold.  No join, no row multiplication."""
    grid = grid or K.threshold_grid()
    pos = _y(scored, y) == 1
    pv = _p(p)
    aggs = []
    for i, t in enumerate(grid):
        hit = pv >= F.lit(float(t))
        aggs += [F.count_if(pos & hit).alias(f"tp{i}"), F.count_if(~pos & hit).alias(f"fp{i}"),
                 F.count_if(pos & ~hit).alias(f"fn{i}"), F.count_if(~pos & ~hit).alias(f"tn{i}")]
    wide = scored.agg(*aggs)
    sw = wide.select(F.explode(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
                 F.col(f"fn{i}").alias("fn"), F.col(f"tn{i}").alias("tn"))
        for i, t in enumerate(grid)])).alias("s")).select("s.*")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sw.select("threshold", safe_div(tp, tp + fp).alias("precision"),
                     safe_div(tp, tp + fn).alias("recall"),
                     safe_div(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
                     tp.cast("bigint").alias("tp"), fp.cast("bigint").alias("fp"),
                     fn.cast("bigint").alias("fn"), F.col("tn").cast("bigint").alias("tn"))


_TARGETS = {"f1": "f1_score", "precision": "precision", "recall": "recall"}


def optimal_threshold(scored: DataFrame, target_metric: str = "f1", grid: list[float] | None = None,
                      y: str = "y", p: str = "p", min_precision: float | None = None) -> DataFrame:
    """First grid threshold with the highest positive score (strictly
    better than 0); 0.5 when none.  ``min_precision`` restricts the
    candidates (max F1 subject to a precision floor)."""
    if target_metric not in _TARGETS:
        raise ValueError(f"Unknown target metric: {target_metric}")
    col = _TARGETS[target_metric]
    sw = threshold_sweep(scored, grid, y, p)
    cand = sw.where(F.col(col) > 0)
    if min_precision is not None:
        cand = cand.where(F.col("precision") >= min_precision)
    best = cand.agg(F.min(F.struct((-F.col(col)).alias("s"), F.col("threshold").alias("t"))).alias("b"))
    return best.select(
        F.lit(target_metric).alias("target_metric"),
        F.coalesce(F.col("b.t"), F.lit(K.THRESHOLD_DEFAULT)).alias("threshold"),
        F.coalesce(-F.col("b.s"), F.lit(0.0)).alias("score"))


# ------------------------------------------------------------- segments
def confidence_segments(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Five left-closed probability bins; an empty bin keeps its name and
    range with null statistics."""
    segs = K.CONFIDENCE_SEGMENTS
    s = F.col(p)
    expr = None
    for name, _, lo, hi in segs:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (s >= lo)
        if hi is not None:
            cond = cond & (s < hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    stats = (known(scored, y, p).groupBy(expr.alias("segment"))
             .agg(F.count(F.lit(1)).alias("count"), F.avg(_y(scored, y)).alias("actual_churn_rate"),
                  F.avg(s).alias("predicted_churn_rate")))
    names = scored.sparkSession.createDataFrame(
        [(i, n, r) for i, (n, r, _, _) in enumerate(segs)], "position int, segment string, range string")
    return (names.join(F.broadcast(stats), "segment", "left")
            .select("position", "segment", "range", F.col("count").cast("bigint").alias("count"),
                    "actual_churn_rate", "predicted_churn_rate"))


# --------------------------------------------------------------- curves
def roc_curve_points(scored: DataFrame, drop_intermediate: bool = True,
                     y: str = "y", p: str = "p") -> DataFrame:
    """(fpr, tpr, threshold) per distinct score, highest first, after a
    (0, 0) start with a null threshold.  With ``drop_intermediate`` a point
    is dropped when the count steps before and after it are equal
    (collinear), first and last always kept."""
    g = score_groups(scored, (), y, p).withColumn("_one", F.lit(1))
    pre = ordered_prefix(g, [], ["score"], ["pos", "neg", "_one"], descending=True)
    pts = pre.select("score", "pos", "neg", "pos_total", "neg_total",
                     (F.col("pos_before") + F.col("pos")).alias("tps"),
                     (F.col("neg_before") + F.col("neg")).alias("fps"),
                     F.col("_one_before").alias("idx"), F.col("_one_total").alias("m"))
    if drop_intermediate:
        # the next lower score is the row with index + 1: an equi-join
        nxt = pts.select((F.col("idx") - 1).alias("idx"), F.col("pos").alias("pos_next"),
                         F.col("neg").alias("neg_next"))
        j = pts.join(nxt, "idx", "left")
        keep = ((F.col("idx") == 0) | (F.col("idx") == F.col("m") - 1) | (F.col("m") <= 2)
                | (F.col("pos_next") != F.col("pos")) | (F.col("neg_next") != F.col("neg")))
        pts = j.where(keep)
    curve = pts.select(safe_div(F.col("fps"), F.col("neg_total"), None).alias("fpr"),
                       safe_div(F.col("tps"), F.col("pos_total"), None).alias("tpr"),
                       F.col("score").alias("threshold"))
    start = scored.sparkSession.createDataFrame([(0.0, 0.0, None)],
                                                "fpr double, tpr double, threshold double")
    return start.unionByName(curve)


def pr_curve_points(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(precision, recall, threshold) per distinct score plus the final
    (1, 0) point with a null threshold."""
    pre = score_prefix(scored, (), y, p)
    tps = F.col("pos_before") + F.col("pos")
    fps = F.col("neg_before") + F.col("neg")
    curve = pre.select((tps / (tps + fps)).alias("precision"),
                       safe_div(tps, F.col("pos_total"), 1.0).alias("recall"),
                       F.col("score").alias("threshold"))
    end = scored.sparkSession.createDataFrame([(1.0, 0.0, None)],
                                              "precision double, recall double, threshold double")
    return curve.unionByName(end)


def score_histogram(scored: DataFrame, bins: int = K.HISTOGRAM_BINS, y: str = "y",
                    p: str = "p") -> DataFrame:
    """30 equal-width bins of ``p`` per true class (each class its own
    range): the classes are the series of one long-table histogram."""
    from .profile import histogram_long
    long = known(scored, y, p).select(F.col(y).cast("string").alias("column_name"), F.col(p).cast("double").alias("value"))
    h = histogram_long(long, bins)
    return h.select(F.col("column_name").cast("int").alias(y), "bin", "bin_lo", "bin_hi", "count")


def confusion_shares(scored: DataFrame, threshold: float = K.THRESHOLD_DEFAULT,
                     y: str = "y", p: str = "p") -> DataFrame:
    cm = confusion(scored, threshold, y, p)
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return cm.select(*[safe_div(F.col(c), n).alias(f"{c}_share") for c in ("tn", "fp", "fn", "tp")],
                     safe_div(F.col("tp"), F.col("tp") + F.col("fn")).alias("captured_churn_rate"))


def quality_gates(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    g = K.QUALITY_GATES
    m = one_row(ranking_auc(scored, (), y, p), brier(scored, y, p))
    return m.select("roc_auc", "pr_auc", "brier_score",
                    F.coalesce(F.col("roc_auc") > g["roc_auc_min"], F.lit(False)).alias("roc_auc_pass"),
                    F.coalesce(F.col("pr_auc") > g["pr_auc_min"], F.lit(False)).alias("pr_auc_pass"),
                    F.coalesce(F.col("brier_score") < g["brier_max"], F.lit(False)).alias("brier_pass"))


def predict_threshold(scored: DataFrame, threshold: float = K.THRESHOLD_DEFAULT,
                      p: str = "p") -> DataFrame:
    """``row_id``, probability and class; both null for an unscored row."""
    return scored.select("row_id", _p(p).alias("probability"),
                         (_p(p) >= F.lit(float(threshold))).cast("int").alias("prediction"))


def prediction_match_rate(scored: DataFrame, threshold: float = K.THRESHOLD_DEFAULT,
                          y: str = "y", p: str = "p") -> DataFrame:
    """Share of the scored rows whose predicted class is the label."""
    hit = ((_p(p) >= F.lit(float(threshold))).cast("int") == _y(scored, y))
    return scored.agg(F.count(hit).alias("n"), F.count_if(hit).alias("n_match"),
                      F.avg(hit.cast("double")).alias("match_rate"), F.count_if(_unscored(y, p)).alias("n_unscored"))


def segment_auc(scored: DataFrame, segments: dict[str, F.Column], y: str = "y", p: str = "p") -> DataFrame:
    """N, ROC-AUC and PR-AUC per (dimension, segment): ``segments`` names
    each dimension with the text of a row's segment (null: in none).  All
    dimensions in one grouped pass."""
    long = scored.select(F.col(y), F.col(p), F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), s.cast("string").alias("segment")) for d, s in segments.items()
    ])).alias("s")).select(y, p, "s.*").where(F.col("segment").isNotNull())
    return ranking_auc(long, ("dimension", "segment"), y, p).select("dimension", "segment", "n", "roc_auc", "pr_auc")
