"""Monitoring and the documented-only extras: PSI drift, retrain trigger,
smoothed target encoding (plain and out of fold), fuzzy category repair.

Everything is a fixed number of aggregates: bin edges and encodings are
one row per column / category (bounded), joined back with broadcast.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions import constants as K

PSI_BINS = 10
PSI_EPS = 1e-4
PSI_ALERT = K.PSI_ALERT
AUC_DROP_ALERT = K.AUC_DROP_ALERT
CHURN_DRIFT_ALERT = K.CHURN_DRIFT_ALERT
RETRAIN_MONTHS = 3  # quarterly
TE_SMOOTHING = 10.0
FUZZY_MAX_DISTANCE = 2


def _bin_index(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin of the baseline range; outside values go to the end bins."""
    w = (hi - lo) / bins
    raw = F.floor(F.try_divide(v - lo, w)).cast("int")
    return F.when(hi == lo, F.lit(0)).otherwise(F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)))


def _shares_psi(cnt: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """PSI and alert per ``keys`` from bin counts ``nb`` (baseline) and ``nc``
    (current); null and no alert where one of them has no value."""
    w = Window.partitionBy(*keys)  # the bins of one column
    share = lambda n: F.when(F.sum(n).over(w) > 0, F.greatest(F.try_divide(F.col(n), F.sum(n).over(w)), F.lit(PSI_EPS)))
    s = cnt.select(*keys, share("nb").alias("pb"), share("nc").alias("pc"))
    out = s.groupBy(*keys).agg(F.sum((F.col("pc") - F.col("pb")) * F.log(F.col("pc") / F.col("pb"))).alias("psi"))
    return out.select(*keys, "psi", X.is_true(F.col("psi") > PSI_ALERT).alias("alert"))


def _long(df: DataFrame, cols: list[str], *keep: Column) -> DataFrame:
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), X.num(X.c(c).cast("double")).alias("value")) for c in cols
    ])).alias("s")).select(*[c for c in ("side",) if keep], "s.*").where(F.col("value").isNotNull())


def _psi_long(long: DataFrame, bins: int) -> DataFrame:
    """PSI per column of a table (side 'b'/'c', column_name, value)."""
    rng = long.where(F.col("side") == "b").groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    cnt = (long.join(F.broadcast(rng), "column_name")  # one row per column
           .groupBy("column_name", _bin_index(F.col("value"), F.col("lo"), F.col("hi"), bins).alias("bin"))
           .agg(F.count_if(F.col("side") == "b").alias("nb"), F.count_if(F.col("side") == "c").alias("nc")))
    return _shares_psi(cnt, ("column_name",))


def psi(baseline: DataFrame, current: DataFrame, cols: list[str], bins: int = PSI_BINS) -> DataFrame:
    """Population stability index per column: sum((c - b) * ln(c / b)) over
    equal-width bins of the baseline range, shares floored at ``eps``."""
    both = _long(baseline, cols, F.lit("b").alias("side")).unionByName(_long(current, cols, F.lit("c").alias("side")))
    return _psi_long(both, bins)


@dataclass(frozen=True)
class DriftBaseline:
    """Bin counts of the baseline: ``{column: (lo, hi, counts)}``; a few numbers a column, kept as JSON."""
    columns: dict

    def to_json(self) -> str:
        return json.dumps(self.columns)

    @staticmethod
    def from_json(text: str) -> DriftBaseline:
        return DriftBaseline({c: (lo, hi, list(n)) for c, (lo, hi, n) in json.loads(text).items()})

    def bin_counts(self) -> list[Column]:
        """One conditional count for each column and bin of the baseline, to be used in any aggregate."""
        out = []
        for k, (c, (lo, hi, n)) in enumerate(self.columns.items()):
            v = X.num(X.c(c).cast("double"))
            at = _bin_index(v, F.lit(lo), F.lit(hi), len(n))
            out += [F.count_if(v.isNotNull() & (at == i)).alias(f"_d{k}_{i}") for i in range(len(n))]
        return out

    def psi_of(self, row: DataFrame) -> DataFrame:
        """(column_name, psi, alert) from one row that holds ``bin_counts``."""
        items = [F.struct(F.lit(c).alias("column_name"), F.lit(int(n[i])).cast("bigint").alias("nb"), F.col(f"_d{k}_{i}").alias("nc"))
                 for k, (c, (_, _, n)) in enumerate(self.columns.items()) for i in range(len(n))]
        return _shares_psi(row.select(F.explode(F.array(*items)).alias("s")).select("s.*"), ("column_name",))


def fit_drift_baseline(baseline: DataFrame, cols: list[str], bins: int = PSI_BINS) -> DriftBaseline:
    """Range and bin counts of the baseline: two aggregates of a few numbers."""
    v = {c: X.num(X.c(c).cast("double")) for c in cols}
    ends = baseline.agg(*[e for i, c in enumerate(cols) for e in (F.min(v[c]).alias(f"lo{i}"), F.max(v[c]).alias(f"hi{i}"))]).first()
    known = {c: (ends[f"lo{i}"], ends[f"hi{i}"], [0] * bins) for i, c in enumerate(cols) if ends[f"lo{i}"] is not None}
    empty = DriftBaseline(known)
    if not known:
        return empty
    row = baseline.agg(*empty.bin_counts()).first()
    return DriftBaseline({c: (lo, hi, [row[f"_d{k}_{i}"] for i in range(bins)]) for k, (c, (lo, hi, _)) in enumerate(known.items())})


def _decision(j: DataFrame, as_of: dt.date | None) -> DataFrame:
    drop = F.col("auc_baseline") - F.col("auc_current")
    cd = F.col("churn_rate_current") - F.col("churn_rate_baseline")
    fired = {"auc_fired": drop > AUC_DROP_ALERT, "psi_fired": F.col("max_psi") > PSI_ALERT,
             "churn_fired": F.abs(cd) > CHURN_DRIFT_ALERT}
    dates = []
    if as_of is not None:
        due = F.add_months(F.col("last_trained"), RETRAIN_MONTHS)
        fired["date_fired"] = F.lit(as_of) >= due
        dates = [F.lit(as_of).alias("as_of"), "last_trained", due.alias("due")]
    out = j.select("auc_baseline", "auc_current", drop.alias("auc_drop"), "max_psi", "churn_rate_baseline",
                   "churn_rate_current", cd.alias("churn_drift"), *dates, *[X.is_true(c).alias(n) for n, c in fired.items()])
    any_fired = F.lit(False)
    for n in fired:
        any_fired = any_fired | F.col(n)
    return out.withColumn("retrain", any_fired)


def retrain_trigger(base_auc: DataFrame, cur_auc: DataFrame, drift: DataFrame,
                    base_rate: DataFrame, cur_rate: DataFrame) -> DataFrame:
    """One row: the inputs, the rules that fired (ROC-AUC drop, any PSI
    alert, churn-rate drift beyond the limits) and the retrain decision.  A
    rule whose input is missing does not fire, so the decision is never null."""
    from .metrics import one_row
    return _decision(one_row(base_auc.select(F.col("roc_auc").alias("auc_baseline")),
                             cur_auc.select(F.col("roc_auc").alias("auc_current")),
                             drift.agg(F.max("psi").alias("max_psi")),
                             base_rate.select(F.col("churn_rate").alias("churn_rate_baseline")),
                             cur_rate.select(F.col("churn_rate").alias("churn_rate_current"))), None)


def retrain_decision(periods: DataFrame, cols: list[str], last_trained: DataFrame, as_of: dt.date, bins: int = PSI_BINS) -> DataFrame:
    """The retrain decision with the quarterly rule, from one table of both
    periods: ``side`` ('baseline' or 'current'), ``y``, ``p`` and the columns
    watched for drift.  ``last_trained`` has one row with the training date
    known at ``as_of`` (null: never); the date rule fires three months later.

    The table is evaluated once (a checkpoint of the columns used); one
    grouped ranking measures both periods."""
    from ..session import work_dir
    from .metrics import one_row, ranking_auc
    work_dir(periods.sparkSession)
    d = periods.select("side", "y", "p", *[X.c(c) for c in cols]).checkpoint(eager=True)
    sides = ("baseline", "current")
    auc = ranking_auc(d, ("side",)).agg(*[F.max(F.when(F.col("side") == s, F.col("roc_auc"))).alias(f"auc_{s}") for s in sides])
    rate = d.agg(*[F.avg(F.when(F.col("side") == s, F.col("y"))).alias(f"churn_rate_{s}") for s in sides])
    short = F.when(F.col("side") == "baseline", "b").when(F.col("side") == "current", "c").alias("side")
    drift = _psi_long(_long(d, cols, short), bins).agg(F.max("psi").alias("max_psi"))
    return _decision(one_row(auc, rate, drift, last_trained.select(F.col("last_trained").cast("date").alias("last_trained"))), as_of)


def fit_target_encoding(train: DataFrame, cols: list[str], label: str = K.LABEL,
                        m: float = TE_SMOOTHING) -> DataFrame:
    """Per (column, value): count, mean label and the encoding shrunk
    towards the overall rate, ``(sum + m * prior) / (n + m)``.  One
    unpivot + group-by; the prior is a fitted scalar (one aggregate)."""
    prior = train.agg(F.avg(label)).collect()[0][0]
    prior = F.lit(prior).cast("double")
    long = train.select(F.col(label).alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), X.c(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select("_y", "s.*").where(F.col("value").isNotNull())
    g = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("_s"))
    return g.select(
        "column_name", "value", F.col("n").cast("bigint"), (F.col("_s") / F.col("n")).alias("churn_rate"),
        ((F.col("_s") + m * prior) / (F.col("n") + m)).alias("encoding"), prior.alias("prior"))


def apply_target_encoding(df: DataFrame, enc: DataFrame, cols: list[str], label: str = K.LABEL) -> DataFrame:
    """Add ``<col>_te``; unseen values and nulls take the fitted prior.  The
    encoding table has one row per category; AQE picks the join."""
    first = enc.select("prior").limit(1).collect()
    prior = first[0][0] if first else None
    out = df
    for c in cols:
        e = enc.where(F.col("column_name") == c).select(F.col("value").alias(f"_v_{c}"),
                                                        F.col("encoding").alias(f"{c}_te"))
        out = out.join(e, X.c(c) == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
    if prior is not None:
        for c in cols:
            out = out.withColumn(f"{c}_te", F.coalesce(F.col(f"{c}_te"), F.lit(float(prior))))
    return out


def fit_target_encoding_folds(train: DataFrame, cols: list[str], label: str = K.LABEL, fold_col: str = "fold",
                              m: float = TE_SMOOTHING) -> DataFrame:
    """The smoothed encoding with what each fold may know: per (column,
    value) ``encoding`` from all training rows, and ``by_fold`` with, for
    every fold, the encoding from the rows of the other folds alone (its
    prior too), so that no row's own label enters its code.

    One shuffle: (column, value, fold) sums, combined in the tasks; a value's
    folds then meet in one small row."""
    per_fold = {r["fold"]: (r["s"] or 0, r["n"]) for r in train.groupBy(F.col(fold_col).alias("fold"))
                .agg(F.sum(label).alias("s"), F.count(label).alias("n")).collect()}  # one row a fold
    total, rows = sum(s for s, _ in per_fold.values()), sum(n for _, n in per_fold.values())
    prior = F.lit(total / rows if rows else None).cast("double")
    long = train.where(F.col(label).isNotNull()).select(F.col(label).alias("_y"), F.col(fold_col).alias("_f"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), X.c(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select("_y", "_f", "s.*").where(F.col("value").isNotNull())
    folds = sorted(per_fold)
    mine = [(F.coalesce(F.sum(F.when(F.col("_f") == f, F.col("_y"))), F.lit(0)).alias(f"_s{k}"),
             F.count_if(F.col("_f") == f).alias(f"_n{k}")) for k, f in enumerate(folds)]
    g = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("_s"), *[c for two in mine for c in two])
    entries = []
    for k, f in enumerate(folds):
        s, n = total - per_fold[f][0], rows - per_fold[f][1]
        left = F.lit(s / n if n else None).cast("double")
        entries += [F.lit(f).cast("int"), F.coalesce(F.try_divide(F.col("_s") - F.col(f"_s{k}") + m * left, F.col("n") - F.col(f"_n{k}") + m), left)]
    by_fold = F.create_map(*entries) if entries else F.lit(None).cast("map<int,double>")
    return g.select("column_name", "value", F.col("n").cast("bigint"), F.try_divide(F.col("_s") + m * prior, F.col("n") + m).alias("encoding"),
                    by_fold.alias("by_fold"), prior.alias("prior"))


def apply_target_encoding_folds(df: DataFrame, enc: DataFrame, cols: list[str], train: DataFrame, label: str = K.LABEL,
                                fold_col: str = "fold") -> DataFrame:
    """Add ``<col>_te``: the other folds' encoding where ``fold_col`` has a
    fold, the encoding of all training rows elsewhere.  Unseen values and
    nulls take the prior of the same rows."""
    per = {r["fold"]: (r["s"] or 0, r["n"]) for r in train.groupBy(F.col(fold_col).alias("fold"))
           .agg(F.sum(label).alias("s"), F.count(label).alias("n")).collect()}  # one row a fold
    total, rows = sum(s for s, _ in per.values()), sum(n for _, n in per.values())
    prior = F.lit(total / rows if rows else None).cast("double")
    for f, (s, n) in per.items():
        prior = F.when(F.col(fold_col) == f, F.lit((total - s) / (rows - n) if rows > n else None).cast("double")).otherwise(prior)
    out = df
    for c in cols:
        e = enc.where(F.col("column_name") == c).select(F.col("value").alias("_v"), F.col("encoding").alias("_e"), F.col("by_fold").alias("_b"))
        code = F.when(F.col(fold_col).isNotNull(), F.try_element_at(F.col("_b"), F.col(fold_col))).otherwise(F.col("_e"))
        out = out.join(e, X.c(c) == F.col("_v"), "left").withColumn(f"{c}_te", F.coalesce(code, prior)).drop("_v", "_e", "_b")
    return out


def fuzzy_repair(col: Column, canon: list[str], max_distance: int = FUZZY_MAX_DISTANCE) -> Column:
    """Nearest canonical spelling by edit distance when within
    ``max_distance`` (ties: first in ``canon``); otherwise unchanged."""
    best = F.least(*[F.struct(F.levenshtein(col, F.lit(v)).alias("d"), F.lit(i).alias("i"), F.lit(v).alias("v"))
                     for i, v in enumerate(canon)])
    return F.when(col.isNull(), col).when(best["d"] <= max_distance, best["v"]).otherwise(col)
