"""Logistic regression for several folds and penalties in the same passes.

``fit_models`` fits, by Newton's method, one balanced L2 model for every
(left-out fold, penalty): an iteration is one scan in which each task turns
its rows into a matrix once and adds up loss, gradient and Hessian of all
models; one row per model and task is shuffled and added.  Folds share one
scaled matrix: each model's own scaling (the statistics of the rows it
learns from) enters as the weights of its penalty, which gives the same
optimum as scaling the rows anew for each fold.

Objective of a model over its rows: sum(w * log loss) / sum(w) + reg / 2 *
|b|^2 on scaled features, w = n / (2 n_class), intercept free; ``reg`` = 1 / n
is C = 1.

``newton_line`` is the two-parameter case (Platt scaling) as plain
aggregates, a fixed number of iterations, so that SQL repeats it.

Rows with a missing feature or label are not trained on and score null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..session import work_dir
from .fitted import Fitted

MAX_ITERATIONS = 50
TOLERANCE = 1e-10  # of the largest Newton step
PLATT_ITERATIONS = 12
PLATT_EPS = 1e-6


@dataclass
class LogisticModels:
    """Coefficients on the raw features: models x features, and intercepts."""
    features: list[str]
    folds: list[int]  # the fold each model leaves out
    reg: list[float]
    coefficients: np.ndarray
    intercepts: np.ndarray
    iterations: int

    def model(self, k: int) -> LinearModel:
        return LinearModel(self.features, self.coefficients[k].tolist(), float(self.intercepts[k]))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """rows x models; nan where a feature is missing."""
        return 1 / (1 + np.exp(-(x @ self.coefficients.T + self.intercepts)))


@dataclass
class LinearModel(Fitted):
    """One logistic model on raw features; the column is plain arithmetic."""
    features: list[str]
    coefficients: list[float]
    intercept: float

    def column(self) -> Column:
        z = F.lit(float(self.intercept))
        for c, k in zip(self.features, self.coefficients):
            z = z + F.col(f"`{c}`").cast("double") * F.lit(float(k))
        p = 1 / (1 + F.exp(-z))
        return F.when(~F.isnan(p), p)

    def to_dict(self) -> dict:
        return {"features": self.features, "coefficients": list(map(float, self.coefficients)), "intercept": float(self.intercept)}

    @classmethod
    def from_dict(cls, d: dict) -> LinearModel:
        return cls(**d)


def _known(df: DataFrame, features: list[str], label: str) -> DataFrame:
    ok = F.col(label).isNotNull()
    for c in features:
        ok = ok & F.col(f"`{c}`").isNotNull() & ~F.isnan(F.col(f"`{c}`").cast("double"))
    return df.where(ok)


def _matrix(b: pa.RecordBatch, n: int) -> np.ndarray:
    return np.column_stack([b.column(f"x{i}").to_numpy() for i in range(n)])


def summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """Adds the arrays of ``parts(slot int, v array<double>)`` by slot; the sums (one row a slot) come to the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column("slot").to_pylist(), b.column("v")):
                v = v.values.to_numpy()
                total[k] = total[k] + v if k in total else v
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["slot", "v"])
    got = parts.repartition("slot").mapInArrow(add, "slot int, v array<double>").collect()
    return {r["slot"]: np.array(r["v"]) for r in got}


def fit_models(df: DataFrame, features: list[str], regs: list[float] | None, label: str = K.LABEL, fold_col: str | None = None,
               folds: list[int] | None = None) -> LogisticModels:
    """Models for every fold of ``folds`` (left out) and penalty of ``regs`` (None: 1 / n of the model's rows)."""
    folds = [-1] if folds is None else folds
    d = len(features)
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    rows = _known(df, features, label).select(F.col(label).cast("double").alias("y"), fold.alias("fold"),
                                              *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    shift = np.array([x or 0.0 for x in rows.agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(d)]).first()])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            if b.num_rows:
                x, y, f = _matrix(b, d) - shift, b.column("y").to_numpy(), b.column("fold").to_numpy()
                for k in np.unique(f):
                    own = f == k
                    v = np.concatenate([[(y[own] != 1).sum(), (y[own] == 1).sum()], x[own].sum(axis=0), (x[own] ** 2).sum(axis=0)])
                    total[int(k)] = total.get(int(k), 0) + v
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["slot", "v"])
    per_fold = summed(rows.mapInArrow(moments, "slot int, v array<double>"))  # one row a fold
    if not per_fold:
        raise ValueError("no row with a label and all features")
    whole = sum(per_fold.values())
    shared_sd = np.sqrt(np.maximum(whole[2 + d:] / whole[:2].sum() - (whole[2:2 + d] / whole[:2].sum()) ** 2, 0))
    shared_sd[shared_sd == 0] = 1.0
    model_fold, model_reg, weights, ridge = [], [], [], []
    for f in folds:
        v = whole - per_fold.get(f, 0)
        n = v[:2].sum()
        if not n:
            raise ValueError(f"no row is left to learn from without fold {f}")
        sd2 = np.maximum(v[2 + d:] / n - (v[2:2 + d] / n) ** 2, 0)
        for r in [1.0 / n] if regs is None else regs:
            model_fold.append(f)
            model_reg.append(r)
            weights.append([n / (2 * v[c]) / n if v[c] else 0.0 for c in (0, 1)])  # sum to 1 over the rows
            # a feature that is constant here (but for rounding) is left out by an infinite penalty
            ridge.append(np.append(np.where(sd2 > 1e-10 * v[2 + d:] / n, r * sd2 / shared_sd ** 2, np.inf), 0.0))
    m = len(model_fold)
    weights, ridge, excluded = np.array(weights), np.array(ridge), np.array(model_fold)
    free = np.isfinite(ridge)
    upper = np.triu_indices(d + 1)

    def passes(w: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((m, 1 + d + 1 + len(upper[0])))
            for b in batches:
                if not b.num_rows:
                    continue
                x = np.column_stack([(_matrix(b, d) - shift) / shared_sd, np.ones(b.num_rows)])
                y, f = b.column("y").to_numpy(), b.column("fold").to_numpy()
                z = x @ w.T
                for k in range(m):
                    u = np.where(f != excluded[k], weights[k][(y == 1).astype(int)], 0.0)
                    p = 0.5 * np.tanh(0.5 * z[:, k]) + 0.5
                    total[k, 0] += u @ (np.logaddexp(0, z[:, k]) - y * z[:, k])
                    total[k, 1:d + 2] += (u * (p - y)) @ x
                    total[k, d + 2:] += ((x * (u * p * (1 - p))[:, None]).T @ x)[upper]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(m, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["slot", "v"])
        got = summed(rows.mapInArrow(run, "slot int, v array<double>"))
        out = []
        for k in range(m):
            h = np.zeros((d + 1, d + 1))
            h[upper] = got[k][d + 2:]
            out.append((got[k][0], got[k][1:d + 2], h + np.triu(h, 1).T))
        return out
    w, step = np.zeros((m, d + 1)), np.zeros((m, d + 1))
    loss = np.full(m, np.inf)
    done = 0
    for done in range(1, MAX_ITERATIONS + 1):
        for k, (value, grad, hess) in enumerate(passes(w)):
            i = free[k]
            value += 0.5 * (ridge[k][i] * w[k][i] ** 2).sum()
            if value > loss[k] + 1e-12 * abs(loss[k]):  # the step went too far
                step[k] /= 2
                w[k] -= step[k]
                continue
            loss[k] = value
            s = np.zeros(d + 1)
            h = hess[np.ix_(i, i)] + np.diag(ridge[k][i])
            s[i] = -np.linalg.lstsq(h, grad[i] + ridge[k][i] * w[k][i], rcond=None)[0]  # the least step where h is singular
            step[k] = s
            w[k] += s
        if np.abs(step).max() < TOLERANCE:
            break
    raw = w[:, :-1] / shared_sd
    return LogisticModels(features, model_fold, model_reg, raw, w[:, -1] - raw @ shift, done)


def held_out_column(models: LogisticModels, fold_col: str) -> Column:
    """Probabilities (one for each penalty) by the models that did not see the row's fold."""
    rows_of: dict[int, list[int]] = {}
    for k, f in enumerate(models.folds):
        rows_of.setdefault(f, []).append(k)
    width = max(len(v) for v in rows_of.values())

    @F.pandas_udf("array<double>")
    def p(fold: pd.Series, *cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in cols])
        whole, out = models.probabilities(x), np.full((len(x), width), np.nan)
        for f, ks in rows_of.items():
            own = (fold == f).to_numpy()
            out[own] = whole[own][:, ks]
        return pd.Series(list(out))
    return p(F.col(fold_col), *[F.col(f"`{c}`").cast("double") for c in models.features])


# ------------------------------------------------------------------ two parameters by aggregates
def logit(p: Column) -> Column:
    """Log-odds of ``p``, kept off 0 and 1; null where ``p`` is."""
    kept = F.least(F.greatest(p, F.lit(PLATT_EPS)), F.lit(1 - PLATT_EPS))
    return F.when(p.isNotNull(), F.log(kept / (1 - kept)))  # least() skips nulls


def newton_line(df: DataFrame, z: str, y: str, iterations: int = PLATT_ITERATIONS) -> tuple[float, float]:
    """(slope, intercept) of the logistic fit of ``y`` on ``z``: Newton steps
    from (0, 0), one aggregate each, over one row per distinct ``z`` (kept by
    a checkpoint).

    Without both classes, or with one value of ``z`` alone, the fit has no
    optimum and the line through the present parameters is kept."""
    work_dir(df.sparkSession)
    d = df.groupBy(F.col(z).alias("z")).agg(F.count("*").alias("n"), F.sum(y).alias("s")).checkpoint(eager=True)
    a, b = 0.0, 0.0
    for _ in range(iterations):
        p = 1 / (1 + F.exp(-(F.lit(a) * F.col("z") + F.lit(b))))
        q, e = p * (1 - p) * F.col("n"), p * F.col("n") - F.col("s")
        r = d.agg(F.sum(e * F.col("z")).alias("ga"), F.sum(e).alias("gb"), F.sum(q * F.col("z") * F.col("z")).alias("haa"),
                  F.sum(q * F.col("z")).alias("hab"), F.sum(q).alias("hbb")).first()  # five numbers
        det = (r["haa"] or 0.0) * (r["hbb"] or 0.0) - (r["hab"] or 0.0) ** 2
        if not det or math.isnan(det) or det <= 1e-300:
            break
        da, db = (r["hbb"] * r["ga"] - r["hab"] * r["gb"]) / det, (r["haa"] * r["gb"] - r["hab"] * r["ga"]) / det
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-13 * (1 + abs(a) + abs(b)):
            break
    return a, b


def newton_line_sql(source: str, iterations: int = PLATT_ITERATIONS) -> str:
    """The same steps as CTEs over ``source(z, y)``; the last is ``line(a, b)``."""
    parts = ["l0 AS (SELECT CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b)"]
    for k in range(iterations):
        p = "(1 / (1 + exp(-((SELECT a FROM l{0}) * z + (SELECT b FROM l{0})))))".format(k)
        parts.append(f"s{k} AS (SELECT sum((p - y) * z) AS ga, sum(p - y) AS gb, sum(p * (1 - p) * z * z) AS haa, sum(p * (1 - p) * z) AS hab, "
                     f"sum(p * (1 - p)) AS hbb FROM (SELECT z, y, {p} AS p FROM {source}))")
        det = "(haa * hbb - hab * hab)"
        parts.append(f"l{k + 1} AS (SELECT (SELECT a FROM l{k}) - (hbb * ga - hab * gb) / {det} AS a, (SELECT b FROM l{k}) - (haa * gb - hab * ga) / {det} AS b FROM s{k})")
    return ",\n".join(parts) + f",\nline AS (SELECT a, b FROM l{iterations})"
