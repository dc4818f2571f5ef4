"""Pairwise-complete correlations by column blocks.

A task turns its rows into a matrix and keeps, for every pair of column
blocks, six arrays: the number of rows where both columns are present, and
over these rows the sums of x, y, x^2, y^2 and x y about a shift of its own
(the means of its first rows).  States with different shifts are merged by
moving them to one (``merged``), so nothing cancels when means are large.
One row a task and pair of blocks is shuffled, and pairs of blocks are
finished side by side.  Matrix products do the work: the plan does not grow
with the number of columns, and nothing of it passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X

BLOCK = 64  # columns of a block: a state is 6 * 64 * 64 numbers

STATE = "slot int, a array<double>, b array<double>, v array<double>"


def block_state(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """6 x columns of x x columns of y: n, sums of x, y, x^2, y^2, x y where both are present (nan is missing)."""
    px, py = (~np.isnan(x)).astype(float), (~np.isnan(y)).astype(float)
    x0, y0 = np.nan_to_num(x), np.nan_to_num(y)
    return np.stack([px.T @ py, x0.T @ py, px.T @ y0, (x0 * x0).T @ py, px.T @ (y0 * y0), x0.T @ y0])


def moved(v: np.ndarray, da: np.ndarray, db: np.ndarray) -> np.ndarray:
    """The state about a shift that is smaller by ``da`` (x) and ``db`` (y)."""
    n, sx, sy, sxx, syy, sxy = v
    a, b = da[:, None], db[None, :]
    return np.stack([n, sx + n * a, sy + n * b, sxx + 2 * a * sx + n * a * a, syy + 2 * b * sy + n * b * b, sxy + a * sy + b * sx + n * a * b])


def correlation(v: np.ndarray) -> np.ndarray:
    """nan where fewer than two rows are shared or a column is constant over them."""
    n, sx, sy, sxx, syy, sxy = v
    with np.errstate(divide="ignore", invalid="ignore"):
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        flat = (n < 2) | (vx <= 1e-14 * np.abs(sxx)) | (vy <= 1e-14 * np.abs(syy))
        return np.where(flat, np.nan, np.clip((sxy - sx * sy / n) / np.sqrt(vx * vy), -1, 1))


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """``i, j, correlation`` for every ordered pair of positions in ``cols``."""
    d, size = len(cols), BLOCK
    starts = list(range(0, d, size))
    slots = [(a, b) for a in range(len(starts)) for b in range(a, len(starts))]
    part = lambda k: slice(starts[k], min(starts[k] + size, d))
    rows = df.select(*[X.num(X.c(c).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, shift = None, None
        for b in batches:
            for at in range(0, b.num_rows, 8192):
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.slice(at, 8192).columns])
                if shift is None:
                    seen = ~np.isnan(x)
                    shift = np.nan_to_num(x).sum(axis=0) / np.maximum(seen.sum(axis=0), 1)
                    total = [np.zeros((6, x[:, part(i)].shape[1], x[:, part(j)].shape[1])) for i, j in slots]
                x = x - shift
                for k, (i, j) in enumerate(slots):
                    total[k] += block_state(x[:, part(i)], x[:, part(j)])
        if total is not None:
            for k, (i, j) in enumerate(slots):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([shift[part(i)]], pa.list_(pa.float64())),
                                                  pa.array([shift[part(j)]], pa.list_(pa.float64())), pa.array([total[k].ravel()], pa.list_(pa.float64()))],
                                                 names=["slot", "a", "b", "v"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, tuple] = {}  # one for each pair of blocks of this task
        for batch in batches:
            for k, a, b, v in zip(batch.column("slot").to_pylist(), *(batch.column(c) for c in "abv")):
                if not v.is_valid:
                    states.setdefault(k, (None, None, None))
                    continue
                a, b, v = (z.values.to_numpy() for z in (a, b, v))
                v = v.reshape(6, len(a), len(b))
                old = states.get(k)
                states[k] = (a, b, v.copy()) if old is None or old[2] is None else (old[0], old[1], old[2] + moved(v, a - old[0], b - old[1]))
        for k, (_, _, v) in states.items():
            i, j = (np.arange(d)[part(s)] for s in slots[k])
            r = np.full((len(i), len(j)), np.nan) if v is None else correlation(v)
            left, right = np.repeat(i, len(j)), np.tile(j, len(i))
            if slots[k][0] != slots[k][1]:
                left, right, r = np.concatenate([left, right]), np.concatenate([right, left]), np.concatenate([r.ravel(), r.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(r.ravel())],
                                             names=["i", "j", "correlation"])
    # a state without rows for every pair of blocks, so that a table without rows has its pairs too
    none = df.sparkSession.createDataFrame([(k, None, None, None) for k in range(len(slots))], STATE)
    states = rows.mapInArrow(run, STATE).unionByName(none).repartition("slot")
    out = states.mapInArrow(merged, "i int, j int, correlation double")
    return out.withColumn("correlation", F.when(~F.isnan("correlation"), F.col("correlation")))
