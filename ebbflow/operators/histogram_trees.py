"""Tree ensembles grown from distributed histograms, for several models at once.

Boosted trees use second-order statistics: per row the gradient g and the
Hessian h of the logistic loss at the current margin; a leaf's value is
``-rate * G / (H + l2)`` and a split gains ``GL^2 / (HL + l2) + GR^2 / (HR +
l2) - G^2 / (H + l2)``.  A random forest is the same search with g = weight
of the positive rows, h = weight and l2 = 0, which makes the gain that of
the Gini impurity and a leaf the weighted share of positives.

Features are binned once (``binned``: quantile cuts from one aggregate) into
a narrow table below the shared folder: row hash, label, fold, one byte a
feature.  Model ``m`` learns from the rows whose fold is not ``excluded[m]``,
so all models of a k-fold read the same scan: the model is one more
dimension of the histogram.  All nodes of a level, of all trees that grow
side by side, are filled in one pass (several if they exceed ``CELLS``):

* a task adds up its rows' cells and sends one block of cells per ``BLOCK``
  cells, whatever its number of rows;
* blocks are shuffled by number and added, the best split of each node is
  found there, and the driver gets one split a node (a bound of the model's
  size, not of the data).

Sums are exact: g and h enter as integers of a fixed scale, so neither the
partitioning nor a retried task changes a tree, and equal gains (one-hot
columns that say the same) go to the first feature and the lowest cut.

Boosting keeps the margins of all models in the table and rewrites it every
``KEEP_EVERY`` rounds (the previous version is removed then); in between,
margins are carried on with the few trees grown since.

Rows with a missing feature or label are not trained on and score null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..session import remove_path, scratch_path
from .fitted import Fitted

BINS = 128
ROWS = 8192  # rows handled at once in a task
CELLS = 1 << 21  # cells filled in one pass: two 16 MB arrays in a task
BLOCK = 1 << 13  # cells of a shuffled block (a node is never cut)
KEEP_EVERY = 5
SCALE_BITS = 36
MIN_GAIN = 1e-6


@dataclass(frozen=True)
class Settings:
    trees: int = 100
    depth: int = 4
    rate: float = 0.1
    l2: float = 1.0
    least: float = 1.0  # least h of a child
    tried: int = 0  # features tried at a node; 0: all
    boosted: bool = True
    positive_weight: float = K.GBT_POSITIVE_WEIGHT
    bins: int = BINS
    seed: int = K.SEED


def boosted_settings(**params) -> Settings:
    return replace(Settings(), **{{"rounds": "trees"}.get(k, k): v for k, v in params.items()})


def forest_settings(n_features: int, **params) -> Settings:
    base = Settings(depth=10, rate=1.0, l2=0.0, least=0.0, boosted=False, tried=max(1, math.isqrt(n_features)))
    return replace(base, **params)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = np.atleast_1d(x).astype(np.uint64)  # arrays wrap round without a warning
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def bag(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson(1), from the row's hash."""
    u = mix(row.view(np.uint64) ^ mix(np.uint64(seed) * np.uint64(1 << 32) + np.uint64(tree))) >> np.uint64(11)
    return np.searchsorted(_POISSON, u.astype(np.float64) / (1 << 53), side="right").astype(np.float64)


def tried_features(tree: np.ndarray, node: np.ndarray, n_features: int, settings: Settings) -> np.ndarray:
    """Ascending features tried at each (tree, node)."""
    k = settings.tried or n_features
    if k >= n_features:
        return np.broadcast_to(np.arange(n_features), (len(tree), n_features))
    start = mix(np.uint64(settings.seed) + mix(tree.astype(np.uint64) * np.uint64(1 << 32) + node.astype(np.uint64)))
    order = mix(start[:, None] + np.arange(n_features, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(np.argpartition(order, k - 1, axis=1)[:, :k], axis=1)


# ------------------------------------------------------------------ model
@dataclass
class Trees:
    """Some trees in heap order: children of node i are 2i + 1 and 2i + 2; a feature of -1 is a leaf."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(n: int, depth: int) -> Trees:
        size = (2 << depth) - 1
        return Trees(np.full((n, size), -1, np.int16), np.zeros((n, size), np.int16), np.zeros((n, size)), np.zeros((n, size)))

    def leaves(self, tree: int, bins: np.ndarray, steps: int) -> np.ndarray:
        """Node where each row ends after at most ``steps`` splits."""
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(steps):
            f = self.feature[tree][node]
            down = 2 * node + 1 + (bins[rows, f] > self.cut[tree][node])
            node = np.where(f >= 0, down, node)
        return node

    def sums(self, bins: np.ndarray, steps: int) -> np.ndarray:
        out = np.zeros(len(bins))
        for t in range(len(self.feature)):
            out += self.value[t][self.leaves(t, bins, steps)]
        return out


@dataclass
class TreeModel(Fitted):
    """A fitted ensemble: saved, loaded and applied in batch and stream alike."""
    features: list[str]
    edges: list[list[float]]
    trees: Trees
    depth: int
    boosted: bool
    base: float = 0.0
    n_trees: int = field(init=False)

    def __post_init__(self):
        self.n_trees = len(self.trees.feature)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """x: rows x features; a row with a missing feature gives nan."""
        out = np.full(len(x), np.nan)
        whole = ~np.isnan(x).any(axis=1)
        s = self.trees.sums(to_bins(x[whole], self.edges), self.depth)
        out[whole] = 1 / (1 + np.exp(-(self.base + s))) if self.boosted else s / max(1, self.n_trees)
        return out

    def column(self) -> Column:
        """Probability of class 1 as a column; null where a feature is missing."""
        model = self

        @F.pandas_udf("double")
        def p(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in cols])
            return pd.Series(model.probabilities(x))
        got = p(*[F.col(f"`{c}`").cast("double") for c in self.features])
        return F.when(~F.isnan(got), got)

    def importance(self) -> np.ndarray:
        """Share of each feature in the sum of gains."""
        used = self.trees.feature >= 0
        total = np.bincount(self.trees.feature[used], self.trees.gain[used], len(self.features))
        return total / total.sum() if total.sum() else total

    def to_dict(self) -> dict:
        t = self.trees
        some = [np.flatnonzero((t.feature[k] >= 0) | (t.value[k] != 0)) for k in range(self.n_trees)]
        return {"features": self.features, "edges": self.edges, "depth": self.depth, "boosted": self.boosted, "base": self.base,
                "trees": [[i.tolist(), t.feature[k, i].tolist(), t.cut[k, i].tolist(), t.value[k, i].tolist(), t.gain[k, i].tolist()]
                          for k, i in enumerate(some)]}

    @classmethod
    def from_dict(cls, d: dict) -> TreeModel:
        t = Trees.empty(len(d["trees"]), d["depth"])
        for k, (i, f, c, v, g) in enumerate(d["trees"]):
            t.feature[k, i], t.cut[k, i], t.value[k, i], t.gain[k, i] = f, c, v, g
        return cls(d["features"], d["edges"], t, d["depth"], d["boosted"], d["base"])


# ------------------------------------------------------------------ binned table
def quantile_edges(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Ascending upper bounds of the bins but the last, per feature: one aggregate, at most ``bins`` numbers a feature."""
    at = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), at, F.lit(100 * bins)).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [sorted(set(q or [])) for q in row]


def to_bins(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Bin of each value: the number of edges below it."""
    out = np.empty(x.shape, np.uint8)
    for f, e in enumerate(edges):
        out[:, f] = np.searchsorted(np.asarray(e, np.float64), x[:, f], side="left")
    return out


@dataclass
class Binned:
    path: str
    table: DataFrame  # row long, y double, fold int, bins binary, margins array<double>
    edges: list[list[float]]
    features: list[str]
    counts: dict  # (fold, y) -> rows
    one_task: bool  # all of it is read by one task


STATE = "row long, y double, fold int, bins binary, margins array<double>"


def _state(spark: SparkSession, df: DataFrame) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "binned")
    df.write.parquet(path)
    return path, spark.read.schema(STATE).parquet(path)


def _bytes(x: np.ndarray) -> pa.Array:
    """One binary value for each row of bytes."""
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.shape[1]), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())


def binned(df: DataFrame, features: list[str], label: str, key: str, fold_col: str | None, settings: Settings, models: int) -> Binned:
    """Writes the binned table.  ``fold_col`` None: one fold, 0."""
    spark = df.sparkSession
    whole = F.col(label).isNotNull()
    for c in features:
        whole = whole & F.col(f"`{c}`").isNotNull() & ~F.isnan(F.col(f"`{c}`").cast("double"))
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    d = df.where(whole).select(F.xxhash64(key).alias("row"), F.col(label).cast("double").alias("y"), fold.alias("fold"),
                               *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    edges = quantile_edges(d, [f"x{i}" for i in range(len(features))], settings.bins)
    counts = {(r["fold"], r["y"]): r["n"] for r in d.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}  # folds x classes
    boosted, n_features = settings.boosted, len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.column_stack([b.column(f"x{i}").to_numpy() for i in range(n_features)])
                margins = pa.array([[0.0] * models if boosted else []] * b.num_rows, pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("y"), b.column("fold"), _bytes(to_bins(x, edges)), margins],
                                                 names=["row", "y", "fold", "bins", "margins"])
    # few rows are not worth many tasks: a forest's pass costs a row some thousand times what a boosting pass does
    parts = max(1, math.ceil(sum(counts.values()) / (65536 if boosted else 2048)))
    d = d.repartition(parts) if parts <= 64 else d
    path, table = _state(spark, d.mapInArrow(run, STATE))
    return Binned(path, table, edges, features, counts, parts == 1 and table.rdd.getNumPartitions() <= 1)


# ------------------------------------------------------------------ growing
@dataclass
class Growth:
    """What a task needs for one pass: the trees so far and the cells to fill."""
    settings: Settings
    number: np.ndarray  # global number of each tree (bagging, features)
    model: np.ndarray  # model of each tree
    excluded: np.ndarray  # fold that each model leaves out, -1 for none
    weights: np.ndarray  # model x class
    trees: Trees
    past: list[Trees]  # of each model, not yet in the stored margins (boosted)
    base: float
    level: int
    slot: np.ndarray  # tree x node of the level -> slot, or -1
    chosen: np.ndarray  # slot x tried features
    start: np.ndarray  # slot x tried: first cell
    width: np.ndarray  # bins of each feature
    ends: np.ndarray  # last slot of each block, exclusive
    scale: float


def gradients(g: Growth, m: int, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-margin))
    w = np.where(y == 1, g.weights[m, 1], g.weights[m, 0])
    return (p - y) * w, np.maximum(p * (1 - p), 1e-16) * w


def fill(g: Growth, row: np.ndarray, y: np.ndarray, fold: np.ndarray, bins: np.ndarray, margins: np.ndarray, cells: np.ndarray) -> None:
    """Adds some rows to the cells (2 x number of cells)."""
    stats: dict[int, tuple] = {}
    for t in range(len(g.number)):
        m = int(g.model[t])
        if g.settings.boosted:
            if m not in stats:
                stats[m] = gradients(g, m, y, margins[:, m] + (g.past[m].sums(bins, g.settings.depth) if g.past else 0.0))
            gg, hh = stats[m]
            live = fold != g.excluded[m]
        else:
            hh = bag(row, int(g.number[t]), g.settings.seed) * np.where(y == 1, g.weights[m, 1], g.weights[m, 0])
            gg = hh * y
            live = (fold != g.excluded[m]) & (hh > 0)
        live = np.flatnonzero(live)
        b = bins[live]
        node = g.trees.leaves(t, b, g.level) - ((1 << g.level) - 1)
        slot = np.where(node >= 0, g.slot[t][np.maximum(node, 0)], -1)
        some = np.flatnonzero(slot >= 0)
        if not len(some):
            continue
        slot, live, b = slot[some], live[some], b[some]
        at = g.start[slot] + np.take_along_axis(b, g.chosen[slot], axis=1)
        own = g.slot[t][g.slot[t] >= 0]
        lo = int(g.start[own.min(), 0])
        hi = int(g.start[own.max(), -1] + g.width[g.chosen[own.max(), -1]])
        for k, v in enumerate((gg, hh)):
            whole = np.rint(v[live] * g.scale)  # sums of ROWS such integers are exact in a double
            cells[k, lo:hi] += np.bincount((at - lo).ravel(), np.repeat(whole, at.shape[1]), hi - lo).astype(np.int64)


def rows_of(b: pa.RecordBatch) -> tuple:
    n = b.num_rows
    bins = np.frombuffer(b"".join(b.column("bins").to_pylist()), np.uint8).reshape(n, -1)
    margins = b.column("margins").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    return b.column("row").to_numpy(), b.column("y").to_numpy(), b.column("fold").to_numpy(), bins, margins


def best_splits(g: Growth, first: int, last: int, G: np.ndarray, H: np.ndarray) -> tuple:
    """Best split of each slot in [first, last) from its cells: slot, feature, cut, gain, GL, HL, G, H."""
    slots = np.arange(first, last)
    chosen, start = g.chosen[slots].ravel(), (g.start[slots] - g.start[first, 0]).ravel()
    width = g.width[chosen]
    segment = np.repeat(np.arange(len(start)), width)
    tried = g.chosen.shape[1]
    cg, ch = np.concatenate([[0], np.cumsum(G)]), np.concatenate([[0], np.cumsum(H)])
    gl, hl = cg[1:] - cg[start][segment], ch[1:] - ch[start][segment]
    total_g, total_h = (cg[start + width] - cg[start])[segment], (ch[start + width] - ch[start])[segment]
    gr, hr = total_g - gl, total_h - hl
    s, l2 = g.scale, g.settings.l2
    least = max(1, round(g.settings.least * s))
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (gl / s) ** 2 / (hl / s + l2) + (gr / s) ** 2 / (hr / s + l2)
    score = np.where((hl >= least) & (hr >= least), score, -np.inf)
    owner = segment // tried
    begin = start[::tried]
    top = np.maximum.reduceat(score, begin)
    hit = np.flatnonzero(score == top[owner])
    cell = hit[np.unique(owner[hit], return_index=True)[1]]  # the first feature and the lowest cut of equal ones
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = score[cell] - (total_g[cell] / s) ** 2 / (total_h[cell] / s + l2)
    return slots, chosen[segment[cell]], cell - start[segment[cell]], np.where(np.isfinite(score[cell]), gain, -np.inf), gl[cell], hl[cell], \
        total_g[cell], total_h[cell]


_SPLITS = "slot array<int>, feature array<int>, cut array<int>, gain array<double>, gl array<long>, hl array<long>, g array<long>, h array<long>"


def level_splits(table: DataFrame, g: Growth, one_task: bool) -> list[tuple]:
    """One pass over the table: the best split of every slot.  A table that
    is one task's work needs no shuffle: that task finds the splits too."""
    ends = np.append(0, g.ends)
    bounds = [int(g.start[a, 0]) for a in ends[:-1]] + [int(g.start[-1, -1] + g.width[g.chosen[-1, -1]])]

    def splits(k: int, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], pa.list_(t)) for v, t in zip(best_splits(g, int(ends[k]), int(ends[k + 1]), x, y), kinds)],
                                          names=["slot", "feature", "cut", "gain", "gl", "hl", "g", "h"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> list[tuple]:
        cells = np.zeros((2, bounds[-1]), np.int64)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                fill(g, *rows_of(b.slice(at, ROWS)), cells)
        return [(k, cells[0, x:y], cells[1, x:y]) for k, (x, y) in enumerate(zip(bounds, bounds[1:])) if cells[1, x:y].any()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = blocks(batches)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in out], pa.int32()), pa.array([x for _, x, _ in out], pa.list_(pa.int64())),
                                          pa.array([x for _, _, x in out], pa.list_(pa.int64()))], names=["block", "g", "h"])

    def run_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, x, y in blocks(batches):
            yield splits(k, x, y)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}  # the blocks of this task
        for b in batches:
            for k, x, y in zip(b.column("block").to_pylist(), b.column("g"), b.column("h")):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                if k in total:
                    total[k][0] += x
                    total[k][1] += y
                else:
                    total[k] = [x.copy(), y.copy()]
        for k, (x, y) in total.items():
            yield splits(k, x, y)
    if one_task:
        parts = table.mapInArrow(run_alone, _SPLITS)
    else:
        parts = table.mapInArrow(run, "block int, g array<long>, h array<long>")
        parts = (parts.repartition("block") if len(g.ends) > 1 else parts.repartition(1)).mapInArrow(add, _SPLITS)
    got = parts.collect()  # one split a node
    return [x for r in got for x in zip(*r)]


def grow(table: DataFrame, g: Growth, one_task: bool) -> Trees:
    """Grows all trees of ``g`` level by level."""
    s, n_trees = g.settings, len(g.number)
    trees = Trees.empty(n_trees, s.depth)
    active = [np.array([0]) for _ in range(n_trees)]  # nodes that may split, ascending
    g = replace(g, trees=trees)

    def value(G: int, H: int) -> float:
        if s.boosted:
            return -s.rate * (G / g.scale) / (H / g.scale + s.l2)
        return G / H if H else 0.0

    def may_split(G: int, H: int) -> bool:
        return H >= 2 * max(1, round(s.least * g.scale)) and (s.boosted or 0 < G < H)
    per_node = int(g.width.sum()) if not s.tried else s.tried * int(np.sort(g.width)[::-1][: s.tried].mean() + 1)
    for level in range(s.depth):
        first = (1 << level) - 1
        order = [t for t in range(n_trees) if len(active[t])]
        following: list[list[int]] = [[] for _ in range(n_trees)]
        while order:
            part, nodes = [], 0
            while order and (not part or (nodes + len(active[order[0]])) * per_node <= CELLS):
                nodes += len(active[order[0]])
                part.append(order.pop(0))
            who = np.repeat(part, [len(active[t]) for t in part])
            node = np.concatenate([active[t] for t in part])
            chosen = tried_features(g.number[who], node, len(g.width), s)
            width = g.width[chosen]
            start = (np.cumsum(width.ravel()) - width.ravel()).reshape(width.shape)
            slot = np.full((len(part), 1 << level), -1, np.int64)
            slot[np.searchsorted(part, who), node - first] = np.arange(len(who))
            block = start[:, 0] // BLOCK
            ends = np.append(np.flatnonzero(np.diff(block)) + 1, len(who))
            now = replace(g, number=g.number[part], model=g.model[part], trees=Trees(*[getattr(trees, f)[part] for f in ("feature", "cut", "value", "gain")]),
                          level=level, slot=slot, chosen=chosen, start=start, ends=ends)
            for k, f, cut, gain, gl, hl, G, H in level_splits(table, now, one_task):
                t, i = int(who[k]), int(node[k])
                trees.value[t, i] = value(G, H)
                if gain > (2 * MIN_GAIN if s.boosted else MIN_GAIN):
                    trees.feature[t, i], trees.cut[t, i], trees.gain[t, i] = f, cut, gain
                    for child, cg, ch in ((2 * i + 1, gl, hl), (2 * i + 2, G - gl, H - hl)):
                        trees.value[t, child] = value(cg, ch)
                        if may_split(cg, ch):
                            following[t].append(child)
        active = [np.array(sorted(a), np.int64) for a in following]
    return trees


def fit(df: DataFrame, features: list[str], settings: Settings, label: str = K.LABEL, key: str = "row_id", fold_col: str | None = None,
        excluded: list[int] | None = None) -> list[TreeModel]:
    """One model for each entry of ``excluded`` (the fold it does not see), grown side by side; by default one model of all rows."""
    spark = df.sparkSession
    excluded = [-1] if excluded is None else excluded
    n_models = len(excluded)
    state = binned(df, features, label, key, fold_col, settings, n_models)
    weights = np.ones((n_models, 2))
    for m, e in enumerate(excluded):
        n = {c: sum(v for (f, y), v in state.counts.items() if f != e and y == c) for c in (0, 1)}
        weights[m] = (1.0, settings.positive_weight) if settings.boosted else [sum(n.values()) / (2 * n[c]) if n[c] else 0.0 for c in (0, 1)]
    rows = sum(state.counts.values())
    most = float(weights.max()) * (1 if settings.boosted else len(_POISSON))
    bits = min(SCALE_BITS, 61 - math.ceil(math.log2(max(2.0, rows * max(1.0, most)))))
    width = np.array([len(e) + 1 for e in state.edges])
    none = np.zeros((0, 0), np.int64)
    g = Growth(settings, np.zeros(0, np.int64), np.zeros(0, np.int64), np.array(excluded), weights, Trees.empty(0, 0), [], 0.0, 0, none, none, none, width,
               np.zeros(0, np.int64), float(2 ** bits))
    if not settings.boosted:
        model = np.repeat(np.arange(n_models), settings.trees)
        trees = grow(state.table, replace(g, number=np.tile(np.arange(settings.trees), n_models), model=model), state.one_task)
        mine = [Trees(*[getattr(trees, f)[model == m] for f in ("feature", "cut", "value", "gain")]) for m in range(n_models)]
    else:
        mine, state = _boost(spark, state, g, n_models)
    remove_path(spark, state.path)
    return [TreeModel(features, state.edges, t, settings.depth, settings.boosted) for t in mine]


def _stack(parts: list[Trees], depth: int) -> Trees:
    if not parts:
        return Trees.empty(0, depth)
    return Trees(*[np.concatenate([getattr(p, f) for p in parts]) for f in ("feature", "cut", "value", "gain")])


def _boost(spark: SparkSession, state: Binned, g: Growth, n_models: int) -> tuple[list[Trees], Binned]:
    s = g.settings
    grown: list[list[Trees]] = [[] for _ in range(n_models)]
    stored = 0
    for r in range(s.trees):
        if r - stored == KEEP_EVERY:
            past = [_stack(t[stored:], s.depth) for t in grown]

            def carry(batches: Iterator[pa.RecordBatch], past: list[Trees] = past) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    for at in range(0, b.num_rows, ROWS):
                        part = b.slice(at, ROWS)
                        _, _, _, bins, margins = rows_of(part)
                        new = margins + np.column_stack([t.sums(bins, s.depth) for t in past])
                        nested = pa.FixedSizeListArray.from_arrays(pa.array(new.ravel()), new.shape[1]).cast(pa.list_(pa.float64()))
                        yield pa.RecordBatch.from_arrays([*part.columns[:4], nested], names=["row", "y", "fold", "bins", "margins"])
            old = state.path
            path, table = _state(spark, state.table.mapInArrow(carry, STATE))
            state = replace(state, path=path, table=table)
            remove_path(spark, old)
            stored = r
        past = [_stack(t[stored:], s.depth) for t in grown]
        new = grow(state.table, replace(g, number=np.full(n_models, r), model=np.arange(n_models), past=past), state.one_task)
        for m in range(n_models):
            grown[m].append(Trees(*[getattr(new, f)[m: m + 1] for f in ("feature", "cut", "value", "gain")]))
    return [_stack(t, s.depth) for t in grown], state


def held_out_column(models: list[TreeModel], excluded: list[int], fold_col: str) -> Column:
    """Probability of class 1 by the model that did not see the row's fold."""
    by_fold = dict(zip(excluded, models))

    @F.pandas_udf("double")
    def p(fold: pd.Series, *cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in cols])
        out = np.full(len(x), np.nan)
        for f, model in by_fold.items():
            own = (fold == f).to_numpy()
            out[own] = model.probabilities(x[own])
        return pd.Series(out)
    got = p(F.col(fold_col), *[F.col(f"`{c}`").cast("double") for c in models[0].features])
    return F.when(~F.isnan(got), got)
