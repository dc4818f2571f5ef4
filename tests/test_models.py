"""Tree ensembles, cross-validation, penalty grid and calibration against plain versions."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ebbflow.operators import features as FE
from ebbflow.operators import histogram_trees as HT
from ebbflow.operators import logistic as LG
from ebbflow.operators import metrics as M
from ebbflow.operators import models as ML
from ebbflow.operators import split as S
from ebbflow.session import scratch_path
from ebbflow.sources import fixtures as fx


@pytest.fixture(scope="module")
def numbers():
    """x, y, fold with ties, equal columns and a column of one value."""
    rng = np.random.default_rng(5)
    n = 400
    x = np.column_stack([rng.normal(size=n).round(1), rng.integers(0, 2, n), rng.integers(0, 5, n), np.full(n, 3.0), rng.normal(size=n)])
    x = np.column_stack([x, x[:, 1], 1 - x[:, 1]])
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] + 1.5 * x[:, 1] * (x[:, 2] > 2) - 1)))).astype(int)
    return x, y, rng.integers(1, 4, n)


FEATURES = [f"f {i}" for i in range(7)]  # names that need quoting


@pytest.fixture(scope="module")
def table(spark, numbers):
    x, y, fold = numbers
    rows = [(i, int(y[i]), int(fold[i]), *map(float, x[i])) for i in range(len(y))]
    rows += [(1000, None, 1, *[0.0] * 7), (1001, 1, 2, float("nan"), *[0.0] * 6)]
    d = spark.createDataFrame(rows, "row_id long, churned int, fold int, " + ", ".join(f"`{c}` double" for c in FEATURES)).repartition(5)
    return d.withColumn(FEATURES[6], F.when(F.col("row_id") != 1001, F.col(f"`{FEATURES[6]}`")))


def plain_boost(x, y, keep, s, edges):
    """Exact greedy second-order boosting over the same cuts."""
    bins = HT.to_bins(x, edges)
    margin = np.zeros(len(y))
    w = np.where(y == 1, s.positive_weight, 1.0)

    def build(rows, g, h, depth):
        G, H = g[rows].sum(), h[rows].sum()
        best = (2 * HT.MIN_GAIN, None)
        if depth:
            for f in range(x.shape[1]):
                for cut in range(len(edges[f])):
                    left = rows[bins[rows, f] <= cut]
                    gl, hl = g[left].sum(), h[left].sum()
                    if hl < s.least or H - hl < s.least:
                        continue
                    gain = gl ** 2 / (hl + s.l2) + (G - gl) ** 2 / (H - hl + s.l2) - G ** 2 / (H + s.l2)
                    if gain > best[0] + 1e-7:
                        best = (gain, (f, cut))
        if best[1] is None:
            return -s.rate * G / (H + s.l2)
        f, cut = best[1]
        go = bins[rows, f] <= cut
        return f, cut, build(rows[go], g, h, depth - 1), build(rows[~go], g, h, depth - 1)

    def value(tree, b):
        while isinstance(tree, tuple):
            tree = tree[2] if b[tree[0]] <= tree[1] else tree[3]
        return tree
    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-margin))
        tree = build(np.flatnonzero(keep), (p - y) * w, p * (1 - p) * w, s.depth)
        margin = margin + np.array([value(tree, b) for b in bins])
    return 1 / (1 + np.exp(-margin))


def test_boosting_equals_plain(spark, numbers, table, monkeypatch):
    x, y, fold = numbers
    monkeypatch.setattr(HT, "KEEP_EVERY", 2)
    monkeypatch.setattr(HT, "BLOCK", 16)  # many shuffled blocks
    s = HT.boosted_settings(rounds=5, depth=3, bins=20)
    models = HT.fit(table, FEATURES, s, fold_col="fold", excluded=[1, 2, 3, -1])
    for m, e in zip(models, (1, 2, 3, -1)):
        assert np.abs(m.probabilities(x) - plain_boost(x, y, fold != e, s, m.edges)).max() < 1e-9, e
    # one model alone, other partitions: the same trees
    alone = HT.fit(table.where("fold <> 2").repartition(3), FEATURES, s)[0]
    assert alone.edges != [] and models[1].edges == HT.fit(table, FEATURES, s)[0].edges
    again = HT.fit(table.repartition(2), FEATURES, s, fold_col="fold", excluded=[2])[0]
    assert again.to_dict() == models[1].to_dict()


def test_forest_of_one_pass_equals_separate_forests(spark, numbers, table, monkeypatch):
    x, y, fold = numbers
    s = HT.forest_settings(len(FEATURES), trees=6, depth=5)
    together = HT.fit(table, FEATURES, s, fold_col="fold", excluded=[1, 2, 3])
    monkeypatch.setattr(HT, "CELLS", 200)  # many passes a level
    monkeypatch.setattr(HT, "ROWS", 37)
    for k, e in enumerate((1, 2, 3)):
        assert HT.fit(table, FEATURES, s, fold_col="fold", excluded=[e])[0].to_dict() == together[k].to_dict()
    # every split of a tree is the best of the features tried there
    m = together[0]
    bins, t = HT.to_bins(x, m.edges), m.trees
    row = np.array([r["h"] for r in table.where("row_id < 1000").orderBy("row_id").select(F.xxhash64("row_id").alias("h")).collect()])
    w = np.where(fold == 1, 0.0, HT.bag(row, 2, s.seed) * np.array([(fold != 1).sum() / (2 * ((fold != 1) & (y == c)).sum()) for c in (0, 1)])[y])
    node = np.zeros(len(y), int)
    for _ in range(s.depth):
        for i in np.unique(node):
            own = (node == i) & (w > 0)
            tried = HT.tried_features(np.array([2]), np.array([i]), 7, s)[0]
            gini = lambda r: (w[r] * y[r]).sum() ** 2 / w[r].sum() if w[r].sum() else 0.0
            best = max((gini(own & (bins[:, f] <= c)) + gini(own & (bins[:, f] > c)) - gini(own) for f in tried for c in range(len(m.edges[f]))
                        if w[own & (bins[:, f] <= c)].sum() and w[own & (bins[:, f] > c)].sum()), default=0.0)
            f = t.feature[2, i]
            if f >= 0:
                assert f in tried and abs(best - t.gain[2, i]) < 1e-7
            else:
                assert abs(t.value[2, i] - (w[own] * y[own]).sum() / max(w[own].sum(), 1e-300)) < 1e-9 or not own.any()
                if 0 < t.value[2, i] < 1 and i < (1 << s.depth) - 1:
                    assert best <= 1e-6
        f = t.feature[2][node]
        node = np.where(f >= 0, 2 * node + 1 + (bins[np.arange(len(y)), np.maximum(f, 0)] > t.cut[2][node]), node)


def test_tree_model_is_kept_and_scores_missing_as_null(spark, table):
    m = ML.fit_model(table, FEATURES, "gbt", rounds=3, depth=2)
    path = scratch_path(spark, "t-trees")
    m.write().save(path)
    got = {r.row_id: r.p for r in ML.score(ML.load_model(path), table).collect()}
    assert got == {r.row_id: r.p for r in ML.score(m, table).collect()}
    assert got[1001] is None and all(0 < p < 1 for k, p in got.items() if k != 1001)
    imp = ML.feature_importance(m, FEATURES).collect()
    assert abs(sum(r.importance for r in imp) - 1) < 1e-9 and [r["rank"] for r in imp] == list(range(1, 8))
    none = ML.fit_model(table.where("churned = 5"), FEATURES, "gbt", rounds=2, depth=2)
    assert {round(r.p, 12) for r in ML.score(none, table.where("row_id < 3")).collect()} == {0.5}
    one = ML.fit_model(table.where("churned = 1"), FEATURES, "gbt", rounds=2, depth=2)
    assert all(r.p > 0.5 for r in ML.score(one, table.where("row_id < 3")).collect())


def plain_logistic(x, y, reg):
    n = len(y)
    mean, sd = x.mean(axis=0), x.std(axis=0)
    use = sd > 1e-12
    z = np.column_stack([(x[:, use] - mean[use]) / sd[use], np.ones(n)])
    w = np.array([1 / (2 * (y == c).sum()) for c in (0, 1)])[y]
    ridge = np.append(np.full(use.sum(), reg), 0.0)
    b = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-z @ b))
        b -= np.linalg.solve((z.T * (w * p * (1 - p))) @ z + np.diag(ridge), z.T @ (w * (p - y)) + ridge * b)
    return lambda v: 1 / (1 + np.exp(-(np.column_stack([(v[:, use] - mean[use]) / sd[use], np.ones(len(v))]) @ b)))


def test_penalty_grid_equals_separate_fits(spark, numbers, table):
    x, y, fold = numbers
    regs = [1e-3, 0.1, 1.0]
    many = LG.fit_models(table, FEATURES, regs, fold_col="fold", folds=[1, 2, 3])
    p = many.probabilities(x)
    for k, (f, r) in enumerate(zip(many.folds, many.reg)):
        own = fold != f
        assert np.abs(p[:, k] - plain_logistic(x[own], y[own], r)(x)).max() < 1e-9, (f, r)
    assert many.iterations < 15
    got = {r.reg_param: r.mean_roc_auc for r in ML.penalty_grid(table, FEATURES, regs, 3).collect()}

    def auc(s, t):
        pos, neg = s[t == 1], s[t == 0]
        return np.mean([((a > neg).sum() + 0.5 * (a == neg).sum()) / len(neg) for a in pos])
    for j, r in enumerate(regs):
        want = np.mean([auc(p[fold == f, 3 * k + j], y[fold == f]) for k, f in enumerate((1, 2, 3))])
        assert abs(got[r] - want) < 1e-9


def test_logistic_folds_agree_with_spark_ml(spark, numbers, table):
    x, y, fold = numbers
    d = table.where("row_id < 1000")
    model = ML.fit_model(d.where("fold <> 2"), FEATURES, "logistic", tol=1e-10)
    want = {r.row_id: r.p for r in ML.score(model, d.where("fold = 2")).collect()}
    scores, models = ML.kfold_scores(d, FEATURES, "logistic", 3)
    got = {r.row_id: r.p for r in scores.collect() if r.fold == 2}
    assert want.keys() == got.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-4
    native = {r.row_id: r.p for r in ML.score(models[1], d.where("fold = 2")).collect()}
    assert max(abs(got[k] - native[k]) for k in got) < 1e-12


@pytest.mark.parametrize("kind", ["random_forest", "gbt", "logistic"])
def test_kfold_metrics_are_those_of_the_held_out_rows(spark, table, kind):
    small = {} if kind == "logistic" else {"trees" if kind == "random_forest" else "rounds": 4, "depth": 3}
    path = scratch_path(spark, "t-kfold")
    rows = {r.fold: r for r in ML.kfold_train(table, FEATURES, kind, 3, best_model_path=path, **small).collect()}
    scores, models = ML.kfold_scores(table, FEATURES, kind, 3, whole=True, **small)
    assert len(models) == 4
    for f in (1, 2, 3):
        want = M.ranking_auc(scores.where(F.col("fold") == f)).first()
        assert (rows[str(f)].roc_auc, rows[str(f)].pr_auc, rows[str(f)].n) == pytest.approx((want.roc_auc, want.pr_auc, want.n), abs=1e-9)
    best = max((1, 2, 3), key=lambda f: rows[str(f)].roc_auc)
    assert [rows[str(f)].is_best for f in (1, 2, 3)] == [f == best for f in (1, 2, 3)]
    kept = {r.row_id: r.p for r in ML.score(ML.load_model(path), table).collect()}
    want = {r.row_id: r.p for r in scores.collect() if r.fold == best}
    assert all(kept[k] == pytest.approx(v, abs=1e-12) if v is not None else kept[k] is None for k, v in want.items())


def test_line_by_newton_is_the_optimum(spark):
    rng = np.random.default_rng(2)
    z = rng.normal(size=300)
    y = (rng.random(300) < 1 / (1 + np.exp(-(1.7 * z - 0.4)))).astype(float)
    df = spark.createDataFrame(list(zip(z.tolist(), y.tolist())), "z double, y double")
    a, b = LG.newton_line(df, "z", "y")
    e = 1 / (1 + np.exp(-(a * z + b))) - y
    assert abs(e @ z) < 1e-8 and abs(e.sum()) < 1e-8
    flat = LG.newton_line(df.where("y = 1"), "z", "y", 3)
    assert all(math.isfinite(v) for v in flat)
    assert LG.newton_line(df.where("false"), "z", "y") == (0.0, 0.0)


def test_split_folds_and_sample_are_independent(spark):
    d = spark.range(15000).select(F.col("id").alias("row_id"), (F.col("id") % 4 == 0).cast("int").alias("churned"))
    d = S.kfold_assign(S.stratified_split(d))
    n = {(r.split, r.fold): r["count"] for r in d.groupBy("split", "fold").count().collect()}
    for f in range(1, 6):
        assert abs(n["test", f] - 600) < 100 and n["test", f] + n["train", f] == 3000, n
    capped = S.cap_per_class(d, cap=1000)
    assert abs(capped.where("split = 'test'").count() - 400) < 80
    per = {r.fold: r["count"] for r in capped.groupBy("fold").count().collect()}
    assert all(abs(per[f] - 400) < 80 for f in range(1, 6)), per
    inside = S.kfold_assign(d.where("split = 'train'").drop("fold"))
    assert {r["count"] for r in inside.groupBy("fold").count().collect()} == {2400}


def test_folds_of_the_features_hold_every_class(spark, sf):
    raw = fx.subscribers(spark, sf, keyed=True)
    d = S.kfold_assign(S.stratified_split(FE.transform_features(raw, FE.fit_features(raw))).where("split = 'train'"))
    assert d.groupBy("fold", "churned").count().count() == 10


def test_forest_rows_are_dealt_by_their_number(spark, monkeypatch):
    """One part or many small ones: the forest learns from even parts, from the same rows, and the same way twice."""
    monkeypatch.setattr(ML, "FOREST_ROWS", 500)
    rng = np.random.default_rng(5)
    rows = [(i % 700 if i % 9 else None, *map(float, rng.integers(0, 6, 3)), int(rng.random() < 0.4)) for i in range(1800)]
    df = spark.createDataFrame(rows, "row_id long, a double, `b c` double, d double, churned int")
    cols = ["churned", "a", "b c", "d"]
    plain = lambda d: sorted(tuple(r) for r in d.collect())
    for parts in (1, 40):
        dealt = ML.spread(df.repartition(parts), cols)
        sizes = [len(p) for p in dealt.rdd.glom().collect()]
        assert len(sizes) == 4 and max(sizes) < 500 + 40, sizes
        assert plain(dealt) == plain(df.select(*[F.col(f"`{c}`") for c in cols]))
    few = df.limit(400)
    assert ML.spread(few, cols) is few
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    one = df.repartition(1)
    trees = [ML.fit_model(one, ["a", "b c", "d"], "random_forest", trees=5, depth=4).stages[-1] for _ in range(2)]
    text = [m.toDebugString.split("\n", 1)[1] for m in trees]
    assert text[0] == text[1] and trees[0].totalNumNodes > 5
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_forest_with_kept_nodes_grows_the_same_trees(spark, table):
    """Keeping each row's node between the levels changes the time, not the trees."""
    d = ML.with_weights(table.coalesce(1), "random_forest")
    d = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip").transform(d)
    e = ML.estimator("random_forest", 0, trees=8, depth=6)
    assert e.getCacheNodeIds()
    text = [x.fit(d).toDebugString.split("\n", 1)[1] for x in (e, e.copy().setCacheNodeIds(False))]
    assert text[0] == text[1]
