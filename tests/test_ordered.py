"""The bucketed prefix sums must equal a single-window answer exactly."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ebbflow.operators.ordered import exact_quantiles, exact_ranks


def test_bucketed_ranks_equal_row_number(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 5000), "k": rng.permutation(5000)})
    df = spark.createDataFrame(pdf).repartition(7)
    small = exact_ranks(df, ["g"], ["k"], rows_per_bucket=300).toPandas()
    exp = pdf.assign(r=pdf.groupby("g")["k"].rank(method="first").astype(int))
    m = small.merge(exp, on=["g", "k"])
    assert len(m) == 5000 and (m["_rank"] == m["r"]).all()


def test_bucketed_quantiles_equal_pandas(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.normal(50, 20, 4000), 1)
    pdf = pd.DataFrame({"c": np.repeat(["a", "b"], 2000), "v": vals})
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, ["c"], "v", [0.25, 0.5, 0.75], rows_per_bucket=100).toPandas().set_index("c")
    for c, grp in pdf.groupby("c"):
        for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
            assert abs(got.loc[c, n] - grp["v"].quantile(q)) < 1e-9


def test_partitioning_does_not_change_ranks(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 3001).alias("k"))
    a = {(r.g, r.k): r._rank for r in exact_ranks(df, ["g"], ["k"], rows_per_bucket=200).collect()}
    b = {(r.g, r.k): r._rank for r in exact_ranks(df.repartition(11), ["g"], ["k"]).collect()}
    assert a == b


def test_many_buckets_use_bucketizer_and_stay_exact(spark):
    from ebbflow.operators import ordered as O
    df = spark.range(20000).select((F.col("id") % 2).alias("g"), ((F.col("id") * 104729) % 20011).alias("k"))
    got = {(r.g, r.k): r._rank for r in O.exact_ranks(df, ["g"], ["k"], rows_per_bucket=50).collect()}
    exp = {(r.g, r.k): r._rank for r in O.exact_ranks(df, ["g"], ["k"]).collect()}
    assert got == exp and len(got) == 20000


def test_many_big_groups(spark):
    from ebbflow.operators import ordered as O
    df = spark.range(6000).select((F.col("id") % 5).alias("g"), ((F.col("id") * 7919) % 6007).alias("k"))
    got = {(r.g, r.k): r._rank for r in O.exact_ranks(df, ["g"], ["k"], rows_per_bucket=100).collect()}
    exp = {(r.g, r.k): r._rank for r in O.exact_ranks(df, ["g"], ["k"]).collect()}
    assert got == exp and len(got) == 6000


def test_buckets_are_even_and_follow_the_order(spark):
    """Values of very different scale, a null group, 200 big groups: no bucket much above its share, descending sums exact."""
    from ebbflow.operators import ordered as O
    df = spark.range(20000).select(F.when(F.col("id") % 200 != 7, F.col("id") % 200).alias("g"),
                                   F.expr("pow(10D, id % 290 - 145) * (id + 1) * if(id % 2 = 0, 1, -1)").alias("v"), F.lit(2).alias("n"))
    wide = O.ordered_prefix(df, ["g"], ["v"], ["n"], descending=True, rows_per_bucket=60)
    got = {(r.g, r.v): (r.n_before, r.n_total) for r in wide.collect()}
    exp = {(r.g, r.v): (r.n_before, r.n_total) for r in O.ordered_prefix(df, ["g"], ["v"], ["n"], descending=True).collect()}
    assert got == exp and len(got) == 20000
    files = wide._jdf.queryExecution().toString()
    assert "percentile_approx" not in files
    sizes = [r["count"] for r in spark.read.parquet(*{f.rsplit("/", 1)[0] for f in wide.inputFiles()}).groupBy("_bucket").count().collect()]
    assert len(sizes) > 200 and max(sizes) < 6 * 20000 / len(sizes)


def test_mixed_big_and_small_groups(spark):
    from ebbflow.operators import ordered as O
    big = spark.range(3000).select(F.lit(0).alias("g"), ((F.col("id") * 7919) % 3001).alias("k"))
    small = spark.range(400).select((F.col("id") % 40 + 1).alias("g"), F.col("id").alias("k"))
    df = big.unionByName(small)
    got = {(r.g, r.k): (r._rank, r._group_rows) for r in O.exact_ranks(df, ["g"], ["k"], rows_per_bucket=100).collect()}
    exp = {(r.g, r.k): (r._rank, r._group_rows) for r in O.exact_ranks(df, ["g"], ["k"]).collect()}
    assert got == exp and len(got) == 3400


def _brute_auc(y, p):
    """Mann-Whitney ROC-AUC and anchored trapezoid PR-AUC, straight numpy."""
    pos, neg = p[y == 1], p[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    roc = gt / (len(pos) * len(neg))
    pr, r0, p0 = 0.0, 0.0, 1.0
    for t in np.unique(p)[::-1]:
        sel = p >= t
        tp, fp = (y[sel] == 1).sum(), (y[sel] == 0).sum()
        r1, p1 = tp / len(pos), tp / (tp + fp)
        pr += (r1 - r0) * (p1 + p0) / 2
        r0, p0 = r1, p1
    return roc, pr


def test_bucketed_auc_equals_brute_force(spark, monkeypatch):
    from ebbflow.operators import metrics as M
    from ebbflow.operators import ordered as O
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 3000)
    p = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)  # many ties
    df = spark.createDataFrame(pd.DataFrame({"row_id": np.arange(3000), "y": y, "p": p})).repartition(6)
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", 7)  # ~100 distinct scores -> many buckets
    r = M.ranking_auc(df).collect()[0]
    roc, pr = _brute_auc(y, p)
    assert abs(r.roc_auc - roc) < 1e-12 and abs(r.pr_auc - pr) < 1e-12
