"""Exact stratified splits, stratified folds, capped samples and cohorts.

Row order comes from a seeded arithmetic scramble of the row key (integer
arithmetic only, so any SQL engine reproduces it bit for bit).  Sides and
folds are ranges of that order, so all that is needed are the scrambles at
the range ends (``cutoffs``): class counts over fixed slices of the
scramble's range locate the slice that holds an end, and only the rows of
that slice are ranked.  The table itself is never shuffled: its split is a
comparison in a projection.  A null label is a class of its own.

Split, folds and capped sample are cut from three different orders
(``FOLD_SALT``, ``CAP_SALT`` are added to the seed), so that a fold or a
sample holds test and train rows in proportion.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K

SLICE_BITS = 17  # a slice is 2^17 scrambles: 16,384 slices, each 1 / 16,384 of a class
_P = 2147483647  # 2^31 - 1: every product below stays under 2^63
_A1, _A2 = 48271, 69621
FOLD_SALT, CAP_SALT = 7919, 104729  # distinct orders under one seed


def scramble(key: Column, seed: int = K.SEED) -> Column:
    """Deterministic pseudo-random order key in [0, 2^31 - 1)."""
    k = F.pmod(key.cast("bigint"), F.lit(_P))
    h1 = F.pmod(k * _A1 + seed, F.lit(_P))
    h2 = F.pmod(h1 * h1 + seed, F.lit(_P))
    return F.pmod(h2 * _A2 + k, F.lit(_P))


def scramble_sql(key: str, seed: int = K.SEED) -> str:
    """The same scramble as SQL text (non-negative keys)."""
    k = f"({key} % {_P})"
    h1 = f"(({k} * {_A1} + {seed}) % {_P})"
    h2 = f"(({h1} * {h1} + {seed}) % {_P})"
    return f"(({h2} * {_A2} + {k}) % {_P})"


def _require_label(df: DataFrame, label: str) -> None:
    if label not in df.columns:
        raise ValueError(f"Target column '{label}' not found in dataframe")


def cutoffs(df: DataFrame, label: str, ends: Callable[[dict], dict], seed: int, key: str) -> dict:
    """``{class: [(scramble, key) or bound, ...]}``: for each class the order
    position of its ``k``-th row for every ``k`` that ``ends(class sizes)``
    asks for (``None`` for 0 rows, so that nothing lies below it).

    ``key`` must be unique.  Two narrow passes over (label, key): counts of
    (class, slice), at most 16,384 rows a class, and the ranks inside the
    slices that hold an end."""
    h = df.select(F.col(label).alias("_l"), scramble(F.col(key), seed).alias("_h"), F.col(key).alias("_k"))
    h = h.withColumn("_s", F.shiftright("_h", SLICE_BITS))
    counts: dict = {}
    for r in h.groupBy("_l", "_s").agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(r["_l"], {})[r["_s"]] = r["n"]
    wanted, out = {}, {}
    for cls, ks in ends({c: sum(n.values()) for c, n in counts.items()}).items():
        out[cls] = [None] * len(ks)
        for i, k in enumerate(ks):
            below = 0
            for s, n in sorted(counts[cls].items()):
                if below < k <= below + n:
                    wanted.setdefault((cls, s, k - below), []).append((cls, i))
                below += n
    if wanted:
        at = lambda c, s: F.col("_l").eqNullSafe(F.lit(c)) & (F.col("_s") == s)
        slices, rows = F.lit(False), F.lit(False)
        for c, s in {(c, s) for c, s, _ in wanted}:
            slices = slices | at(c, s)
        for c, s, k in wanted:
            rows = rows | (at(c, s) & (F.col("_rn") == k))
        rank = F.row_number().over(Window.partitionBy("_l", "_s").orderBy("_h", "_k"))
        for r in h.where(slices).withColumn("_rn", rank).where(rows).collect():  # one row per end
            for cls, i in wanted[(r["_l"], r["_s"], r["_rn"])]:
                out[cls][i] = (r["_h"], r["_k"])
    return out


def _up_to(end: tuple | None, seed: int, key: str) -> Column:
    """The row's (scramble, key) is not above ``end``."""
    if end is None:
        return F.lit(False)
    h = scramble(F.col(key), seed)
    return (h < F.lit(end[0])) | ((h == F.lit(end[0])) & (F.col(key) <= F.lit(end[1])))


def _by_class(label: str, exprs: dict) -> Column:
    out = F.lit(None)
    for cls, e in exprs.items():
        out = F.when(F.col(label).eqNullSafe(F.lit(cls)), e).otherwise(out)
    return out


def _class_order(sizes: dict) -> list:
    return sorted(sizes, key=lambda c: (c is None, c))


def side_quotas(sizes: dict, test_size: float) -> dict:
    """Test rows per class: ``ceil(rows * test_size)`` in all, shared in
    proportion; what rounding down leaves goes to the largest fractions
    (ties: the smaller class, null last)."""
    n = sum(sizes.values())
    total = math.ceil(n * test_size)
    quota = {c: m * total // n for c, m in sizes.items()}
    order = sorted(_class_order(sizes), key=lambda c: -(sizes[c] * total % n))
    for c in order[:total - sum(quota.values())]:
        quota[c] += 1
    return quota


def stratified_split(df: DataFrame, label: str = K.LABEL, test_size: float = K.TEST_SIZE,
                     seed: int = K.SEED, key: str = "row_id") -> DataFrame:
    """Add ``split`` ('train'/'test'): the first ``side_quotas`` rows of each
    class in scramble order are the test side.  ``key`` must be unique."""
    _require_label(df, label)
    ends = cutoffs(df, label, lambda sizes: {c: [k] for c, k in side_quotas(sizes, test_size).items()}, seed, key)
    side = _by_class(label, {c: F.when(_up_to(e[0], seed, key), "test").otherwise("train") for c, e in ends.items()})
    return df.withColumn("split", side.cast("string"))


def stratified_split_by_group(df: DataFrame, group: str = "account_id", label: str = K.LABEL,
                              test_size: float = K.TEST_SIZE, seed: int = K.SEED) -> DataFrame:
    """Split whole groups (e.g. repeated accounts never straddle train and
    test): groups are stratified by their highest label, ranked by a
    seeded scramble of the group key's hash, and the side is joined back
    on the group key (a shuffle join; AQE splits a hot group).  Rows without
    a group key form one group."""
    _require_label(df, label)
    g = (df.groupBy(group).agg(F.max(label).alias(label))
         .withColumn("_gk", F.xxhash64(F.col(group)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))))
    sides = stratified_split(g, label, test_size, seed, key="_gk").select(F.col(group).alias("_g"), "split")
    return df.join(sides, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")


def split_summary(split: DataFrame, label: str = K.LABEL) -> DataFrame:
    """Per side: rows, share of all rows, label rate."""
    g = split.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.avg(label).alias("churn_rate"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(0)))
    return g.select("split", "rows", (F.col("rows") / total).alias("ratio"), "churn_rate")


def fold_sizes(sizes: dict, n_folds: int) -> dict:
    """Rows of each class in each fold.  Classes are dealt round the folds
    one after the other, each starting where the one before it ended, so
    fold sizes differ by at most one within a class and overall."""
    out, before = {}, 0
    for c in _class_order(sizes):
        out[c] = [(sizes[c] - (f - before) % n_folds + n_folds - 1) // n_folds for f in range(n_folds)]
        before += sizes[c]
    return out


def kfold_assign(df: DataFrame, label: str = K.LABEL, n_folds: int = K.N_FOLDS,
                 seed: int = K.SEED, key: str = "row_id") -> DataFrame:
    """Add ``fold`` (1..k): stratified, shuffled; each class's scramble order
    (another one than the split's) is cut into consecutive ranges of
    ``fold_sizes`` rows.  ``key`` must be unique."""
    _require_label(df, label)
    seed += FOLD_SALT

    def ends(sizes):
        per = fold_sizes(sizes, n_folds)
        return {c: [sum(n[:f]) for f in range(1, n_folds)] for c, n in per.items()}

    folds = {}
    for cls, at in cutoffs(df, label, ends, seed, key).items():
        e = F.lit(1)
        for end in at:
            e = e + F.when(_up_to(end, seed, key), 0).otherwise(1)
        folds[cls] = e
    return df.withColumn("fold", _by_class(label, folds).cast("int"))


def cap_per_class(df: DataFrame, label: str = K.LABEL, cap: int = K.CAP_PER_CLASS,
                  seed: int = K.SEED, key: str = "row_id") -> DataFrame:
    """At most ``cap`` rows per class, seeded.  A top-k per group: Spark
    applies the limit per partition before the window's shuffle
    (WindowGroupLimit), so a huge class ships only ``cap`` rows per task."""
    w = Window.partitionBy(label).orderBy(scramble(F.col(key), seed + CAP_SALT), F.col(key))
    return (df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).drop("_rn"))


# ---------------------------------------------------------------- cohorts
def cohort_high_risk(raw: DataFrame, key: str = "row_id") -> DataFrame:
    return (raw.where((F.col("contract_type") == "Month-to-month")
                      & (F.col("payment_method") == "Electronic check") & (F.col(K.LABEL) == 1))
            .orderBy(key).limit(1))


def cohort_low_risk(raw: DataFrame, key: str = "row_id") -> DataFrame:
    return (raw.where(F.col("contract_type").isin("One year", "Two year")
                      & F.col("payment_method").isin("Bank transfer (automatic)", "Credit card (automatic)")
                      & (F.col(K.LABEL) == 0) & (F.col("months_with_provider") > 24))
            .orderBy(key).limit(1))


def cohort_medium_risk(raw: DataFrame, key: str = "row_id") -> DataFrame:
    return (raw.where((F.col("contract_type") == "One year")
                      & F.col("months_with_provider").between(12, 36))
            .orderBy(key).limit(1))


COHORTS = [
    ("high_risk_customer", "contract Month-to-month, payment Electronic check, churned", True, cohort_high_risk),
    ("low_risk_customer", "contract of one or two years, automatic payment, over 24 months, not churned", False, cohort_low_risk),
    ("medium_risk_customer", "contract One year, 12 to 36 months", None, cohort_medium_risk),
]


def cohort_export(raw: DataFrame, key: str = "row_id") -> DataFrame:
    """One JSON document per cohort: features without ids or label, nulls
    omitted (``to_json`` drops null fields)."""
    feats = [c for c in raw.columns if c not in (K.LABEL, "account_id", "customer_hash", key)]
    parts = None
    for name, desc, expected, fn in COHORTS:
        d = fn(raw, key).select(
            F.lit(name).alias("name"), F.lit(desc).alias("description"),
            F.to_json(F.struct(*feats)).alias("features"),
            F.lit(expected).cast("boolean").alias("expected_churn"),
            (F.col(K.LABEL) == 1).alias("actual_churned"))
        parts = d if parts is None else parts.unionByName(d)
    return parts
