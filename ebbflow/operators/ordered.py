"""Exact ordered prefix sums without a single-task window.

Several operators need "how much lies before me in sort order": ROC/PR
running sums, exact ranks, exact quantiles.  ``Window.orderBy(...)`` without
a partition sends everything to one task, and a label-partitioned window
makes one task per class — a third of all rows or more in one task.
Instead, where a group has more than ``ROWS_PER_BUCKET`` rows:

1. rows are range-partitioned by (group, order) into buckets of about that
   many rows (Spark samples the bounds, so buckets are even whatever the
   distribution of the values and the number of groups) and written once to
   the shared folder with their bucket number;
2. totals per (bucket, group) give the offsets of the groups that reach
   into more than one bucket: at most two rows a bucket, broadcast back;
3. a window partitioned by (group, bucket) adds the running sum inside.

Buckets follow the sort order, so the result is exact whatever the bounds
are; the bounds only balance the work.  Callers pre-aggregate to one row
per distinct order value, so a hot value is a single row and cannot
overload a bucket.

When every group fits in one bucket (small data) the plan is one shuffle
and one window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 65_536   # x 2M rows: up to ~1.3e11 rows stay at target size


def ordered_prefix(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Sequence[str],
    descending: bool = False,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add ``<m>_before`` (sum of ``m`` over rows strictly earlier in
    ``order`` within the same ``keys`` group) and ``<m>_total`` (group sum)
    for every measure ``m``.

    ``order`` must not be null.  Rows with identical full order keys are
    ordered arbitrarily, so callers pass one row per distinct key.
    """
    keys, order, measures = list(keys), list(order), list(measures)
    rows_per_bucket = rows_per_bucket or ROWS_PER_BUCKET  # read at call time (tunable)
    ob = [F.col(o).desc() if descending else F.col(o).asc() for o in order]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.sum("_n").alias("rows"), F.max("_n").alias("largest"))
    size = counts.first()  # two numbers

    if (size["largest"] or 0) <= rows_per_bucket:
        part = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        prev = part.orderBy(*ob).rowsBetween(Window.unboundedPreceding, -1)
        whole = part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return df.select(
            "*",
            *[F.coalesce(F.sum(m).over(prev), F.lit(0)).alias(f"{m}_before") for m in measures],
            *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures])

    buckets = min(MAX_BUCKETS, math.ceil(size["rows"] / rows_per_bucket))
    path = scratch_path(df.sparkSession, "ordered")
    ranged = df.repartitionByRange(buckets, *[F.col(k).asc() for k in keys], *ob).withColumn("_bucket", F.spark_partition_id())
    ranged.write.parquet(path)
    b = df.sparkSession.read.schema(ranged.schema).parquet(path)
    # (bucket, group) totals; a group in one bucket alone needs no offset
    tot = b.groupBy(*keys, "_bucket").agg(*[F.sum(m).alias(f"_bt_{m}") for m in measures])
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))  # at most one row a bucket for a group
    wall = wk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wprev = wk.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(
        *[F.col(k).alias(f"_ok_{k}") for k in keys], F.col("_bucket").alias("_ob"), F.count(F.lit(1)).over(wall).alias("_parts"),
        *[F.coalesce(F.sum(f"_bt_{m}").over(wprev), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_bt_{m}").over(wall).alias(f"_gt_{m}") for m in measures]).where("_parts > 1").drop("_parts")
    cond = F.col("_bucket") == F.col("_ob")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_ok_{k}"))
    b = b.join(F.broadcast(offs), cond, "left")  # at most two rows a bucket: the groups at its ends

    part = Window.partitionBy(*keys, "_bucket")
    win = part.orderBy(*ob).rowsBetween(Window.unboundedPreceding, -1)
    whole = part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = b.select(
        "*",
        *[(F.coalesce(F.col(f"_off_{m}"), F.lit(0)) + F.coalesce(F.sum(m).over(win), F.lit(0))).alias(f"{m}_before")
          for m in measures],
        *[F.coalesce(F.col(f"_gt_{m}"), F.sum(m).over(whole)).alias(f"{m}_total") for m in measures])
    return out.drop("_bucket", "_ob", *[f"_ok_{k}" for k in keys],
                    *[f"_off_{m}" for m in measures], *[f"_gt_{m}" for m in measures])


def exact_ranks(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                rows_per_bucket: int | None = None) -> DataFrame:
    """``row_number()`` over ``partition by keys order by order`` (as
    ``_rank``, 1-based) plus ``_group_rows``, without a per-group single
    task.  ``order`` must be unique within a group."""
    pre = ordered_prefix(df.withColumn("_one", F.lit(1)), keys, order, ["_one"],
                         rows_per_bucket=rows_per_bucket)
    return (pre.withColumn("_rank", F.col("_one_before") + 1)
            .withColumnRenamed("_one_total", "_group_rows")
            .drop("_one", "_one_before"))


def lerp(lo: Column, hi: Column, t: Column) -> Column:
    """numpy's linear interpolation (exact at both ends)."""
    d = hi - lo
    return F.when(t >= 0.5, hi - d * (1 - t)).otherwise(lo + d * t)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    qs: Sequence[float],
    names: Sequence[str] | None = None,
    rows_per_bucket: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles of ``value`` per ``keys`` group, nulls
    and NaN ignored (pandas ``quantile`` semantics), exact at any scale.

    Works on per-value counts, so no task holds a group's values: one
    partial aggregate, the bucketed prefix sums, then at most
    ``2 x len(qs)`` rows per group reach the final aggregate.  With
    ``weight`` a row stands for that many equal values (a table that is
    counted already).  Output: ``keys..., n, <name>...``.
    """
    keys = list(keys)
    names = list(names or [f"q{int(round(q * 100))}" for q in qs])
    v = F.col(value)
    counts = (df.where(v.isNotNull() & ~F.isnan(v.cast("double")))
              .groupBy(*keys, value).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_cnt")))
    pre = ordered_prefix(counts, keys, [value], ["_cnt"], rows_per_bucket=rows_per_bucket)
    n = F.col("_cnt_total")
    hits, picks = [], []
    start, end = F.col("_cnt_before"), F.col("_cnt_before") + F.col("_cnt")
    for q, nm in zip(qs, names):
        pos = (n - 1).cast("double") * F.lit(float(q))
        r_lo, r_hi = F.floor(pos), F.ceil(pos)
        in_lo = (start <= r_lo) & (r_lo < end)
        in_hi = (start <= r_hi) & (r_hi < end)
        hits += [in_lo, in_hi]
        picks += [F.when(in_lo, v).alias(f"_lo_{nm}"), F.when(in_hi, v).alias(f"_hi_{nm}"),
                  (pos - r_lo).alias(f"_t_{nm}")]
    hit = hits[0]
    for h in hits[1:]:
        hit = hit | h
    sel = pre.where(hit).select(*keys, n.alias("_n"), *picks)
    aggs = [F.max("_n").alias("n")]
    for nm in names:
        aggs += [F.max(f"_lo_{nm}").alias(f"_lo_{nm}"), F.max(f"_hi_{nm}").alias(f"_hi_{nm}"),
                 F.max(f"_t_{nm}").alias(f"_t_{nm}")]
    g = sel.groupBy(*keys).agg(*aggs) if keys else sel.agg(*aggs)
    return g.select(*keys, "n", *[
        lerp(F.col(f"_lo_{nm}").cast("double"), F.col(f"_hi_{nm}").cast("double"),
             F.col(f"_t_{nm}")).alias(nm) for nm in names])
