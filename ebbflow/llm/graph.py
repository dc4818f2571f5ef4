"""Connected components of a distributed edge table."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.session import scratch_path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes a table into the shared folder and reads it back: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forest(links: Iterable[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """A spanning forest of the links a-b, which come in blocks (a, b)."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := up.setdefault(x, x)) != x:
            up[x] = up[p]
            x = p
        return x
    out = []
    for a, b in links:
        for x, y in zip(a.tolist(), b.tolist()):
            if (p := root(x)) != (q := root(y)):
                up[max(p, q)] = min(p, q)
                out.append((x, y))
    return out


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``: the least node reachable.

    Alternating large-star and small-star rounds: each node links its larger
    (then its smaller) neighbours to its least neighbour, until each
    component is one star.  A round is an aggregate with map-side combine
    and a join on the node, whose heavy partitions AQE can split; no
    neighbour list is gathered.  Self links and repeated edges are harmless;
    an empty table gives no rows; null ends are ignored.
    """
    e = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct())
    e = saved(e, "edges")
    mark = None
    for _ in range(max_rounds):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        e = saved(small, "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            roots = e.select(F.col("v").alias("node")).distinct()
            return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .unionAll(roots.select("node", F.col("node").alias("component"))))
        mark = tuple(now)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
