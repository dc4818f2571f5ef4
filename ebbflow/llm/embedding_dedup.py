"""Embedding near-dedup: iterative quantisation, multi-index tables, exact rerank.

1. Unit vectors of a bounded sample (``FIT_ROWS``) fit a rotation: principal
   axes first, then alternating sign codes and Procrustes rotations, which
   balances the quantisation error over the bits.  Several rotations from
   different starts give as many bits as the tables need.
2. Every vector is indexed.  A code is cut into substrings of ``s`` bits, one
   table each; vectors that agree in a substring share a bucket.  s follows
   log2 of the number of vectors, so buckets keep their size; the number of
   tables follows from s so that a pair at the threshold (each bit differs
   with probability angle / pi) is missed with probability ``MISS``.
3. Buckets are dealt in cells: a bucket is hashed into blocks of about
   ``CELL`` vectors and every pair of blocks is a cell, so no task holds a
   whole bucket.  Only codes travel to the cells.  A cell compares them by
   Hamming distance, and names the vectors that have a partner within
   ``reach``, ``DEVIATIONS`` standard deviations above the mean at the
   threshold, which met it in no earlier table.
4. Only these go to their cell once more, with the original vector, and are
   reranked in double precision.  A pair counts in the first table in which
   it meets.  A cell sends on link counts and a spanning forest of its
   links, never the pairs.

Equal vectors are one class with a count, so a very common vector is one
entry.  Null vectors, zero vectors and vectors with null or non-finite
components link with nothing; so do vectors of different lengths with each
other; a null vec_id links with nothing; repeated rows are members of the
class of their vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import components, forest, saved

COSINE = 0.95
FIT_ROWS = 4096  # vectors that the rotation is fitted on
FIT_ROUNDS = 30
MISS = 0.002
CELL = 1024
DEVIATIONS = 5
#: rows of the table of buckets over ``CELL`` (three numbers each) that may be broadcast
BROADCAST_ROWS = 100_000


def fit_rotation(sample: np.ndarray, seed: int, bits: int) -> np.ndarray:
    """Iterative quantisation: a dims x bits projection whose signs are the code."""
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    _, _, axes = np.linalg.svd(sample - sample.mean(axis=0), full_matrices=True)
    axes = axes[:bits].T if dims >= bits else axes.T
    v = sample @ axes
    r = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))[0]
    for _ in range(FIT_ROUNDS):
        left, _, right = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (left @ right).T
    return axes @ r


def tables_for(rows: int, cosine: float) -> tuple[int, int]:
    """Bits of a substring, and the number of tables that keeps the miss rate."""
    bits = min(24, max(8, math.ceil(math.log2(max(rows, 2))) - 5))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree))


def codes(unit: np.ndarray, rotations: list[np.ndarray], bits: int, tables: int) -> np.ndarray:
    """rows x tables substrings of the codes."""
    signs = np.concatenate([(unit @ r >= 0) for r in rotations], axis=1)[:, : bits * tables]
    weight = (1 << np.arange(bits)).astype(np.int64)
    return (signs.reshape(len(unit), tables, bits) * weight).sum(axis=2)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def reach(bits: int, dims: int, cosine: float) -> int:
    """Largest Hamming distance of codes whose vectors are compared; bits beyond ``dims`` may repeat others."""
    p = math.acos(cosine) / math.pi
    return math.floor(bits * (p + DEVIATIONS * math.sqrt(p * (1 - p) / min(bits, dims))))


def pack(keys: np.ndarray, bits: int) -> np.ndarray:
    """rows x tables substrings as rows x words of 64 bits, table after table."""
    signs = (keys[:, :, None] >> np.arange(bits) & 1).astype(np.uint8).reshape(len(keys), -1)
    return np.packbits(np.pad(signs, ((0, 0), (0, -signs.shape[1] % 64))), axis=1)


def unpack(code: pa.Array, bits: int, tables: int) -> np.ndarray:
    """The substrings again."""
    raw = np.frombuffer(b"".join(code.to_pylist()), np.uint8).reshape(len(code), -1)
    signs = np.unpackbits(raw, axis=1)[:, : bits * tables].reshape(len(raw), tables, bits)
    return (signs * (1 << np.arange(bits)).astype(np.int64)).sum(axis=2)


def _index(rotations: list[np.ndarray], bits: int, tables: int, dims: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("embedding"), dims)
                c = codes(x / np.linalg.norm(x, axis=1, keepdims=True), rotations, bits, tables)
                code = pa.array([r.tobytes() for r in pack(c, bits)], pa.binary())
                keys = pa.FixedSizeListArray.from_arrays(pa.array(c.ravel().astype(np.int32), pa.int32()), tables).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column("rep"), code, keys], names=["rep", "code", "keys"])
    return index


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Rows sorted by cell, never cut within one, and where cells of two or more rows begin and end."""
    def cut(t: pa.Table):
        t = t.combine_chunks()
        cell = t.column("cell").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
        return t, [(i, j) for i, j in zip(cuts, cuts[1:]) if j - i > 1]

    held = None  # the last cell of a batch may go on in the next
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        cell = t.column("cell").to_numpy()
        last = int(np.searchsorted(cell, cell[-1]))
        if last:
            yield cut(t.slice(0, last))
        held = t.slice(last)
    if held is not None:
        yield cut(held)


def sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows to compare with each other; ``side`` is 0 or 1 across two blocks, 2 within one."""
    return np.flatnonzero(side != 1), np.flatnonzero(side != 0)


def near_codes(words: np.ndarray, keys: np.ndarray, side: np.ndarray, table: int, most: int) -> np.ndarray:
    """Rows of one cell with a partner at Hamming distance ``most`` or less that no earlier table brought together."""
    hit = np.zeros(len(words), bool)
    left, right = sides(side)
    for k in range(0, len(left), 512):
        i = left[k: k + 512]
        distance = np.zeros((len(i), len(right)), np.uint16)
        for w in range(words.shape[1]):
            distance += np.bitwise_count(words[i, w, None] ^ words[None, right, w])
        x, y = np.nonzero(distance <= most)
        x, y = i[x], right[y]
        if side[0] == 2:
            x, y = x[x < y], y[x < y]
        first = np.ones(len(x), bool)
        for t in range(table):
            first &= keys[x, t] != keys[y, t]
        hit[x[first]] = hit[y[first]] = True
    return hit


def _prune(bits: int, tables: int, most: int):
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cells in whole_cells(batches):
            side, table = (t.column(c).to_numpy() for c in ("side", "table"))
            code = t.column("code").combine_chunks()
            keys = unpack(code, bits, tables)
            words = np.frombuffer(b"".join(code.to_pylist()), np.uint64).reshape(len(keys), -1)
            hit = np.zeros(len(keys), bool)
            for i, j in cells:
                hit[i:j] = near_codes(words[i:j], keys[i:j], side[i:j], int(table[i]), most)
            for b in t.filter(pa.array(hit)).to_batches():
                yield b
    return prune


def cell_links(rep, many, unit, keys, side, table, cosine):
    """Link counts and forest of one cell."""
    a_all, b_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    left, right = sides(side)
    for k in range(0, len(left), 512):
        i = left[k: k + 512]
        x, y = np.nonzero(unit[i] @ unit[right].T >= cosine)
        x, y = i[x], right[y]
        pick = rep[x] < rep[y] if side[0] == 2 else rep[x] != rep[y]
        x, y = x[pick], y[pick]
        first = ~(keys[x, :table] == keys[y, :table]).any(axis=1)  # no earlier table has this pair
        x, y = x[first], y[first]
        a_all.append(x), b_all.append(y)
    a, b = np.concatenate(a_all), np.concatenate(b_all)
    if not len(a):
        return [], [], []
    n = np.bincount(a, many[b], len(rep)) + np.bincount(b, many[a], len(rep))
    linked = np.flatnonzero(n)
    tree = forest([(a, b)])
    return linked, n[linked].astype(np.int64), tree


def _rerank(dims: int, bits: int, tables: int, cosine: float):
    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cells in whole_cells(batches):
            rep, many, side, table = (t.column(c).to_numpy() for c in ("rep", "many", "side", "table"))
            x = matrix(t.column("embedding").combine_chunks(), dims)
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            keys = unpack(t.column("code").combine_chunks(), bits, tables)
            a, b, n = [], [], []
            for i, j in cells:
                who, count, tree = cell_links(rep[i:j], many[i:j], unit[i:j], keys[i:j], side[i:j], int(table[i]), cosine)
                a += rep[i:j][who].tolist() if len(who) else []
                b += [None] * len(who)
                n += count.tolist() if len(who) else []
                for x0, y0 in tree:
                    a.append(int(rep[i + x0])), b.append(int(rep[i + y0])), n.append(0)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])
    return rerank


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that can link."""
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType(), vectors.schema["embedding"].dataType.containsNull)
    kind = "float" if single else "double"  # single precision travels as such
    v = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast(kind) + F.lit(0.0).cast(kind)).alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.coalesce(fine, F.lit(False))).where(F.exists("embedding", lambda x: x != 0.0))


def links(vectors: DataFrame, cosine: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """Classes of equal vectors (vec_id, rep, many), and (a, b, n): edges, or link counts where b is null."""
    spark = vectors.sparkSession
    v = usable(vectors)
    groups = v.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many"))
    groups = saved(groups.withColumn("dims", F.size("embedding")), "vector-groups")
    name = F.xxhash64("embedding")
    # members by hash, confirmed on the vector itself
    named = groups.select(name.alias("h"), F.col("embedding").alias("e"), "rep", "many")
    member = v.withColumn("h", name).join(named, "h").where("embedding = e").select("vec_id", "rep", "many")
    out = None
    for row in groups.groupBy("dims").count().collect():  # one index per vector length
        g = groups.where(F.col("dims") == row["dims"])
        dims = row["dims"]
        bits, tables = tables_for(row["count"], cosine)
        sample = [r[0] for r in g.orderBy(F.xxhash64("rep")).limit(FIT_ROWS).select("embedding").collect()]
        x = np.array(sample, np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        rotations = [fit_rotation(x, k, dims) for k in range(math.ceil(bits * tables / dims))]
        index = g.mapInArrow(_index(rotations, bits, tables, dims), "rep long, code binary, keys array<int>")
        rows = saved(index, "vector-codes").select("rep", "code", F.posexplode("keys").alias("table", "key"))
        large = rows.groupBy("table", "key").agg(F.count("*").alias("size")).where(F.col("size") > CELL)
        large = saved(large.select("table", "key", F.ceil(F.col("size") / CELL).alias("parts")), "vector-buckets")
        rows = rows.join(F.broadcast(large) if large.count() <= BROADCAST_ROWS else large, ["table", "key"], "left")
        rows = rows.withColumn("parts", F.coalesce("parts", F.lit(1).cast("long"))).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")))
        # a vector of block p is on side 0 of cells (p, q > p), on side 1 of (q < p, p), on side 2 of (p, p)
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
        rows = rows.select("rep", "code", "table", "key", "part", other)
        rows = rows.withColumn("side", F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1))
        cell = F.xxhash64("table", "key", F.least("part", "other"), F.greatest("part", "other"))
        rows = rows.select("rep", "code", "table", "side", cell.alias("cell")).repartition("cell").sortWithinPartitions("cell")
        near = rows.mapInArrow(_prune(bits, tables, reach(bits * tables, dims, cosine)), rows.schema)
        near = saved(near, "vector-near").join(g.select("rep", "many", "embedding"), "rep")
        got = near.repartition("cell").sortWithinPartitions("cell").mapInArrow(_rerank(dims, bits, tables, cosine), "a long, b long, n long")
        out = got if out is None else out.unionByName(got)
    if out is None:
        out = spark.createDataFrame([], "a long, b long, n long")
    return member, saved(out, "vector-links")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per row of ``vectors(vec_id, embedding, ..)``: vec_id, n_links, component_id, kept."""
    member, found = links(vectors, cosine)
    label = components(found.where("b IS NOT NULL").select("a", "b"))
    count = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    reps = member.join(count, "rep", "left").join(label.select(F.col("node").alias("rep"), "component"), "rep", "left")
    known = reps.select("vec_id", (F.col("many") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("c"))
    known = known.groupBy(F.col("vec_id").alias("id")).agg(F.max("n").alias("n"), F.min("c").alias("c"))
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(known, F.col("vec_id") == F.col("id"), "left")
    c = F.coalesce("c", "vec_id")
    return v.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), c.alias("component_id"),
                    F.coalesce(F.col("vec_id") == c, F.lit(True)).alias("kept"))
