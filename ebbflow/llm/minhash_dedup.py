"""MinHash near-dedup with odd sketches.

1. A task names the distinct word shingles of each document, folds their
   MinHash samples into band keys and into an odd sketch: a bitmap in which
   every sample flips one bit.  Two bitmaps' XOR population count p estimates
   the samples that differ, -(bits/2) ln(1 - 2p/bits), precisely when
   similarity is high.
2. Documents with equal shingle sets form one class (128-bit set hash);
   only the least id of a class goes on.
3. A band key shared by several classes makes them candidates.  First every
   class is paired with the least class of its bucket (a star: linear in the
   bucket).  Pairs whose sketches can't reach the threshold go; the rest are
   confirmed on the full shingle sets.
4. Members of a bucket that the star left in another component than the
   bucket's centre are compared with the whole bucket, so no candidate pair
   across components is left out.  This is done in cells (a block of such
   members against a block of the bucket) inside tasks: first by sketches;
   the components of the pairs that pass are small groups, in which cells
   then count all intersections on the full sets.  Cells send on spanning
   forests, never their pairs.  Confirmed links of both steps give the
   components.

With 32 bands of 5 rows a pair at similarity 0.85 is missed with
probability 1e-8, at 0.8 with 3e-6; the sketch filter allows 5 standard
deviations.

Edge cases: null or empty texts have no shingles and link with nothing;
fewer words than a shingle make one shingle of the whole text; a row
without a doc_id links with nothing, as no link could name it; repeated
rows are members of their class like any copy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components, forest, saved
from .textarrays import CHUNK_BYTES, NULL_ID, doc_key, lists, mix64, slices, small_batches, span_hash, unused, word_arrays

BANDS, ROWS = 32, 5
SKETCH_BITS = 512
CELL, CELL_SHINGLES = 1024, 400_000  # documents, and shingles, of one side of a cell
CELL_ROWS = 64  # documents of a cell compared at once with its other side
_FACTORS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SALTS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
SIGNED = "oid long, n long, c1 long, c2 long, bands array<long>, sketch array<long>"


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle names of each text."""
    w = word_arrays(texts, lower=True)
    n = len(w.name)
    out = []
    if n:
        at = np.arange(n)
        end = w.first[w.row + 1]
        names = span_hash(w.name, at, np.minimum(at + width, end))
    for a, b in zip(w.first, w.first[1:]):
        out.append(np.unique(names[a: max(a + 1, b - width + 1)]) if b > a else np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of a non-empty shingle set."""
    low = np.full(len(_FACTORS), np.uint64(0xFFFFFFFFFFFFFFFF))
    for a in range(0, len(shingles), 2048):
        np.minimum(low, (_FACTORS[:, None] * shingles[None, a: a + 2048]).min(axis=1), out=low)
    return low


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples as 64-bit words."""
    spot = (mix64(samples ^ _SALTS) % np.uint64(SKETCH_BITS)).astype(np.int64)
    return np.packbits((np.bincount(spot, minlength=SKETCH_BITS) & 1).astype(np.uint8)).view(np.int64)


def most_flips(threshold: float) -> int:
    """Largest XOR population count that the threshold, less 5 standard deviations, allows."""
    k = BANDS * ROWS
    low = max(0.0, threshold - 5 * math.sqrt(threshold * (1 - threshold) / k))
    differ = 2 * k * (1 - low)
    p = SKETCH_BITS / 2 * (1 - math.exp(-2 * differ / SKETCH_BITS))
    return min(SKETCH_BITS, int(p + 2.5 * math.sqrt(SKETCH_BITS) / 2))


def _sign(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, c1, c2, bands, sketches = [], [], [], [], []
                for s in shingle_sets(part.column("text"), width):
                    n.append(len(s))
                    if not len(s):
                        c1.append(0), c2.append(0), bands.append(np.zeros(0, np.int64)), sketches.append(np.zeros(0, np.int64))
                        continue
                    c1.append(mix64(s + np.uint64(11)).sum(dtype=np.uint64))
                    c2.append(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
                    low = signature(s)
                    rows = (mix64(low + _SALTS).reshape(BANDS, ROWS) * _FACTORS[:ROWS]).sum(axis=1, dtype=np.uint64)
                    bands.append(mix64(rows + _SALTS[:BANDS]).view(np.int64))
                    sketches.append(odd_sketch(low))
                flat = lambda parts: lists(np.concatenate(parts), [len(x) for x in parts], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column("oid"), pa.array(n, pa.int64()), pa.array(np.array(c1, np.uint64).view(np.int64)),
                    pa.array(np.array(c2, np.uint64).view(np.int64)), flat(bands), flat(sketches),
                ], names=["oid", "n", "c1", "c2", "bands", "sketch"])
    return sign


def _confirm(width: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ta", CHUNK_BYTES // 2):
                left, right = shingle_sets(part.column("ta"), width), shingle_sets(part.column("tb"), width)
                ok = []
                for x, y in zip(left, right):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(ok))
    return confirm


def _sets(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = shingle_sets(part.column("text"), width)
                flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([part.column("oid"), lists(flat, [len(x) for x in found], pa.int64())], names=["oid", "shingles"])
    return sets


def _cells(work):
    """Runs ``work(columns) -> (a, b)`` on each cell; rows come sorted by cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(t: pa.Table) -> pa.RecordBatch:
            t = t.combine_chunks()
            cell = t.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            got = [work(t.slice(i, j - i).combine_chunks()) for i, j in zip(cuts, cuts[1:])]
            return pa.RecordBatch.from_arrays([pa.array([x for g in got for x, _ in g], pa.int64()), pa.array([y for g in got for _, y in g], pa.int64())],
                                              names=["a", "b"])
        held = None  # the last cell of a batch may go on in the next
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            cell = t.column("cell").to_numpy()
            last = int(np.searchsorted(cell, cell[-1]))
            if last:
                yield flush(t.slice(0, last))
            held = t.slice(last)
        if held is not None:
            yield flush(held)
    return run


def _sketch_cell(limit: int):
    def work(t: pa.Table) -> list[tuple[int, int]]:
        rep, comp, side = (t.column(c).to_numpy() for c in ("rep", "comp", "side"))
        bits = t.column("sketch").chunk(0).flatten().to_numpy().view(np.uint64).reshape(len(rep), -1)
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)

        def links():
            for k in range(0, len(x), CELL_ROWS):
                i = x[k: k + CELL_ROWS]
                p = np.bitwise_count(bits[i][:, None, :] ^ bits[y][None, :, :]).sum(axis=2, dtype=np.int32)
                u, v = np.nonzero((p <= limit) & (comp[i][:, None] != comp[y]))
                yield rep[i[u]], rep[y[v]]
        return forest(links())
    return work


def _exact_cell(percent: int):
    def work(t: pa.Table) -> list[tuple[int, int]]:
        rep, comp, side = (t.column(c).to_numpy() for c in ("rep", "comp", "side"))
        sets = t.column("shingles").chunk(0)
        size = np.diff(sets.offsets.to_numpy())
        flat = sets.flatten().to_numpy()
        owner = np.repeat(np.arange(len(rep)), size)
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(x) or not len(y):
            return []
        place = np.empty(len(rep), np.int64)
        place[x], place[y] = np.arange(len(x)), np.arange(len(y))
        of_x = side[owner] == 0
        shared = np.intersect1d(flat[of_x], flat[~of_x])  # the others are in no intersection
        col = np.minimum(np.searchsorted(shared, flat), max(len(shared) - 1, 0))
        live = shared[col] == flat if len(shared) else np.zeros(len(flat), bool)
        both = np.zeros((len(x), len(y)), np.float32)  # counts below 2^24 are exact
        for k in range(0, len(shared), 2048):
            part = live & (col >= k) & (col < k + 2048)
            left, right = np.zeros((len(x), 2048), np.float32), np.zeros((len(y), 2048), np.float32)
            p, q = part & of_x, part & ~of_x
            left[place[owner[p]], col[p] - k] = 1
            right[place[owner[q]], col[q] - k] = 1
            both += left @ right.T

        def links():
            for k in range(0, len(x), CELL_ROWS):
                i, n = x[k: k + CELL_ROWS], both[k: k + CELL_ROWS].astype(np.int64)
                u, v = np.nonzero((100 * n >= percent * (size[i][:, None] + size[y] - n)) & (comp[i][:, None] != comp[y]))
                yield rep[i[u]], rep[y[v]]
        return forest(links())
    return work


def dealt(rows: DataFrame, group: str, parts: DataFrame) -> DataFrame:
    """Rows dealt to cells: the block of a row marked ``apart`` (side 0) meets every block of its whole group (side 1).

    ``parts`` has (group, px, py), the numbers of blocks of either side.
    """
    r = rows.join(parts, group)
    block = lambda n: F.pmod(F.xxhash64("rep"), F.col(n))
    x = r.where("apart").withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("py") - 1))).withColumn("i", block("px")).withColumn("side", F.lit(0))
    y = r.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("px") - 1))).withColumn("j", block("py")).withColumn("side", F.lit(1))
    both = x.unionByName(y).withColumn("cell", F.xxhash64(group, "i", "j"))
    return both.drop(group, "i", "j", "px", "py", "apart").repartition("cell").sortWithinPartitions("cell")


def flips(x: Column, y: Column) -> Column:
    return sum((F.bit_count(x[k].bitwiseXOR(y[k])) for k in range(1, SKETCH_BITS // 64)), F.bit_count(x[0].bitwiseXOR(y[0])))


def confirmed(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose full shingle sets reach the threshold."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("oid")).distinct()
    texts = saved(docs.select(doc_key().alias("oid"), "text").hint("merge").join(ids, "oid", "left_semi").dropDuplicates(["oid", "text"]), "minhash-texts")
    both = (pairs.join(texts.select(F.col("oid").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("oid").alias("b"), F.col("text").alias("tb")), "b"))
    return both.select("a", "b", "ta", "tb").mapInArrow(_confirm(width, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the least doc_id reachable over links, a link being
    100 * |intersection| >= percent * |union| of the shingle sets.
    """
    small_batches(docs.sparkSession)
    signed = saved(docs.select(doc_key().alias("oid"), "text").mapInArrow(_sign(width), SIGNED), "minhash-signed")
    full = signed.where(f"n > 0 AND oid < {NULL_ID}")
    classes = full.groupBy("c1", "c2", "n").agg(F.min("oid").alias("rep"))
    member = saved(full.select("oid", "c1", "c2", "n").join(classes, ["c1", "c2", "n"]).select("oid", "n", "rep"), "minhash-member")
    reps = saved(full.join(member.where("oid = rep").select("oid").distinct(), "oid", "left_semi")
                 .dropDuplicates(["oid", "c1", "c2"]).select(F.col("oid").alias("rep"), "bands", "sketch"), "minhash-reps")
    sketch = reps.select("rep", "sketch")
    limit = most_flips(percent / 100)

    banded = reps.select("rep", F.explode("bands").alias("band"))
    centres = banded.groupBy("band").agg(F.min("rep").alias("centre"), F.count("*").alias("many")).where("many > 1").drop("many")
    shared = saved(banded.join(centres, "band"), "minhash-shared")  # buckets of several classes

    star = shared.where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct()
    star = saved(_near(star, sketch, limit), "minhash-star")
    links = saved(confirmed(docs, star, width, percent), "minhash-links")

    label = components(links)
    of = lambda name, out: label.select(F.col("node").alias(name), F.col("component").alias(out))
    bucket = (shared.join(of("rep", "lr"), "rep", "left").join(of("centre", "lc"), "centre", "left")
              .select("band", "rep", F.coalesce("lr", "rep").alias("comp"), F.coalesce("lc", "centre").alias("home")))
    bucket = bucket.withColumn("apart", F.col("comp") != F.col("home"))
    blocks = lambda n, size: F.ceil(n / size)
    parts = bucket.groupBy("band").agg(blocks(F.count_if("apart"), CELL).alias("px"), blocks(F.count("*"), CELL).alias("py")).where("px > 0")
    rows = dealt(bucket.drop("home").join(sketch, "rep"), "band", parts)
    near = saved(rows.mapInArrow(_cells(_sketch_cell(limit)), "a long, b long").distinct(), "minhash-near")
    if not near.isEmpty():
        links = links.unionAll(_across(docs, near, label, width, percent))
        label = components(links)
    found = (member.join(label.select(F.col("node").alias("rep"), "component"), "rep", "left")
             .select("oid", "n", F.coalesce("component", "rep").alias("comp")))
    found = found.unionAll(signed.where(f"n = 0 OR oid = {NULL_ID}").select("oid", "n", F.col("oid").alias("comp")))
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return found.select(back("oid").alias("doc_id"), F.col("n").alias("n_shingles"), back("comp").alias("component_id"),
                        (F.col("oid") == F.col("comp")).alias("kept"))


def _across(docs: DataFrame, near: DataFrame, label: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between different components within the groups that ``near(a, b)`` joins, on the full shingle sets."""
    node = components(near).select(F.col("node").alias("rep"), F.col("component").alias("team"))
    node = node.join(label.select(F.col("node").alias("rep"), "component"), "rep", "left").select("rep", "team", F.coalesce("component", "rep").alias("comp"))
    node = saved(node, "minhash-teams")
    texts = docs.select(doc_key().alias("oid"), "text").hint("merge").join(node.select(F.col("rep").alias("oid")).distinct(), "oid", "left_semi").dropDuplicates(["oid", "text"])
    sets = saved(texts.mapInArrow(_sets(width), "oid long, shingles array<long>").withColumnRenamed("oid", "rep"), "minhash-sets")
    rows = node.join(sets.select("rep", F.size("shingles").alias("n")), "rep")
    count = rows.groupBy("team", "comp").agg(F.count("*").alias("docs"), F.sum("n").alias("words"))
    most = count.groupBy("team").agg(F.max(F.struct("docs", "comp")).getField("comp").alias("home"))
    count = count.join(most, "team").groupBy("team", "home").agg(
        F.sum(F.when(F.col("comp") != F.col("home"), F.col("docs"))).alias("xd"), F.sum(F.when(F.col("comp") != F.col("home"), F.col("words"))).alias("xw"),
        F.sum("docs").alias("yd"), F.sum("words").alias("yw"))
    blocks = lambda d, w: F.greatest(F.ceil(F.col(d) / CELL), F.ceil(F.col(w) / CELL_SHINGLES))
    parts = count.where("xd > 0").select("team", blocks("xd", "xw").alias("px"), blocks("yd", "yw").alias("py"))
    node = node.join(most, "team").withColumn("apart", F.col("comp") != F.col("home")).drop("home").join(sets, "rep")
    return saved(dealt(node, "team", parts).mapInArrow(_cells(_exact_cell(percent)), "a long, b long").distinct(), "minhash-across")


def _near(pairs: DataFrame, sketch: DataFrame, limit: int) -> DataFrame:
    a = sketch.select(F.col("rep").alias("a"), F.col("sketch").alias("sa"))
    b = sketch.select(F.col("rep").alias("b"), F.col("sketch").alias("sb"))
    return pairs.join(a, "a").join(b, "b").where(flips(F.col("sa"), F.col("sb")) <= limit).select("a", "b")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that another of their group stands for.

    Rows equal in doc_id and text stay once; rows without a doc_id all stay;
    all columns stay, whatever their names.
    """
    key = unused(docs.columns, "__key")
    kept = near_duplicates(docs, width, percent).where("kept").select(F.col("doc_id").alias(key)).distinct()
    named = docs.where("doc_id IS NOT NULL").withColumn(key, F.col("doc_id").cast("long"))
    named = named.join(kept, key, "left_semi").dropDuplicates([key, "text"]).drop(key)
    return named.unionByName(docs.where("doc_id IS NULL"))
