"""Spelling variants: words one edit apart, grouped under the commoner spelling.

1. Words of whole texts are counted in the tasks and then by Spark, with
   map-side combine (``word_counts``).
2. Two words one edit apart, the longer of M code points, share a prefix and
   a suffix of M - 1 code points together, so they share the first or the
   last M // 2.  Every word is entered under both halves, once as the longer
   and once as the shorter word of a pair (four rows a word).
3. The words under one half are dealt in blocks of ``BLOCK`` and pairs of
   blocks are tiles, so no task holds a whole half however common it is.  A
   tile compares padded code-point matrices, left-aligned for the length of
   the common prefix and right-aligned for that of the common suffix;
   prefix + suffix >= M - 1 is a single edit (``edits``).  A pair that shares
   its first half is not counted again under the last half.  Tiles send on a
   count and the best near word of each word, never pairs.
4. ``form`` leads to a word at least five times as common, so chains are
   short (27 steps at most, as counts fit a long) and ``roots`` follows them
   by doubling.

Edge cases: null and empty texts have no words; a null doc_id is written as
``null`` where the id enters a checksum; repeated rows count each; runs of
any length are words; an empty table returns no row; other columns are
never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import saved
from .textarrays import LOWER, buffers, runs, slices, small_batches

LEAST_LENGTH, LEAST_COUNT, RATIO, DROP_EVERY = 6, 5, 5, 199
BLOCK = 1024  # words of a block; a tile is two blocks
TILE_ROWS = 128  # rows of a tile compared at once
LONG_RUN = 48  # bytes; the checksums of longer runs are taken one by one
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0xEDB88320) ^ (t >> 1), t >> 1)
    return t


_CRC = _crc_table()


def letters(data: np.ndarray) -> np.ndarray:
    """True for the bytes of A-Z, a-z and U+00C0 to U+00FF in UTF-8."""
    lead = data == 0xC3
    out = _LETTER[data] | lead
    out[1:] |= lead[:-1]
    return out


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """crc32 of data[start:end] for many runs at once, each going on from ``seed``."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    order = order[np.searchsorted(-size[order], -LONG_RUN):]
    state = seed[order] ^ np.uint32(0xFFFFFFFF)
    s, n = start[order], size[order]
    for t in range(int(n[0]) if len(n) else 0):
        live = np.searchsorted(-n, -t)  # the runs longer than t come first
        state[:live] = _CRC[(state[:live] ^ data[s[:live] + t]) & np.uint32(255)] ^ (state[:live] >> np.uint32(8))
    out = np.empty(len(size), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(size > LONG_RUN):
        out[k] = zlib.crc32(data[start[k]: end[k]], int(seed[k]))
    return out


def counted(texts: pa.Array, ids: list) -> tuple[pa.Array, pa.Array]:
    """Words of the texts, and their counts; a word may come twice."""
    data, offsets = buffers(pc.fill_null(texts, "") if texts.null_count else texts)
    mask = letters(data)
    data = LOWER[data]
    start, end = runs(mask, offsets)
    row = np.searchsorted(offsets[1:], start, side="right")
    prefix = np.array([zlib.crc32(f"{'null' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = checksums(data, start, end, prefix[row])
    hit = h % DROP_EVERY == 0
    # code points of a run: bytes that do not continue one
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    size = lead[end] - lead[start]
    some = ~hit & (size >= LEAST_LENGTH)
    s, n = start[some], (end - start)[some]
    total = np.concatenate([[0], np.cumsum(n)])
    flat = data[np.repeat(s - total[:-1], n) + np.arange(int(total[-1]))]
    whole = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(total.astype(np.int64)), pa.py_buffer(flat))
    got = pc.value_counts(whole)
    short = []
    for k in np.flatnonzero(hit & (size > LEAST_LENGTH)):
        w = data[start[k]: end[k]].tobytes().decode()
        at = int(h[k]) % len(w)
        short.append(w[:at] + w[at + 1:])
    return (pa.concat_arrays([got.field(0).cast(pa.string()), pa.array(short, pa.string())]),
            pa.concat_arrays([got.field(1), pa.array([1] * len(short), pa.int64())]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            word, n = counted(part.column("text"), part.column("doc_id").to_pylist())
            yield pa.RecordBatch.from_arrays([word, n], names=["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of at least ``LEAST_LENGTH`` code points that occur ``LEAST_COUNT`` times or more."""
    small_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text <> ''")
    words = d.mapInArrow(_count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def code_points(words: list[str], width: int, right: bool) -> np.ndarray:
    """words x width code points, padded with 0 at the end, or in front."""
    out = np.zeros((len(words), width), np.int32)
    for k, w in enumerate(words):
        p = np.frombuffer(w.encode("utf-32-le"), np.int32)
        out[k, width - len(p):] = p if right else 0
        if not right:
            out[k, :len(p)] = p
    return out


def common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every row of ``a`` and of ``b``, at most ``most`` (of the row of ``b``)."""
    out = np.zeros((len(a), len(b)), np.int32)
    alive = np.ones(out.shape, bool)
    for t in range(a.shape[1]):
        alive &= a[:, t, None] == b[None, :, t]
        if not alive.any():
            break
        out += alive
    return np.minimum(out, most)


def edits(longer: list[str], other: list[str], width: int, half: int, suffix_side: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of ``longer``, all of ``width`` code points, and of ``other``, of ``width`` or one less) one edit apart.

    On the suffix side, pairs that share their first ``half`` are left out.
    """
    la, lb = code_points(longer, width, False), code_points(other, width, False)
    ra, rb = code_points(longer, width, True)[:, ::-1], code_points(other, width, True)[:, ::-1]
    size = np.array([len(w) for w in other], np.int32)
    a_all, b_all = [], []
    for k in range(0, len(longer), TILE_ROWS):
        prefix = common(la[k: k + TILE_ROWS], lb, size)
        near = prefix < width  # else the same word
        if suffix_side:
            near &= prefix < half
        near &= prefix + common(ra[k: k + TILE_ROWS], rb, size) >= width - 1
        a, b = np.nonzero(near)
        a_all.append(a + k), b_all.append(b)
    return np.concatenate(a_all), np.concatenate(b_all)


def tile(words: list[str], n: np.ndarray, side: np.ndarray, width: int, half: int, suffix_side: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with near words in this tile, how many, and the best of them; ``side`` is 0 or 1 across two blocks, 2 within one."""
    long = np.array([len(w) for w in words]) == width
    found = []
    for first, second in ((0, 1), (1, 0)) if side[0] != 2 else ((2, 2),):
        i = np.flatnonzero(long & (side == first))
        j = np.flatnonzero(side == second)
        if first == 1:  # longer words of both blocks met in the other order
            j = j[~long[j]]
        if len(i) and len(j):
            a, b = edits([words[k] for k in i], [words[k] for k in j], width, half, suffix_side)
            a, b = i[a], j[b]
            if first == 2:
                once = ~long[b] | (a < b)
                a, b = a[once], b[once]
            found += [(a, b), (b, a)]
    who = np.concatenate([a for a, _ in found]) if found else np.zeros(0, int)
    other = np.concatenate([b for _, b in found]) if found else np.zeros(0, int)
    order = np.array(sorted(range(len(words)), key=lambda k: (-int(n[k]), words[k])), np.int64)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    best = np.full(len(words), len(words), np.int64)
    np.minimum.at(best, who, rank[other])
    count = np.bincount(who, minlength=len(words))
    some = np.flatnonzero(count)
    return some, count[some], order[best[some]]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(t: pa.Table) -> pa.RecordBatch:
        cell = t.column("cell").to_numpy()
        words, n, side = t.column("word").to_pylist(), t.column("n").to_numpy(), t.column("side").to_numpy()
        width, last = t.column("width").to_numpy(), t.column("last").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
        out: list = []
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                m = int(width[a])
                who, count, best = tile(words[a:b], n[a:b], side[a:b], m, m // 2, bool(last[a]))
                out += [(words[a + i], int(c), words[a + j], int(n[a + j])) for i, c, j in zip(who.tolist(), count.tolist(), best.tolist())]
        cols = list(zip(*out)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                                           pa.array(cols[3], pa.int64())], names=["word", "near", "best", "best_n"])
    held = None  # rows are sorted by tile: the last tile of a batch may go on in the next
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


def near_words(counts: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of the words that have near words."""
    size = F.length("word")
    sides = F.array(*[F.struct((size + up).alias("width"), F.lit(last).alias("last")) for up in (0, 1) for last in (False, True)])
    rows = counts.select("word", "n", F.explode(sides).alias("s")).select("word", "n", "s.*")
    half = F.floor(F.col("width") / 2).cast("int")
    rows = rows.withColumn("half", F.when(F.col("last"), F.right(F.col("word"), half)).otherwise(F.left(F.col("word"), half)))
    key = ["width", "last", "half"]
    # a half needs a longer word, and another word, to hold a pair
    sizes = (rows.groupBy(*key).agg(F.count("*").alias("size"), F.max(F.length("word")).alias("longest"))
             .where("size > 1 AND longest = width").select(*key, F.ceil(F.col("size") / BLOCK).alias("parts")))
    rows = rows.join(sizes, key).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")))
    # a word of block p is on side 0 of tiles (p, q > p), on side 1 of (q < p, p), on side 2 of (p, p)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = rows.withColumn("side", F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1))
    cell = F.xxhash64(*key, F.least("part", "other"), F.greatest("part", "other"))
    rows = rows.select("word", "n", "width", "last", "side", cell.alias("cell"))
    # a tile is much work for few bytes: with a number given, partitions are not merged by size
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "cell").sortWithinPartitions("cell")
    got = rows.mapInArrow(_tiles, "word string, near long, best string, best_n long")
    return got.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))).alias("s")) \
        .select("word", "n_near", F.col("s.w").alias("best"), (-F.col("s.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of ``forms(word, form)``."""
    up = saved(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("more")), "forms")
    while up.where("more").limit(1).count():
        step = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        nxt = up.join(step, "root", "left")
        up = saved(nxt.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")), "forms")
    return up.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """Per word of ``docs(doc_id, text, ..)``: word, form, root, n, n_near, form_n."""
    counts = saved(word_counts(docs), "word-counts")
    near = saved(near_words(counts), "near-words")
    all_ = counts.join(near, "word", "left")
    formed = F.col("best_n") >= RATIO * F.col("n")
    all_ = all_.select("word", F.when(formed, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                       F.when(formed, F.col("best_n")).alias("form_n"))
    all_ = saved(all_, "word-forms")
    chains = roots(all_.where("form IS NOT NULL"))
    return all_.join(chains, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
