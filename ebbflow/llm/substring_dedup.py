"""Substring dedup by recompression.

Every text is a sequence of word names.  Recompression rounds shorten it:
a round names maximal runs of one symbol, or pairs of a "left" and a
"right" symbol (a coin per symbol and round).  Names are hashes of what
they stand for, so each round names equal runs and pairs alike in all
documents without a shared dictionary.  Only symbols of bounded length
take part, so whether a symbol border falls between two words depends on
``CONTEXT`` words to either side alone: equal substrings get equal interior
borders wherever they stand.

A window of ``width`` words is represented by the interior border with the
least name (name = hash of the words around it).  Consecutive windows with
the same border form one segment, about seven windows long, and segments
are what Spark shuffles: equal windows always meet under the same border
name.  Within a border name

* a segment whose whole content occurs earlier repeats as a whole;
* segments that differ are compared window by window (window hashes travel
  with the segment), which verifies and delimits the repeat exactly;
* a border name with one segment repeats nothing.

Windows that a task has already seen earlier in its own slice of the input
are settled before the shuffle, so a passage held by a third of all
documents sends one row per slice.  Border names that a sample shows to be
frequent are shuffled by window instead of by border, and windows that it
shows to be frequent by window and a salt of the document: the earliest of
each salt are compared once more.  This changes only where rows are
compared, never the result.

Edge cases: null or empty texts have no words; texts under ``width`` words
keep all of them; rows equal in doc_id and text are one document (each loses
the words that any of them loses, none is earlier); rows without a doc_id are
documents of their own, as are other texts under one doc_id, and sort last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import saved
from .textarrays import keyed, mix64, slices, small_batches, span_hash, word_arrays

#: (what a round names, longest symbol in words that takes part)
ROUNDS = (("runs", 1), ("pairs", 1), ("pairs", 2))
CONTEXT = sum(n for _, n in ROUNDS)
HOT_NAMES = 4096  # most frequent border names of the sample that are dealt by window
HOT_WINDOWS = 65536  # most frequent of the windows dealt singly, which are salted by document
SAMPLE_DOCS = 4000
SALTS = 64
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
SEGMENTS = "key long, salt int, oid long, start int, win binary"
_TYPES = {"key": pa.int64(), "salt": pa.int32(), "oid": pa.int64(), "start": pa.int32(), "win": pa.binary()}
NAME_BYTES = 6  # bytes of a window hash that travel; they are compared under one 63-bit border name only


def recompress(name: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Word indices at which a top-level symbol begins."""
    n = len(name)
    begin = np.arange(n)
    for k, (kind, limit) in enumerate(ROUNDS):
        if len(begin) < 2:
            break
        size = np.diff(begin, append=n)
        short = size <= limit
        join = short[:-1] & short[1:] & (row[begin[:-1]] == row[begin[1:]])
        if kind == "runs":
            join &= name[:-1] == name[1:]
        else:
            right = (mix64(name ^ np.uint64(k + 1)) & np.uint64(1)).astype(bool)
            join &= ~right[:-1] & right[1:]
        head = np.ones(len(begin), bool)
        head[1:] = ~join
        at = np.flatnonzero(head)
        count = np.diff(at, append=len(begin)).astype(np.uint64)
        last = name[at + count.astype(np.int64) - 1]
        if kind == "runs":  # one symbol, so often
            named = mix64(name[at] + count * np.uint64(0xC2B2AE3D27D4EB4F))
        else:
            named = mix64(name[at] * np.uint64(3) + mix64(last + np.uint64(k)))
        name = np.where(count > 1, named, name[at])
        begin = begin[at]
    return begin


def segments(batch: pa.RecordBatch, width: int, hot: np.ndarray, hot_windows: np.ndarray = np.zeros(0, np.uint64)) -> pa.RecordBatch:
    """Segment rows, and rows with start -1: per document, the spans settled here."""
    batch = batch.take(pc.sort_indices(batch, sort_keys=[("oid", "ascending")]))
    oid = batch.column("oid").to_numpy()
    w = word_arrays(batch.column("text"))
    n = len(w.name)
    pos = np.arange(n) - w.first[w.row] if n else np.zeros(0, np.int64)
    at = np.flatnonzero(pos + width <= w.first[w.row + 1] - w.first[w.row]) if n else np.zeros(0, np.int64)
    if not len(at):
        return pa.RecordBatch.from_pydict({k: pa.array([], t) for k, t in _TYPES.items()})
    win = span_hash(w.name, at, at + width)
    # the earliest of equal windows in this slice; the others are repeats
    tied = len(oid) > 1 and bool((oid[1:] == oid[:-1]).any())
    order = np.lexsort((pos[at], oid[w.row[at]], win)) if tied else np.argsort(win, kind="stable")
    fresh = np.ones(len(at), bool)
    same = win[order][1:] == win[order][:-1]
    if tied:
        lead = np.maximum.accumulate(np.where(np.r_[True, ~same], np.arange(len(at)), 0))
        same &= ((oid[w.row[at[order]]] != oid[w.row[at[order[lead]]]]) | (pos[at[order]] != pos[at[order[lead]]]))[1:]
    fresh[order[1:][same]] = False
    # least interior border of each window
    border = np.full(n + 1, _NONE)
    b = recompress(w.name, w.row)
    b = b[(b >= CONTEXT) & (b <= n - CONTEXT)]
    border[b] = span_hash(w.name, b - CONTEXT, b + CONTEXT) >> np.uint64(1)
    least, off = border[at + CONTEXT].copy(), np.zeros(len(at), np.int64)
    for k in range(1, width - 2 * CONTEXT + 1):
        other = border[at + CONTEXT + k]
        lower = other < least
        least[lower] = other[lower]
        off[lower] = k
    lone = (least == _NONE) | np.isin(least, hot)  # dealt window by window
    least[lone] = mix64(win[lone] ^ np.uint64(0x5851F42D4C957F2D))
    anchor = at + off
    # spans of the repeats found here, one row per document
    rep = at[~fresh]
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, rep, 1)
    np.add.at(depth, rep + width, -1)
    gone = np.cumsum(depth[:-1]) > 0
    edge = gone.copy()
    edge[1:] &= ~(gone[:-1] & (w.row[1:] == w.row[:-1]))
    stop = gone.copy()
    stop[:-1] &= ~(gone[1:] & (w.row[1:] == w.row[:-1]))
    s, e = np.flatnonzero(edge), np.flatnonzero(stop) + 1
    span, span_row = (pos[s] << 32) | (e - s), w.row[s]
    rows, counts = np.unique(span_row, return_counts=True)
    # segments of the others
    at, win, least, anchor, lone = at[fresh], win[fresh], least[fresh], anchor[fresh], lone[fresh]
    begins = np.ones(len(at), bool)
    begins[1:] = (np.diff(at) != 1) | (anchor[1:] != anchor[:-1]) | (w.row[at[1:]] != w.row[at[:-1]]) | lone[1:] | lone[:-1]
    i = np.flatnonzero(begins)
    size = np.diff(i, append=len(at))
    first = at[i]
    short = np.ascontiguousarray(win.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - NAME_BYTES:])
    of = oid[w.row[first]]
    salt = np.where(lone[i] & np.isin(least[i], hot_windows), 1 + (mix64(of.astype(np.uint64)) % np.uint64(SALTS)).astype(np.int64), 0)
    bounds = np.concatenate([[0], np.cumsum(np.concatenate([size * NAME_BYTES, counts * 8]))]).astype(np.int32)
    packed = pa.py_buffer(short.tobytes() + span.astype("<i8").tobytes())
    return pa.RecordBatch.from_arrays([
        pa.array(np.r_[least[i], mix64(oid[rows].astype(np.uint64) + np.uint64(7))].view(np.int64), pa.int64()),
        pa.array(np.r_[salt, np.zeros(len(rows), np.int64)].astype(np.int32), pa.int32()),
        pa.array(np.r_[of, oid[rows]], pa.int64()),
        pa.array(np.r_[pos[first], np.full(len(rows), -1)].astype(np.int32), pa.int32()),
        pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), packed]),
    ], names=list(_TYPES))


def _scan(width: int, hot: list[int], hot_windows: list[int]):
    known, windows = (np.array(sorted(x), np.int64).view(np.uint64) for x in (hot, hot_windows))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = segments(part, width, known, windows)
                if out.num_rows:
                    yield out
    return scan


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            total, gone, sha, kept_text = [], [], [], []
            for text, spans, packed in zip(*(part.column(c).to_pylist() for c in ("text", "spans", "packed"))):
                words = (text or "").encode().split()
                total.append(len(words))
                spans = (spans or []) + [x for p in packed or [] for x in np.frombuffer(p, "<i8").tolist()]
                if spans:
                    keep = np.ones(len(words), np.uint8)
                    for span in spans:
                        keep[span >> 32: (span >> 32) + (span & 0xFFFFFFFF)] = 0
                    gone.append(len(words) - int(keep.sum()))
                    words = compress(words, keep.tolist())
                else:
                    gone.append(0)
                kept = b" ".join(words)
                sha.append(hashlib.sha256(kept).hexdigest())
                kept_text.append(kept.decode())
            out = [part.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()),
                   pa.array(kept_text, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def frequent(texts: DataFrame, width: int) -> tuple[list[int], list[int]]:
    """Border names that are frequent in a sample of documents, and windows that are so among those dealt singly then."""
    sample = texts.where(F.pmod(F.xxhash64("oid"), F.lit(100)) == 0).limit(SAMPLE_DOCS)

    def often(hot: list[int], most: int) -> list[int]:
        return [r["key"] for r in sample.mapInArrow(_scan(width, hot, []), SEGMENTS).where("start >= 0").groupBy("key").count()
                .where("count >= 8").orderBy(F.desc("count"), "key").limit(most).collect()]
    hot = often([], HOT_NAMES)
    return hot, often(hot, HOT_WINDOWS)


def repeated_spans(docs: DataFrame, width: int = 20, hot: tuple[list[int], list[int]] | None = None) -> DataFrame:
    """(oid, spans, packed) of ``docs(oid, text)``: per document the word spans that windows starting earlier also hold, as start << 32 | length;
    ``packed`` has such numbers as little-endian bytes.  ``hot``: names and windows to deal out more finely (``frequent`` of a sample unless given)."""
    if width <= 2 * CONTEXT:
        raise ValueError(f"width must exceed {2 * CONTEXT} words")
    small_batches(docs.sparkSession)
    texts = docs.select("oid", "text")
    s = texts.mapInArrow(_scan(width, *(hot or frequent(texts, width))), SEGMENTS).repartition("key", "salt").withColumn("seg", F.xxhash64("win"))
    by_key = Window.partitionBy("key", "salt")
    here = F.struct("oid", "start")
    s = (s.withColumn("lo", F.min("seg").over(by_key)).withColumn("hi", F.max("seg").over(by_key))
         .withColumn("lead", F.min(here).over(Window.partitionBy("key", "salt", "seg")))
         .withColumn("is_lead", F.col("lead") == here)
         .where("start < 0 OR NOT is_lead OR lo <> hi OR salt > 0"))
    n = (F.length("win") / NAME_BYTES).cast("int")

    def one(w, p, size, packed):
        return F.struct(w.cast("string").alias("w"), p.cast("int").alias("p"), size.cast("int").alias("size"), packed.cast("binary").alias("packed"))
    none = F.lit(None)
    span = F.when(F.col("start") < 0, F.array(one(none, F.lit(-1), F.lit(0), F.col("win")))) \
        .when(~F.col("is_lead"), F.array(one(none, F.col("start"), n + (width - 1), none))) \
        .otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda i: one(F.hex(F.col("win").substr(i * NAME_BYTES + 1, F.lit(NAME_BYTES))),
                                                                         F.col("start") + i, F.lit(width), none)))
    x = s.select("key", "salt", "oid", F.explode_outer(span).alias("x")).select("key", "salt", "oid", "x.*")
    spot = F.struct("oid", "p")
    least = F.min(F.when(F.col("w").isNotNull(), spot))
    repeats = F.col("w").isNull() | (F.col("lead") != spot)
    x = (x.withColumn("lead", least.over(Window.partitionBy("key", "salt", "w"))).withColumn("repeats", repeats).drop("lead")
         .where("repeats OR salt > 0"))
    x = saved(x, "repeated-spans")  # read twice: the texts are scanned once
    # the earliest of each salt: SALTS rows a frequent window at most
    leads = x.where("NOT repeats").withColumn("lead", least.over(Window.partitionBy("key", "w"))).where(F.col("lead") != spot)
    tested = x.where("repeats").unionAll(leads.drop("lead"))
    long = F.when(F.col("p") >= 0, F.shiftleft(F.col("p").cast("long"), 32) + F.col("size"))
    return tested.groupBy("oid").agg(F.collect_list(long).alias("spans"), F.collect_list("packed").alias("packed"))


def remove_repeats(docs: DataFrame, width: int = 20) -> DataFrame:
    """Per row of ``docs(doc_id, text, ..)``: doc_id, n_words, n_removed, kept_sha256, kept_text (kept words joined by one space)."""
    texts = keyed(docs.select("doc_id", "text"))
    return (texts.join(repeated_spans(texts, width), "oid", "left")
            .select(F.col("doc_id").cast("long").alias("doc_id"), "text", "spans", "packed")
            .mapInArrow(_strip, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"))
