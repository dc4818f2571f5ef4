"""Word arrays: a column of texts as flat numpy arrays, inside a Spark task.

Several operators need the words of every text (runs of characters other
than space, tab, LF, VT, FF, CR) as 64-bit names.  A slice of an Arrow
batch is read straight from its byte buffer: word starts and ends come
from one white-space mask, names from one ``reduceat``.  ``slices`` keeps
the arrays small whatever the batch size; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import saved

CHUNK_BYTES = 1 << 20  # text bytes handled at once in a task; the arrays take some 60 times as much
NULL_ID = (1 << 63) - 1  # stands for a null doc_id: sorts after every other
#: ids that are null or stand for several texts and may be broadcast
BROADCAST_IDS = 100_000
WORD = r"[^\x20\x09-\x0D]+"
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every output bit depends on every input bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E6C63D0876A9A47)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD1B54A32D192ED03)
    return x ^ (x >> np.uint64(32))


BASE = np.uint64(0xA0761D6478BD642F)
BASE_INV = np.uint64(pow(int(BASE), -1, 1 << 64))
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BYTE[SPACE] = 0
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64 (kept, and grown on demand)."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _POWERS[int(base)] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def span_hash(names: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of names[first:last] for many spans at once, equal for equal content."""
    n = len(names)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(names * powers(BASE, n), out=total[1:], dtype=np.uint64)
    return mix64((total[last] - total[first]) * powers(BASE_INV, n + 1)[first])


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # byte offset of each text, and the end
    start: np.ndarray  # byte offset of each word
    end: np.ndarray
    row: np.ndarray  # text of each word
    first: np.ndarray  # index of the first word of each text, and the end
    name: np.ndarray  # 64-bit name of each word


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array without nulls."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64) \
        if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True bytes, cut at text borders."""
    n = len(mask)
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    ends = mask.copy()
    ends[:-1] &= ~mask[1:]
    border = offsets[(offsets > 0) & (offsets < n)]
    begins[border] = mask[border]
    ends[border - 1] = mask[border - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_names(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit names of the bytes from each start to the next; white space counts for nothing."""
    if not len(start):
        return np.zeros(0, np.uint64)
    parts = _BYTE[data]
    parts *= powers(BASE, len(data))
    return mix64(np.add.reduceat(parts, start) * powers(BASE_INV, len(data))[start])


def word_arrays(texts: pa.Array, lower: bool = False) -> Words:
    """Words of each text; a null text has none.  ``lower`` folds A-Z only."""
    data, offsets = buffers(pc.fill_null(texts, "") if texts.null_count else texts)
    if lower:
        data = LOWER[data]
    start, end = runs(~SPACE[data], offsets)
    row = np.searchsorted(offsets[1:], start, side="right")
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    return Words(data, offsets, start, end, row, first, span_names(data, start))


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` text bytes, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no column has it (case apart)."""
    have = {c.lower() for c in columns}
    while name.lower() in have:
        name = "_" + name
    return name


def doc_key(name: str = "doc_id") -> Column:
    """The id as an ordering key: null sorts last."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def keyed(docs: DataFrame, key: str = "oid", by: tuple[str, ...] = ("text",)) -> DataFrame:
    """``docs`` with a long ``key`` (no column of theirs) that names each document: the doc_id, where that is one document's alone.

    Rows equal in doc_id and ``by`` are one document.  Of an id with several
    contents the one of least hash keeps the id, the others get a key from
    content.  Every row without an id is a document of its own, with a key
    from content and a running number among rows alike.  Keys from content
    have 60 bits and lie at the top of the range, so these rows sort last.
    """
    number = F.col("doc_id").cast("long")
    h, of, first, last, nth = (unused([*docs.columns, key], f"__{x}") for x in ("h", "of", "first", "last", "nth"))
    d = docs.withColumn(h, F.xxhash64(*by))
    odd = d.select(number.alias(of), h).groupBy(of).agg(F.min(h).alias(first), F.max(h).alias(last))
    odd = saved(odd.where(F.col(of).isNull() | (F.col(first) != F.col(last))).drop(last), "odd-ids")
    n, nulls = odd.agg(F.count("*"), F.count_if(F.col(of).isNull())).first()
    made = lambda *c: F.lit(NULL_ID) - F.shiftrightunsigned(F.xxhash64(*c), 4)
    named = d.where("doc_id IS NOT NULL") if nulls else d
    if n > nulls:
        odd = odd.where(F.col(of).isNotNull())
        named = named.join(F.broadcast(odd) if n <= BROADCAST_IDS else odd, number == F.col(of), "left")
        named = named.withColumn(key, F.when(F.col(first) != F.col(h), made(number, h)).otherwise(number))
    else:
        named = named.withColumn(key, number)
    columns = [*docs.columns, key]
    if not nulls:
        return named.select(*columns)
    plain = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
    alike = Window.partitionBy(h).orderBy(*[f.name for f in docs.schema if isinstance(f.dataType, plain)])
    free = d.where("doc_id IS NULL").withColumn(nth, F.row_number().over(alike)).withColumn(key, made(F.lit("null"), h, nth))
    return named.select(*columns).unionAll(free.select(*columns))


def small_batches(spark: SparkSession, size: int = 16 << 20) -> None:
    """Bounds the bytes of an Arrow batch, where the session sets no bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) in (64 << 20, (1 << 31) - 1):  # Spark's own defaults
        spark.conf.set(key, str(size))
