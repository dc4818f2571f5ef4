"""Quality scoring: positive-unlabelled learning with a non-negative risk.

A score is the sigmoid of a linear function of a text's make-up: rates of
pairs of neighbouring character classes (every ASCII punctuation mark is a
class of its own; letters, capitals, digits, blanks, line ends and other
bytes are one each) and a few word statistics (``MAKE_UP``).  Words and
languages are never looked at, so it reads any script.

Training sees trusted positives P (labels of 1 in the training folds) and
unlabelled web text U (a sample of all documents); labels of 0 are never
used.  With the class prior p, the share of good text in U,

    risk = p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)]),  l(z) = log(1 + exp(-z))

is what a fully labelled set would give; the second part is a risk on bad
text and cannot be negative, so where a batch makes it negative the step
goes uphill on that part (``step``).  The prior is estimated first: a
classifier of P against U is fitted on one half of both samples, and on the
other half the prior is the ratio of the shares of U and of P above the
threshold where its upper confidence bound is least; the halves then change
places, and the mean of both counts (``prior``).

Both samples are bounded (``POSITIVES``, ``UNLABELLED``: the least by a hash
of the id).  Make-ups are computed in parallel, one task fits, the weights
(some 1,500 numbers) come back and go to the scoring tasks.  Seeded:
reruns agree.

Edge cases: null and empty texts and texts of white space are the make-up
of zeros, and get the score of it; without a trusted positive every text
scores 0.5; of several labels of a document the lowest counts, null labels
are ignored; a null doc_id is in no fold (held_out false) and never trains;
repeated rows are scored each; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import Words, slices, small_batches, word_arrays

FOLDS, HELD_OUT_FOLD, THRESHOLD = 5, 0, 0.3
POSITIVES, UNLABELLED = 2048, 4096
STEPS, BATCH, RATE, DECAY, SPREAD = 1200, 256, 0.03, 1e-4, 4e-3
MAKE_UP = ("words, log", "bytes of a word", "words met before", "its root", "words equal to the next", "its root", "words of the commonest", "its root",
           "lines a word")

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASS = np.full(256, 5, np.uint8)  # other bytes, control characters too
for _k, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t", b"\n\v\f\r")):
    CLASS[[*_bytes]] = _k
CLASS[[*_MARKS]] = np.arange(6, 6 + len(_MARKS))
CLASSES = 6 + len(_MARKS)
WIDTH = CLASSES * CLASSES + len(MAKE_UP)


def word_statistics(w: Words) -> np.ndarray:
    """texts x MAKE_UP."""
    n = np.diff(w.first)
    out = np.zeros((len(n), len(MAKE_UP)))
    some = np.flatnonzero(n)
    if not len(some):
        return out
    first = w.first[:-1][some]
    size = np.add.reduceat(w.end - w.start, first)
    order = np.lexsort((w.name, w.row))
    new = np.ones(len(order), bool)
    new[1:] = (w.name[order][1:] != w.name[order][:-1]) | (w.row[order][1:] != w.row[order][:-1])
    at = np.flatnonzero(new)
    many = np.diff(np.append(at, len(order)))
    owner = w.row[order][at]
    most = np.zeros(len(n), np.int64)
    np.maximum.at(most, owner, many)
    same = np.zeros(len(w.name), bool)
    same[:-1] = (w.name[1:] == w.name[:-1]) & (w.row[1:] == w.row[:-1])
    lines = np.bincount(np.searchsorted(w.offsets[1:], np.flatnonzero(w.data == 10), side="right"), minlength=len(n))
    k = n[some]
    again, twice, top = 1 - np.bincount(owner, minlength=len(n))[some] / k, np.add.reduceat(same.astype(np.int64), first) / k, most[some] / k
    out[some] = np.stack([np.log1p(k) / 10, np.minimum(size / k, 30) / 10, again, np.sqrt(again), twice, np.sqrt(twice), top, np.sqrt(top),
                          np.minimum(lines[some] / k, 1)], axis=1)
    return out


def make_up(texts: pa.Array) -> np.ndarray:
    """texts x WIDTH: square roots of the rates of class pairs, and word statistics."""
    w = word_arrays(texts)
    n = np.diff(w.offsets)
    out = np.zeros((len(n), WIDTH), np.float32)
    kind = CLASS[w.data].astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    inside = np.flatnonzero(row[1:] == row[:-1])
    pair = kind[:-1] * CLASSES + kind[1:]
    for a in range(0, len(n), 256):  # some texts at a time: a count for every pair of classes
        lo, hi = np.searchsorted(row[inside], [a, a + 256])
        k = inside[lo:hi]
        part = min(256, len(n) - a)
        counts = np.bincount((row[k] - a) * CLASSES ** 2 + pair[k], minlength=part * CLASSES ** 2).reshape(part, -1)
        out[a: a + part, : CLASSES ** 2] = np.sqrt(counts / np.maximum(n[a: a + part, None] - 1, 1))
    out[:, CLASSES ** 2:] = word_statistics(w)
    out[np.diff(w.first) == 0] = 0
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * z) + 0.5


def risk(w: np.ndarray, pos: np.ndarray, free: np.ndarray, p: float) -> tuple[float, float]:
    """Risk on good text, and the unbiased (maybe negative) risk on bad text; the last weight is the intercept."""
    loss = lambda z: np.logaddexp(0, -z).mean()
    zp, zu = pos @ w[:-1] + w[-1], free @ w[:-1] + w[-1]
    return p * loss(zp), loss(-zu) - p * loss(-zp)


def step(w: np.ndarray, pos: np.ndarray, free: np.ndarray, p: float) -> np.ndarray:
    """Direction to subtract: the gradient of the non-negative risk, uphill on its second part where that is negative."""
    zp, zu = pos @ w[:-1] + w[-1], free @ w[:-1] + w[-1]
    good = -p * (1 - sigmoid(zp)) / len(zp)
    bad_u, bad_p = sigmoid(zu) / len(zu), -p * sigmoid(zp) / len(zp)
    bad = np.append(free.T @ bad_u + pos.T @ bad_p, bad_u.sum() + bad_p.sum())
    if risk(w, pos, free, p)[1] < 0:
        return -bad
    return np.append(pos.T @ good, good.sum()) + bad


def descend(pos: np.ndarray, free: np.ndarray, direction, steps: int, seed: int) -> np.ndarray:
    """Adam over seeded batches of both samples; the mean of the last quarter of the weights."""
    rng = np.random.default_rng(seed)
    w = np.zeros(pos.shape[1] + 1)
    one, two, mean, late = np.zeros_like(w), np.zeros_like(w), np.zeros_like(w), 0
    for t in range(1, steps + 1):
        g = direction(w, pos[rng.integers(0, len(pos), BATCH)], free[rng.integers(0, len(free), BATCH)])
        one += 0.1 * (g - one)
        two += 0.01 * (g * g - two)
        w -= RATE * (one / (1 - 0.9 ** t)) / (np.sqrt(two / (1 - 0.99 ** t)) + 1e-8) + RATE * DECAY * np.append(w[:-1], 0)
        if 4 * t > 3 * steps:
            mean += w
            late += 1
    return mean / late


def apart(w: np.ndarray, pos: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Gradient of the plain cross entropy of positives against unlabelled text."""
    dp = -(1 - sigmoid(pos @ w[:-1] + w[-1])) / (2 * len(pos))
    du = sigmoid(free @ w[:-1] + w[-1]) / (2 * len(free))
    return np.append(pos.T @ dp + free.T @ du, dp.sum() + du.sum())


def prior(pos: np.ndarray, free: np.ndarray, seed: int = 5) -> float:
    """Share of good text in ``free``, by the best threshold of a classifier fitted on the other half."""
    if len(pos) < 4 or len(free) < 4:
        return 0.5
    found = []
    for k in (0, 1):
        w = descend(pos[k::2], free[k::2], apart, STEPS // 4, seed + k)
        zp, zu = np.sort(pos[1 - k::2] @ w[:-1]), np.sort(free[1 - k::2] @ w[:-1])
        at = np.unique(zp)
        above_p, above_u = 1 - np.searchsorted(zp, at) / len(zp), 1 - np.searchsorted(zu, at) / len(zu)
        wide = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(zp)) + 1 / np.sqrt(len(zu)))
        best = np.argmin((above_u + wide) / above_p)
        found.append(above_u[best] / above_p[best])
    return float(np.clip(np.mean(found), 0.02, 0.98))


def fit(pos: np.ndarray, free: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float] | None:
    """Weights (mean and scale of the features folded in) and the class prior; None without positives."""
    if not len(pos) or not len(free):
        return None
    centre, spread = free.mean(axis=0), np.sqrt(free.var(axis=0) + np.float32(SPREAD))
    pos, free = ((a - centre) / spread for a in (pos, free))
    p = prior(pos, free)
    w = descend(pos, free, lambda w, a, b: step(w, a, b, p), STEPS, seed)
    slope = w[:-1] / spread
    return np.append(slope, w[-1] - slope @ centre), p


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT_FOLD, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded samples: id, text, good (a trusted positive; null for unlabelled text)."""
    d = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out())
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").alias("q")).where("q = 1")
    ids = d.select("id").distinct()
    good = marks.select("id").join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(POSITIVES).withColumn("good", F.lit(True))
    free = ids.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(UNLABELLED).withColumn("good", F.lit(None).cast("boolean"))
    # at most the samples' rows, two numbers each
    return d.join(F.broadcast(good.unionAll(free)), "id")


def _make_ups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            x = make_up(part.column("text"))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), WIDTH).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("good"), flat], names=["id", "good", "x"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, good, x = [], [], []
    for b in batches:
        if b.num_rows:
            ids.append(b.column("id").to_numpy())
            good.append(pc.is_valid(b.column("good")).to_numpy(zero_copy_only=False))
            x.append(b.column("x").flatten().to_numpy().reshape(-1, WIDTH))
    if not x:
        return
    ids, good, x = np.concatenate(ids), np.concatenate(good), np.concatenate(x)
    order = np.lexsort((*x.T[-len(MAKE_UP):], ids))  # the same order whatever the partitions were
    good, x = good[order], x[order]
    model = fit(x[good], x[~good])
    if model:
        yield pa.RecordBatch.from_pydict({"weights": pa.array([model[0].tolist()], pa.list_(pa.float64())), "prior": pa.array([model[1]])})


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float] | None:
    """Weights and class prior, fitted in one task on the bounded samples."""
    small_batches(docs.sparkSession)
    x = training_rows(docs, labels).mapInArrow(_make_ups, "id long, good boolean, x array<float>")
    got = x.repartition(1).mapInArrow(_fit, "weights array<double>, prior double").collect()
    return (np.array(got[0]["weights"]), got[0]["prior"]) if got else None


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text, ..)``: doc_id, held_out, score, predicted."""
    model = train(docs, labels)
    w = model[0] if model else np.zeros(WIDTH + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                s = sigmoid(make_up(part.column("text")) @ w[:-1] + w[-1])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(s, pa.float64())],
                                                 names=["doc_id", "held_out", "score"])
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    out = d.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
