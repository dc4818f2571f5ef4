"""Toxicity scoring: a bidirectional gated recurrent network in numpy.

Inputs of a word are a word vector and the mean vector of its byte trigrams
(hashed tables, word borders included), each with the log-odds of the row in
the training sample, so invented or inflected words are read by their parts.  A gated recurrent layer runs over a window
of ``WINDOW`` words in each direction; attention pools its outputs to one
logit.  Overlapping windows start every ``STRIDE`` words (of training texts
every ``TRAIN_STRIDE``) and cover every text to its end, so that a passage of
up to ``WINDOW - STRIDE`` words always stands whole in one of them; a text's
score is that of its worst window.

Training: a bounded sample of labelled rows (``SAMPLE_PER_CLASS``, the least
by a hash of the id) whose crc32(doc_id as text) mod 4 is not 2.  A label
marks a whole text, so each epoch trains on the window that the current
model finds worst in each text (for a clean text, its hardest negative) and
on a random one of the clean texts.  Both tables start from smoothed
log-odds in the sample.  Everything is seeded.

Scoring is a map over documents: the model (about 1 MB) goes to the tasks,
which compute inputs once per distinct word of a slice.

Edge cases: null and empty texts and texts without a letter or digit score
0; without labels of both classes every text scores 0; null labels are
ignored, of several labels of a document the highest counts; a null doc_id
is in no fold (held_out false) and never trains.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import BASE, BASE_INV, LOWER, buffers, mix64, powers, runs, slices, small_batches, unused

WINDOW, STRIDE, TRAIN_STRIDE = 32, 8, 24
SAMPLE_PER_CLASS = {1: 1024, 0: 1536}
HELD_OUT_FOLD, FOLDS = 2, 4
ODDS_FOLDS = 4
THRESHOLD = 0.3
STEPS, BATCH, RATE, TABLE_RATE = 480, 64, 0.01, 0.001
WORD_BITS, GRAM_BITS, WORD_DIM, GRAM_DIM, HIDDEN, ATTENTION = 16, 14, 2, 4, 8, 8

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
_BYTE[~_LETTER] = 0
_GRAM = (mix64(np.arange(768, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32).reshape(3, 256)
Model = dict[str, np.ndarray]


@dataclass
class Inputs:
    word: np.ndarray  # table row of each distinct word
    grams: np.ndarray  # table rows of the trigrams of the distinct words, one after the other
    size: np.ndarray  # trigrams of each distinct word
    back: np.ndarray  # distinct word of each word
    first: np.ndarray  # first word of each text, and the end


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with ASCII and Latin-1 capitals made small."""
    out = LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    out[capital] += 0x20
    return out


def inputs(texts: pa.Array) -> Inputs:
    """Words of the texts (runs of letters and digits, lower-cased) as table rows."""
    data, offsets = buffers(pc.fill_null(texts, "") if texts.null_count else texts)
    data = lowered(data)
    plain = _LETTER[data]
    start, end = runs(plain, offsets)
    row = np.searchsorted(offsets[1:], start, side="right")
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    if not len(start):
        none = np.zeros(0, np.int64)
        return Inputs(none, none, none, none, first)
    name = mix64(np.add.reduceat(_BYTE[data] * powers(BASE, len(data)), start) * powers(BASE_INV, len(data))[start])
    uniq, pick, back = np.unique(name, return_index=True, return_inverse=True)
    s, size = start[pick], (end - start)[pick]
    flat = np.repeat(s - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    padded = np.concatenate([[0], np.where(plain, data, 0), [0]]).astype(np.uint8)
    inner = np.ones(len(flat), bool)
    begins = np.cumsum(size) - size
    inner[begins] = False
    last = np.ones(len(flat), bool)
    last[begins + size - 1] = False
    left = np.where(inner, padded[flat], 0)  # byte before, border at the word's edge
    right = np.where(last, padded[flat + 2], 0)
    gram = (_GRAM[0][left] + _GRAM[1][padded[flat + 1]] * np.uint32(3) + _GRAM[2][right] * np.uint32(7)) * np.uint32(2654435761)
    return Inputs((uniq >> np.uint64(64 - WORD_BITS)).astype(np.int64), (gram >> np.uint32(32 - GRAM_BITS)).astype(np.int64), size, back, first)


def windows(first: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and length of every window; the last window of a long text ends with it."""
    n = np.diff(first)
    count = np.where(n == 0, 0, 1 + np.maximum(0, -(-(n - WINDOW) // stride)))
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at = np.minimum(k * stride, np.maximum(n[text] - WINDOW, 0))
    return text, first[:-1][text] + at, np.minimum(n[text], WINDOW)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def vectors(m: Model, x: Inputs) -> np.ndarray:
    """Input vectors of the distinct words: odds of the word, mean and highest odds of its trigrams, learnt word and mean trigram vectors."""
    begins, size = np.cumsum(x.size) - x.size, x.size[:, None].astype(np.float32)
    odds = m["gram_odds"][x.grams]
    parts = [m["word_odds"][x.word][:, None], np.add.reduceat(odds, begins)[:, None] / size, np.maximum.reduceat(odds, begins)[:, None],
             m["words"][x.word], np.add.reduceat(m["grams"][x.grams], begins, axis=0) / size]
    return np.concatenate(parts, axis=1)


def recur(gate: np.ndarray, step: np.ndarray, live: np.ndarray | None, u: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Outputs of one direction: ``step`` has the row of ``gate`` at each time, time x rows."""
    k = 2 * HIDDEN
    half = np.float32(0.5)
    u_zr, u_new = np.ascontiguousarray(u[:, :k]) * half, np.ascontiguousarray(u[:, k:])
    g_zr, g_new = np.ascontiguousarray(gate[:, :k]) * half, np.ascontiguousarray(gate[:, k:])
    out = np.empty((*step.shape, HIDDEN), np.float32)
    h = np.zeros(out.shape[1:], np.float32)
    for t, rows in enumerate(step):
        zr = g_zr.take(rows, axis=0)
        zr += h @ u_zr
        np.tanh(zr, out=zr)  # the sigmoid by its half angle
        zr *= half
        zr += half
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        hu = h @ u_new
        new = g_new.take(rows, axis=0)
        new += r * hu
        np.tanh(new, out=new)
        if live is not None:
            z = np.where(live[t, :, None], z, np.float32(1))
        if keep is not None:
            keep.append((h, z, r, new, hu))
        h = np.subtract(h, new, out=out[t])
        h *= z
        h += new
    return out


def logits(m: Model, gates: tuple[np.ndarray, np.ndarray], step: np.ndarray, live: np.ndarray | None) -> np.ndarray:
    ahead = recur(gates[0], step, live, m["uf"])
    behind = recur(gates[1], step[::-1], None if live is None else live[::-1], m["ub"])[::-1]
    o = np.concatenate([ahead, behind], axis=2)  # time x rows x 2 hidden
    e = np.tanh(o @ m["wa"]) @ m["va"]
    if live is not None:
        e = np.where(live, e, np.float32(-1e9))
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    return np.einsum("tr,trk,k->r", a, o, m["wo"], optimize=True) + m["bo"][0]


def window_scores(m: Model, x: Inputs, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and logit of every window."""
    text, at, size = windows(x.first, stride)
    if not len(text):
        return text, at, np.zeros(0, np.float32)
    v = vectors(m, x)
    gates = v @ m["wf"] + m["bf"], v @ m["wb"] + m["bb"]
    out = np.empty(len(text), np.float32)
    time = np.arange(WINDOW)
    for full in (True, False):
        rows = np.flatnonzero((size == WINDOW) == full)
        for k in range(0, len(rows), 4096):
            r = rows[k: k + 4096]
            step, live = at[r] + time[:, None], None
            if not full:
                live = time[:, None] < size[r]
                step = np.where(live, step, at[r])
            out[r] = logits(m, gates, x.back[step], live)
    return text, at, out


def scores(m: Model, texts: pa.Array) -> np.ndarray:
    """The worst window of each text, as a probability."""
    x = inputs(texts)
    text, _, logit = window_scores(m, x)
    worst = np.full(len(texts), -np.inf, np.float32)
    np.maximum.at(worst, text, logit)
    return np.where(np.isfinite(worst), sigmoid(worst), 0.0).astype(np.float64)


def gradients(m: Model, x: Inputs, at: np.ndarray, size: np.ndarray, y: np.ndarray) -> Model:
    """Gradients of the mean cross entropy over some windows."""
    time = np.arange(WINDOW)
    live = time[:, None] < size
    step = x.back[np.where(live, at + time[:, None], at)]
    uniq, step = np.unique(step, return_inverse=True)
    step = step.reshape(live.shape)
    begins = np.cumsum(x.size) - x.size
    width = x.size[uniq]
    flat = np.repeat(begins[uniq] - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
    some = Inputs(x.word[uniq], x.grams[flat], width, step, x.first)
    v = vectors(m, some)
    gates = v @ m["wf"] + m["bf"], v @ m["wb"] + m["bb"]
    kf: list = []
    kb: list = []
    ahead = recur(gates[0], step, live, m["uf"], kf)
    behind = recur(gates[1], step[::-1], live[::-1], m["ub"], kb)[::-1]
    o = np.concatenate([ahead, behind], axis=2)
    hidden = np.tanh(o @ m["wa"])
    e = np.where(live, hidden @ m["va"], np.float32(-1e9))
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    pooled = np.einsum("tr,trk->rk", a, o)
    p = sigmoid(pooled @ m["wo"] + m["bo"][0])
    d = ((p - y) / len(y)).astype(np.float32)
    g: Model = {"wo": pooled.T @ d, "bo": np.array([d.sum()], np.float32)}
    dpool = d[:, None] * m["wo"]
    do = a[:, :, None] * dpool
    da = np.einsum("trk,rk->tr", o, dpool)
    de = a * (da - (a * da).sum(axis=0))
    g["va"] = np.einsum("trk,tr->k", hidden, de)
    dh = de[:, :, None] * m["va"] * (1 - hidden ** 2)
    g["wa"] = np.einsum("trk,tra->ka", o, dh)
    do += dh @ m["wa"].T
    dv = np.zeros_like(v)
    for side, kept, order in (("f", kf, step), ("b", kb, step[::-1])):
        grad_o = do[:, :, :HIDDEN] if side == "f" else do[::-1, :, HIDDEN:]
        u = m["u" + side]
        gu, back, dgate = np.zeros_like(u), np.zeros((len(y), HIDDEN), np.float32), np.zeros_like(gates[0])
        for t in range(WINDOW - 1, -1, -1):
            h, z, r, new, hn = kept[t]
            dht = grad_o[t] + back
            dnew = dht * (1 - z) * (1 - new ** 2)
            dz = dht * (h - new) * z * (1 - z)  # 0 where the step is not live, as z is 1 there
            dr = dnew * hn * r * (1 - r)
            dhu = np.concatenate([dz, dr, dnew * r], axis=1)
            gu += h.T @ dhu
            back = dht * z + dhu @ u.T
            np.add.at(dgate, order[t], np.concatenate([dz, dr, dnew], axis=1))
        g["u" + side], g["w" + side], g["b" + side] = gu, v.T @ dgate, dgate.sum(axis=0)
        dv += dgate @ m["w" + side].T
    g["words"], g["grams"] = np.zeros_like(m["words"]), np.zeros_like(m["grams"])
    np.add.at(g["words"], some.word, dv[:, 3:3 + WORD_DIM])
    np.add.at(g["grams"], some.grams, np.repeat(dv[:, 3 + WORD_DIM:] / width[:, None].astype(np.float32), width, axis=0))
    return g


def table_counts(y: np.ndarray, rows: np.ndarray, owner: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Toxic and clean texts that hold each table row; ``owner`` is the text of each entry of ``rows``."""
    pair = np.unique(rows + (owner.astype(np.int64) << bits))
    row, text = pair & ((1 << bits) - 1), pair >> bits
    return np.bincount(row, y[text], 1 << bits), np.bincount(row, 1 - y[text], 1 << bits)


def log_odds(pos: np.ndarray, neg: np.ndarray, toxic: float, clean: float) -> np.ndarray:
    """Smoothed log-odds, drawn towards 0 for rare rows."""
    odds = np.log((pos + 0.5) / (toxic + 1)) - np.log((neg + 0.5) / (clean + 1))
    seen = pos + neg
    return np.clip(odds * seen / (seen + 3), -2, 4).astype(np.float32)


def fit(texts: list[str], labels: list[int], seed: int = 11) -> Model | None:
    """Trains the network; None unless both classes are there.

    The sample is cut into ``ODDS_FOLDS`` parts; while training, a text's
    inputs use the odds that the other parts give, as its own label says
    nothing about it when it is new.
    """
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    f32 = lambda *shape, s=1.0: (rng.standard_normal(shape) * s).astype(np.float32)
    dim = 3 + WORD_DIM + GRAM_DIM
    m: Model = {"words": f32(1 << WORD_BITS, WORD_DIM, s=0.01), "grams": f32(1 << GRAM_BITS, GRAM_DIM, s=0.01),
                "wf": f32(dim, 3 * HIDDEN, s=0.4), "wb": f32(dim, 3 * HIDDEN, s=0.4), "bf": np.zeros(3 * HIDDEN, np.float32),
                "bb": np.zeros(3 * HIDDEN, np.float32), "uf": f32(HIDDEN, 3 * HIDDEN, s=0.3), "ub": f32(HIDDEN, 3 * HIDDEN, s=0.3),
                "wa": f32(2 * HIDDEN, ATTENTION, s=0.3), "va": f32(ATTENTION, s=0.3), "wo": f32(2 * HIDDEN, s=0.3), "bo": np.zeros(1, np.float32)}
    parts = []
    for k in range(ODDS_FOLDS):
        mine = y[k::ODDS_FOLDS]
        x = inputs(pa.array(texts[k::ODDS_FOLDS], pa.string()))
        text, at, length = windows(x.first, TRAIN_STRIDE)
        owner = np.repeat(np.arange(len(mine)), np.diff(x.first))
        # a text holds a trigram if it holds a word with it
        pair = np.unique(x.back + owner * max(1, len(x.word)))
        word, who = pair % max(1, len(x.word)), pair // max(1, len(x.word))
        n = x.size[word]
        flat = np.repeat((np.cumsum(x.size) - x.size)[word] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        counts = [*table_counts(mine, x.word[word], who, WORD_BITS), *table_counts(mine, x.grams[flat], np.repeat(who, n), GRAM_BITS)]
        parts.append((x, mine, text, at, length, counts))
    if not any(len(p[2]) for p in parts):
        return None
    total = [sum(p[5][k] for p in parts) for k in range(4)]

    def odds(c, toxic, clean):
        return {"word_odds": log_odds(c[0], c[1], toxic, clean), "gram_odds": log_odds(c[2], c[3], toxic, clean)}
    toxic, clean = y.sum(), (1 - y).sum()
    others = [odds([t - c for t, c in zip(total, p[5])], toxic - p[1].sum(), clean - (1 - p[1]).sum()) for p in parts]
    moments = {k: (np.zeros_like(p), np.zeros_like(p)) for k, p in m.items()}
    done = 0
    while done < STEPS:
        batches = []
        for k, (x, mine, text, at, length, _) in enumerate(parts):
            if not len(text):
                continue
            if done:
                bad = window_scores(m | others[k], x, TRAIN_STRIDE)[2]
            else:  # before training, a window is as bad as its worst word
                v = vectors(m | others[k], x)[:, :3].sum(axis=1)[x.back]
                bad = v[np.minimum(at[:, None] + np.arange(WINDOW), (at + length - 1)[:, None])].max(axis=1)
            order = np.lexsort((-bad, text))
            top = order[np.r_[True, np.diff(text[order]) > 0]]
            free = np.flatnonzero(mine[text] == 0)
            pick = rng.permutation(np.concatenate([top, rng.choice(free, min(len(free), len(top)), replace=False)]))
            batches += [(k, pick[i: i + BATCH]) for i in range(0, len(pick), BATCH)]
        fade = 1 if done < STEPS // 2 else 0.3
        for b in rng.permutation(len(batches)):
            k, w = batches[b]
            x, mine, text, at, length, _ = parts[k]
            done += 1
            for name, g in gradients(m | others[k], x, at[w], length[w], mine[text[w]]).items():
                one, two = moments[name]
                one += 0.1 * (g - one)
                two += 0.01 * (g * g - two)
                rate = TABLE_RATE if name in ("words", "grams") else RATE
                m[name] -= (fade * rate * (one / (1 - 0.9 ** done)) / (np.sqrt(two / (1 - 0.99 ** done)) + 1e-7)).astype(np.float32)
    return m | odds(total, toxic, clean)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded training sample: id, text, toxic."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(fold != HELD_OUT_FOLD)
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.join(docs.select(F.col("doc_id").cast("long").alias("id")).distinct(), "id", "left_semi")
    some = [marks.where(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(n) for c, n in SAMPLE_PER_CLASS.items()]
    some = F.broadcast(some[0].unionAll(some[1]))  # at most the sample's rows, two numbers each
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).join(some, "id")


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted({i: (t, c) for b in batches for i, t, c in zip(*(b.column(k).to_pylist() for k in ("id", "text", "toxic")))}.items())
    model = fit([t for _, (t, _) in rows], [c for _, (_, c) in rows])
    if model:
        out = io.BytesIO()
        np.savez(out, **model)
        yield pa.RecordBatch.from_pydict({"model": pa.array([out.getvalue()], pa.binary())})


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Trains in one task, on the bounded sample alone; the model (about 1 MB) comes back to the driver."""
    got = training_rows(docs, labels).repartition(1).mapInArrow(_fit, "model binary").collect()
    return dict(np.load(io.BytesIO(got[0]["model"]))) if got else None


def score(docs: DataFrame, model: Model | None, name: str = "__score") -> DataFrame:
    """``docs`` with their score as ``name``, which must be no column of theirs."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                s = scores(m, part.column("text")) if m else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s, pa.float64())], schema=part.schema.append(pa.field(name, pa.float64())))
    schema = docs.schema
    return docs.mapInArrow(run, type(schema)([*schema.fields]).add(name, "double"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    model = train(docs, labels)
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    return score(small, model).select("doc_id", F.coalesce(fold == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), F.col("__score").alias("score"),
                                      F.when(F.col("__score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted toxic; trained on ``labelled`` documents.  All columns stay, whatever their names."""
    name = unused(docs.columns, "__score")
    return score(docs, train(labelled, labels), name).where(F.col(name) < THRESHOLD).drop(name)
