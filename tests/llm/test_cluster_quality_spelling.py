"""Centroid clustering, quality scoring and spelling variants against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ebbflow.llm import centroid_clusters as cc
from ebbflow.llm import quality, queries
from ebbflow.llm import spelling_variants as sv

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- centroid clustering
def plain_kmeans(rows, k, rounds, dims, seed=2):
    v = [(i, [math.floor(256 * float(x)) for x in e]) for i, e in rows
         if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    named = sorted(v, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in named[:k]]

    def assign():
        out = []
        for _, x in v:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        got = assign()
        for j in range(len(centroids)):
            own = [x for (_, x), (c, _) in zip(v, got) if c == j]
            if own:
                centroids[j] = [sum(col) // len(own) for col in zip(*own)]
    got = assign()
    per = Counter()
    for c, d in got:
        per[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i is None, i or 0), c, d, per[c], sum(per.values()), sha[c]) for (i, _), (c, d) in zip(v, got))


def as_rows(df):
    return sorted(((r.vec_id is None, r.vec_id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_clusters_equal_plain_kmeans(spark, rounds):
    rng = np.random.default_rng(rounds)
    # few distinct components: ties between centroids and equal vectors; a third of the rows are one vector
    rows = [(i, (rng.integers(-3, 4, 4) / 4).tolist()) for i in range(150)] + [(1000 + i, [0.5, 0.25, -0.5, 0.0]) for i in range(75)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    assert as_rows(cc.cluster_vectors(df, 4, 9, rounds)) == plain_kmeans(rows, 9, rounds, 4)


def test_cluster_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], "a"), (1, [1.0, 2.0], "a"), (2, None, "b"), (3, [1.0], "c"), (4, [1.0, None], "d"), (5, [nan, 1.0], "e"),
            (6, [inf, 1.0], "f"), (None, [0.0, -0.1], "g"), (7, [], "h")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string").withColumnRenamed("cluster", "distance")
    for k in (1, 2, 40):
        got = as_rows(cc.cluster_vectors(df, 2, k, 2))
        assert got == plain_kmeans([r[:2] for r in rows], k, 2, 2), k
    none = cc.cluster_vectors(df.where("false"), 2, 3, 2)
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match="fits a long"):
        cc.cluster_vectors(spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>"), 2, 1, 1).collect()


def test_products_are_kept_by_nonzero_changes():
    rng = np.random.default_rng(3)
    x = rng.integers(-(1 << 26), 1 << 26, (50, 8))
    c = rng.integers(-(1 << 26), 1 << 26, (5, 8))
    exact = np.array([[sum(int(a) * int(b) for a, b in zip(u, w)) for w in c] for u in x])
    assert (cc.product(x, c.T) == exact).all() and (cc.product(x % 1000, c.T % 1000) == (x % 1000) @ (c.T % 1000)).all()
    change = np.zeros_like(c)
    change[1, 3], change[4, [0, 7]] = 5, (-9, 2)
    assert (cc.updated(exact, x, change) == cc.product(x, (c + change).T)).all()


# ---------------------------------------------------------------- spelling variants
def plain_counts(docs):
    n = Counter()
    for i, t in docs:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(n):
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def variant_rows(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_variants_of_the_table(spark):
    for where in (SF, "/root/testdata/sf0.01"):
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{where}/documents.parquet").collect()]
        n = plain_counts(docs)
        got = variant_rows(queries.op13_spelling_variants(spark, where))
        assert {(r[0], r[3]) for r in got} == set(n.items())
        # every pair, by deletion and replacement patterns
        by = {}
        for w in n:
            for k in range(len(w)):
                by.setdefault(w[:k] + "*" + w[k + 1:], set()).add(w)
                by.setdefault(w[:k] + w[k + 1:], set()).add(w)
            by.setdefault(w, set()).add(w)
        near = {w: set() for w in n}
        for vs in by.values():
            for a in vs:
                near[a] |= {b for b in vs if a != b and one_edit(a, b)}
        for w, form, root, c, n_near, form_n in got:
            best = min(near[w], key=lambda v: (-n[v], v), default=None)
            want = best if best is not None and n[best] >= 5 * c else None
            assert (form, n_near, form_n) == (want, len(near[w]), n[want] if want else None), w


@pytest.mark.parametrize("block", [4, 1024])
def test_variants_equal_plain(spark, monkeypatch, block):
    """Long chains, hot halves, repeated letters, every kind of edit; blocks of four words make many tiles."""
    monkeypatch.setattr(sv, "BLOCK", block)
    monkeypatch.setattr(sv, "TILE_ROWS", 3)
    rng = np.random.default_rng(block)
    counts = {"aaaaaa": 6, "aaaaaaa": 40, "aaaaaaaa": 300, "aaaaaaab": 2000, "prefix" + "é" * 3: 9, "prefix" + "é" * 4: 45, "prefixééè": 45}
    for _ in range(400):
        counts["".join(rng.choice(list("abc"), rng.integers(6, 9)))] = int(rng.integers(5, 60))
    counts["z" * 5000] = 7
    counts["z" * 4999 + "y"] = 35
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    got = {r.word: r for r in sv.near_words(df).collect()}
    for w, n in counts.items():
        near = [v for v in counts if abs(len(v) - len(w)) < 2 and one_edit(w, v)]
        if not near:
            assert w not in got
            continue
        best = min(near, key=lambda v: (-counts[v], v))
        assert (got[w].n_near, got[w].best, got[w].best_n) == (len(near), best, counts[best]), w


def test_variants_whole_query_on_a_fixture(spark):
    docs = [(k, "Würdest wurdest! " * 7 + "abcdefgh ABCDEFG abcdef abcdefghi " * (k % 3) + "x" * 300 + " ÀÉÎÕÜß×÷ÿ " + "tailĀend") for k in range(60)]
    docs += [(None, "abcdefghi " * 900), (None, "abcdefghi " * 3), (7, None), (8, ""), (9, "  \n"), (9, "Würdest " * 4), (9, "Würdest " * 4)]
    df = spark.createDataFrame([(a, b, 5) for a, b in docs], "doc_id long, text string, n long").repartition(3)
    assert variant_rows(sv.variants(df)) == plain_variants(plain_counts(docs))
    assert sv.variants(df.where("false")).count() == 0


def test_roots_follow_long_chains(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(23)] + [("a", "w5"), ("b", "c")]
    got = {r.word: r.root for r in sv.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {a: ("c" if a == "b" else "w23") for a, _ in chain}


def test_checksums_and_letters():
    words = [w.encode() for w in ("", "a", "abc", "straßenbahn", "y" * 47, "y" * 48, "y" * 49, "y" * 1000)]
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    seed = np.arange(100, 100 + len(words), dtype=np.uint32)
    assert sv.checksums(data, start, end, seed).tolist() == [zlib.crc32(w, int(s)) for w, s in zip(words, seed)]
    text = "aZ¿ÀÿĀ ×é日本"
    mask = sv.letters(np.frombuffer(text.encode(), np.uint8))
    at = 0
    for c in text:
        assert mask[at] == bool(re.fullmatch("[A-Za-zÀ-ÿ]", c)), c
        at += len(c.encode())


# ---------------------------------------------------------------- quality
def plain_make_up(text):
    b = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", b)
    out = np.zeros(quality.WIDTH)
    if not words:
        return out
    kinds = [int(quality.CLASS[c]) for c in b]
    for x, y in zip(kinds, kinds[1:]):
        out[x * quality.CLASSES + y] += 1
    out[: quality.CLASSES ** 2] = np.sqrt(out[: quality.CLASSES ** 2] / max(len(b) - 1, 1))
    n = len(words)
    again, twice, top = 1 - len(set(words)) / n, sum(x == y for x, y in zip(words, words[1:])) / n, max(Counter(words).values()) / n
    out[quality.CLASSES ** 2:] = [math.log1p(n) / 10, min(sum(map(len, words)) / n, 30) / 10, again, again ** 0.5, twice, twice ** 0.5, top, top ** 0.5,
                                  min(b.count(b"\n") / n, 1)]
    return out


def test_make_up_equals_plain():
    texts = ["", None, " \n", "a", "The The cat.\nsat | on | it!!\n", "日本 日本 語", "x " * 3000, "A1-b_C\té"] * 40
    got = quality.make_up(pa.array(texts, pa.string()))
    assert np.allclose(got, [plain_make_up(t) for t in texts], atol=1e-6)


def test_risk_step_is_the_gradient():
    rng = np.random.default_rng(1)
    pos, free, w = rng.normal(size=(20, 5)) + 1, rng.normal(size=(30, 5)), np.ones(6)
    for p, bad_is_negative in ((0.2, False), (0.98, True)):
        def objective(v):
            good, bad = quality.risk(v, pos, free, p)
            return -bad if bad_is_negative else good + bad
        assert (quality.risk(w, pos, free, p)[1] < 0) == bad_is_negative
        g = quality.step(w, pos, free, p)
        for k in range(6):
            e = np.zeros(6)
            e[k] = 1e-5
            assert abs((objective(w + e) - objective(w - e)) / 2e-5 - g[k]) < 1e-6


@pytest.mark.parametrize("share", [0.3, 0.6, 0.9])
def test_prior_of_a_mixture(share):
    rng = np.random.default_rng(int(share * 10))
    good, bad = lambda n: rng.normal(size=(n, 4)) + 1.5, lambda n: rng.normal(size=(n, 4)) - 1.5
    n = 3000
    assert abs(quality.prior(good(1500), np.concatenate([good(int(n * share)), bad(n - int(n * share))])[rng.permutation(n)]) - share) < 0.06


def test_quality_learns_and_holds_out(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in got.items())
    right = Counter((int(r.quality), got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out)
    assert right[0, 0] >= 0.9 * (right[0, 0] + right[0, 1]) and right[1, 1] >= 0.97 * (right[1, 1] + right[1, 0]), right
    one = quality.train(docs, labels)
    two = quality.train(docs.repartition(5), labels.repartition(3))
    assert np.allclose(one[0], two[0], rtol=1e-6, atol=1e-9) and 0.7 < one[1] < 0.98
    # labels of 0, and all labels of the held-out fold, change nothing
    other = labels.withColumn("quality", labels.quality.cast("int")).where("quality = 1 OR doc_id < 0")
    kept = other.where("pmod(crc32(cast(cast(doc_id as string) as binary)), 5) <> 0")
    assert np.allclose(quality.train(docs, kept)[0], one[0], rtol=1e-6, atol=1e-9)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 2.0), (None, "some text", 3.0), (2, "!!! ...", 4.0), (3, " \n ", 5.0)],
                                 "doc_id long, text string, score double")
    none = spark.createDataFrame([(1, 0), (1, None), (None, 1)], "doc_id long, quality int")
    assert [(r.score, r.predicted) for r in quality.score_documents(docs, none).collect()] == [(0.5, 1)] * 5
    some = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (3, 1), (3, None)], "doc_id long, quality int")
    got = quality.score_documents(docs, some).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if r.doc_id in (1, 3)}) == 1
    assert quality.score_documents(docs.where("false"), some).count() == 0
