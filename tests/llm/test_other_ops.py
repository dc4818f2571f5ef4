"""Extraction, toxicity, mixing, embeddings, graph and pipeline."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from ebbflow.llm import embedding_dedup, graph, html_extract, queries, source_mix, toxicity

SF = "/root/testdata/sf0.001"

PAGE = """<!DOCTYPE html><html><head><title>Site &amp; title</title><style>p{}</style><script>var x = "<p>no</p>";</script></head>
<body class="has-sidebar"><header><h1>Site name</h1><p>Welcome to the site that is for all of you and it is the best.</p></header>
<nav><ul><li><a href="/">Home</a></li><li>More</li></ul></nav>
<div id="cookie-notice"><p>We use the cookies that are on this site and you agree to it by the use of it, as it was.</p></div>
<main><article><h1>Title &lt;one&gt;</h1><p>First   paragraph&nbsp;with <b>bold</b> text,<br>and a <a href="x">link</a> in it.<p>Short.
<aside class="side">An aside that is in the article but not of it, for the reader that likes it.</aside>
<p>5 &lt; 6 and a < b</p><div class="ad-box">Buy the best of it now</div><ul><li>item one</li><li>item two</li></ul>
<form><p>Your name in the form is for the list</p><input name=a></form><p>Last &#233;t&eacute;</p></article>
<section class="comments"><p>This is what I think of the article and it is not the best that I have had from you.</p></section></main>
<footer>&copy; all of it</footer><script>unclosed"""


def test_main_text():
    want = ["Title <one>", "First paragraph with bold text, and a link in it.", "Short.", "5 < 6 and a < b", "item one", "item two", "Last été"]
    assert html_extract.main_text(PAGE).split("\n\n") == want
    assert html_extract.main_text(None) == html_extract.main_text("") == ""
    assert html_extract.main_text("<p>") == "" and html_extract.main_text("<article>just <i>this") == "just this"


def test_neighbours_decide_short_blocks():
    long = "It is the story of a town that was on the river and of the people that had to leave it for the hills. " * 3
    page = f"<div><h2>Heading</h2><p>{long}</p><p>Short one.</p><p>{long}</p></div><div><p><a href=a>x</a> <a href=b>yy</a></p><p>tail</p></div>"
    kept = html_extract.main_text(page).split("\n\n")
    assert kept[0] == "Heading" and kept[2] == "Short one." and kept[-1] != "tail" and len(kept) == 4


def test_extract_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in queries.op1_html_extraction(spark, SF).collect()}
    for r in pages.collect():
        inner = r.html[r.html.index("<article>") + 9: r.html.index("</article>")]
        import html
        import re
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id].text == "\n\n".join(x for x in parts if x), r.page_id
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
    odd = spark.createDataFrame([(1, None, None, 5), (None, "u", "", 6)], "page_id long, url string, html string, text long")
    assert [(r.text, r.n_chars) for r in html_extract.extract_pages(odd).collect()] == [("", 0)] * 2


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    texts = ["alpha beta gamma delta", "beta beta foul", "x y z foul words here and there " * 6]
    x = toxicity.inputs(__import__("pyarrow").array(texts))
    toxicity_dims = 3 + toxicity.WORD_DIM + toxicity.GRAM_DIM
    h, a = toxicity.HIDDEN, toxicity.ATTENTION
    m = {"words": rng.normal(size=(1 << toxicity.WORD_BITS, toxicity.WORD_DIM)), "grams": rng.normal(size=(1 << toxicity.GRAM_BITS, toxicity.GRAM_DIM)),
         "wf": rng.normal(size=(toxicity_dims, 3 * h)), "wb": rng.normal(size=(toxicity_dims, 3 * h)), "bf": np.zeros(3 * h), "bb": np.zeros(3 * h),
         "uf": rng.normal(size=(h, 3 * h)), "ub": rng.normal(size=(h, 3 * h)), "wa": rng.normal(size=(2 * h, a)), "va": rng.normal(size=a),
         "wo": rng.normal(size=2 * h), "bo": np.zeros(1), "word_odds": rng.normal(size=1 << toxicity.WORD_BITS),
         "gram_odds": rng.normal(size=1 << toxicity.GRAM_BITS)}
    m = {k: (v * 0.3).astype(np.float32) for k, v in m.items()}
    text, at, size = toxicity.windows(x.first)
    y = (text > 0).astype(np.float32)

    def loss():
        p = toxicity.sigmoid(toxicity.window_scores(m, x)[2]).astype(np.float64)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    g = toxicity.gradients(m, x, at, size, y)
    for name in g:
        k = np.unravel_index(np.argmax(np.abs(g[name])), g[name].shape)
        keep, eps = m[name][k], 1e-2
        m[name][k] = keep + eps
        up = loss()
        m[name][k] = keep - eps
        low = loss()
        m[name][k] = keep
        assert abs((up - low) / (2 * eps) - g[name][k]) < 2e-3 + 0.05 * abs(g[name][k]), name


def test_windows_cover_every_word():
    first = np.cumsum([0, 0, 1, 5, 32, 33, 48, 49, 500])
    text, at, size = toxicity.windows(first)
    seen = np.zeros(first[-1], bool)
    for a, n in zip(at, size):
        seen[a: a + n] = True
    assert seen.all() and (size <= toxicity.WINDOW).all()


def test_toxicity_learns_and_holds_out(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in got.items())
    right = Counter((int(r.toxic), got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out)
    assert right[1, 1] >= 0.6 * (right[1, 1] + right[1, 0]) and right[0, 0] >= 0.95 * (right[0, 0] + right[0, 1])
    model = toxicity.train(docs, labels)
    again = toxicity.train(docs.repartition(5), labels.repartition(3))
    assert all(np.array_equal(model[k], again[k]) for k in model)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 2.0), (None, "some text", 3.0), (2, "!!! ...", 4.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 0), (1, None), (None, 1)], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.score_documents(docs, labels).collect()] == [(0.0, 0)] * 4
    assert toxicity.score_documents(docs.where("false"), labels).count() == 0
    assert toxicity.drop_toxic(docs, docs, labels).columns == docs.columns


def expected_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s] or sizes[s] == 0]
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


@pytest.mark.parametrize("where", [SF, "/root/testdata/sf0.01"])
def test_mix_targets(spark, where):
    got = queries.op7_source_mix(spark, where).collect()
    source = {r.doc_id: (r.source, len(r.text.encode().split())) for r in spark.read.parquet(f"{where}/documents.parquet").collect()}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        s, n = source[r.doc_id]
        assert r.size == n and 0 <= r.taken <= 2 * n
        sizes[s] += n
        taken[s] += r.taken
        target[s] = r.target
    want = expected_targets(dict(sizes))
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s]) and abs(taken[s] - want[s]) <= 3 * source_mix.BLOCK_WORDS, s
    again = queries.op7_source_mix(spark, where).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mix_edges_and_shards(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(k, " ".join("w" for _ in range(int(rng.integers(0, 900)))), [None, "b", "", "ä", "z"][k % 5]) for k in range(300)] + [(900, None, "only")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", source_mix.F.lit("clash"))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = expected_targets(dict(sizes))
    for shard in (1 << 21, 4000):
        monkeypatch.setattr(source_mix, "SHARD_WORDS", shard)
        got = source_mix.mix(df).collect()
        taken = defaultdict(int)
        for r in got:
            taken[rows[r.doc_id][2] if r.doc_id < 900 else "only"] += r.taken
        shards = max(sizes.values()) // shard + 1
        assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 3 * source_mix.BLOCK_WORDS * shards for s in sizes)
    mixed = source_mix.mixed_documents(df)
    assert mixed.columns == df.columns
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
    assert words == Counter({r.doc_id: r.taken for r in got if r.taken})
    assert source_mix.mix(df.where("false")).count() == 0


def test_sainte_lague_equals_highest_quotients(spark):
    rng = np.random.default_rng(4)
    for seats, votes in ((17, [5, 5, 5, 1]), (1000, rng.integers(1, 10_000, 37).tolist()), (50, [10_000, *[3] * 90]), (7, [0, 0, 4])):
        rows = [(k, float(v), seats) for k, v in enumerate(votes)]
        got = {r.p: r.given for r in source_mix.apportion(spark.createDataFrame(rows, "p long, v double, n long"), [], ["p"], "v", "n").collect()}
        best = sorted(((-v / (2 * k + 1), p) for p, v in enumerate(votes) if v for k in range(seats)))[:seats]
        want = Counter(p for _, p in best)
        assert got == {p: want[p] for p in range(len(votes))}


def brute_links(vectors, cosine=0.95):
    unit = {}
    for k, v in vectors:
        if k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit.setdefault(k, np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)))
    ids = sorted(unit)
    n, up = Counter(), {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, i in enumerate(ids):
        for j in ids[:a]:
            if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                n[i] += 1
                n[j] += 1
                p, q = root(i), root(j)
                up[max(p, q)] = min(p, q)
    return n, {i: root(i) for i in ids}


def test_embedding_dedup_table(spark):
    v = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    n, comp = brute_links(v)
    got = {r.vec_id: r for r in queries.op8_embedding_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(v)
    found = sum(r.n_links for r in got.values())
    assert all(got[i].n_links <= n[i] for i in got) and found >= 0.98 * sum(n.values())
    assert sum(got[i].component_id == comp[i] for i in comp) >= 0.98 * len(comp)


def test_embedding_dedup_built(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 16)  # buckets of many cells
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(size=16).tolist()) for k in range(150)]
    base = rng.normal(size=16)
    rows += [(200 + k, (base + rng.normal(size=16) * 0.12).tolist()) for k in range(90)]
    rows += [(300 + k, base.tolist()) for k in range(40)] + [(400, (2 * base).tolist()), (401, None), (402, [0.0] * 16), (403, [float("nan")] * 16),
             (404, [None] * 16), (405, [1.0, 2.0]), (406, [2.0, 4.0]), (407, []), (408, [-0.0, 1.0]), (409, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", source_mix.F.lit(1)).repartition(3)
    n, comp = brute_links(rows)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert len(got) == len(rows) and sum(r.n_links for r in got.values()) >= 0.98 * sum(n.values())
    assert all(got[i].n_links <= n[i] for i in got) and [got[i].n_links for i in (405, 406, 408, 409)] == [1, 1, 1, 1]
    assert all(got[i].component_id == comp.get(i, i) for i in got) and all(got[i].kept == (comp.get(i, i) == i) for i in got)
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def test_components(spark):
    rng = np.random.default_rng(9)
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(200, 260)] + [tuple(map(int, rng.integers(300, 500, 2))) for _ in range(150)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        p, q = root(a), root(b)
        up[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges + [(7, 7), (None, 3)], "a long, b long")).collect()}
    assert got == {x: root(x) for x in {e for a, b in edges if a != b for e in (a, b)}}


def test_pipeline_stages(spark):
    """Each stage against its operator's decisions on the stage's own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = graph.saved(stage(spark, docs, SF), f"test-{name}")
        if name != "token_output":
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        if name in ("toxicity", "near_dedup", "decontamination"):
            kept = {r.doc_id for r in out.collect()}
            if name == "toxicity":
                scored = toxicity.score_documents(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
                assert kept == {r.doc_id for r in scored if not r.predicted}
            if name == "near_dedup":
                from tests.llm.test_text_ops import brute_components
                rows = docs.orderBy("doc_id").collect()
                comp = brute_components([r.text for r in rows], 5, 80)[1]
                assert kept == {rows[c].doc_id for c in comp}
            if name == "decontamination":
                from tests.llm.test_text_ops import brute_contaminated
                bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
                rows = [(r.doc_id, r.text) for r in docs.collect()]
                assert kept == {d for d, _ in rows} - brute_contaminated(rows, bench)
        if name == "token_output":
            assert out.count() == docs.count()
            n = sorted((r.start, r.n_tokens) for r in out.collect())
            assert n[0][0] == 0 and all(a + c == b for (a, c), (b, _) in zip(n, n[1:]))
        docs = out
