"""Odd pages, ties in token files, clashing column names, windows at every offset, templates of short items."""

import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ebbflow.llm import decontaminate, html_extract, minhash_dedup, source_mix, token_files, toxicity
from ebbflow.llm.textarrays import keyed

LONG = "It is the story of a town that was on the river and of the people that had to leave it for the hills. " * 2


# ---------------------------------------------------------------- pages
@pytest.mark.parametrize("piece", ["<b>", "<i><b></i>", "<p><i>", "<textarea>", "<select>x", "</b>", "<hr><i>", "<a href='x'>", "<div><span>", "<td>", "<a b=\"", "<svg>",
                                   "<!-- ", "<", "<title>", "<li>", "<h1><b>", "<p></i>"])
def test_time_is_linear_in_unclosed_tags(piece):
    html_extract.main_text(piece * 10)
    page = "<article><p>Some text here.</p>" + piece * (1_000_000 // len(piece))
    began = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - began < 12 * max(1, 3 / len(piece)), piece  # a quadratic reading takes minutes


def test_quoted_values_may_hold_an_end_of_tag():
    page = """<article><p>One <img alt='x > y' src=a> two <a title="b > c" href='d'>three</a> <i data-x = 'p > "q"'>four</i> it's <b title=it's>five</b></p></article>"""
    assert html_extract.main_text(page) == "One two three four it's five"
    assert html_extract.main_text('<article><p class="a>b</p>c') == html_extract.main_text("<article>b c").replace("b c", "b\n\nc")


def test_nothing_of_an_article_is_lost():
    page = f"""<body><main><article><h2 id="related-work" class="menu">Related work</h2><section id="search"><p id="share">How we search.</p></section>
<p>The root is <math><mi>x</mi><mo>=</mo><msqrt><mn>2</mn></msqrt></math> as <svg><title>t</title><text>axis</text><text>label</text></svg> shows.</p>
<noscript><p>Without scripts this stays.</p></noscript><object><p>Fallback.</p></object><div id="comments"><p>{LONG}</p></div>
<div class="ad-box">Buy it</div><div class="related"><p>Other stories</p></div></article><div id="comments"><p>{LONG}</p></div></main></body>"""
    assert html_extract.main_text(page).split("\n\n") == ["Related work", "How we search.", "The root is x=2 as axis label shows.",
                                                         "Without scripts this stays.", "Fallback."]


def test_pages_without_article_in_any_script():
    chinese = "这是一个关于河边小镇的故事，人们不得不离开那里。" * 4
    russian = "Это рассказ о городе у реки и о людях, которые должны были уйти в горы. Они ушли весной."
    for one in (chinese, russian, chinese[:80]):
        page = f"<nav><a href=a>x</a></nav><div><p>{one}</p><p>{one[:90]}。</p><p>{one}</p></div><footer>{one}</footer>"
        assert html_extract.main_text(page).split("\n\n") == [one, one[:90] + "。", one]
    mixed = f"<div><p>{LONG}</p><p>{chinese}</p><p>{LONG}</p></div><ul><li><a href=a>Home</a></li></ul>"
    assert html_extract.main_text(mixed).split("\n\n") == [LONG.strip(), chinese, LONG.strip()]
    assert html_extract.main_text("<p>Town council votes down new bridge plan, mayor says more talks needed</p>") != ""
    short = f"<div><p>{LONG}</p><p>Nobody expected much: prices fell, rents rose, wages stood still everywhere.</p><p>{LONG}</p></div>"
    assert len(html_extract.main_text(short).split("\n\n")) == 3


def test_a_page_of_several_megabytes():
    page = "<article>" + "".join(f"<p>Paragraph {k} with <b>some</b> text &amp; more of it, all the way.</p>" for k in range(60_000)) + "</article>"
    began = time.process_time()
    text = html_extract.main_text(page)
    assert text.count("\n\n") == 59_999 and time.process_time() - began < 60


# ---------------------------------------------------------------- token files
def test_starts_of_tied_rows_are_their_places_in_the_files(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(int(d), " ".join(["word"] * int(n))) for d, n in zip(rng.integers(0, 4, 300), rng.integers(0, 30, 300))]
    rows += [(None, "x " * k) for k in range(40)] + [(2, "same text")] * 5
    path = f"{tmp_path}/t"
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash")).repartition(6)
    index = token_files.write_and_index(df, public_tokenizers.path("word_bpe_49k.json"), path)
    got = sorted((r.start, r.n_tokens, r.ids_crc32, r.doc_id) for r in index.collect())
    import os
    import zlib
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    want, start = [], 0
    for f in files:
        for r in spark.read.schema(token_files.SCHEMA).orc(f"{path}/{f}").coalesce(1).collect():
            ids = np.array(r.ids, "<u4")
            want.append((start, len(ids), zlib.crc32(ids.tobytes()), r.doc_id))
            start += len(ids)
    assert got == want and len(got) == len(rows)
    keys = [(w[3] is None, w[3] or 0) for w in want]
    assert keys == sorted(keys)


# ---------------------------------------------------------------- clashing names
CLASH = ["__h", "__of", "__first", "__last", "__nth", "__key", "__id", "__score", "__size", "__base", "__words", "__text", "__plan", "__P", "size", "key", "r", "oid"]


def clashing(spark, texts):
    return spark.createDataFrame([(k if k % 3 else None, t, "s", *[f"{c}{k}" for c in CLASH]) for k, t in enumerate(texts)],
                                 "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASH))


def test_stages_keep_columns_of_any_name(spark):
    prose = [" ".join(f"w{(k * 7 + j) % 97}{j}" for j in range(40)) for k in range(6)]
    texts = [*prose, prose[1], "", None, prose[0]]
    docs = clashing(spark, texts)
    bench = spark.createDataFrame([(0, prose[4])], "item_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    before = {tuple(r[3:]): r for r in docs.collect()}
    for name, out in (("toxicity", toxicity.drop_toxic(docs, docs, labels)), ("near_dedup", minhash_dedup.keep_one(docs)),
                      ("decontamination", decontaminate.clean(docs, bench)), ("mixing", source_mix.mixed_documents(docs))):
        rows = out.collect()
        assert out.columns == docs.columns and rows, name
        for r in rows:
            was = before[tuple(r[3:])]  # every other column as it was
            assert r.doc_id == was.doc_id and r.source == was.source, name
            assert name == "mixing" or r.text == was.text, name
    assert decontaminate.clean(docs, bench).count() == len(texts) - 1
    k = keyed(docs, "mine")
    assert k.columns == [*docs.columns, "mine"] and k.select("mine").distinct().count() == len(texts)


# ---------------------------------------------------------------- toxicity
def plain_scores(m, text):
    """The network over every window, one word and one number at a time."""
    x = toxicity.inputs(pa.array([text]))
    n, h = int(x.first[1]), toxicity.HIDDEN
    if not n:
        return 0.0
    begins = np.cumsum(x.size) - x.size
    word = []
    for k in x.back:
        g = x.grams[begins[k]: begins[k] + x.size[k]]
        odds = [float(m["gram_odds"][i]) for i in g]
        word.append(np.concatenate([[m["word_odds"][x.word[k]], sum(odds) / len(odds), max(odds)], m["words"][x.word[k]], m["grams"][g].mean(axis=0)]))
    sig = lambda v: 1 / (1 + np.exp(-v))

    def direction(seq, w, u, b):
        state, out = np.zeros(h), []
        for v in seq:
            gx, gh = v @ w + b, state @ u
            z, r = sig(gx[:h] + gh[:h]), sig(gx[h:2 * h] + gh[h:2 * h])
            new = np.tanh(gx[2 * h:] + r * gh[2 * h:])
            state = z * state + (1 - z) * new
            out.append(state)
        return out
    starts = sorted({*range(0, max(1, n - toxicity.WINDOW + 1), toxicity.STRIDE), max(0, n - toxicity.WINDOW)})
    best = -np.inf
    for a in starts:
        seq = word[a: a + toxicity.WINDOW]
        both = [np.concatenate(p) for p in zip(direction(seq, m["wf"], m["uf"], m["bf"]), direction(seq[::-1], m["wb"], m["ub"], m["bb"])[::-1])]
        e = np.array([np.tanh(o @ m["wa"]) @ m["va"] for o in both])
        a_ = np.exp(e - e.max())
        best = max(best, float((a_ / a_.sum()) @ np.array(both) @ m["wo"] + m["bo"][0]))
    return float(sig(best))


@pytest.fixture(scope="module")
def network():
    rng = np.random.default_rng(9)
    vocab = [f"mild{k}" for k in range(150)]
    bad = [f"vile{k}" for k in range(12)]
    texts, labels = [], []
    for k in range(160):
        w = list(rng.choice(vocab, int(rng.integers(20, 120))))
        labels.append(int(rng.random() < 0.3))
        if labels[-1]:
            at = int(rng.integers(0, len(w)))
            w[at:at] = list(rng.choice(bad, 6))
        texts.append(" ".join(w))
    return toxicity.fit(texts, labels), vocab, bad, rng


def test_scores_equal_a_plain_network(network):
    m, vocab, bad, rng = network
    texts = ["", "!!", "one", " ".join(vocab[:31]), " ".join(vocab[:32]), " ".join(vocab[:33]), " ".join([*vocab[:50], *bad, *vocab[50:77]]), "Mild1 VILE2 x"]
    got = toxicity.scores(m, pa.array(texts))
    assert np.abs(got - [plain_scores(m, t) for t in texts]).max() < 2e-4


def test_a_passage_counts_at_every_offset(network):
    m, vocab, bad, rng = network
    clean = list(rng.choice(vocab, 150))
    passage = bad[:8]
    scores = toxicity.scores(m, pa.array([" ".join([*clean[:at], *passage, *clean[at:]]) for at in range(151)]))
    assert scores.min() >= 0.5 and toxicity.scores(m, pa.array([" ".join(clean)]))[0] < toxicity.THRESHOLD
    for n in (1, 5, 32, 33, 200):  # every passage of up to WINDOW - STRIDE words stands whole in some window
        text, at, size = toxicity.windows(np.array([0, n]))
        for a in range(n):
            for length in range(1, min(toxicity.WINDOW - toxicity.STRIDE, n - a) + 1):
                assert any(x <= a and a + length <= x + s for x, s in zip(at, size))


# ---------------------------------------------------------------- templates
def test_short_items_with_other_numbers(spark):
    items = ["What is 12 + 30 ? It is 42 .", "Sum 3 , 5 , 8 and 13", "A train goes 30 km in 2 hours ."]
    texts = ["some text What is 15 + 20 ? It is 35 . more", "here: Sum 4 , 6 , 9 and 14", "then A train goes 50 km in 3 hours .",
             "some text What is 7 + 7 ? It is 7 . more",  # one value for three
             "Sum 4 , 6 , 9 or 14", "a sum of 15 + 20 is 35", "A train goes 50 km in 50 hours ."]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {0: [0], 1: [1], 2: [2]}
