"""Substring dedup where names and windows are frequent: salted windows give the result of brute force."""

import random

import pytest

from ebbflow.llm import substring_dedup as sd
from ebbflow.llm.textarrays import keyed

from .test_text_ops import brute_repeats, corpus, frame, split


def counts(df, texts, hot):
    k = keyed(df.select("doc_id", "text"))
    spans = k.join(sd.repeated_spans(k, hot=hot), "oid", "left").select("doc_id", "text", "spans", "packed")
    got = {r.doc_id: r.n_removed for r in spans.mapInArrow(
        sd._strip, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string").collect()}
    return [got[i] for i in range(len(texts))]


def hot_of(df, least=1):
    """Every border name, then every window, that comes ``least`` times or more."""
    t = df.selectExpr("doc_id AS oid", "text")

    def keys(*known):
        return [r.key for r in t.mapInArrow(sd._scan(20, *known), sd.SEGMENTS).where("start >= 0").groupBy("key").count().where(f"count >= {least}").collect()]
    names = keys([], [])
    return names, keys(names, [])


@pytest.mark.parametrize("part", ["none", "names", "windows", "some"])
def test_salted_windows_equal_brute_force(spark, part):
    texts = corpus(3)
    df = frame(spark, texts).repartition(7)
    names, windows = hot_of(df)
    assert names and windows
    hot = {"none": ([], []), "names": (names, []), "windows": (names, windows), "some": (names[::2], windows[::3])}[part]
    assert counts(df, texts, hot) == [sum(g) for g in brute_repeats(texts)]


def test_passage_in_every_text(spark):
    """One passage of 60 words in every text: the sample names its windows, no salt holds a large part of them."""
    r = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [" ".join([*(f"u{k}x{r.randrange(1000)}" for _ in range(30)), passage, f"e{k}"]) for k in range(600)]
    df = frame(spark, texts).repartition(100)
    hot = hot_of(df, 8)
    assert hot[1]
    rows = df.selectExpr("doc_id AS oid", "text").mapInArrow(sd._scan(20, *hot), sd.SEGMENTS).where("start >= 0")
    by_window = max(x["count"] for x in rows.groupBy("key").count().collect())
    by_salt = max(x["count"] for x in rows.groupBy("key", "salt").count().collect())
    assert by_window >= 90 and by_salt <= by_window / 8
    want = [0] + [60] * (len(texts) - 1)
    assert counts(df, texts, hot) == want
    assert sum(len(split(t)) for t in texts) == 91 * len(texts)


def test_frequent_reads_the_sample(spark):
    texts = [" ".join(f"p{k}" for k in range(60)) + f" e{i}" for i in range(3000)]
    t = frame(spark, texts).selectExpr("doc_id AS oid", "text").repartition(400)
    names, windows = sd.frequent(t, 20)
    assert names and windows and len(windows) <= sd.HOT_WINDOWS
