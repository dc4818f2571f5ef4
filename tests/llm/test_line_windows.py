"""Line dedup with windows of two lines, against brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.llm import line_dedup, queries

SF = "/root/testdata/sf0.1"


BLANK = " \t\n\r\f"


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def brute(texts, windows=True):
    """Lines that stay, by sets of the chunks and windows seen; texts in the order of their ids."""
    chunks, pairs, out = set(), set(), []
    for t in texts:
        if t is None:
            out.append((0, 0, None))
            continue
        lines = t.split("\n")
        gone = [False] * len(lines)
        cuts = [i for i in range(2, len(lines)) if md5(md5(lines[i - 2]) + md5(lines[i - 1])) < "4"]
        for a, b in zip([0, *cuts], [*cuts, len(lines)]):
            c = tuple(lines[a:b])
            if b - a > 1 and "".join(c).strip(BLANK):
                if c in chunks:
                    gone[a:b] = [True] * (b - a)
                chunks.add(c)
        for i in range(len(lines) - 1) if windows else ():
            p = (lines[i], lines[i + 1])
            if "".join(p).strip(BLANK):
                if p in pairs:
                    gone[i] = gone[i + 1] = True
                pairs.add(p)
        kept = [x for x, g in zip(lines, gone) if not g]
        out.append((len(lines), sum(gone), "\n".join(kept)))
    return out


def made(seed=5, n=80):
    rng = np.random.default_rng(seed)
    line = lambda: " ".join(f"w{k}" for k in rng.integers(0, 500, 6))
    shared = [[line() for _ in range(k)] for k in (2, 2, 3, 5, 12, 40)]
    texts = []
    for _ in range(n):
        parts = [line() for _ in range(int(rng.integers(0, 9)))]
        for k in rng.integers(0, len(shared), int(rng.integers(0, 3))):
            at = int(rng.integers(0, len(parts) + 1))
            parts[at:at] = shared[k]
        texts.append("\n".join(parts))
    return texts + [None, "", "same\n" * 50, "same\n" * 3 + "end", "\n\n\n\n", "a\n\n\nb", "x\n\n\n\nb", "\n\n\n\n", "one line", "one line",
                    "\u2003\n ", "\u2003\n ", " \t\n ", " \t\n ", "a\x00b\nq\r\nr", "z\nq\r\nr\ns"]


def frame(spark, texts):
    rows = [(k, t, "x", 1, "y", 2.0) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lines string, oid long, chunks string, again double")


def result(df):
    return [(r.n_lines, r.n_removed, r.text) for r in df.orderBy("doc_id").collect()]


@pytest.mark.parametrize("windows", [True, False])
def test_brute_force(spark, windows):
    texts = made()
    got = result(line_dedup.remove_repeated_lines(frame(spark, texts), windows))
    assert got == brute(texts, windows)
    assert sum(g[1] for g in got) > 300


def test_passage_in_the_middle(spark):
    texts = [f"own {k} a\nown {k} b\nfirst shared\nsecond shared\nown {k} c" for k in range(6)]
    got = result(line_dedup.remove_repeated_lines(frame(spark, texts)))
    assert [g[1] for g in got] == [0, 2, 2, 2, 2, 2]
    assert got[3][2] == "own 3 a\nown 3 b\nown 3 c"


@pytest.mark.parametrize("names", [1, 7])
def test_names_that_collide(spark, monkeypatch, names):
    """Few names for all parts: bytes alone decide."""
    exact = line_dedup.name_of
    monkeypatch.setattr(line_dedup, "name_of", lambda *a: F.pmod(exact(*a), F.lit(names)))
    texts = made(seed=9, n=25)
    assert result(line_dedup.remove_repeated_lines(frame(spark, texts))) == brute(texts)


def test_hot_window_and_long_text(spark):
    rng = np.random.default_rng(2)
    long = "\n".join(f"line {k}" for k in rng.integers(0, 9000, 30_000))
    texts = [f"top {k}\ncommon one\ncommon two\nend {k}" for k in range(400)] + [long, long + "\ncommon one\ncommon two", "w " * 1_500_000]
    assert result(line_dedup.remove_repeated_lines(frame(spark, texts))) == brute(texts)


def test_rows_without_an_id(spark):
    df = spark.createDataFrame([(None, "a\nb"), (None, "a\nb"), (1, "a\nb"), (None, None), (1, "a\nb"), (2, "c\na\nb")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_removed, r.text) for r in line_dedup.remove_repeated_lines(df).collect()), key=str)
    # the two equal rows of id 1 are one document, the first to hold the lines
    assert got == sorted([(None, 2, ""), (None, 2, ""), (1, 0, "a\nb"), (1, 0, "a\nb"), (None, 0, None), (2, 2, "c")], key=str)
    assert line_dedup.remove_repeated_lines(df.where("false")).count() == 0


def test_recall_on_whole_documents(spark):
    """Every line of a run of two or more repeated lines goes, on sf0.1."""
    got = queries.op5_line_dedup(spark, SF).orderBy("doc_id").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    want = brute([texts[k] for k in sorted(texts)])
    assert [(r.n_lines, r.n_removed, r.text) for r in got] == want
    assert sum(w[1] for w in want) > 10_000
