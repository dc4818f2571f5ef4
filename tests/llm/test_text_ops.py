"""Text operators against brute force, on the small table and on built cases."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ebbflow.llm import decontaminate, line_dedup, minhash_dedup, queries, source_mix, substring_dedup, token_counts, token_files
from ebbflow.llm.textarrays import word_arrays

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, oid string, n string, key string"


def split(text):
    return WORDS.findall(text or "")


def frame(spark, texts, start=0):
    rows = [(start + k, t, "en", "s", len(t or ""), "x", "y", "z") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def rows(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def corpus(seed=3, n=60):
    """Texts with exact and near copies, shared passages, runs of one word, long and empty texts."""
    rng = np.random.default_rng(seed)
    vocab = [f"w{k}" for k in range(400)] + ["The", "été", "über", "x y", "a,b", "It's"]
    prose = lambda k: " ".join(rng.choice(vocab, k))
    out = [prose(int(rng.integers(1, 120))) for _ in range(n)]
    passage, other = prose(60), prose(25)
    for k in range(0, 20, 2):
        out.append(prose(30) + " " + passage + "\n" + prose(int(rng.integers(0, 30))))
    for k in range(8):
        out.append(other + "  " + prose(5) + "\t" + other)
    base = prose(300)
    out += [base] * 3 + [base.replace(" ", "\n", 4)]
    for k in range(6):
        w = base.split(" ")
        w[10 * k + 5] = f"edit{k}"
        out.append(" ".join(w))
    out += ["", None, " \n ", "one", "one two", "One two", "same " * 90, "same " * 45 + "end", "ab ab cd " * 40, prose(6000)]
    return out


def brute_repeats(texts, width=20):
    seen, gone = {}, [[False] * len(split(t)) for t in texts]
    for k, t in enumerate(texts):
        w = split(t)
        for i in range(len(w) - width + 1):
            win = tuple(w[i: i + width])
            if win in seen:
                gone[k][i: i + width] = [True] * width
            else:
                seen[win] = (k, i)
    return gone


@pytest.mark.parametrize("hot,parts", [(False, 1), (True, 5)])
def test_substring_dedup(spark, monkeypatch, hot, parts):
    texts = corpus()
    gone = brute_repeats(texts)
    if hot:  # the first names of the sample go by window
        monkeypatch.setattr(substring_dedup, "SAMPLE_DOCS", 100)
    df = frame(spark, texts)
    df = df.repartition(parts) if parts > 1 else df.coalesce(1)
    got = rows(substring_dedup.remove_repeats(df))
    for k, t in enumerate(texts):
        w = split(t)
        kept = " ".join(x for x, g in zip(w, gone[k]) if not g)
        assert (got[k]["n_words"], got[k]["n_removed"]) == (len(w), sum(gone[k])), k
        assert got[k]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest() and got[k]["kept_text"] == kept


def test_substring_dedup_by_window_only(spark, monkeypatch):
    """Every border name dealt by window gives the same result."""
    texts = corpus(5)
    real = substring_dedup.segments
    names = substring_dedup.np.concatenate([np.asarray(real(pa.RecordBatch.from_pydict(
        {"oid": pa.array([k], pa.int64()), "text": pa.array([t], pa.string())}), 20, np.zeros(0, np.uint64)).column("key")) for k, t in enumerate(texts)])
    parts = []
    for k in range(0, len(texts), 7):
        b = pa.RecordBatch.from_pydict({"oid": pa.array(range(k, min(k + 7, len(texts))), pa.int64()), "text": pa.array(texts[k: k + 7], pa.string())})
        parts.append((real(b, 20, names.view(np.uint64)), real(b, 20, np.zeros(0, np.uint64))))
    for by_window, by_border in parts:
        sizes = lambda b: [len(x) // 6 for x, at in zip(b.column("win").to_pylist(), b.column("start").to_pylist()) if at >= 0]
        assert sum(sizes(by_window)) == sum(sizes(by_border)) and max(sizes(by_window), default=0) <= 1


def test_substring_dedup_repeated_rows_and_nulls(spark):
    text = " ".join(f"u{k}" for k in range(40))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, None)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in substring_dedup.remove_repeats(df).collect())
    assert got == [(False, 1, 0), (False, 1, 0), (False, 2, 0), (True, 0, 40)]
    assert substring_dedup.remove_repeats(df.where("false")).count() == 0


def shingles(text, width):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in split(text)]
    return {tuple(w[i: i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute_components(texts, width, percent):
    sets = [shingles(t, width) for t in texts]
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [root(i) for i in range(len(sets))]


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_minhash_dedup(spark, width, percent):
    texts = corpus(11)
    rng = np.random.default_rng(1)  # a chain of drifting copies: far ends are linked only through the middle
    drift = [f"d{k}" for k in range(120)]
    for k in range(12):
        texts.append(" ".join(drift))
        drift[int(rng.integers(0, 120))] = f"new{k}"
    n, comp = brute_components(texts, width, percent)
    got = rows(minhash_dedup.near_duplicates(frame(spark, texts).repartition(4), width, percent))
    assert [got[k]["n_shingles"] for k in range(len(texts))] == n
    assert [got[k]["component_id"] for k in range(len(texts))] == comp
    assert all(got[k]["kept"] == (comp[k] == k) for k in range(len(texts)))


def test_minhash_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    n, comp = brute_components([t for _, t in docs], 3, 85)
    got = rows(queries.op9_minhash_dedup(spark, SF))
    assert {d: (got[d]["n_shingles"], got[d]["component_id"]) for d, _ in docs} == {d: (n[k], docs[comp[k]][0]) for k, (d, _) in enumerate(docs)}


def test_minhash_edges(spark):
    df = spark.createDataFrame([(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (4, None), (5, "A b c  d e f")],
                               "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in minhash_dedup.near_duplicates(df).collect())
    assert got == [(-1, 2, -1, True), (3, 2, 3, True), (3, 2, 3, True), (4, 0, 4, True), (5, 2, 3, False)]
    assert sorted(r.doc_id or -1 for r in minhash_dedup.keep_one(df).collect()) == [-1, 3, 4]
    assert minhash_dedup.near_duplicates(df.where("false")).count() == 0


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    limit = minhash_dedup.most_flips(0.85)
    for same, near in ((1900, True), (1300, False)):  # similarity 0.90 and 0.48
        b = np.concatenate([a[:same], rng.integers(0, 1 << 63, 2000 - same, dtype=np.uint64)])
        x, y = (minhash_dedup.odd_sketch(minhash_dedup.signature(np.unique(s))) for s in (a, b))
        assert (int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= limit) == near


def test_line_dedup_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cur = con.execute(line_dedup.SQL)
    names = [d[0] for d in cur.description]
    want = {r[names.index("doc_id")]: dict(zip(names, r)) for r in cur.fetchall()}
    assert rows(queries.op5_line_dedup(spark, SF)) == want
    assert sum(r["n_removed"] for r in want.values()) > 0


def test_line_dedup_edges(spark):
    block = "\n".join(f"line {k} of a shared licence" for k in range(30))
    texts = [f"top\n{block}\nend", f"other\nhead\n{block}", block, None, "", "\n\n\n\n", "\n\n\n\n", "one line", "one line"]
    got = rows(line_dedup.remove_repeated_chunks(frame(spark, texts)))
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    seen, total = set(), 0
    for k, t in enumerate(texts):
        if t is None:
            assert (got[k]["text"], got[k]["n_lines"], got[k]["n_removed"]) == (None, 0, 0)
            continue
        lines = t.split("\n")
        cuts = [i for i in range(1, len(lines)) if i > 1 and md5(md5(lines[i - 2]) + md5(lines[i - 1])) < "4"]
        chunks = [lines[a:b] for a, b in zip([0, *cuts], [*cuts, len(lines)])]
        kept = [c for c in chunks if len(c) == 1 or not "".join(c).strip() or tuple(c) not in seen]
        seen |= {tuple(c) for c in chunks}
        gone = len(lines) - sum(map(len, kept))
        assert (got[k]["n_lines"], got[k]["n_removed"], got[k]["text"]) == (len(lines), gone, "\n".join(x for c in kept for x in c)), k
        total += gone
    assert total > 20
    assert line_dedup.remove_repeated_chunks(frame(spark, texts).where("false")).count() == 0


BENCH = [(0, "A shop sells 12 apples and 5 pears, so it sells 17 pieces of fruit because 12 plus 5 makes 17 in all."),
         (1, "The river Anda flows through the old town and then turns north where the river Anda meets the wide sea."),
         (2, "too short item"), (3, None), (4, "six words make this small item"),
         (0, "A shop sells 12 apples and 5 pears, so it sells 17 pieces of fruit because 12 plus 5 makes 17 in all.")]


def test_decontamination(spark):
    filler = "Plain words that say nothing at all about it. "
    texts = [filler + BENCH[0][1], filler + BENCH[0][1].upper() + filler,
             "A shop sells 30 apples and 4 pears, so it sells 34 pieces of fruit because 30 plus 4 makes 34 in all.",  # other numbers
             "A shop sells 30 apples and 4 pears, so it sells 55 pieces of fruit because 71 plus 8 makes 99 in all.",  # slots at odds, words as many
             filler * 40, None, "", "The river Osca flows through the old town and then turns north where the river Osca meets the wide sea.",
             "he said six words make this small item here", "six words make this big item", "A shop sells 12 apples and 5 pears"]
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = {k: v["item_ids"] for k, v in rows(decontaminate.contaminated(frame(spark, texts), bench)).items()}
    assert got == {0: [0], 1: [0], 2: [0], 7: [1], 8: [4]}
    assert sorted(r.doc_id for r in decontaminate.clean(frame(spark, texts), bench).collect()) == [3, 4, 5, 6, 9, 10]
    assert decontaminate.contaminated(frame(spark, texts), bench.where("false")).count() == 0
    assert decontaminate.contaminated(frame(spark, texts).where("false"), bench).count() == 0


def found_items(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {k: v["item_ids"] for k, v in rows(decontaminate.contaminated(frame(spark, texts), bench)).items()}


def test_decontamination_short_capitalised_items(spark):
    items = ["What is the capital of Peru?", "Who was the 7 th king of that island and when", "Days later she left the old house"]
    texts = ["then he asked What is the capital of Peru? and left", "he asked, What is the capital of Peru?", "What is the capital of Peru?",
             "what is the capital of peru", "it says Who was the 3 th king of that island and when he died", "What is the capital city of Peru?",
             "and 5 Days later she left the old house", "it says: Who was the 3 th queen of that island and when"]
    assert found_items(spark, items, texts) == {0: [0], 1: [0], 2: [0], 3: [0], 4: [1], 6: [2]}


def test_decontamination_items_without_plain_words(spark):
    items = ["2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43", "Who Wrote The Old Book Of Tales", "12 + 30 = 42", "3 kg 4 cm 5 kg 6 cm 7 kg",
             "Anna, Boris, Carla, Dario, Elena, Fritz, Greta, Hanno, Irene, Jonas, Klara, Ludwig, Maria, Nils", "Prime", "Blue whale song"]
    texts = [f"some words before {t}. and after" for t in items[:5]] + ["a prime one", "the blue whale, song", "1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024, 2048",
             "12 + 31 = 43", "Who Wrote The New Book Of Tales", "whale blue song"]
    assert found_items(spark, items, texts) == {0: [0], 1: [1], 2: [2], 3: [3], 4: [4], 5: [5], 6: [6]}


def brute_contaminated(docs, bench):
    """Windows of plain lower-case tokens: no numbers or names take part in these tables' passages."""
    def plain(t):
        return [w for w in re.split(r"[^\w¤]+", (t or "").lower()) if w]
    items = {i: plain(t) for i, t in bench}
    bad = set()
    for d, t in docs:
        w = plain(t)
        grams = {tuple(w[k: k + 13]) for k in range(len(w) - 12)}
        if any(tuple(x[k: k + 13]) in grams for x in items.values() for k in range(len(x) - 12)):
            bad.add(d)
    return bad


def test_decontamination_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute_contaminated(docs, bench)
    assert want and set(rows(queries.op4_decontamination(spark, SF))) == want


ODD_TEXTS = ["", None, " ", "a", " lead", "trail ", "two  spaces   three", "tab\tnew\nline\n\nx", "\n\n", "it's we'll 'S", "x y z", "  q",
             "end<|endoftext|> more", "  <|endoftext|>\n\n<|startoftext|>", "007 1000 0", "naïve Ünïcode ẞ 你好 世界 ١٢", "é café", "🙂 ok🙂",
             "a\x1cb", "word " * 3000, "\r\n\x0b\x0c mixed \r\n", "İstanbul ΣΑΣ"]


def test_token_counts_match_library(spark):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ODD_TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows(token_counts.count_tokens(frame(spark, texts).repartition(3), public_tokenizers.path("byte_bpe_50k.json")))
    for k, t in enumerate(texts):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[k]["n_bytes"], got[k]["n_tokens"], got[k]["over_limit"]) == (len((t or "").encode()), n, n > 1024), (k, t and t[:40])


def test_token_files_match_library(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    texts = ODD_TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows(token_files.write_and_index(frame(spark, texts).repartition(3), path, f"{tmp_path}/t"))
    start = 0
    for k, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert got[k] == {"doc_id": k, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}, (k, t and t[:40])
        start += len(ids)
    back = rows(token_files.read_tokens(spark, f"{tmp_path}/t", [4, 9]))
    assert {k: v["ids"][:-1] for k, v in back.items()} == {k: tok.encode(texts[k], add_special_tokens=False).ids for k in (4, 9)}
    empty = frame(spark, texts).where("false")
    assert token_files.write_and_index(empty, path, f"{tmp_path}/e").count() == 0


def test_words_taken_apart_give_the_ids_of_the_library():
    ids = token_files.word_ids(public_tokenizers.path("word_bpe_49k.json"))
    assert ids.split and ids.merge
    bits = ["Haen", "it's", "IT'S", "dogs'", "'Ll", "e\u0301", "\u00c9", "\u00dcn\u00ef", "\u00d7", "\u00e9\u00f7,", "J\u030c", "\u2260", "=\u0338",
            "<|endoftext|>", "<|ENDOFTEXT|>", "|>", "<|", "<B>", ",", "...", "'", '"', "\u2014,", "\ufb01", "\u0391\u03a3,", "\u0130", "\u0131", "\u212a",
            "\u4e2d\u6587,", "123", "1,000.", "\u0663", "a\u00a0B,", "\u0085", "x\u200dY", "\u00aa", "\u00b5,", "0", "O0", "\u00df", "\u1e9e", "\u0300", "C++", "|",
            " ", " ", " ", "\n", "\t"]
    r = random.Random(5)
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(6000)]
    texts += [None, "", " ", "A" * 20000 + ",", "!" * 20000 + "a" + "!" * 20000]
    for a in range(0, len(texts), 500):
        flat, counts = token_files.encoded(pa.array(texts[a: a + 500], pa.string()), ids, 2)
        want = [[*ids.tok.encode(t or "", add_special_tokens=False).ids, 2] for t in texts[a: a + 500]]
        assert counts.tolist() == [len(x) for x in want]
        assert flat.tolist() == [i for x in want for i in x]


def test_token_files_null_and_repeated_ids(spark, tmp_path):
    df = spark.createDataFrame([(None, "z"), (2, "a b"), (2, "a"), (1, None)], "doc_id long, text string")
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in token_files.write_and_index(df, public_tokenizers.path("word_bpe_49k.json"), f"{tmp_path}/n").collect())
    assert got == [(0, 1, 1), (1, 2, 2), (3, 2, 3), (6, None, 2)]


def test_word_arrays_cut_at_text_borders():
    w = word_arrays(pa.array(["ab c", None, "", "d", " e "]))
    assert [bytes(w.data[a:b]) for a, b in zip(w.start, w.end)] == [b"ab", b"c", b"d", b"e"] and w.row.tolist() == [0, 0, 3, 4]
    again = word_arrays(pa.array(["x", "ab c"]).slice(1))
    assert again.name.tolist() == w.name[:2].tolist()


def test_rows_without_id_or_with_a_shared_one_are_documents(spark):
    leak = "he said " + BENCH[4][1] + " here"
    long, other = (" ".join(f"{c}{k}" for k in range(40)) for c in "uv")
    block = "\n".join(f"line {k} of a shared licence" for k in range(30))
    texts = [(None, leak), (None, "six words make it"), (None, "this small item"), (None, long), (None, long), (None, long + " end"), (None, ""), (None, None),
             (None, "top\n" + block), (None, "head\nother\n" + block), (7, other), (7, "x " + other), (7, leak), (7, block)]
    df = spark.createDataFrame([(d, t, "s") for d, t in texts], "doc_id long, text string, source string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert sorted((r.doc_id or 0, r.item_ids) for r in decontaminate.contaminated(df, bench).collect()) == [(0, [4]), (7, [4])]
    kept = [(r.doc_id, r.text) for r in decontaminate.clean(df, bench).collect()]
    assert sorted(map(str, kept)) == sorted(str(x) for x in texts if x[1] != leak)

    gone = [(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(df).collect()]
    assert sorted(x[2] for x in gone if x[0] is None and x[1] in (40, 41)) == [0, 40, 40]
    assert sorted(x[2] for x in gone if x[0] == 7 and x[1] in (40, 41)) == [0, 40]
    words = sum(n - r for _, n, r in gone)
    assert words == sum(map(len, map(split, [leak, leak, long, "end", other, "x", "six words make it", "this small item", "top", "head other", block])))

    lines = line_dedup.remove_repeated_chunks(df).collect()
    assert len(lines) == len(texts) and sum(r.n_removed for r in lines) > 30
    assert all(r.n_removed == 0 for r in lines if r.n_lines < 30)

    plan = source_mix.mix(df).collect()
    assert sorted(r.size for r in plan) == sorted(len(split(t)) for _, t in texts)
    mixed = source_mix.mixed_documents(df)
    assert mixed.columns == df.columns
    got = sorted((r.doc_id or 0, r.text) for r in mixed.collect())
    assert got == sorted((r.doc_id or 0, r.text) for r in source_mix.mixed_documents(df.orderBy(F.desc("text")).repartition(3)).collect())
    assert sum(len(split(t)) for _, t in got) == sum(r.taken for r in plan) > 0
