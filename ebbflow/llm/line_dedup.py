"""Line dedup by content-defined chunks and line windows, in SQL functions only.

A text's lines (split at LF) are cut into chunks where a rolling hash over
the last two line hashes says so: after line i if md5(md5(line i-1) ||
md5(line i)) starts with 0-3, one line in four on average, and at the end.
A border depends on two lines alone, so an insertion moves no border
beyond its own neighbourhood, and a passage of several lines shared by
many documents falls into the same chunks in all of them.

A chunk of several lines that occurred before (smaller doc_id, or same
document, earlier line) goes.  A passage may begin and end inside a chunk,
so matches are extended line by line: every window of two lines, the
width of the rolling hash, goes too if it occurred before.  Together they
remove each line of a run of two or more lines that a text repeats,
wherever its ends lie; of a run of one repeated line the first stays.

1. Names (64-bit hashes) of chunks and windows are counted with map-side
   combine, which also finds the first occurrence.  Occurrences are joined
   with it; names that hold over 1 / ``HOT`` of all repeats, fewer than
   ``HOT`` in number, are salted.
2. Bytes: windows inside a repeated chunk are settled by it; of the rest,
   the distinct texts of each name are counted, again with map-side combine.
   One text means that all are equal.  A name with several (a collision) is
   taken apart by its texts, so results do not depend on the hash.

Edge cases: a null text stays null with no lines; chunks and windows of
white space alone stay; an empty text is one empty line; rows
equal in doc_id and text are one document; rows without a doc_id are documents
of their own, as are other texts under one doc_id, and sort last.  Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import saved
from .textarrays import keyed

#: a name is hot with over 1 / HOT of all repeats
HOT = 1000
SALTS = 64


def chunked(docs: DataFrame) -> DataFrame:
    """(oid, doc_id, text, lines, chunks) of ``docs(oid, doc_id, text)``: chunks are structs (first, size) of 1-based line numbers."""
    d = docs.withColumn("lines", F.split("text", "\n", -1))
    d = d.withColumn("names", F.transform("lines", lambda x: F.md5(x.cast("binary"))))
    count = F.size("lines")
    ends = F.filter(F.sequence(F.lit(1), count), lambda i: (i == F.size("lines")) | (
        (i > 1) & (F.substring(F.md5(F.concat(F.element_at("names", F.greatest(i - 1, F.lit(1))), F.element_at("names", i)).cast("binary")), 1, 1) < "4")))
    d = d.withColumn("ends", F.when(F.col("text").isNotNull(), ends)).drop("names")
    first = lambda k: F.when(k == 0, F.lit(1)).otherwise(F.get("ends", k - 1) + 1)
    return d.withColumn("chunks", F.transform("ends", lambda e, k: F.struct(first(k).alias("first"), (e - first(k) + 1).alias("size")))).drop("ends")


def chunk_text(first, size):
    return F.array_join(F.slice("lines", first, size), "\n")


def name_of(first: Column, size: Column) -> Column:
    """64-bit name of ``size`` lines from ``first`` on."""
    window = F.xxhash64(F.element_at("lines", first), F.element_at("lines", first + 1))
    return F.when(size == 2, window).otherwise(F.xxhash64(chunk_text(first, size)))


def spans(docs: DataFrame, windows: bool) -> DataFrame:
    """(name, oid, first, size) of chunks of several lines and, with ``windows``, of all pairs of neighbouring lines; none is blank."""
    c = chunked(docs)
    some = F.filter("chunks", lambda c: c["size"] > (2 if windows else 1))
    if windows:
        pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("lines") - 1, F.lit(1))), lambda i: F.struct(i.alias("first"), F.lit(2).alias("size")))
        some = F.concat(some, F.filter(pairs, lambda c: c["first"] < F.size("lines")))
    full = lambda c: F.exists(F.slice("lines", c["first"], c["size"]), lambda x: x.rlike("[^ \\t\\r\\f]"))
    named = F.transform(F.filter(some, full), lambda c: F.struct(name_of(c["first"], c["size"]).alias("name"), c["first"].alias("first"), c["size"].alias("size")))
    # an outer explode: the plain one adds a filter that would repeat the chunking
    return c.select("oid", F.explode_outer(named).alias("c")).where("c.name IS NOT NULL").select("c.name", "oid", "c.first", "c.size")


def marked(docs: DataFrame, windows: bool) -> DataFrame:
    """(oid, doc_id, text, chunks, again, leads): structs (first, size, lead) of repeated chunks, first lines of repeated windows and of their leads."""
    found = spans(docs, windows)
    lead = (found.groupBy("name").agg(F.min(F.struct("oid", "first")).alias("lead"), F.count("*").alias("many")).where("many > 1"))
    lead = saved(lead, "line-leads")
    total = lead.agg(F.sum("many")).first()[0] or 0
    hot = F.col("many") * HOT > total
    salted = lead.select("name", "lead", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    # fewer than HOT names
    dealt = found.join(F.broadcast(lead.where(hot).select("name", F.lit(SALTS).alias("salts"))), "name", "left")
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("oid", "first"), F.coalesce("salts", F.lit(1))).cast("int"))
    rows = dealt.join(salted, ["name", "salt"]).select("oid", "first", "size", (F.struct("oid", "first") == F.col("lead")).alias("lead"))
    by_doc = rows.groupBy("oid").agg(F.collect_set(F.when(F.col("size") > 2, F.struct("first", "size", "lead"))).alias("chunks"),
                                     F.collect_set(F.when((F.col("size") == 2) & ~F.col("lead"), F.col("first"))).alias("again"),
                                     F.collect_set(F.when((F.col("size") == 2) & F.col("lead"), F.col("first"))).alias("leads"))
    return saved(docs.join(by_doc, "oid", "left").select("oid", "doc_id", "text", "chunks", "again", "leads"), "line-texts")


def tested(texts: DataFrame, whole: bool) -> DataFrame:
    """(name, bytes, oid, first, size) of what is to be compared; without ``whole`` no windows inside a repeated chunk."""
    lines = texts.where("chunks IS NOT NULL").withColumn("lines", F.split("text", "\n", -1))
    settled = F.flatten(F.transform(F.filter("chunks", lambda c: ~c["lead"]), lambda c: F.sequence(c["first"], c["first"] + c["size"] - 2)))
    again = F.col("again") if whole else F.array_except("again", settled)
    parts = F.concat(F.transform("chunks", lambda c: F.struct(c["first"].alias("first"), c["size"].alias("size"))),
                     F.transform(F.concat(again, "leads"), lambda i: F.struct(i.alias("first"), F.lit(2).alias("size"))))
    t = lines.select("oid", "lines", F.explode(parts).alias("c"))
    return t.select(name_of(F.col("c.first"), F.col("c.size")).alias("name"), chunk_text(F.col("c.first"), F.col("c.size")).cast("binary").alias("bytes"),
                    "oid", "c.first", "c.size")


def collisions(parts: DataFrame) -> DataFrame:
    """Names with several texts."""
    return saved(parts.select("name", "bytes").distinct().groupBy("name").count().where("count > 1").select("name"), "line-collisions")


def spared(texts: DataFrame) -> DataFrame | None:
    """(oid, spare): parts that share a name with an earlier one, but are the first of their bytes; None without collisions."""
    if collisions(tested(texts, whole=False)).isEmpty():
        return None
    parts = tested(texts, whole=True)
    parts = parts.join(collisions(parts), "name")
    lead = parts.groupBy("name", "bytes").agg(F.min(F.struct("oid", "first")).alias("lead"))
    alone = parts.join(lead, ["name", "bytes"]).where(F.struct("oid", "first") == F.col("lead"))
    return alone.groupBy("oid").agg(F.collect_set(F.struct("first", "size")).alias("spare"))


def remove_repeated_lines(docs: DataFrame, windows: bool = True) -> DataFrame:
    """Per row of ``docs(doc_id, text, ..)``: doc_id, n_lines, n_removed, text (the lines that stay, joined by LF)."""
    t = marked(keyed(docs.select("doc_id", "text")), windows)
    spare = spared(t)
    go = F.concat(F.transform(F.filter("chunks", lambda c: ~c["lead"]), lambda c: F.struct(c["first"].alias("first"), c["size"].alias("size"))),
                  F.transform("again", lambda i: F.struct(i.alias("first"), F.lit(2).alias("size"))))
    if spare is not None:
        t = t.join(spare, "oid", "left")
        go = F.when(F.col("spare").isNull(), go).otherwise(F.array_except(go, "spare"))
    t = t.withColumn("lines", F.split("text", "\n", -1)).withColumn("go", go)
    gone = F.array_distinct(F.flatten(F.transform("go", lambda c: F.sequence(c["first"], c["first"] + c["size"] - 1))))
    t = t.withColumn("gone", F.coalesce(gone, F.array().cast("array<int>")))
    keep = F.transform(F.array_except(F.sequence(F.lit(1), F.size("lines")), "gone"), lambda i: F.element_at("lines", i))
    return t.select("doc_id", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed"),
                    F.when(F.size("gone") == 0, F.col("text")).otherwise(F.array_join(keep, "\n")).alias("text"))


def remove_repeated_chunks(docs: DataFrame) -> DataFrame:
    """The same by whole chunks alone, without the extension to windows."""
    return remove_repeated_lines(docs, windows=False)


SQL = """
WITH l AS (
  SELECT doc_id, i, line, md5(line) AS h FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE text IS NOT NULL)),
b AS (
  SELECT *, lag(h) OVER w AS before, lead(line) OVER w AS after FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
c AS (
  SELECT doc_id, i, line, after,
    coalesce(sum(CASE WHEN before IS NOT NULL AND substr(md5(before || h), 1, 1) < '4' THEN 1 ELSE 0 END)
      OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM b),
g AS (
  SELECT doc_id, k, min(i) AS first, count(*) AS size, string_agg(line, chr(10) ORDER BY i) AS chunk FROM c GROUP BY doc_id, k),
r AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, first) AS nth FROM g
  WHERE size > 1 AND regexp_matches(chunk, '[^ \\t\\n\\r\\f]')),
p AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY line, after ORDER BY doc_id, i) AS nth FROM c
  WHERE after IS NOT NULL AND regexp_matches(line || after, '[^ \\t\\r\\f]')),
m AS (
  SELECT c.doc_id, c.i, c.line, coalesce(r.nth, 1) > 1 OR coalesce(p.nth, 1) > 1
    OR coalesce(lag(p.nth) OVER (PARTITION BY c.doc_id ORDER BY c.i), 1) > 1 AS gone
  FROM c LEFT JOIN r ON c.doc_id = r.doc_id AND c.k = r.k LEFT JOIN p ON c.doc_id = p.doc_id AND c.i = p.i)
SELECT d.doc_id, coalesce(x.n_lines, 0)::BIGINT AS n_lines, coalesce(x.n_removed, 0)::BIGINT AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN coalesce(x.text, '') END AS text
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN gone THEN 1 ELSE 0 END) AS n_removed,
    string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS text
  FROM m GROUP BY doc_id) x ON d.doc_id = x.doc_id
"""
