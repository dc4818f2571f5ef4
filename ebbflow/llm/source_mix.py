"""Mixing sources to target weights by Sainte-Laguë apportionment.

1. Targets: sources in code point order (null last) weigh ``WEIGHTS`` in
   turn and share ``SHARE`` of all words; no source gets more than ``MOST``
   times its own words.  In the order of their caps per weight the capped
   sources are a prefix, so running sums settle the resharing at once.
2. The mix is dealt in blocks of ``BLOCK_WORDS`` words.  Sainte-Laguë
   apportionment (highest quotients target / (2k + 1)) gives each source an
   integer number of blocks, then each shard of the source its quota, by its
   words.  Seats start from rounded quotas; the few quotients near the
   divisor decide the rest, so work is linear in the parties.
3. A shard orders its documents by a seeded md5 and cuts the word stream into
   blocks.  A quota of q out of m blocks takes every block q div m times and
   a seeded run of q mod m blocks once more.  A document's words in those
   blocks are plain arithmetic on running sums: no block is ever a row.

Shards hold about ``SHARD_WORDS`` words, so a source with a third of all
rows spreads over as many tasks as its size needs.  Everything is a function
of ids, sizes and ``SEED``: reruns agree.

Edge cases: null texts have size 0 and are never taken; null sources are a
source; rows equal in
doc_id, text and source are taken alike; rows without a doc_id are documents of
their own, as are others under one doc_id; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import saved
from .textarrays import WORD, keyed, unused

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 21
SEED = "mix-1"


def sized(docs: DataFrame, key: str = "__id") -> DataFrame:
    """(key, doc_id, source, size, r) of ``docs`` with their ``key``: words of each document and its seeded order key."""
    words = F.length(F.regexp_replace(F.regexp_replace("text", WORD, "w"), r"[\x20\x09-\x0D]+", ""))
    return docs.select(F.col(key).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "source", F.coalesce(words, F.lit(0)).cast("long").alias("size"),
                       F.md5(F.concat(F.lit(SEED), F.col(key).cast("string")).cast("binary")).alias("r"))


def same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target): one row per source."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1) % len(WEIGHTS)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(x) for x in WEIGHTS]), (turn + 1).cast("int")).cast("double"))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    cap = F.col("source_size") * MOST
    s = s.withColumn("total", F.sum("source_size").over(whole) * F.lit(SHARE)).withColumn("cap", cap)
    s = s.withColumn("before", F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("open", F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing)))
    level = (F.col("total") - F.col("before")) / F.col("open")
    s = s.withColumn("capped", F.col("cap") <= level * F.col("weight"))
    s = s.withColumn("level", F.max(F.when(~F.col("capped"), level)).over(whole))
    return s.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def apportion(parties: DataFrame, group: list[str], key: list[str], votes: str, seats: str) -> DataFrame:
    """Adds ``given``: Sainte-Laguë seats per party; ``seats`` is the group's total on each of its rows.

    Ties go to the party that comes first by ``key``.
    """
    by = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    p = parties.withColumn("_v", F.col(votes).cast("double")).withColumn("_sum", F.sum("_v").over(by))
    p = p.withColumn("_ideal", F.when(F.col("_sum") > 0, F.col("_v") * F.col(seats) / F.col("_sum")).otherwise(F.lit(0.0)))
    p = p.withColumn("_base", F.floor(F.col("_ideal") + 0.5))
    p = p.withColumn("_over", F.when(F.col("_sum") > 0, F.sum("_base").over(by) - F.col(seats)).otherwise(F.lit(0))).withColumn("_n", F.count("*").over(by))
    # a party gains or loses at most its share of the difference, and two more
    reach = F.floor(F.col("_ideal") * (F.abs("_over") + F.col("_n")) / F.greatest(F.col(seats), F.lit(1))) + 2
    ks = F.when(F.col("_over") > 0, F.when(F.col("_base") > 0, F.sequence(F.greatest(F.col("_base") - reach, F.lit(0)), F.col("_base") - 1))) \
        .when(F.col("_over") < 0, F.sequence(F.col("_base"), F.col("_base") + reach))
    c = p.where("_over <> 0 AND _v > 0").select(*key, "_over", "_v", F.explode(ks).alias("_k"), *[g for g in group if g not in key])
    quotient = F.col("_v") / (2 * F.col("_k") + 1)
    lose = Window.partitionBy(*group or [F.lit(1)]).orderBy(quotient, *[F.desc_nulls_first(k) for k in key])
    gain = Window.partitionBy(*group or [F.lit(1)]).orderBy(F.desc(quotient), *[F.asc_nulls_last(k) for k in key])
    c = c.withColumn("_nth", F.when(F.col("_over") > 0, F.row_number().over(lose)).otherwise(F.row_number().over(gain)))
    c = c.where(F.col("_nth") <= F.abs("_over")).groupBy(*key).agg(F.sum(F.when(F.col("_over") > 0, -1).otherwise(1)).alias("_moved"))
    c = c.select(*[F.col(k).alias(f"_k_{k}") for k in key], "_moved")
    on = [same(k, f"_k_{k}") for k in key]
    joined = p.join(c, on, "left").withColumn("given", (F.col("_base") + F.coalesce("_moved", F.lit(0))).cast("long"))
    return joined.select(*parties.columns, "given")


def mix(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: key, doc_id, size, source_size, target, taken, and where in the document the extra copy lies.

    ``base`` whole copies are taken, and once more the words of the document
    at [from1, to1) and [from2, to2) (0-based word numbers).
    """
    return plan(keyed(docs.select("doc_id", "text", "source"), "__id", ("text", "source")))


def plan(docs: DataFrame, key: str = "__id") -> DataFrame:
    """The mix of ``docs`` named by ``key``; see ``mix``."""
    d = saved(sized(docs, key), "mix-sizes")
    t = targets(d).withColumn("blocks", F.round(F.sum("target").over(Window.partitionBy(F.lit(1))) / BLOCK_WORDS).cast("long"))
    t = apportion(t, [], ["source"], "target", "blocks")
    t = t.withColumn("shards", F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1)))
    t = saved(t.select(F.col("source").alias("of"), "source_size", "target", F.col("given").alias("due"), "shards"), "mix-sources")
    d = d.join(t, same("source", "of")).drop("of").withColumn("shard", F.pmod(F.conv(F.substring("r", 1, 8), 16, 10).cast("long"), "shards"))

    v = d.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("due").alias("due"))
    v = apportion(v, ["source"], ["source", "shard"], "words", "due").withColumn("m", F.ceil(F.col("words") / BLOCK_WORDS))
    v = v.withColumn("q", F.least("given", F.col("m") * MOST)).where("m > 0")
    name = F.concat_ws("/", F.lit(SEED), F.coalesce("source", F.lit("")), F.col("shard").cast("string"))
    v = v.withColumn("start", F.pmod(F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long"), "m"))
    v = v.select(F.col("source").alias("of"), F.col("shard").alias("at"), "words", F.floor(F.col("q") / F.col("m")).alias("base"),
                 "start", F.pmod("q", "m").alias("extra"), "m")

    line = Window.partitionBy("source", "shard").orderBy("r", "key").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("b", F.sum("size").over(line)).withColumn("a", F.col("b") - F.col("size"))
    d = d.join(v, same("source", "of") & (F.col("shard") == F.col("at")), "left")
    lo1, hi1 = F.col("start") * BLOCK_WORDS, F.least((F.col("start") + F.col("extra")) * BLOCK_WORDS, "words")
    hi2 = F.greatest(F.col("start") + F.col("extra") - F.col("m"), F.lit(0)) * BLOCK_WORDS
    inside = lambda x: F.coalesce(F.least(F.greatest(x - F.col("a"), F.lit(0)), "size"), F.lit(0)).cast("long")
    d = d.select("key", "doc_id", "size", "source_size", "target", F.coalesce("base", F.lit(0)).cast("long").alias("base"),
                 inside(lo1).alias("from1"), inside(hi1).alias("to1"), F.lit(0).cast("long").alias("from2"), inside(hi2).alias("to2"))
    extra = F.greatest(F.col("to1") - F.col("from1"), F.lit(0)) + F.col("to2")
    return d.withColumn("taken", F.col("base") * F.col("size") + extra)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows with the columns of ``docs``: each whole copy, then the text of the extra run, cut at words.

    A document of which nothing is taken gives no row.  ``n_chars``, if
    there, is set to the length of the row's own text.  All columns stay,
    whatever their names.
    """
    key, p, words, piece = (unused(docs.columns, f"__{x}") for x in ("id", "plan", "words", "text"))
    rows = keyed(docs, key, ("text", "source"))
    due = plan(rows, key).groupBy(F.col("key").alias(key)).agg(F.min(F.struct("size", "base", "from1", "to1", "to2")).alias(p))
    d = rows.join(due, key).where(F.col(f"{p}.size") > 0)
    d = d.withColumn(words, F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)))

    def cut(lo, hi):
        some = F.array_join(F.slice(words, (lo + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int")), "")
        return F.when((lo == 0) & (hi == F.col(f"{p}.size")), F.col("text")).when(hi > lo, F.regexp_replace(some, r"[\x20\x09-\x0D]+$", ""))
    parts = F.concat(F.array_repeat("text", F.col(f"{p}.base").cast("int")),
                     F.array(cut(F.col(f"{p}.from1"), F.col(f"{p}.to1")), cut(F.lit(0), F.col(f"{p}.to2"))))
    # an outer explode: the plain one adds a filter that would repeat the cutting
    d = d.withColumn(piece, F.explode_outer(F.filter(parts, lambda x: x.isNotNull()))).where(F.col(piece).isNotNull())
    length = {"n_chars": F.length(piece).cast(docs.schema["n_chars"].dataType).alias("n_chars")} if "n_chars" in docs.columns else {}
    return d.select(*[F.col(piece).alias("text") if c == "text" else length.get(c, F.col(c)) for c in docs.columns])
