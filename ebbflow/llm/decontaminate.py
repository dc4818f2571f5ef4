"""Benchmark decontamination by template canonicalisation, in SQL functions only.

Documents and benchmark items are put into template form: punctuation goes,
digits become ``0``, names (capitalised words within a sentence) become a
name mark, unit words after a number become a unit mark, the rest is lower
case.  Every token keeps its place, so the raw tokens give the slot values.

Windows of ``WINDOW`` tokens are hash-joined: every window of an item by its
raw lower-case tokens, and those with slots and at least ``LITERALS`` words
also in template form.  Equal hashes are confirmed on the tokens themselves,
for which only matched documents are read again.  Matches on one alignment
(document place minus item place) must fill slots consistently, both ways:
wherever the item repeats a slot value, the document has one value for it,
and where the item has several values of a kind the document does not have
one for all.  So "5 apples and 3 pears, 5 in all" matches the same question
with 7 and 4 but not a text whose numbers merely stand in like places.  Whether an item's
first word is a name only the text before it would show: a capitalised one
is looked for both as a word and as a name.

A document is contaminated if an alignment with consistent slots covers
``ENOUGH`` tokens of an item (all of it, if shorter), or if raw windows do.

Edge cases: null or empty texts and items match nothing; an item shorter than
a window is one window, and one of fewer than ``LEAST`` tokens is found by its
raw tokens alone; repeated items and rows are reported alike; rows
without a doc_id are documents of their own, as are other texts under one
doc_id; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import saved
from .textarrays import keyed, unused

WINDOW = 8  # template tokens hashed together
LITERALS = 2  # of them words, at least, for a match in template form; fewer must match as they stand
ENOUGH = 13  # tokens an alignment must cover
LEAST = 5  # tokens of an item that may match in template form
#: benchmark tokens or matches that may be broadcast (under 100 bytes each, 50 MB in all); more are joined by shuffle
BROADCAST_WINDOWS = 500_000
#: unit words and signs that count as a unit after a number
UNITS = ("mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb lbs oz pound pounds ton tons ml l liter liters litre "
         "litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years cent cents "
         "dollar dollars euro euros usd eur percent degree degrees kmh mph w kw v hz").split()
NAME, UNIT = "¤", "µ"
SLOTS = ("0", NAME, UNIT)
_IN = r"\p{L}\p{M}\p{N}"
_BETWEEN = f"[^{_IN}{NAME}]+"


def marked(text: Column) -> Column:
    """Text with the mark ``NAME`` before capitalised words within a sentence."""
    return F.regexp_replace(F.replace(text, F.lit(NAME), F.lit(" ")), r" (?=\p{Lu}\p{Ll})(?<=[\p{Ll},;] )", f" {NAME}")


def raw_tokens(text: Column) -> Column:
    """Lower-case tokens of a marked text as they stand, place for place those of ``template_tokens``."""
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit(NAME), F.lit(""))), f"[^{_IN}]+"), "")


def template_tokens(text: Column) -> Column:
    """Tokens of a marked text in template form, place for place."""
    t = F.lower(F.regexp_replace(text, f"{NAME}[{_IN}]+", NAME))
    numbers = F.regexp_replace(F.regexp_replace(t, r"\p{N}+", "0"), rf"(0{_BETWEEN})(?:{'|'.join(UNITS)})(?![{_IN}])", f"$1{UNIT}")
    return F.array_remove(F.split(F.when(t.rlike(r"\p{N}"), numbers).otherwise(t), _BETWEEN), "")


def tokenised(df: DataFrame, *keep: str) -> DataFrame:
    """``keep``, template tokens ``tmpl`` and raw tokens ``raw`` (null for a null text)."""
    d = df.select(*keep, marked(F.col("text")).alias("marked"))
    return d.select(*keep, template_tokens(F.col("marked")).alias("tmpl"), raw_tokens(F.col("marked")).alias("raw"),
                    F.trim(F.col("marked")).rlike(r"^\p{Lu}\p{Ll}").alias("capital"))


def windows(tokens: DataFrame, kinds: list[tuple[str, int]], *keep: str) -> DataFrame:
    """The hash ``h`` of every window of each kind (token column, size): keep, k (the kind), at (0-based), h."""
    n, many = F.size("raw"), len(kinds)
    places = [F.when(n >= size, F.sequence(F.lit(k), (n - size) * many + k, F.lit(many))).otherwise(F.array().cast("array<int>"))
              for k, (_, size) in enumerate(kinds)]
    # an outer explode: the plain one adds a filter that would repeat the tokenising
    used = sorted({c for c, _ in kinds} - set(keep))
    t = tokens.select(*keep, *used, F.explode_outer(F.concat(*places)).alias("x"))
    t = t.select(*keep, *used, F.pmod("x", F.lit(many)).alias("k"), F.floor(F.col("x") / many).cast("int").alias("at"))
    h = None
    for k, (column, size) in enumerate(kinds):
        name = F.xxhash64(F.slice(column, F.col("at") + 1, size))
        h = F.when(F.col("k") == k, name) if h is None else h.when(F.col("k") == k, name)
    return t.select(*keep, "k", "at", h.alias("h")).where("at IS NOT NULL")


def item_forms(benchmark: DataFrame) -> DataFrame:
    """(item_id, form, tmpl, raw, item_size) of items with a token, one row per form.

    Form 0 is the item as it stands; form 1, of items that begin with a
    capitalised word, has that word as a name, as within a sentence.
    """
    t = tokenised(benchmark, "item_id").withColumn("item_size", F.size("raw")).where("item_size > 0")
    named = F.concat(F.array(F.lit(NAME)), F.slice("tmpl", 2, F.greatest(F.col("item_size"), F.lit(1))))
    forms = F.when(F.col("capital"), F.array("tmpl", named)).otherwise(F.array("tmpl"))
    return t.select("item_id", F.posexplode(forms).alias("form", "tmpl"), "raw", "item_size").distinct()


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, item_size, form, column, size, item_at, ih): the windows to look for.

    Every window by its raw tokens, and by its template if that has a slot
    and words enough beside.
    """
    size = F.least("item_size", F.lit(WINDOW))
    t = items.withColumn("size", size).withColumn("item_at", F.explode(F.sequence(F.lit(0), F.col("item_size") - F.col("size"))))
    t = t.where("form = 0 OR item_at = 0")
    piece = lambda c: F.slice(c, F.col("item_at") + 1, F.col("size"))
    words = F.size(F.filter(piece("tmpl"), lambda x: ~x.isin(*SLOTS)))
    template = (F.col("item_size") >= LEAST) & (words < F.col("size")) & (words >= F.least(F.lit(LITERALS), F.col("size") - 1))
    raw = F.when(F.col("form") == 0, F.struct(F.lit("raw").alias("column"), F.xxhash64(piece("raw")).alias("ih")))
    tmpl = F.when(template, F.struct(F.lit("tmpl").alias("column"), F.xxhash64(piece("tmpl")).alias("ih")))
    t = t.select("item_id", "item_size", "form", "size", "item_at", F.explode(F.array(raw, tmpl)).alias("w")).where("w IS NOT NULL")
    return t.select("item_id", "item_size", "form", "w.column", "size", "item_at", "w.ih")


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Window matches in ``docs(oid, doc_id, text)``, confirmed on the tokens.

    Columns: oid, doc_id, item_id, item_size, shift, item_at, verbatim, raw, item_tmpl, item_raw.
    """
    items = saved(item_forms(benchmark), "benchmark-items")
    names = saved(item_windows(items), "benchmark-windows")
    small = items.agg(F.coalesce(F.sum("item_size"), F.lit(0))).first()[0] <= BROADCAST_WINDOWS
    kinds = sorted(tuple(r) for r in names.select("column", "size").distinct().collect()) or [("raw", WINDOW)]  # at most 2 * WINDOW
    number = F.coalesce(*[F.when((F.col("column") == c) & (F.col("size") == size), F.lit(k)) for k, (c, size) in enumerate(kinds)])
    coded = names.withColumn("ik", number)
    if names.count() <= BROADCAST_WINDOWS:
        coded = F.broadcast(coded)
    at_hand = F.broadcast if small else lambda df: df

    tokens = tokenised(docs, "oid")
    m = windows(tokens, kinds, "oid").join(coded, (F.col("h") == F.col("ih")) & (F.col("k") == F.col("ik")))
    found = saved(m.select("oid", F.struct("at", "item_id", "item_at", "item_size", "size", "form", (F.col("column") == "raw").alias("verbatim")).alias("m")), "benchmark-matches")

    # the tokens of matched documents only
    by_doc = found.groupBy("oid").agg(F.collect_set("m").alias("ms"))
    if found.count() <= BROADCAST_WINDOWS:
        by_doc = F.broadcast(by_doc)
    d = docs.where("text IS NOT NULL").join(by_doc, "oid")
    d = tokenised(d, "oid", "doc_id", "ms").select("oid", "doc_id", F.explode_outer("ms").alias("m"), "tmpl", "raw")
    part = lambda c: F.slice(c, F.col("m.at") + 1, F.col("m.size"))
    d = d.select("oid", "doc_id", "m.item_id", "m.item_at", "m.item_size", "m.size", "m.form", "m.verbatim",
                 (F.col("m.at") - F.col("m.item_at")).alias("shift"), part("tmpl").alias("tmpl"), part("raw").alias("raw"))
    of_item = items.select(F.col("item_id").alias("i"), F.col("item_size").alias("n"), F.col("form").alias("f"), F.col("tmpl").alias("it"),
                           F.col("raw").alias("ir"))
    d = d.join(at_hand(of_item), (F.col("item_id") == F.col("i")) & (F.col("item_size") == F.col("n")) & (F.col("form") == F.col("f")))
    piece = lambda c: F.slice(c, F.col("item_at") + 1, F.col("size"))
    d = d.withColumn("item_tmpl", piece("it")).withColumn("item_raw", piece("ir"))
    return (d.where(F.when(F.col("verbatim"), F.col("raw") == F.col("item_raw")).otherwise(F.col("tmpl") == F.col("item_tmpl")))
            .select("oid", "doc_id", "item_id", "item_size", "shift", "item_at", "verbatim", "raw", "item_tmpl", "item_raw"))


def covered_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document of ``docs(oid, doc_id, text)``: oid, doc_id, item_ids (ascending), covered."""
    spot = F.explode(F.arrays_zip(F.sequence(F.col("item_at"), F.col("item_at") + F.size("raw") - 1).alias("j"), "raw", "item_tmpl", "item_raw"))
    line = ["oid", "doc_id", "item_id", "item_size", "shift"]
    t = hits(docs, benchmark).select(*line, "verbatim", spot.alias("t")).select(*line, "verbatim", "t.*")
    slot = F.when(F.col("item_tmpl").isin(*SLOTS), F.col("item_tmpl"))
    t = t.groupBy(*line, "j").agg(F.max(slot).alias("slot"), F.max("verbatim").alias("bare"), F.min(F.struct("item_raw", "raw")).alias("t"))
    v = t.groupBy(*line, "slot", F.when(F.col("slot").isNotNull(), F.col("t.item_raw")).alias("value")).agg(
        F.count("*").alias("n"), F.count_if("bare").alias("bare"), F.min("t.raw").alias("lo"), F.max("t.raw").alias("hi"))
    v = v.groupBy(*line, "slot").agg(F.sum("n").alias("n"), F.sum("bare").alias("bare"),
                                     (F.max(F.col("lo") != F.col("hi")) | ((F.count("*") > 1) & (F.min("lo") == F.max("hi")))).alias("mixed"))
    a = v.groupBy(*line).agg(F.sum("n").alias("covered"), F.sum("bare").alias("bare"), F.max(F.col("slot").isNotNull() & F.col("mixed")).alias("mixed"))
    need = F.least(F.lit(ENOUGH), "item_size")
    a = a.where(((F.col("covered") >= need) & ~F.col("mixed")) | (F.col("bare") >= need))
    return a.groupBy("oid", "doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("covered").alias("covered"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document: doc_id, n_items, item_ids (ascending), covered (most tokens on one alignment)."""
    found = covered_items(keyed(docs.select("doc_id", "text")), benchmark)
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), F.size("item_ids").cast("long").alias("n_items"), "item_ids", "covered")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents; all columns stay, whatever their names."""
    key = unused(docs.columns, "__key")
    rows = keyed(docs, key)
    bad = covered_items(rows.select(F.col(key).alias("oid"), "doc_id", "text"), benchmark).select(F.col("oid").alias(key))
    return rows.join(bad, key, "left_anti").select(*docs.columns)
