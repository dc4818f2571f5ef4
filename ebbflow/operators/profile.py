"""Profiling (EDA) as a fixed number of passes, whatever the column count.

* moments and extremes of every numeric column: one ``agg`` (partial
  aggregation map-side), reshaped with ``stack``;
* everything per (column, value) — distinct counts, top categories,
  churn by feature, binary detection — comes from one ``unpivot`` +
  ``groupBy(column, value)``, a single shuffle whose map-side combine
  absorbs hot values;
* quantiles are exact and distributed (``ordered.exact_quantiles``).

Result tables are tidy (one row per column / pair / bin) and carry plain
names so they can be unioned into the long summary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as X
from ..functions import constants as K
from .comoments import correlation_pairs
from .ordered import exact_quantiles

# the DataFrame's own dtype names, as pandas would report them
_DTYPE_NAMES = {
    T.StringType: "object", T.BooleanType: "bool", T.IntegerType: "int64",
    T.LongType: "int64", T.ShortType: "int64", T.ByteType: "int64",
    T.DoubleType: "float64", T.FloatType: "float64",
}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def dtype_name(dt: T.DataType) -> str:
    return _DTYPE_NAMES.get(type(dt), dt.simpleString())


def _cell(df: DataFrame, name: str) -> Column:
    """A cell as it is counted: NaN is missing and ``-0.0`` equals ``0.0``."""
    dt = df.schema[name].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return (X.num(X.c(name)) + F.lit(0.0)).cast(dt)
    return X.c(name)


def _long_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value double) for every numeric cell, NaN as null."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), X.num(X.c(c).cast("double")).alias("value"))
        for c in cols])).alias("s")).select("s.column_name", "s.value")


def _long_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value string) for every cell, nulls kept."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), X.c(c).cast("string").alias("value"))
        for c in cols])).alias("s")).select("s.column_name", "s.value")


def value_frequencies(df: DataFrame, cols: list[str] | None = None,
                      label: str | None = K.LABEL) -> DataFrame:
    """(column, value, n, label_sum) over non-null values: one shuffle."""
    cols = cols or df.columns
    lab = label if label and label in df.columns else None
    structs = [F.struct(F.lit(c).alias("column_name"), _cell(df, c).cast("string").alias("value"))
               for c in cols]
    base = df.select(F.explode(F.array(*structs)).alias("s"),
                     *( [X.c(lab).alias("_y")] if lab else []))
    agg = [F.count(F.lit(1)).alias("n")]
    if lab:
        agg.append(F.sum("_y").cast("bigint").alias("label_sum"))
    return (base.where(F.col("s.value").isNotNull())
            .groupBy(F.col("s.column_name").alias("column_name"), F.col("s.value").alias("value"))
            .agg(*agg))


# -------------------------------------------------------------- structure
def null_counts(df: DataFrame) -> DataFrame:
    """Per column: position, kind, dtype, rows and null count — one
    aggregate over the table, reshaped to one row per column."""
    fields = df.schema.fields
    num = set(numeric_columns(df))
    info = df.sparkSession.createDataFrame(
        [(f.name, i, "numeric" if f.name in num else "categorical", dtype_name(f.dataType))
         for i, f in enumerate(fields)],
        "column_name string, position int, kind string, dtype string")
    nulls = df.agg(F.count(F.lit(1)).alias("_rows"),
                   *[F.count_if(_cell(df, f.name).isNull()).alias(f"n{i}")
                     for i, f in enumerate(fields)])
    nulls_long = nulls.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"n{i}").alias("n_null"))
        for i, f in enumerate(fields)])).alias("s")).select(
        F.col("_rows").cast("bigint").alias("n_rows"), "s.column_name", F.col("s.n_null").cast("bigint").alias("n_null"))
    return F.broadcast(info).join(nulls_long, "column_name")


def column_profile(df: DataFrame, vf: DataFrame | None = None) -> DataFrame:
    """Per column: position, kind, dtype, rows, exact distinct and null
    counts, whatever the cardinality: values are grouped by (column, value)
    and the groups counted.  ``vf`` is an optional precomputed
    ``value_frequencies`` table of all columns."""
    vf = vf if vf is not None else value_frequencies(df, label=None)
    distinct = vf.groupBy("column_name").agg(F.count(F.lit(1)).alias("_d"))  # one row per column
    return (null_counts(df).join(F.broadcast(distinct), "column_name", "left")
            .select("column_name", "position", "kind", "dtype", "n_rows",
                    F.coalesce(F.col("_d"), F.lit(0)).cast("bigint").alias("n_distinct"), "n_null"))


def dtype_counts(df: DataFrame) -> DataFrame:
    """Columns and non-null cells per dtype (one aggregate, no distincts)."""
    return null_counts(df).groupBy("dtype").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_columns"),
        F.sum(F.col("n_rows") - F.col("n_null")).cast("bigint").alias("n_values"))


def binary_columns(df: DataFrame) -> DataFrame:
    """Columns with exactly two distinct non-null values: the smallest and
    the largest differ and no cell lies between them.  Two aggregates of
    one row each; no value is shuffled."""
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    ends = df.agg(*[e for i, f in enumerate(fields) for e in (
        F.min(_cell(df, f.name)).alias(f"lo{i}"), F.max(_cell(df, f.name)).alias(f"hi{i}"))]).collect()[0]
    two = [(i, f) for i, f in enumerate(fields) if ends[f"lo{i}"] != ends[f"hi{i}"]]
    found = []
    if two:
        between = df.agg(*[F.count_if((_cell(df, f.name) != F.lit(ends[f"lo{i}"]).cast(f.dataType))
                                      & (_cell(df, f.name) != F.lit(ends[f"hi{i}"]).cast(f.dataType))).alias(f"b{i}")
                           for i, f in two]).collect()[0]
        found = [f.name for i, f in two if between[f"b{i}"] == 0]
    return df.sparkSession.createDataFrame([(c, df.columns.index(c)) for c in found], "column_name string, position int")


def missing_values(df: DataFrame) -> DataFrame:
    """Missing cells (null or NaN) and their percent for columns that have
    any (one aggregate)."""
    p = null_counts(df)
    return (p.select("column_name", "position", F.col("n_null").alias("n_missing"),
                     F.try_divide(F.col("n_null") * 100.0, F.col("n_rows")).alias("pct_missing"),
                     F.sum("n_null").over(Window.partitionBy(F.lit(0))).alias("total_missing"))
            .where(F.col("n_missing") > 0))


# ---------------------------------------------------------------- numeric
def numeric_counts(vf: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value double, n) of numeric columns from a ``value_frequencies`` table."""
    return vf.where(F.col("column_name").isin(*cols)).select("column_name", F.col("value").cast("double").alias("value"), "n")


def quartiles(counted: DataFrame) -> DataFrame:
    """(column_name, n, q25, q50, q75) of a ``numeric_counts`` table."""
    return exact_quantiles(counted, ["column_name"], "value", [0.25, 0.5, 0.75], names=["q25", "q50", "q75"], weight="n")


def numeric_stats(df: DataFrame, cols: list[str] | None = None, quarts: DataFrame | None = None) -> DataFrame:
    """count, mean, std (n-1), min, q25, q50, q75, max, skewness, kurtosis
    (bias-corrected) per numeric column.  ``quarts``: known ``quartiles``."""
    cols = cols or numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        v = X.num(X.c(c).cast("double"))
        aggs += [F.count(v).alias(f"c{i}"), F.avg(v).alias(f"m{i}"),
                 F.stddev_samp(v).alias(f"s{i}"), F.min(v).alias(f"lo{i}"),
                 F.max(v).alias(f"hi{i}"),
                 F.coalesce(X.sample_skewness(v), F.when(F.count(v) >= 3, 0.0)).alias(f"sk{i}"),
                 F.coalesce(X.sample_kurtosis(v), F.when(F.count(v) >= 4, 0.0)).alias(f"ku{i}")]
    wide = df.agg(*aggs)
    moments = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"),
                 F.col(f"c{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                 F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"),
                 F.col(f"hi{i}").alias("max"), F.col(f"sk{i}").alias("skewness"),
                 F.col(f"ku{i}").alias("kurtosis"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")
    qs = quarts if quarts is not None else exact_quantiles(_long_numeric(df, cols), ["column_name"], "value", [0.25, 0.5, 0.75],
                                                           names=["q25", "q50", "q75"])
    return (moments.join(qs.drop("n"), "column_name", "left")
            .select("column_name", "position", "count", "mean", "std", "min", "q25", "q50", "q75",
                    "max", "skewness", "kurtosis"))


def outliers_iqr(df: DataFrame, cols: list[str] | None = None, counted: DataFrame | None = None,
                 quarts: DataFrame | None = None) -> DataFrame:
    """Values strictly outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR]; percent over
    the non-null count.  Fences (one row per column) are broadcast.  A
    column without values has 0 outliers and a null percent.  ``counted``
    and ``quarts``: known ``numeric_counts`` and ``quartiles``."""
    cols = cols or numeric_columns(df)
    if counted is None:
        counted = _long_numeric(df, cols).where(F.col("value").isNotNull()).withColumn("n", F.lit(1).cast("bigint"))
    q = quarts if quarts is not None else quartiles(counted)
    iqr = F.col("q75") - F.col("q25")
    fences = q.select("column_name", (F.col("q25") - K.IQR_FACTOR * iqr).alias("lower"),
                      (F.col("q75") + K.IQR_FACTOR * iqr).alias("upper"))
    pos = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)],
                                          "column_name string, position int")
    beyond = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    out = (counted.join(F.broadcast(fences), "column_name")
           .groupBy("column_name")
           .agg(F.sum("n").alias("n"), F.sum(F.when(beyond, F.col("n")).otherwise(0)).alias("n_outliers")))
    return (pos.join(F.broadcast(out), "column_name", "left")
            .select("column_name", "position", F.coalesce(F.col("n_outliers"), F.lit(0)).cast("bigint").alias("n_outliers"),
                    (F.col("n_outliers") * 100.0 / F.col("n")).alias("pct_outliers")))


def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson r for every ordered pair (pairwise-complete), one pass over
    column blocks; null where fewer than two rows are shared or a column is
    constant over them."""
    cols = cols or numeric_columns(df)
    name = F.array(*[F.lit(c) for c in cols])
    return correlation_pairs(df, cols).select(name[F.col("i")].alias("var1"), name[F.col("j")].alias("var2"), "i", "j", "correlation")


def strong_correlations(df: DataFrame, cols: list[str] | None = None,
                        threshold: float = K.STRONG_CORRELATION) -> DataFrame:
    m = correlation_matrix(df, cols)
    return m.where((F.col("i") < F.col("j")) & (F.abs("correlation") > threshold))


def histogram(df: DataFrame, cols: list[str] | None = None, bins: int = K.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between min and max, last bin closed (numpy rules:
    edges ``min + i * (max - min) / bins``, index corrected against them).
    Only populated bins are returned."""
    cols = cols or numeric_columns(df)
    return histogram_long(_long_numeric(df, cols), bins)


def histogram_long(long: DataFrame, bins: int = K.HISTOGRAM_BINS) -> DataFrame:
    """``histogram`` over a long ``(column_name, value)`` table: every
    series gets its own range; one pass for the ranges, one for the bins."""
    long = long.where(F.col("value").isNotNull())
    rng = long.groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    # numpy widens a zero range by 0.5 on each side
    rng = rng.select("column_name",
                     F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                     F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    step = (F.col("hi") - F.col("lo")) / bins
    j = long.join(F.broadcast(rng), "column_name")
    raw = F.floor((F.col("value") - F.col("lo")) * (F.lit(bins) / (F.col("hi") - F.col("lo")))).cast("int")
    j = j.withColumn("_i", F.least(raw, F.lit(bins - 1)))
    edge = lambda k: k * step + F.col("lo")
    j = j.withColumn("_i", F.when(F.col("value") < edge(F.col("_i")), F.col("_i") - 1).otherwise(F.col("_i")))
    j = j.withColumn("_i", F.when((F.col("value") >= edge(F.col("_i") + 1)) & (F.col("_i") != bins - 1),
                                  F.col("_i") + 1).otherwise(F.col("_i")))
    out = j.groupBy("column_name", "_i", "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
    return out.select("column_name", F.col("_i").alias("bin"),
                      (F.col("_i") * step + F.col("lo")).alias("bin_lo"),
                      F.when(F.col("_i") == bins - 1, F.col("hi"))
                      .otherwise((F.col("_i") + 1) * step + F.col("lo")).alias("bin_hi"),
                      "count")


def box_stats(df: DataFrame, cols: tuple[str, ...] = ("monthly_fee", "months_with_provider"),
              by: str = K.LABEL) -> DataFrame:
    """Five-number summary per ``by`` group with 1.5 IQR whiskers (the
    most extreme values inside the fences) and the count beyond them."""
    cols = [c for c in cols if c in df.columns]
    long = (df.select(X.c(by).alias("grp"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), X.num(X.c(c).cast("double")).alias("value"))
        for c in cols])).alias("s")).select("grp", "s.column_name", "s.value")
        .where(F.col("value").isNotNull()))
    q = exact_quantiles(long, ["column_name", "grp"], "value", [0.25, 0.5, 0.75],
                        names=["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    qf = q.select("column_name", "grp", "q1", "median", "q3",
                  (F.col("q1") - K.IQR_FACTOR * iqr).alias("_lo"),
                  (F.col("q3") + K.IQR_FACTOR * iqr).alias("_hi"))
    v = F.col("value")
    fences = qf.select("column_name", "grp", "_lo", "_hi")  # joined as AQE sees fit
    agg = (long.join(fences, ["column_name", "grp"])
           .groupBy("column_name", "grp")
           .agg(F.min(F.when(v >= F.col("_lo"), v)).alias("whisker_low"),
                F.max(F.when(v <= F.col("_hi"), v)).alias("whisker_high"),
                F.count_if((v < F.col("_lo")) | (v > F.col("_hi"))).cast("bigint").alias("n_fliers"),
                F.min(v).alias("min"), F.max(v).alias("max")))
    return (qf.drop("_lo", "_hi").join(agg, ["column_name", "grp"])
            .select("column_name", F.col("grp").alias(by), "min", "whisker_low", "q1", "median", "q3",
                    "whisker_high", "max", "n_fliers"))


# ------------------------------------------------------------ categorical
def _vf_for(df: DataFrame, cols: list[str], vf: DataFrame | None, label: str | None = None) -> DataFrame:
    if vf is None:
        return value_frequencies(df, cols, label=label)
    return vf.where(F.col("column_name").isin(*cols))


def categorical_stats(df: DataFrame, vf: DataFrame | None = None) -> DataFrame:
    """Distinct count, most frequent value (ties: smallest) and its count."""
    cols = categorical_columns(df)
    vf = _vf_for(df, cols, vf)
    top = vf.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("unique_values"),
        F.min(F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("b"))
    pos = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)],
                                          "column_name string, position int")
    return (top.join(F.broadcast(pos), "column_name")
            .select("column_name", "position", F.col("unique_values").cast("bigint").alias("unique_values"),
                    F.col("b.v").alias("most_frequent"),
                    (-F.col("b.k")).cast("bigint").alias("frequency_most_frequent")))


def top_categories(df: DataFrame, k: int = K.TOP_CATEGORIES, vf: DataFrame | None = None) -> DataFrame:
    """Top-``k`` values per categorical column by count (ties: value asc).

    ``row_number`` per column over the (column, value) table; Spark plans
    it with a per-partition group limit before the window's shuffle."""
    vf = _vf_for(df, categorical_columns(df), vf)
    w = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value").asc())
    return (vf.select("column_name", "value", F.col("n").cast("bigint").alias("count"),
                      F.row_number().over(w).alias("rank"))
            .where(F.col("rank") <= k))


def value_counts(df: DataFrame, col: str = K.LABEL) -> DataFrame:
    return (df.where(X.c(col).isNotNull()).groupBy(X.c(col).alias(col))
            .agg(F.count(F.lit(1)).alias("count")))


# ------------------------------------------------------------------ churn
def churn_summary(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    y = X.c(label)
    return df.agg(F.avg(y).alias("churn_rate"),
                  F.sum(y).cast("bigint").alias("churned_count"),
                  (F.count(F.lit(1)) - F.sum(y)).cast("bigint").alias("retained_count"))


def churn_feature_columns(df: DataFrame, label: str = K.LABEL, vf: DataFrame | None = None) -> list[str]:
    """Text/bool columns, or numeric ones with fewer than 10 distinct values,
    excluding the label and the two id columns.  The distinct counts come
    from ``vf`` when given, else from one (column, value) grouping."""
    skip = set(K.CHURN_BY_FEATURE_SKIP) | {label}
    cat = [c for c in categorical_columns(df) if c not in skip]
    nums = [c for c in numeric_columns(df) if c not in skip]
    keep_num = []
    if nums:
        freq = vf if vf is not None else value_frequencies(df, nums, label=None)
        n = (freq.where(F.col("column_name").isin(*nums)).groupBy("column_name")
             .agg(F.count(F.lit(1)).alias("d")).collect())  # one row per column
        many = {r["column_name"] for r in n if r["d"] >= 10}
        keep_num = [c for c in nums if c not in many]
    return [c for c in df.columns if c in set(cat) | set(keep_num)]


def churn_by_feature(df: DataFrame, cols: list[str] | None = None, label: str = K.LABEL,
                     vf: DataFrame | None = None) -> DataFrame:
    """Mean churn and count per (feature, value), null values dropped —
    every feature in one shuffle.  A shared ``vf`` must carry
    ``label_sum``."""
    cols = cols if cols is not None else churn_feature_columns(df, label)
    vf = _vf_for(df, cols, vf, label=label)
    return vf.select(F.col("column_name").alias("feature"), "value",
                     (F.col("label_sum") / F.col("n")).alias("churn_rate"),
                     F.col("n").cast("bigint").alias("count"))


def churn_by_contract(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    return (df.where(F.col("contract_type").isNotNull()).groupBy("contract_type")
            .agg(F.avg(label).alias("churn_rate")))


def key_feature_report(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """Churn rate of the key features with the 4-decimal/percent text."""
    cols = [c for c in K.KEY_FEATURES if c in df.columns]
    cb = churn_by_feature(df, cols, label)
    r = F.col("churn_rate")
    return cb.select("feature", F.col("value").alias("category"), "churn_rate",
                     F.format_string("%.4f (%.2f%%)", r, r * 100).alias("text"))


def shared_frequencies(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """``value_frequencies`` of every column with the label sum, written
    once to the shared checkpoint folder: the distinct counts, categorical
    stats, top categories and churn-by-feature all read it instead of each
    re-exploding the table."""
    from ..session import work_dir
    work_dir(df.sparkSession)
    return value_frequencies(df, df.columns, label=label).checkpoint(eager=True)


SUMMARY_NUMERIC_METRICS = ["count", "mean", "std", "min", "q25", "q50", "q75", "max", "skewness", "kurtosis"]
SUMMARY_TOP_CATEGORIES = 5


def _tidy(df: DataFrame, section: str, name: Column, metrics: dict[str, Column], text: Column | None = None) -> DataFrame:
    """(section, column_name, metric, value, text) rows, one ``explode`` per
    block, so that each source table is scanned once."""
    text = text if text is not None else F.lit(None)
    items = [F.struct(F.lit(m).alias("metric"), F.round(v.cast("double"), 9).alias("value"),
                      text.cast("string").alias("text")) for m, v in metrics.items()]
    return df.select(F.lit(section).alias("section"), name.cast("string").alias("column_name"),
                     F.explode(F.array(*items)).alias("s")).select("section", "column_name", "s.*")


def summary_blocks(raw: DataFrame, label: str = K.LABEL) -> dict[str, DataFrame]:
    """The blocks of the whole summary as tidy tables: dataset info, column
    types, missing values, numerical statistics with outliers, categorical
    statistics with the top categories, correlations, churn.  The churn
    blocks are left out without the label column, the correlations with
    fewer than two numeric columns, the numerical statistics without any.  (Memory use of a local frame has no
    counterpart in a distributed table.)"""
    vf = shared_frequencies(raw, label)
    prof = column_profile(raw, vf).select("*", F.lit(1).alias("one"))
    none = F.lit(None)
    info = prof.agg(F.max("n_rows").alias("r"), F.count(F.lit(1)).alias("c"), F.sum("n_null").alias("m"),
                    *[F.count_if(c).alias(a) for a, c in (("nn", F.col("kind") == "numeric"),
                                                          ("nc", F.col("kind") == "categorical"),
                                                          ("nb", F.col("n_distinct") == 2))])
    cat = categorical_stats(raw, vf)
    blocks = {
        "dataset_info": _tidy(info, "dataset_info", none, {"total_rows": F.col("r"), "total_columns": F.col("c")}),
        "type_counts": _tidy(info, "column_types", none, {"numerical": F.col("nn"), "categorical": F.col("nc"),
                                                         "binary": F.col("nb")}),
        "column_types": _tidy(prof, "column_types", F.col("column_name"), {"type": F.col("one")},
                              F.concat_ws(",", "kind", "dtype", F.when(F.col("n_distinct") == 2, "binary"))),
        "total_missing": _tidy(info, "missing_values", none, {"total_missing": F.col("m")}),
        "missing": _tidy(missing_values(raw), "missing_values", F.col("column_name"),
                         {c: F.col(c) for c in ("n_missing", "pct_missing")}),
        "categorical": _tidy(cat, "categorical_stats", F.col("column_name"), {"unique_values": F.col("unique_values")}),
        "most_frequent": _tidy(cat, "categorical_stats", F.col("column_name"),
                               {"most_frequent": F.col("frequency_most_frequent")}, F.col("most_frequent")),
        "top_categories": _tidy(top_categories(raw, vf=vf), "categorical_stats", F.col("column_name"),
                                {"category": F.col("count")}, F.col("value")),
        "top_categories_short": _tidy(top_categories(raw, SUMMARY_TOP_CATEGORIES, vf), "categorical_stats",
                                      F.col("column_name"), {"category": F.col("count")}, F.col("value")),
    }
    if numeric_columns(raw):
        # quartiles and outliers come from the counted values; the quartiles (one row a column) are kept
        counted = numeric_counts(vf, numeric_columns(raw))
        quarts = quartiles(counted).checkpoint(eager=True)
        blocks["numeric"] = _tidy(numeric_stats(raw, quarts=quarts), "numerical_stats", F.col("column_name"),
                                  {c: F.col(c) for c in SUMMARY_NUMERIC_METRICS})
        blocks["outliers"] = _tidy(outliers_iqr(raw, counted=counted, quarts=quarts), "numerical_stats", F.col("column_name"),
                                   {c: F.col(c) for c in ("n_outliers", "pct_outliers")})
    if len(numeric_columns(raw)) > 1:
        m = correlation_matrix(raw)
        strong = m.where((F.col("i") < F.col("j")) & (F.abs("correlation") > K.STRONG_CORRELATION))
        blocks["correlations"] = _tidy(m, "correlations", F.col("var1"), {"correlation": F.col("correlation")}, F.col("var2"))
        blocks["strong_correlations"] = _tidy(strong, "strong_correlations", F.col("var1"),
                                              {"correlation": F.col("correlation")}, F.col("var2"))
    if label in raw.columns:
        by = churn_by_feature(raw, churn_feature_columns(raw, label, vf), label, vf)
        key = by.where(F.col("feature").isin(*K.KEY_FEATURES))
        blocks["churn"] = _tidy(churn_summary(raw, label), "churn_analysis", none,
                                {c: F.col(c) for c in ("churn_rate", "churned_count", "retained_count")})
        blocks["churn_by_feature"] = _tidy(by, "churn_by_feature", F.col("feature"),
                                           {c: F.col(c) for c in ("churn_rate", "count")}, F.col("value"))
        blocks["churn_key_features"] = _tidy(key, "churn_by_feature", F.col("feature"),
                                             {"churn_rate": F.col("churn_rate")}, F.col("value"))
    return blocks


def _union(blocks: dict[str, DataFrame], leave: tuple[str, ...]) -> DataFrame:
    out = None
    for name, b in blocks.items():
        if name not in leave:
            out = b if out is None else out.unionByName(b)
    return out


def generate_summary(raw: DataFrame, label: str = K.LABEL) -> DataFrame:
    """The whole summary, one tidy table: every block with ten categories a
    column, the full correlation matrix and churn by every feature."""
    return _union(summary_blocks(raw, label), ("top_categories_short", "churn_key_features"))


def summary_long(raw: DataFrame, label: str = K.LABEL) -> DataFrame:
    """The summary as it is exported to CSV: five categories a column, the
    strong correlations only and the churn rate of the key features."""
    return _union(summary_blocks(raw, label), ("top_categories", "correlations", "churn_by_feature"))
