"""Catalog: profiling (EDA) of the raw subscriber table.

The oracle text is generated per column from the raw schema (the same
fixed schema the Spark side reads), so each per-column block is a plain
aggregate in DuckDB; the Spark side runs the fixed-pass operators.
"""

from __future__ import annotations

from itertools import combinations


from ..functions import constants as K
from ..operators import profile as P
from ..sources import fixtures as fx
from ..sources.files import RAW_SCHEMA
from ..sources.fixtures import oracle_cte
from .registry import ORACLE, query
from .sqltext import ident, q

SUB = oracle_cte("subscribers")
_NUMERIC = [f.name for f in RAW_SCHEMA.fields if f.dataType.typeName() in ("integer", "double")]
_DTYPE = {f.name: ("float64" if f.dataType.typeName() == "double" else
                   "int64" if f.dataType.typeName() == "integer" else "object") for f in RAW_SCHEMA.fields}
_POS = {c: i for i, c in enumerate(K.RAW_COLUMNS)}
_CATEG = [c for c in K.RAW_COLUMNS if c not in _NUMERIC]
# churn-by-feature columns the rule picks on this schema: text columns and
# numeric ones with < 10 distinct values, minus label and ids
_CHURN_COLS = [c for c in K.RAW_COLUMNS if c not in K.CHURN_BY_FEATURE_SKIP
               and c not in ("months_with_provider", "monthly_fee", "lifetime_spend")]


def _subs(spark, sf):
    return fx.subscribers(spark, sf)


def _num(c: str) -> str:
    return f"CAST({ident(c)} AS DOUBLE)"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


# ------------------------------------------------------------- structure
_PROFILE_SQL = SUB + "SELECT * FROM (" + _union([
    f"SELECT {q(c)} AS column_name, CAST({i} AS INTEGER) AS position, "
    f"{q('numeric' if c in _NUMERIC else 'categorical')} AS kind, {q(_DTYPE[c])} AS dtype, "
    f"CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT {ident(c)}) AS BIGINT) AS n_distinct, "
    f"CAST(count(*) - count({ident(c)}) AS BIGINT) AS n_null FROM subscribers"
    for i, c in enumerate(K.RAW_COLUMNS)]) + ") t"


@query("eda_column_profile", _PROFILE_SQL)
def eda_column_profile(spark, sf):
    return P.column_profile(_subs(spark, sf))


@query("eda_dtype_counts", SUB + "SELECT dtype, CAST(count(*) AS BIGINT) AS n_columns, CAST(sum(n) AS BIGINT) AS n_values "
       "FROM (" + _union([f"SELECT {q(_DTYPE[c])} AS dtype, count({ident(c)}) AS n FROM subscribers" for c in K.RAW_COLUMNS])
       + ") t GROUP BY dtype")
def eda_dtype_counts(spark, sf):
    return P.dtype_counts(_subs(spark, sf))


@query("eda_binary_columns", _PROFILE_SQL.replace("SELECT * FROM (", "SELECT column_name, position FROM (", 1)
       + " WHERE n_distinct = 2")
def eda_binary_columns(spark, sf):
    return P.binary_columns(_subs(spark, sf))


@query("eda_missing", SUB + "SELECT column_name, position, n_null AS n_missing, n_null * 100.0 / n_rows AS pct_missing, "
       "CAST(sum(n_null) OVER () AS BIGINT) AS total_missing FROM (SELECT * FROM ("
       + _PROFILE_SQL[len(SUB):] + ")) p QUALIFY n_missing > 0", doubles=["pct_missing"])
def eda_missing(spark, sf):
    return P.missing_values(_subs(spark, sf))


# --------------------------------------------------------------- numeric
def _numeric_sql() -> str:
    parts = []
    for i, c in enumerate(_NUMERIC):
        x = _num(c)
        parts.append(
            f"SELECT {q(c)} AS column_name, CAST({i} AS INTEGER) AS position, CAST(count({x}) AS BIGINT) AS count, "
            f"avg({x}) AS mean, stddev_samp({x}) AS std, min({x}) AS min, "
            f"CAST(quantile_cont({x}, 0.25) AS DOUBLE) AS q25, CAST(quantile_cont({x}, 0.5) AS DOUBLE) AS q50, "
            f"CAST(quantile_cont({x}, 0.75) AS DOUBLE) AS q75, max({x}) AS max, "
            f"skewness({x}) AS skewness, kurtosis({x}) AS kurtosis FROM subscribers")
    return SUB + _union(parts)


@query("eda_numeric_stats", _numeric_sql(),
       doubles=["mean", "std", "min", "q25", "q50", "q75", "max", "skewness", "kurtosis"])
def eda_numeric_stats(spark, sf):
    return P.numeric_stats(_subs(spark, sf))


def _outlier_sql() -> str:
    parts = []
    for i, c in enumerate(_NUMERIC):
        x = _num(c)
        q1, q3 = f"(SELECT quantile_cont({x}, 0.25) FROM subscribers)", f"(SELECT quantile_cont({x}, 0.75) FROM subscribers)"
        lo, hi = f"({q1} - {K.IQR_FACTOR} * ({q3} - {q1}))", f"({q3} + {K.IQR_FACTOR} * ({q3} - {q1}))"
        parts.append(
            f"SELECT {q(c)} AS column_name, CAST({i} AS INTEGER) AS position, "
            f"CAST(count_if({x} < {lo} OR {x} > {hi}) AS BIGINT) AS n_outliers, "
            f"count_if({x} < {lo} OR {x} > {hi}) * 100.0 / count({x}) AS pct_outliers FROM subscribers")
    return SUB + _union(parts)


@query("eda_outliers_iqr", _outlier_sql(), doubles=["pct_outliers"])
def eda_outliers_iqr(spark, sf):
    return P.outliers_iqr(_subs(spark, sf))


def _corr_sql(strong: bool, threshold: float = K.STRONG_CORRELATION) -> str:
    parts = []
    pairs = list(combinations(range(len(_NUMERIC)), 2))
    for i, j in pairs:
        r = f"corr({_num(_NUMERIC[i])}, {_num(_NUMERIC[j])})"
        orders = [(i, j)] if strong else [(i, j), (j, i)]
        for a, b in orders:
            parts.append(f"SELECT {q(_NUMERIC[a])} AS var1, {q(_NUMERIC[b])} AS var2, CAST({a} AS INTEGER) AS i, "
                         f"CAST({b} AS INTEGER) AS j, {r} AS correlation FROM subscribers")
    if not strong:
        for i, c in enumerate(_NUMERIC):
            parts.append(f"SELECT {q(c)} AS var1, {q(c)} AS var2, CAST({i} AS INTEGER) AS i, "
                         f"CAST({i} AS INTEGER) AS j, corr({_num(c)}, {_num(c)}) AS correlation FROM subscribers")
    body = SUB + "SELECT * FROM (" + _union(parts) + ") t"
    if strong:
        body += f" WHERE abs(correlation) > {threshold}"
    return body


@query("eda_correlation_matrix", _corr_sql(False), doubles=["correlation"])
def eda_correlation_matrix(spark, sf):
    return P.correlation_matrix(_subs(spark, sf))


@query("eda_strong_correlations", _corr_sql(True), doubles=["correlation"])
def eda_strong_correlations(spark, sf):
    return P.strong_correlations(_subs(spark, sf))


WEAK_CORRELATION = 0.01  # low enough that pairs of these tables pass the filter


@query("eda_correlations_above", _corr_sql(True, WEAK_CORRELATION), doubles=["correlation"])
def eda_correlations_above(spark, sf):
    """Column pairs above a threshold that the caller names."""
    return P.strong_correlations(_subs(spark, sf), threshold=WEAK_CORRELATION)


def _hist_sql() -> str:
    b = K.HISTOGRAM_BINS
    parts = [f"SELECT {q(c)} AS column_name, {_num(c)} AS value FROM subscribers WHERE {ident(c)} IS NOT NULL"
             for c in _NUMERIC]
    return (SUB + ", long AS (" + _union(parts) + "),\n"
            "rng0 AS (SELECT column_name, min(value) AS lo, max(value) AS hi FROM long GROUP BY column_name),\n"
            "rng AS (SELECT column_name, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, "
            "CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM rng0),\n"
            f"a AS (SELECT l.column_name, value, lo, hi, (hi - lo) / {b} AS step, "
            f"least(CAST(floor((value - lo) * ({b} / (hi - lo))) AS INTEGER), {b - 1}) AS i0 "
            "FROM long l JOIN rng r ON l.column_name = r.column_name),\n"
            "b AS (SELECT *, CASE WHEN value < i0 * step + lo THEN i0 - 1 ELSE i0 END AS i1 FROM a),\n"
            f"c AS (SELECT *, CASE WHEN value >= (i1 + 1) * step + lo AND i1 <> {b - 1} THEN i1 + 1 ELSE i1 END AS i2 FROM b)\n"
            f"SELECT column_name, i2 AS bin, i2 * step + lo AS bin_lo, CASE WHEN i2 = {b - 1} THEN hi ELSE (i2 + 1) * step + lo END "
            "AS bin_hi, CAST(count(*) AS BIGINT) AS count FROM c GROUP BY column_name, i2, lo, hi, step")


@query("eda_histogram", _hist_sql(), doubles=["bin_lo", "bin_hi"])
def eda_histogram(spark, sf):
    return P.histogram(_subs(spark, sf))


def _box_sql() -> str:
    parts = []
    for c in ("monthly_fee", "months_with_provider"):
        x = _num(c)
        parts.append(f"SELECT {q(c)} AS column_name, churned, {x} AS value FROM subscribers WHERE {ident(c)} IS NOT NULL")
    return (SUB + ", long AS (" + _union(parts) + "),\n"
            "qs AS (SELECT column_name, churned, CAST(quantile_cont(value, 0.25) AS DOUBLE) AS q1, "
            "CAST(quantile_cont(value, 0.5) AS DOUBLE) AS median, CAST(quantile_cont(value, 0.75) AS DOUBLE) AS q3 "
            "FROM long GROUP BY column_name, churned)\n"
            f"SELECT l.column_name, l.churned, min(value) AS min, min(value) FILTER (WHERE value >= q1 - {K.IQR_FACTOR} * (q3 - q1)) "
            f"AS whisker_low, q1, median, q3, max(value) FILTER (WHERE value <= q3 + {K.IQR_FACTOR} * (q3 - q1)) AS whisker_high, "
            f"max(value) AS max, CAST(count_if(value < q1 - {K.IQR_FACTOR} * (q3 - q1) OR value > q3 + {K.IQR_FACTOR} * (q3 - q1)) "
            "AS BIGINT) AS n_fliers FROM long l JOIN qs USING (column_name, churned) GROUP BY l.column_name, l.churned, q1, median, q3")


@query("eda_box_stats", _box_sql(), doubles=["q1", "median", "q3"])
def eda_box_stats(spark, sf):
    return P.box_stats(_subs(spark, sf))


# ----------------------------------------------------------- categorical
def _freq_sql(cols: list[str], label: bool) -> str:
    lab = ", churned AS y" if label else ""
    parts = [f"SELECT {q(c)} AS column_name, CAST({ident(c)} AS VARCHAR) AS value{lab} FROM subscribers "
             f"WHERE {ident(c)} IS NOT NULL" for c in cols]
    return "long AS (" + _union(parts) + ")"


@query("eda_categorical_stats", SUB + ", " + _freq_sql(_CATEG, False) + ",\n"
       "vf AS (SELECT column_name, value, count(*) AS n FROM long GROUP BY column_name, value),\n"
       "pos AS (SELECT * FROM (VALUES " + ", ".join(f"({q(c)}, {i})" for i, c in enumerate(_CATEG))
       + ") t(column_name, position))\n"
       "SELECT column_name, CAST(position AS INTEGER) AS position, CAST(count(*) AS BIGINT) AS unique_values, "
       "arg_min(value, (-n, value)) AS most_frequent, CAST(max(n) AS BIGINT) AS frequency_most_frequent "
       "FROM vf JOIN pos USING (column_name) GROUP BY column_name, position")
def eda_categorical_stats(spark, sf):
    return P.categorical_stats(_subs(spark, sf))


@query("eda_top_categories", SUB + ", " + _freq_sql(_CATEG, False) + ",\n"
       "vf AS (SELECT column_name, value, count(*) AS n FROM long GROUP BY column_name, value)\n"
       "SELECT column_name, value, CAST(n AS BIGINT) AS count, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, "
       f"value ASC) AS INTEGER) AS rank FROM vf QUALIFY rank <= {K.TOP_CATEGORIES}")
def eda_top_categories(spark, sf):
    return P.top_categories(_subs(spark, sf))


@query("eda_value_counts", SUB + "SELECT churned, CAST(count(*) AS BIGINT) AS count FROM subscribers "
       "WHERE churned IS NOT NULL GROUP BY churned")
def eda_value_counts(spark, sf):
    return P.value_counts(_subs(spark, sf), K.LABEL)


# ----------------------------------------------------------------- churn
@query("eda_churn_summary", SUB + "SELECT avg(churned) AS churn_rate, CAST(sum(churned) AS BIGINT) AS churned_count, "
       "CAST(count(*) - sum(churned) AS BIGINT) AS retained_count FROM subscribers", doubles=["churn_rate"])
def eda_churn_summary(spark, sf):
    return P.churn_summary(_subs(spark, sf))


@query("eda_churn_by_feature", SUB + ", " + _freq_sql(_CHURN_COLS, True) + "\n"
       "SELECT column_name AS feature, value, sum(y) / count(*) AS churn_rate, CAST(count(*) AS BIGINT) AS count "
       "FROM long GROUP BY column_name, value", doubles=["churn_rate"])
def eda_churn_by_feature(spark, sf):
    return P.churn_by_feature(_subs(spark, sf))


@query("eda_churn_by_contract", SUB + "SELECT contract_type, avg(churned) AS churn_rate FROM subscribers "
       "WHERE contract_type IS NOT NULL GROUP BY contract_type", doubles=["churn_rate"])
def eda_churn_by_contract(spark, sf):
    """The minimum slice: one scan, one join, one group-by."""
    return P.churn_by_contract(_subs(spark, sf))


@query("eda_key_feature_report", SUB + ", " + _freq_sql([c for c in K.KEY_FEATURES], True) + "\n"
       "SELECT column_name AS feature, value AS category, sum(y) / count(*) AS churn_rate, "
       "printf('%.4f (%.2f%%)', sum(y) / count(*), sum(y) * 100.0 / count(*)) AS text "
       "FROM long GROUP BY column_name, value", doubles=["churn_rate"])
def eda_key_feature_report(spark, sf):
    return P.key_feature_report(_subs(spark, sf))


# --------------------------------------------------------- whole summary
def _summary_sql(whole: bool) -> str:
    """All blocks as (section, column_name, metric, value, text)."""
    ctes = {"prof": _PROFILE_SQL, "mis": ORACLE["eda_missing"], "num": ORACLE["eda_numeric_stats"],
            "outl": ORACLE["eda_outliers_iqr"], "cat": ORACLE["eda_categorical_stats"], "top": ORACLE["eda_top_categories"],
            "corr": ORACLE["eda_correlation_matrix"], "strong": ORACLE["eda_strong_correlations"],
            "cs": ORACLE["eda_churn_summary"], "cbf": ORACLE["eda_churn_by_feature"]}

    def rows(src, section, name, metrics, text="NULL", where=""):
        return [f"SELECT {q(section)} AS section, CAST({name} AS VARCHAR) AS column_name, {q(m)} AS metric, "
                f"round(CAST({v} AS DOUBLE), 9) AS value, CAST({text} AS VARCHAR) AS text FROM {src}{where}"
                for m, v in metrics.items()]

    same = lambda *names: {n: n for n in names}
    parts = rows("prof", "dataset_info", "NULL", {"total_rows": "max(n_rows)", "total_columns": "count(*)"})
    parts += rows("prof", "column_types", "NULL", {"numerical": "count_if(kind = 'numeric')",
                                                  "categorical": "count_if(kind = 'categorical')",
                                                  "binary": "count_if(n_distinct = 2)"})
    parts += rows("prof", "column_types", "column_name", {"type": "1"},
                  "kind || ',' || dtype || CASE WHEN n_distinct = 2 THEN ',binary' ELSE '' END")
    parts += rows("prof", "missing_values", "NULL", {"total_missing": "sum(n_null)"})
    parts += rows("mis", "missing_values", "column_name", same("n_missing", "pct_missing"))
    parts += rows("num", "numerical_stats", "column_name", same(*P.SUMMARY_NUMERIC_METRICS))
    parts += rows("outl", "numerical_stats", "column_name", same("n_outliers", "pct_outliers"))
    parts += rows("cat", "categorical_stats", "column_name", same("unique_values"))
    parts += rows("cat", "categorical_stats", "column_name", {"most_frequent": "frequency_most_frequent"}, "most_frequent")
    parts += rows("top", "categorical_stats", "column_name", {"category": "count"}, "value",
                  "" if whole else f" WHERE rank <= {P.SUMMARY_TOP_CATEGORIES}")
    parts += rows("strong", "strong_correlations", "var1", same("correlation"), "var2")
    parts += rows("cs", "churn_analysis", "NULL", same("churn_rate", "churned_count", "retained_count"))
    if whole:
        parts += rows("corr", "correlations", "var1", same("correlation"), "var2")
        parts += rows("cbf", "churn_by_feature", "feature", same("churn_rate", "count"), "value")
    else:
        parts += rows("cbf", "churn_by_feature", "feature", same("churn_rate"), "value",
                      " WHERE feature IN (" + ", ".join(q(c) for c in K.KEY_FEATURES) + ")")
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + _union(parts)


@query("generate_summary", _summary_sql(True), doubles=["value"])
def generate_summary(spark, sf):
    """Every block of the summary as one tidy table."""
    return P.generate_summary(_subs(spark, sf))


@query("eda_summary_long", _summary_sql(False), doubles=["value"])
def eda_summary_long(spark, sf):
    """The summary as exported: every section, key features only."""
    return P.summary_long(_subs(spark, sf))
