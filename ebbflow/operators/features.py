"""Cleaning, imputation, feature engineering and encoding.

Each step is a ``DataFrame -> DataFrame`` projection guarded by column
presence.  Fitted steps are split into ``fit(df) -> state`` (a small
aggregate collected to the driver: a median, a mode, category lists) and
``transform(df, state)`` (a single ``select`` with literals), so batch and
streaming jobs apply the same frozen values and the whole chain collapses
into one codegen'd projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions import constants as K
from .ordered import exact_quantiles

MAX_CATEGORIES = 10_000  # default of ``max_categories``: a column with more cannot become one-hot columns


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def _replace(df: DataFrame, **exprs) -> DataFrame:
    """Replace columns in place, keeping column order, in one projection."""
    return df.select(*[exprs[c].alias(c) if c in exprs else X.c(c) for c in df.columns])


# ------------------------------------------------------------------ cleaning
def clean_internet_plan(df: DataFrame) -> DataFrame:
    if not _has(df, "internet_plan"):
        return df
    return _replace(df, internet_plan=X.clean_internet_plan(X.c("internet_plan")))


def clean_payment_method(df: DataFrame) -> DataFrame:
    if not _has(df, "payment_method"):
        return df
    return _replace(df, payment_method=X.clean_payment_method(X.c("payment_method")))


def clean_all(df: DataFrame) -> DataFrame:
    exprs = {}
    if _has(df, "internet_plan"):
        exprs["internet_plan"] = X.clean_internet_plan(X.c("internet_plan"))
    if _has(df, "payment_method"):
        exprs["payment_method"] = X.clean_payment_method(X.c("payment_method"))
    return _replace(df, **exprs)


# ---------------------------------------------------------------- imputation
@dataclass
class ImputeState:
    tenure_median: float | None = None
    payment_mode: str | None = None


def _median(df: DataFrame, value) -> float | None:
    """Exact median (linear interpolation) without a per-task map of values."""
    row = exact_quantiles(df.select(value.alias("value")), [], "value", [0.5], names=["med"]).collect()[0]
    return row["med"]


def _category_counts(df: DataFrame, cols: dict, max_categories: int) -> dict[str, dict]:
    """``{name: {value: rows}}`` (null included) by one (column, value)
    grouping.  At most ``max_categories`` values a column come to the
    driver: the read stops one row beyond that and a wider column raises."""
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("c"), e.cast("string").alias("v"))
                                         for n, e in cols.items()])).alias("s")).select("s.*")
    rows = long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).limit((max_categories + 1) * len(cols) + 1).collect()
    out: dict[str, dict] = {n: {} for n in cols}
    for r in rows:
        out[r["c"]][r["v"]] = r["n"]
    for n, v in out.items():
        if len(v) - (None in v) > max_categories:
            raise ValueError(f"column {n!r} has more than {max_categories} categories; too wide to one-hot")
    return out


def _mode(counts: dict) -> str:
    """Most frequent non-null value (ties: smallest), else the fixed fallback."""
    return min((v for v in counts if v is not None), key=lambda v: (-counts[v], v), default=K.PAYMENT_FALLBACK)


def fit_impute(df: DataFrame) -> ImputeState:
    """Median tenure (exact) and most frequent payment method.  The mode is
    the top row of the value counts, so any number of values is fine."""
    st = ImputeState()
    if _has(df, "months_with_provider"):
        st.tenure_median = _median(df, X.num(X.c("months_with_provider")))
    if _has(df, "payment_method"):
        p = X.c("payment_method")
        top = (df.where(p.isNotNull()).groupBy(p.alias("v")).agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.col("n").desc(), F.col("v").asc()).limit(1).collect())
        st.payment_mode = top[0]["v"] if top else K.PAYMENT_FALLBACK
    return st


def payment_mode(df: DataFrame) -> str:
    return fit_impute(df.select("payment_method")).payment_mode


def impute_exprs(df: DataFrame, st: ImputeState) -> dict:
    exprs = {}
    tenure = None
    if _has(df, "months_with_provider"):
        tenure = F.coalesce(X.num(X.c("months_with_provider")),
                            F.lit(st.tenure_median).cast("double"))
        exprs["months_with_provider"] = tenure
    if _has(df, "lifetime_spend"):
        spend = X.num(X.c("lifetime_spend"))
        if _has(df, "monthly_fee", "months_with_provider"):
            spend = F.coalesce(spend, X.num(X.c("monthly_fee")) * tenure)
        exprs["lifetime_spend"] = spend
    if _has(df, "payment_method"):
        exprs["payment_method"] = F.coalesce(X.c("payment_method"), F.lit(st.payment_mode))
    return exprs


def transform_impute(df: DataFrame, st: ImputeState) -> DataFrame:
    return _replace(df, **impute_exprs(df, st))


def impute_all(df: DataFrame, st: ImputeState | None = None) -> DataFrame:
    return transform_impute(df, st or fit_impute(df))


# --------------------------------------------------------------- engineering
def engineer_exprs(df: DataFrame) -> list:
    """New feature columns in the order they are appended."""
    out = []
    if _has(df, "months_with_provider"):
        out.append(X.tenure_group(X.c("months_with_provider")).alias("tenure_group"))
    if _has(df, "payment_method"):
        out.append(X.high_risk_payment(X.c("payment_method")).alias("high_risk_payment"))
    if _has(df, "phone_service", "internet_plan"):
        out.append(X.is_multi_service(X.c("phone_service"), X.c("internet_plan"))
                   .alias("is_multi_service"))
    if _has(df, "monthly_fee"):
        out.append(X.high_value_customer(X.c("monthly_fee")).alias("high_value_customer"))
    if _has(df, "seniorcitizen", "dependents"):
        out.append(X.senior_with_dependents(X.c("seniorcitizen"), X.c("dependents"))
                   .alias("senior_with_dependents"))
    return out


def engineer_features(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Add the engineered columns and drop the redundant ones (``keep``
    names side columns such as ``row_id`` that must survive)."""
    drop = [c for c in K.DROP_COLUMNS if c in df.columns and c not in keep]
    new = engineer_exprs(df)
    return df.select(*[X.c(c) for c in df.columns if c not in drop], *new)


# ------------------------------------------------------------------ encoding
@dataclass
class EncodeState:
    categories: dict[str, list[str]] = field(default_factory=dict)

    def feature_names(self, base: list[str]) -> list[str]:
        names = [c for c in base if c not in self.categories]
        for col in K.ONEHOT_COLUMNS:
            names += [X.onehot_name(col, v) for v in self.categories.get(col, [])]
        return names


def fit_encode(df: DataFrame, max_categories: int = MAX_CATEGORIES) -> EncodeState:
    """Sorted distinct non-null values of each one-hot column, one grouping;
    a column with more than ``max_categories`` values raises, it is never
    truncated."""
    cols = [c for c in K.ONEHOT_COLUMNS if c in df.columns]
    counts = _category_counts(df, {c: X.c(c) for c in cols}, max_categories)
    return EncodeState({c: sorted(v for v in counts[c] if v is not None) for c in cols})


def encode_exprs(df: DataFrame, st: EncodeState, skip: tuple[str, ...] = ()) -> list:
    kept = []
    for col in df.columns:
        if col in skip or col in st.categories:
            continue
        if col in K.BINARY_POSITIVE:
            kept.append(X.encode_binary(X.c(col), K.BINARY_POSITIVE[col]).alias(col))
        elif col == "contract_type":
            kept.append(X.encode_contract(X.c(col)).alias(col))
        else:
            kept.append(X.c(col))
    for col in K.ONEHOT_COLUMNS:
        if col not in st.categories:
            continue
        if col not in df.columns:  # scoring input without the column: all zero
            kept += [F.lit(0).alias(X.onehot_name(col, v)) for v in st.categories[col]]
            continue
        kept += [X.onehot(X.c(col), v).alias(X.onehot_name(col, v)) for v in st.categories[col]]
    return kept


def encode_features(df: DataFrame, st: EncodeState | None = None) -> DataFrame:
    st = st or fit_encode(df)
    return df.select(*encode_exprs(df, st))


# ------------------------------------------------------------ whole process
@dataclass
class FeatureState:
    impute: ImputeState
    encode: EncodeState
    feature_names: list[str]


def _tenure_label(t: float | None) -> str:
    """Python twin of ``columns.tenure_group`` for one fitted value."""
    e = K.TENURE_EDGES
    if t is not None and t == t:
        for i, lab in enumerate(K.TENURE_LABELS):
            if e[i] < t <= e[i + 1]:
                return lab
    return K.TENURE_MISSING


def fit_features(raw: DataFrame, max_categories: int = MAX_CATEGORIES) -> FeatureState:
    """Fit median, mode and every category list over the cleaned table: one
    exact quantile and one (column, value) grouping.  Categories after
    imputation follow from the raw ones: the imputed value joins its
    column's list when that column had nulls.  The result equals fitting
    impute then encode in sequence."""
    cleaned = clean_all(raw)
    exprs = {c: X.c(c) for c in K.ONEHOT_COLUMNS if c in cleaned.columns}
    has_t = _has(cleaned, "months_with_provider")
    if has_t:
        t = X.num(X.c("months_with_provider"))
        exprs["tenure_group"] = F.when(t.isNotNull(), X.tenure_group(t))
    counts = _category_counts(cleaned, exprs, max_categories)
    imp = ImputeState()
    if has_t:
        imp.tenure_median = _median(cleaned, t)
    if "payment_method" in counts:
        imp.payment_mode = _mode(counts["payment_method"])
    cats = {}
    for c, v in counts.items():
        vals = set(v) - {None}
        if None in v and c == "payment_method":
            vals.add(imp.payment_mode)
        if None in v and c == "tenure_group":
            vals.add(_tenure_label(imp.tenure_median))
        cats[c] = sorted(vals)
    enc = EncodeState({c: cats[c] for c in K.ONEHOT_COLUMNS if c in cats})
    eng_cols = engineer_features(transform_impute(cleaned, imp), keep=("row_id",)).columns
    base = [c for c in eng_cols if c not in (K.LABEL, "row_id")]
    return FeatureState(imp, enc, enc.feature_names(base))


def transform_features(raw: DataFrame, st: FeatureState, keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """clean -> impute -> engineer -> encode, label last; one projection
    chain that Catalyst collapses.  ``keep`` side columns are placed first."""
    cleaned = clean_all(raw)
    eng = engineer_features(transform_impute(cleaned, st.impute), keep=keep)
    side = [c for c in keep if c in eng.columns]
    body = encode_exprs(eng, st.encode, skip=(*side, K.LABEL))
    label = [X.c(K.LABEL)] if K.LABEL in eng.columns else []
    return eng.select(*[X.c(c) for c in side], *body, *label)


def process_features(raw: DataFrame, keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """The whole feature process fitted on ``raw`` itself (parity mode)."""
    return transform_features(raw, fit_features(raw), keep=keep)


def align_features(df: DataFrame, feature_names: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Training column order: absent columns become 0, extras are dropped."""
    have = set(df.columns)
    return df.select(*[X.c(c) for c in keep if c in have],
                     *[X.c(n) if n in have else F.lit(0).alias(n) for n in feature_names])


def state_to_json(st: FeatureState) -> str:
    import json
    return json.dumps({"impute": {"tenure_median": st.impute.tenure_median,
                                  "payment_mode": st.impute.payment_mode},
                       "categories": st.encode.categories, "feature_names": st.feature_names})


def state_from_json(text: str) -> FeatureState:
    import json
    d = json.loads(text)
    return FeatureState(ImputeState(**d["impute"]), EncodeState(d["categories"]), d["feature_names"])
