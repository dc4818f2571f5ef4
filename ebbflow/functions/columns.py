"""Column expressions shared by batch and streaming jobs.

Every function here returns a ``pyspark.sql.Column`` built from built-in
functions only, so the whole feature plan stays inside whole-stage codegen.
Null handling follows pandas semantics, spelled out per function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

# characters Python's str.strip() removes: ASCII whitespace, the
# separators \x1c-\x1f, NEL and every Unicode space separator (\p{Z})
_WS = "[\\s\\x0B\\x1c-\\x1f\\x85\\p{Z}]"
STRIP_PATTERN = f"^{_WS}+|{_WS}+$"


def c(name: str) -> Column:
    return F.col(f"`{name}`")


def num(col: Column) -> Column:
    """Numeric value with NaN turned into null.

    In Spark ``NaN > x`` is true; pandas treats NaN as missing, so every
    numeric predicate goes through this first.
    """
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def is_true(cond: Column) -> Column:
    """pandas comparison result: a null comparison counts as False."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    return is_true(cond).cast("int")


def strip_ws(col: Column) -> Column:
    return F.regexp_replace(col, STRIP_PATTERN, "")


def replace_values(col: Column, mapping: dict[str, str | None]) -> Column:
    """Dictionary replace: matched values are swapped, others pass through."""
    expr = None
    for src, dst in mapping.items():
        val = F.lit(dst) if dst is not None else F.lit(None).cast("string")
        expr = (F.when(col == src, val) if expr is None
                else expr.when(col == src, val))
    return col if expr is None else expr.otherwise(col)


def map_values(col: Column, mapping: dict, default) -> Column:
    """Dictionary map: unmatched values (and null) take ``default``."""
    expr = None
    for src, dst in mapping.items():
        expr = (F.when(col == src, F.lit(dst)) if expr is None
                else expr.when(col == src, F.lit(dst)))
    return expr.otherwise(F.lit(default))


# ------------------------------------------------------------------ cleaning
def clean_internet_plan(col: Column) -> Column:
    return replace_values(col, K.INTERNET_PLAN_FIXES)


def clean_payment_method(col: Column) -> Column:
    folded = strip_ws(F.lower(col))
    return replace_values(folded, {**K.PAYMENT_CODES, K.PAYMENT_NULL_TEXT: None})


# -------------------------------------------------------------- engineering
def tenure_group(tenure: Column) -> Column:
    t = num(tenure)
    e = K.TENURE_EDGES
    expr = F.when((t > e[0]) & (t <= e[1]), K.TENURE_LABELS[0])
    for i in range(1, len(K.TENURE_LABELS)):
        expr = expr.when((t > e[i]) & (t <= e[i + 1]), K.TENURE_LABELS[i])
    return expr.otherwise(K.TENURE_MISSING)


def high_risk_payment(payment: Column) -> Column:
    return flag(payment == K.HIGH_RISK_PAYMENT)


def is_multi_service(phone: Column, plan: Column) -> Column:
    # pandas: null != 'No' is True, null == 'Yes' is False
    return (is_true(phone == "Yes") & ~plan.eqNullSafe("No")).cast("int")


def high_value_customer(fee: Column) -> Column:
    return flag(num(fee) > K.HIGH_VALUE_FEE)


def senior_with_dependents(senior: Column, dependents: Column) -> Column:
    return (is_true(senior == 1) & is_true(dependents == "Yes")).cast("int")


# ----------------------------------------------------------------- encoding
def encode_binary(col: Column, positive: str) -> Column:
    return flag(col == positive)


def encode_contract(col: Column) -> Column:
    return map_values(col, K.CONTRACT_CODES, K.CONTRACT_DEFAULT).cast("int")


def onehot_name(column: str, value: str) -> str:
    return f"{column}_{value}"


def onehot(col: Column, value: str) -> Column:
    return flag(col == value)


# ------------------------------------------------------------------ moments
def sample_skewness(col: Column) -> Column:
    """Bias-corrected skewness G1 (pandas ``skew``), null below 3 values."""
    n = F.count(col).cast("double")
    g1 = F.skewness(col)
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(col: Column) -> Column:
    """Bias-corrected excess kurtosis G2 (pandas ``kurt``), null below 4."""
    n = F.count(col).cast("double")
    g2 = F.kurtosis(col)
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def safe_div(a: Column, b: Column, zero=0.0) -> Column:
    """Division where an empty denominator gives ``zero`` (never raises)."""
    return F.when(b == 0, F.lit(zero)).otherwise(F.try_divide(a, b))
