"""Oracle SQL text shared by several catalog entries.

Generated from the same fixed values the Spark code uses, so both sides
read one definition of every dictionary, bin edge and threshold.
"""

from __future__ import annotations

from ..functions import constants as K
from ..functions.columns import STRIP_PATTERN
from ..operators.split import FOLD_SALT, scramble_sql
from ..sources.fixtures import oracle_cte


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ident(s: str) -> str:
    return '"' + s.replace('"', '""') + '"'


def dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


PLAN_SQL = ("CASE WHEN internet_plan IN (" + ", ".join(q(k) for k in K.INTERNET_PLAN_FIXES)
            + ") THEN 'Fiber optic' ELSE internet_plan END")

_PAY = f"regexp_replace(lower(payment_method), {q(STRIP_PATTERN)}, '', 'g')"
PAYMENT_SQL = ("CASE " + _PAY + " " + " ".join(
    f"WHEN {q(k)} THEN {q(v)}" for k, v in K.PAYMENT_CODES.items())
    + f" WHEN {q(K.PAYMENT_NULL_TEXT)} THEN NULL ELSE {_PAY} END")


def tenure_group_sql(t: str = "months_with_provider") -> str:
    e, lab = K.TENURE_EDGES, K.TENURE_LABELS
    parts = [f"WHEN {t} > {dbl(e[i])} AND {t} <= {dbl(e[i + 1])} THEN {q(lab[i])}" for i in range(len(lab))]
    return "CASE " + " ".join(parts) + f" ELSE {q(K.TENURE_MISSING)} END"


HIGH_RISK_SQL = f"CASE WHEN payment_method = {q(K.HIGH_RISK_PAYMENT)} THEN 1 ELSE 0 END"
MULTI_SQL = "CASE WHEN phone_service = 'Yes' AND internet_plan IS DISTINCT FROM 'No' THEN 1 ELSE 0 END"
HIGH_VALUE_SQL = f"CASE WHEN monthly_fee > {dbl(K.HIGH_VALUE_FEE)} THEN 1 ELSE 0 END"
SENIOR_DEP_SQL = "CASE WHEN seniorcitizen = 1 AND dependents = 'Yes' THEN 1 ELSE 0 END"
CONTRACT_SQL = ("CASE contract_type " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in K.CONTRACT_CODES.items())
                + f" ELSE {K.CONTRACT_DEFAULT} END")


def binary_sql(col: str) -> str:
    return f"CASE WHEN {col} = {q(K.BINARY_POSITIVE[col])} THEN 1 ELSE 0 END"


# Category lists the fixture data produce (the Spark side fits them).
FIXTURE_CATEGORIES = {
    "internet_plan": ["DSL", "Fiber optic", "No"],
    "extra_lines": ["No", "No phone service", "Yes"],
    "payment_method": ["bank_transfer", "credit_card", "electronic_check", "mailed_check"],
    "addon_security": ["No", "No internet service", "Yes"],
    "addon_backup": ["No", "No internet service", "Yes"],
    "addon_device_protect": ["No", "No internet service", "Yes"],
    "addon_techsupport": ["No", "No internet service", "Yes"],
    "stream_tv": ["No", "No internet service", "Yes"],
    "stream_movies": ["No", "No internet service", "Yes"],
    "tenure_group": ["0-12", "13-24", "25-48", "49+", "nan"],
}

KEPT_FEATURES = ["gender", "seniorcitizen", "partner", "dependents", "months_with_provider",
                 "phone_service", "contract_type", "paperless_billing", "monthly_fee",
                 "high_risk_payment", "is_multi_service", "high_value_customer",
                 "senior_with_dependents"]


def onehot_sql() -> list[str]:
    out = []
    for col in K.ONEHOT_COLUMNS:
        for v in FIXTURE_CATEGORIES[col]:
            out.append(f"CASE WHEN {col} = {q(v)} THEN 1 ELSE 0 END AS {ident(col + '_' + v)}")
    return out


def feature_names() -> list[str]:
    return KEPT_FEATURES + [f"{c}_{v}" for c in K.ONEHOT_COLUMNS for v in FIXTURE_CATEGORIES[c]]


# CTE chain: subscribers_k -> cleaned -> stats -> imputed -> engineered -> encoded
def prep_cte(upto: str = "encoded") -> str:
    parts = [oracle_cte("subscribers_k").rstrip()[len("WITH "):]]
    parts.append(f"cleaned AS (SELECT * REPLACE ({PLAN_SQL} AS internet_plan, {PAYMENT_SQL} AS payment_method) "
                 "FROM subscribers_k)")
    parts.append("stats AS (SELECT (SELECT quantile_cont(months_with_provider, 0.5) FROM cleaned) AS med, "
                 "coalesce((SELECT payment_method FROM cleaned WHERE payment_method IS NOT NULL "
                 "GROUP BY payment_method ORDER BY count(*) DESC, payment_method ASC LIMIT 1), "
                 f"{q(K.PAYMENT_FALLBACK)}) AS mode)")
    med, mode = "(SELECT med FROM stats)", "(SELECT mode FROM stats)"
    parts.append(f"imputed AS (SELECT c.* REPLACE (coalesce(c.months_with_provider, {med}) AS months_with_provider, "
                 f"coalesce(c.lifetime_spend, c.monthly_fee * coalesce(c.months_with_provider, {med})) AS lifetime_spend, "
                 f"coalesce(c.payment_method, {mode}) AS payment_method) FROM cleaned c)")
    kept = [c for c in K.RAW_COLUMNS if c not in K.DROP_COLUMNS]
    parts.append("engineered AS (SELECT row_id, " + ", ".join(kept) + ", "
                 f"{tenure_group_sql()} AS tenure_group, {HIGH_RISK_SQL} AS high_risk_payment, "
                 f"{MULTI_SQL} AS is_multi_service, {HIGH_VALUE_SQL} AS high_value_customer, "
                 f"{SENIOR_DEP_SQL} AS senior_with_dependents FROM imputed)")
    enc = ["row_id"]
    for c in KEPT_FEATURES:
        if c in K.BINARY_POSITIVE:
            enc.append(f"{binary_sql(c)} AS {c}")
        elif c == "contract_type":
            enc.append(f"{CONTRACT_SQL} AS contract_type")
        else:
            enc.append(c)
    enc += onehot_sql() + ["churned"]
    parts.append("encoded AS (SELECT " + ", ".join(enc) + " FROM engineered)")
    order = ["cleaned", "stats", "imputed", "engineered", "encoded"]
    keep = 1 + order.index(upto) + 1
    return "WITH " + ",\n".join(parts[:keep]) + "\n"


def ranked_cte(source: str = "subscribers_k", seed: int = K.SEED, name: str = "ranked") -> str:
    """Per-class rank by the seeded scramble, with the class size, the rows
    of the classes before it and its test rows (largest remainder)."""
    sizes = f"SELECT churned, count(*) AS n_cls FROM {source} GROUP BY churned"
    share = (f"SELECT churned, n_cls, sum(n_cls) OVER () AS n, "
             f"CAST(ceil(sum(n_cls) OVER () * {dbl(K.TEST_SIZE)}) AS BIGINT) AS n_side, "
             f"coalesce(sum(n_cls) OVER (ORDER BY churned NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
             f"AS n_before FROM ({sizes})")
    quota = ("SELECT churned AS cls, n_cls, n_before, n_cls * n_side // n + CASE WHEN row_number() OVER (ORDER BY "
             "n_cls * n_side % n DESC, churned NULLS LAST) <= n_side - sum(n_cls * n_side // n) OVER () THEN 1 ELSE 0 END "
             f"AS n_test FROM ({share})")
    return (f"{name} AS (SELECT s.*, row_number() OVER (PARTITION BY churned ORDER BY {scramble_sql('row_id', seed)}, row_id) "
            f"AS rk, n_cls, n_before, n_test FROM {source} s JOIN ({quota}) ON cls IS NOT DISTINCT FROM churned)")


SPLIT_CASE = "CASE WHEN rk <= n_test THEN 'test' ELSE 'train' END"


def folds_cte(source: str = "subscribers_k") -> str:
    """``ranked`` in the order that folds are cut from."""
    return ranked_cte(source, K.SEED + FOLD_SALT)


def fold_case(k: int = K.N_FOLDS) -> str:
    """Fold number of a ``ranked`` row: one more for every range end below its rank."""
    size = [f"(n_cls - ((({f} - n_before) % {k} + {k}) % {k}) + {k - 1}) // {k}" for f in range(k)]
    return "CAST(1 + " + " + ".join(
        f"CASE WHEN rk > {' + '.join(size[:f])} THEN 1 ELSE 0 END" for f in range(1, k)) + " AS INTEGER)"
