"""Catalog: reading, cleaning, imputation, engineering, encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions import constants as K
from ..operators import features as FE
from ..sources import files
from ..sources import fixtures as fx
from .registry import query
from .sqltext import (CONTRACT_SQL, HIGH_RISK_SQL, HIGH_VALUE_SQL, MULTI_SQL, PAYMENT_SQL, PLAN_SQL,
                      SENIOR_DEP_SQL, binary_sql, feature_names, onehot_sql, prep_cte, tenure_group_sql)
from ..sources.fixtures import oracle_cte

SUBK = oracle_cte("subscribers_k")


def _subs(spark, sf):
    return fx.subscribers(spark, sf, keyed=True)


# ------------------------------------------------------------- sources
@query("read_subscribers", oracle_cte("subscribers") + "SELECT * FROM subscribers")
def read_subscribers(spark, sf):
    """CSV round trip: the raw table written as CSV, read back with an
    explicit schema and the pandas null-token rules."""
    return files.csv_round_trip(spark, fx.subscribers(spark, sf))


@query("read_payload_json")
def read_payload_json(spark, sf):
    """Scoring payload document (``examples[].features{}``) -> one row per
    example, built from the cohort export of the raw table."""
    return files.payload_round_trip(spark, _subs(spark, sf))


# ------------------------------------------------------------ cleaning
@query("clean_internet_plan", SUBK + f"SELECT row_id, {PLAN_SQL} AS internet_plan FROM subscribers_k")
def clean_internet_plan(spark, sf):
    return FE.clean_internet_plan(_subs(spark, sf)).select("row_id", "internet_plan")


@query("clean_payment_method", SUBK + f"SELECT row_id, {PAYMENT_SQL} AS payment_method FROM subscribers_k")
def clean_payment_method(spark, sf):
    return FE.clean_payment_method(_subs(spark, sf)).select("row_id", "payment_method")


@query("clean_all", prep_cte("cleaned") + "SELECT * FROM cleaned")
def clean_all(spark, sf):
    return FE.clean_all(_subs(spark, sf))


# ------------------------------------------------------ feature flags
@query("tenure_group", SUBK + f"SELECT row_id, months_with_provider, {tenure_group_sql()} AS tenure_group "
                              "FROM subscribers_k")
def tenure_group(spark, sf):
    return _subs(spark, sf).select("row_id", "months_with_provider",
                                   X.tenure_group(F.col("months_with_provider")).alias("tenure_group"))


@query("high_risk_payment", prep_cte("cleaned") + f"SELECT row_id, payment_method, {HIGH_RISK_SQL} AS high_risk_payment FROM cleaned")
def high_risk_payment(spark, sf):
    d = FE.clean_all(_subs(spark, sf))
    return d.select("row_id", "payment_method", X.high_risk_payment(F.col("payment_method")).alias("high_risk_payment"))


@query("is_multi_service", prep_cte("cleaned") + f"SELECT row_id, phone_service, internet_plan, {MULTI_SQL} AS is_multi_service FROM cleaned")
def is_multi_service(spark, sf):
    d = FE.clean_all(_subs(spark, sf))
    return d.select("row_id", "phone_service", "internet_plan",
                    X.is_multi_service(F.col("phone_service"), F.col("internet_plan")).alias("is_multi_service"))


@query("high_value_customer", SUBK + f"SELECT row_id, monthly_fee, {HIGH_VALUE_SQL} AS high_value_customer FROM subscribers_k")
def high_value_customer(spark, sf):
    return _subs(spark, sf).select("row_id", "monthly_fee",
                                   X.high_value_customer(F.col("monthly_fee")).alias("high_value_customer"))


@query("senior_with_dependents", SUBK + f"SELECT row_id, {SENIOR_DEP_SQL} AS senior_with_dependents FROM subscribers_k")
def senior_with_dependents(spark, sf):
    return _subs(spark, sf).select("row_id", X.senior_with_dependents(
        F.col("seniorcitizen"), F.col("dependents")).alias("senior_with_dependents"))


@query("drop_redundant", SUBK + "SELECT * EXCLUDE (" + ", ".join(K.DROP_COLUMNS) + ") FROM subscribers_k")
def drop_redundant(spark, sf):
    d = _subs(spark, sf)
    return d.drop(*[c for c in K.DROP_COLUMNS if c in d.columns])


# ---------------------------------------------------------- imputation
@query("impute_tenure_median", prep_cte("stats") + "SELECT c.row_id, coalesce(c.months_with_provider, (SELECT med FROM stats)) "
       "AS months_with_provider FROM cleaned c")
def impute_tenure_median(spark, sf):
    d = FE.clean_all(_subs(spark, sf))
    st = FE.ImputeState(tenure_median=FE.fit_impute(d.select("months_with_provider")).tenure_median)
    return FE.transform_impute(d.select("row_id", "months_with_provider"), st)


@query("impute_lifetime_spend", prep_cte("imputed") + "SELECT row_id, lifetime_spend FROM imputed")
def impute_lifetime_spend(spark, sf):
    d = FE.clean_all(_subs(spark, sf))
    st = FE.fit_impute(d.select("months_with_provider"))
    return FE.transform_impute(d.select("row_id", "months_with_provider", "monthly_fee", "lifetime_spend"),
                               st).select("row_id", "lifetime_spend")


@query("impute_payment_mode", prep_cte("stats") + "SELECT c.row_id, coalesce(c.payment_method, (SELECT mode FROM stats)) "
       "AS payment_method FROM cleaned c")
def impute_payment_mode(spark, sf):
    d = FE.clean_all(_subs(spark, sf)).select("row_id", "payment_method")
    return FE.transform_impute(d, FE.ImputeState(payment_mode=FE.payment_mode(d)))


@query("impute_all", prep_cte("imputed") + "SELECT * FROM imputed")
def impute_all(spark, sf):
    return FE.impute_all(FE.clean_all(_subs(spark, sf)))


# --------------------------------------------------------- engineering
@query("engineer_features", prep_cte("engineered") + "SELECT * FROM engineered")
def engineer_features(spark, sf):
    d = FE.impute_all(FE.clean_all(_subs(spark, sf)))
    return FE.engineer_features(d, keep=("row_id",))


# ------------------------------------------------------------ encoding
_BIN = ", ".join(f"{binary_sql(c)} AS {c}" for c in K.BINARY_POSITIVE)


@query("encode_binary", SUBK + f"SELECT row_id, {_BIN} FROM subscribers_k")
def encode_binary(spark, sf):
    d = _subs(spark, sf)
    return d.select("row_id", *[X.encode_binary(F.col(c), v).alias(c) for c, v in K.BINARY_POSITIVE.items()])


@query("encode_contract", SUBK + f"SELECT row_id, contract_type AS contract_text, {CONTRACT_SQL} AS contract_type FROM subscribers_k")
def encode_contract(spark, sf):
    d = _subs(spark, sf)
    return d.select("row_id", F.col("contract_type").alias("contract_text"),
                    X.encode_contract(F.col("contract_type")).alias("contract_type"))


@query("encode_onehot", prep_cte("engineered") + "SELECT row_id, " + ", ".join(onehot_sql()) + " FROM engineered")
def encode_onehot(spark, sf):
    d = FE.engineer_features(FE.impute_all(FE.clean_all(_subs(spark, sf))), keep=("row_id",))
    st = FE.fit_encode(d)
    enc = FE.encode_features(d, st)
    return enc.select("row_id", *[X.c(n) for n in st.feature_names([]) ])


@query("encode_features", prep_cte("encoded") + "SELECT * FROM encoded")
def encode_features(spark, sf):
    d = FE.engineer_features(FE.impute_all(FE.clean_all(_subs(spark, sf))), keep=("row_id",))
    return FE.encode_features(d)


@query("process_features", prep_cte("encoded") + "SELECT * FROM encoded")
def process_features(spark, sf):
    """Flagship: clean -> impute -> engineer -> encode, label last."""
    return FE.process_features(_subs(spark, sf))


_ALIGN_DROP = ["months_with_provider", "monthly_fee"]


@query("align_features", prep_cte("encoded") + "SELECT row_id, " + ", ".join(
    ("0 AS " if n in _ALIGN_DROP else "") + f'"{n}"' for n in feature_names()) + " FROM encoded")
def align_features(spark, sf):
    """Scoring input missing two training columns and carrying an extra
    one, aligned to the training feature order."""
    raw = _subs(spark, sf)
    st = FE.fit_features(raw)
    enc = FE.transform_features(raw, st).drop(*_ALIGN_DROP).withColumn("extra", F.lit(1))
    return FE.align_features(enc, st.feature_names, keep=("row_id",))
