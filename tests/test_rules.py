"""Hand-computed micro-frames, one per semantic rule."""

import math

import pytest
from pyspark.sql import functions as F

from ebbflow.functions import columns as X
from ebbflow.functions import constants as K
from ebbflow.operators import features as FE
from ebbflow.operators import metrics as M
from ebbflow.operators import profile as P


def test_tenure_bins_right_closed(spark):
    vals = [-1.0, 0.0, 12.0, 12.5, 24.0, 48.0, 49.0, 100.0, 101.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "t double")
    got = [r[0] for r in df.select(X.tenure_group(F.col("t"))).collect()]
    assert got == ["nan", "0-12", "0-12", "13-24", "13-24", "25-48", "49+", "49+", "nan", "nan", "nan"]


def test_payment_cleaning(spark):
    vals = [" ELECTRONIC CHECK\t", "Mailed check", "NAN", None, "Bank transfer", "credit card (automatic)"]
    df = spark.createDataFrame([(v,) for v in vals], "payment_method string")
    got = [r[0] for r in FE.clean_payment_method(df).collect()]
    assert got == ["electronic_check", "mailed_check", None, None, "bank transfer", "credit_card"]


def test_internet_plan_exact_repairs(spark):
    df = spark.createDataFrame([("Fiber optiic",), ("fiber optiic",), ("DSL",), (None,)], "internet_plan string")
    assert [r[0] for r in FE.clean_internet_plan(df).collect()] == ["Fiber optic", "fiber optiic", "DSL", None]


def test_flags_null_and_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (70.35,), (70.36,)], "fee double")
    assert [r[0] for r in df.select(X.high_value_customer(F.col("fee"))).collect()] == [0, 0, 0, 1]
    df2 = spark.createDataFrame([("Yes", None), ("Yes", "No"), (None, "DSL"), ("No", "DSL")], "ph string, pl string")
    assert [r[0] for r in df2.select(X.is_multi_service(F.col("ph"), F.col("pl"))).collect()] == [1, 0, 0, 0]


def test_mode_ties_and_fallback(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "b", "a", None]], "payment_method string")
    assert FE.payment_mode(df) == "a"
    empty = spark.createDataFrame([(None,)], "payment_method string")
    assert FE.payment_mode(empty) == K.PAYMENT_FALLBACK


def test_impute_order_and_spend(spark):
    df = spark.createDataFrame([(1.0, 10.0, None), (3.0, 20.0, 5.0), (None, 30.0, None), (5.0, None, None)],
                               "months_with_provider double, monthly_fee double, lifetime_spend double")
    rows = FE.impute_all(df).collect()
    assert [r.months_with_provider for r in rows] == [1.0, 3.0, 3.0, 5.0]
    assert [r.lifetime_spend for r in rows] == [10.0, 5.0, 90.0, None]


def test_encoding_defaults(spark):
    df = spark.createDataFrame([("Two year",), ("One year",), ("Month-to-month",), ("weird",), (None,)],
                               "contract_type string")
    assert [r[0] for r in df.select(X.encode_contract(F.col("contract_type"))).collect()] == [0, 1, 2, 1, 1]
    b = spark.createDataFrame([("Male",), ("male",), (None,)], "gender string")
    assert [r[0] for r in b.select(X.encode_binary(F.col("gender"), "Male")).collect()] == [1, 0, 0]


def test_moments_and_quartiles(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 5.0, 9.0, 14.0, 3.5]], "x double")
    r = P.numeric_stats(df).collect()[0]
    assert r.skewness == pytest.approx(1.3114429062, abs=1e-8)
    assert r.kurtosis == pytest.approx(0.9711166248, abs=1e-8)
    assert (r.q25, r.q50, r.q75) == (2.0, 3.5, 7.0)


SIX = [(0.9, 1), (0.9, 0), (0.8, 1), (0.4, 0), (0.3, 1), (0.1, 0)]


def test_pr_and_roc_auc(spark):
    df = spark.createDataFrame([(i, y, p) for i, (p, y) in enumerate(SIX)], "row_id long, y int, p double")
    r = M.ranking_auc(df).collect()[0]
    assert r.pr_auc == pytest.approx(0.627777777778, abs=1e-10)
    assert r.roc_auc == pytest.approx(0.611111111111, abs=1e-10)


def test_sweep_all_low_scores_keeps_default(spark):
    df = spark.createDataFrame([(i, i % 2, 0.05) for i in range(10)], "row_id long, y int, p double")
    r = M.optimal_threshold(df, "f1").collect()[0]
    assert r.threshold == 0.5 and r.score == 0.0
    with pytest.raises(ValueError):
        M.optimal_threshold(df, "nope")


def test_threshold_grid_values():
    g = K.threshold_grid()
    assert len(g) == 16 and g[0] == 0.1 and g[9] == 0.5500000000000002


def test_confidence_segments_keep_empty_bins(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.1)], "row_id long, y int, p double")
    rows = M.confidence_segments(df).orderBy("position").collect()
    assert [r.segment for r in rows] == ["very_low", "low", "medium", "high", "very_high"]
    assert rows[1]["count"] is None and rows[0]["count"] == 1


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in range(0, 31)], "x double")
    h = {r.bin: r["count"] for r in P.histogram(df, ["x"], 30).collect()}
    assert sum(h.values()) == 31 and h[29] == 2
    assert math.isclose(sum(1 for _ in h), 30)


def test_strip_matches_python_whitespace(spark):
    vals = [" electronic check ", "\x1cMAILED CHECK\x1f", "\x0bcredit card (automatic)\x85"]
    df = spark.createDataFrame([(v,) for v in vals], "payment_method string")
    got = [r[0] for r in FE.clean_payment_method(df).collect()]
    assert got == ["electronic_check", "mailed_check", "credit_card"]
    assert [v.lower().strip() for v in vals] == ["electronic check", "mailed check", "credit card (automatic)"]


def test_metrics_with_one_class_do_not_raise(spark):
    df = spark.createDataFrame([(1, 0, 0.3), (2, 0, 0.6)], "row_id long, y int, p double")
    r = M.ranking_auc(df).collect()[0]
    assert r.roc_auc is None and r.pr_auc is None
    assert M.evaluate_model(df).collect()[0].accuracy == 0.5
    assert M.pr_curve_points(df).count() == 3


def test_unscored_rows_are_counted_apart(spark):
    sc = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.2), (3, 1, None), (4, None, 0.8), (5, 0, float("nan"))],
                               "row_id long, y int, p double")
    c = M.confusion(sc).collect()[0]
    assert (c.tn, c.fp, c.fn, c.tp, c.n_unscored) == (1, 0, 0, 1, 3)
    r = M.prediction_match_rate(sc).collect()[0]
    assert (r.n, r.n_match, r.match_rate, r.n_unscored) == (2, 2, 1.0, 3)
    assert M.ranking_auc(sc).collect()[0].n == 2
    assert M.brier(sc).collect()[0][0] == pytest.approx((0.01 + 0.04) / 2)
    assert sum(x["count"] or 0 for x in M.confidence_segments(sc).collect()) == 2
    assert {x.row_id for x in M.predict_threshold(sc).where("prediction IS NULL").collect()} == {3, 5}


def test_nan_is_missing_and_zero_has_one_sign(spark):
    df = spark.createDataFrame([(float("nan"), None), (1.0, None), (2.0, None), (0.0, None), (-0.0, None)], "v double, w double")
    prof = {r.column_name: r for r in P.column_profile(df).collect()}
    assert (prof["v"].n_distinct, prof["v"].n_null) == (3, 1) and prof["w"].n_distinct == 0
    assert {r.column_name: r.n_missing for r in P.missing_values(df).collect()} == {"v": 1, "w": 5}
    out = {r.column_name: r for r in P.outliers_iqr(df).collect()}
    assert out["w"].n_outliers == 0 and out["w"].pct_outliers is None


def test_binary_columns(spark):
    df = spark.createDataFrame([(1, "a", True, 0.0, None), (2, "b", False, -0.0, "x"), (2, "c", True, 1.0, "x")],
                               "i int, s string, b boolean, z double, one string")
    assert [r.column_name for r in P.binary_columns(df).orderBy("position").collect()] == ["i", "b", "z"]


def test_too_many_categories_raise(spark):
    df = spark.createDataFrame([(str(i),) for i in range(30)], "internet_plan string")
    assert len(FE.fit_encode(df, max_categories=30).categories["internet_plan"]) == 30
    with pytest.raises(ValueError):
        FE.fit_encode(df, max_categories=29)


def test_summary_has_every_block(spark):
    df = spark.createDataFrame([("Month-to-month", 1.0, 2.0, 1), ("One year", 2.0, 4.1, 0), ("One year", 3.0, 5.9, 0)],
                               "contract_type string, monthly_fee double, lifetime_spend double, churned int")
    blocks = {r.section for r in P.generate_summary(df).select("section").distinct().collect()}
    assert blocks == {"dataset_info", "column_types", "numerical_stats", "categorical_stats", "correlations",
                      "strong_correlations", "churn_analysis", "churn_by_feature", "missing_values"}
    assert P.generate_summary(df.select("contract_type")).count() > 0
