"""Metric formulas on small frames worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from lumenfold.operators import analysis as G, metrics as M


def one(df):
    return df.first().asDict()


def test_regression_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 1.0), (None, 1.0), (3.0, None)], "y double, p double")
    r = one(M.regression_metrics(df, "y", "p"))
    assert r["mse"] == pytest.approx(10 / 3) and r["rmse"] == pytest.approx(math.sqrt(10 / 3))
    assert r["mae"] == pytest.approx(4 / 3) and r["mer"] == 1.0
    assert r["mape"] == pytest.approx((1 + 0 + 0.75) / 3)
    assert r["R2"] == pytest.approx(1 - 10 / (14 / 3))
    assert r["smape"] == pytest.approx((2 / 3 + 0 + 6 / 5) / 3)


def test_regression_zero_denominators(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0)], "y double, p double")
    r = one(M.regression_metrics(df, "y", "p"))
    assert r["mape"] is None and r["R2"] is None and r["smape"] == 0.0 and r["rmsle"] == 0.0


def test_weights_equal_repeated_rows(spark):
    rows = [(1.0, 2.0, 3), (5.0, 4.0, 1), (2.0, 2.5, 2)]
    df = spark.createDataFrame(rows, "y double, p double, w int")
    twice = df.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("w"))))
    a, b = one(M.regression_metrics(df, "y", "p", weight="w")), one(M.regression_metrics(twice, "y", "p"))
    assert all(a[k] == pytest.approx(b[k]) for k in a)
    df = df.selectExpr("cast(y > 1.5 as int) y", "p / 5 p", "w")
    twice = df.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("w"))))
    a, b = one(M.binary_metrics(df, "y", "p", weight="w")), one(M.binary_metrics(twice, "y", "p"))
    assert all(a[k] == pytest.approx(b[k]) for k in a)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "y int, p double")
    r = one(M.binary_metrics(df, "y", "p"))
    assert r["auc"] == pytest.approx((1 + 1 + 0.5 + 1) / 4) and r["gini"] == pytest.approx(2 * r["auc"] - 1)
    assert r["aucpr"] == pytest.approx((1 * 1 + 1 * 2 / 3) / 2)
    assert r["lift_at_0.5"] == pytest.approx((1 + 0.5) / 2 / 0.5)  # the tied pair counts half
    assert (r["accuracy"], r["error_rate_binary"]) == (0.75, 0.25)
    assert r["F1"] == pytest.approx(2 * 2 / (4 + 0 + 1))


def test_single_class(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.2)], "y int, p double")
    r = one(M.binary_metrics(df, "y", "p"))
    assert r["auc"] is None and r["mcc"] == 0.0 and r["aucpr"] == pytest.approx(1.0)
    df = spark.createDataFrame([(0, 0.1)], "y int, p double")
    assert one(M.binary_metrics(df, "y", "p"))["F1"] == 0.0


def test_log_loss_is_clipped(spark):
    df = spark.createDataFrame([(1, 0.0)], "y int, p double")
    assert one(M.binary_metrics(df, "y", "p", names=["log_loss"]))["log_loss"] == pytest.approx(-math.log(1e-15))


def test_multiclass(spark):
    df = spark.createDataFrame([("a", 0.5, 0.5, 0.0), ("b", 0.2, 0.3, 0.5), ("c", 0.1, 0.1, 0.8)],
                               "y string, a double, b double, c double")
    r = one(M.multiclass_metrics(df, "y", {"a": "a", "b": "b", "c": "c"}))
    assert r["accuracy"] == pytest.approx(2 / 3)  # the tie goes to a
    assert r["macroF1"] == pytest.approx((1 + 0 + 2 / 3) / 3)
    assert r["map_at_3"] == pytest.approx((1 + 1 / 2 + 1) / 3)
    assert r["qkappa"] == pytest.approx(1 - (1 / 3) / (5 / 3 + 8 / 3 - 2 * 1 * 4 / 3))


def test_unknown_names(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "y double, p double")
    with pytest.raises(ValueError):
        M.regression_metrics(df, "y", "p", names=["auc"])
    with pytest.raises(ValueError):
        M.evaluate(df, "detection")


def test_default_metric(spark):
    df = spark.createDataFrame([(1.0, 3.0)], "y double, p double")
    assert M.evaluate(df, "regression", y="y", p="p").columns == ["rmse"]


def test_retrieval(spark):
    queries = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "q int, t int")
    found = spark.createDataFrame([(1, 10, 2), (1, 11, 1), (2, 21, 1), (2, 20, 3)], "q int, i int, rank int")
    r = one(M.retrieval_metrics(queries, found, "q", "i", "rank", "t", 2))
    assert r["accuracy_at_k"] == pytest.approx(1 / 3) and r["mrr_at_k"] == pytest.approx(1 / 6)


def test_threshold_analysis(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "y int, p double")
    best = G.optimal_threshold(df, "y", "p").first()
    assert best["threshold"] == 0.7 and best["f1"] == pytest.approx(0.8)
    r = one(G.dynamic_performance(df, "y", "p", 0.75))
    assert (r["tp"], r["fp"], r["fn"], r["tn"], r["precision"], r["recall"]) == (1, 1, 1, 1, 0.5, 0.5)
    for t in (-0.1, 1.1):
        with pytest.raises(ValueError):
            G.dynamic_performance(df, "y", "p", t)
    points = G.chart_curves(df, "y", "p").orderBy("threshold").collect()
    assert (points[0]["tpr"], points[0]["fpr"], points[0]["lift"]) == (1.0, 1.0, 1.0) and points[-1]["precision"] == 1.0
