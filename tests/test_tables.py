"""Roles, profiles, features, registry and time windows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumenfold.operators import drift as D, features as E, nested as N, profile as A, registry as L, roles as P, timeseries as S
from lumenfold.operators.roles import ColumnRoles


def test_roles(spark):
    df = spark.createDataFrame([(1, 2.0, "x", "y")], "id int, t double, a string, b string")
    roles = ColumnRoles(target="t", id="id", drop=("b",))
    assert P.assign_roles(df, roles).columns == ["id", "t", "a"] and roles.features(df.columns) == ["a"]
    with pytest.raises(ValueError):
        P.assign_roles(df, ColumnRoles(target="nope"))


def test_null_values(spark):
    df = spark.createDataFrame([("null", float("nan")), (None, None), ("x", 1.0)], "s string, d double")
    assert P.normalize_nulls(df).collect() == [(None, None), (None, None), ("x", 1.0)]
    prof = {r["feature"]: r for r in A.numeric_profile(df).collect()}
    assert (prof["d"]["missing"], prof["d"]["count"], prof["d"]["median"]) == (2, 1, 1.0)


def test_pred_label_takes_first_on_ties_and_strips_prefix(spark):
    df = spark.createDataFrame([(0.4, 0.4, 0.2)], "pred_b double, x_pred_a double, other double")
    assert P.pred_label(df).first()["pred_label"] == "b"
    df = spark.createDataFrame([(0.1, 0.9)], "pred_b double, x_pred_a double")
    assert P.pred_label(df).first()["pred_label"] == "x_a"


def test_policy_and_shares(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    kept, none = P.type_policy(df, {"a": "int"})
    assert [r[0] for r in kept.collect()] == [1, None, None] and none.isEmpty()
    good, bad = P.type_policy(df, {"a": "int"}, "strict")
    assert good.count() == 2 and bad.collect() == [("x",)]
    with pytest.raises(ValueError):
        P.type_policy(df, {"a": "int"}, "lenient")
    with pytest.raises(ValueError):
        P.sample(df, 1.5, ["a"])


def test_types_and_drops(spark):
    rows = [(i, i % 3, f"word {i} of a long enough text", "ab"[i % 2], 1, None) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, k int, txt string, cat string, one int, nil string")
    for approximate in (False, True):
        kinds = dict(A.infer_feature_types(df, approximate=approximate).collect())
        assert kinds["k"] == "ordinal" and kinds["id"] == "linear" and kinds["txt"] == "textual" and kinds["cat"] == "categorical"
    dropped = dict(A.dropped_features(df.withColumn("k2", F.col("k"))).collect())
    assert dropped == {"one": "constant", "nil": "all_null", "txt": "unique_id", "k2": "duplicate"}


def test_same_values_in_other_order_are_no_duplicate(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (3, 3)], "a int, b int")
    assert A.dropped_features(df).isEmpty()


def test_wide_correlation_equals_narrow(spark, monkeypatch):
    df = spark.range(200).select(*[(F.rand(i) + F.col("id") * i / 500).alias(f"c{i}") for i in range(4)])
    narrow = {(r["a"], r["b"]): r["score"] for r in A.correlation_matrix(df).collect()}
    monkeypatch.setattr(A, "WIDE_CORRELATION", 2)
    wide = {(r["a"], r["b"]): r["score"] for r in A.correlation_matrix(df).collect()}
    assert all(narrow[k] == pytest.approx(wide[k]) for k in narrow) and narrow["c1", "c1"] == 1.0


def test_chart_keys_go(spark):
    df = spark.createDataFrame([({"mean": 1.0, "barChart": 2.0},)], "m map<string,double>")
    assert df.select(A.without_charts("m")).first()[0] == {"mean": 1.0}


def test_psi_is_zero_without_drift(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("x"))
    assert D.drift_psi(df, df, ["x"]).first()["psi"] == pytest.approx(0.0)
    assert D.drift_ks(df, df, ["x"]).first()["ks"] == 0.0
    far = df.select((F.col("x") + 1000).alias("x"))
    assert D.drift_ks(df, far, ["x"]).first()["ks"] == 1.0


def test_target_encoding_never_sees_its_fold(spark):
    df = spark.createDataFrame([(1, "a", 10.0, 0), (2, "a", 20.0, 1), (3, "b", 30.0, 0), (4, "b", 50.0, 1)],
                               "id int, c string, y double, fold int")
    before = dict(E.target_encode_train(df, "c", "y", "fold").select("id", "c_tenc").collect())
    changed = df.withColumn("y", F.when(F.col("fold") == 0, F.col("y") + 1000).otherwise(F.col("y")))
    after = dict(E.target_encode_train(changed, "c", "y", "fold").select("id", "c_tenc").collect())
    assert before[1] == after[1] == pytest.approx((20 + 10 * 35) / 11) and before[2] != after[2]


def test_select_features_caps(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("y"), (F.col("id") * 2.0).alias("good"), F.rand(1).alias("noise"))
    assert [r["feature"] for r in E.select_features(df, "y", ["good", "noise"], n=1).collect()] == ["good"]


def test_registry_rules(spark):
    models = spark.createDataFrame([("e", "m1", 1, ["best"]), ("e", "m2", 2, ["best"]), ("e", "m3", 3, []), ("f", "m4", 5, []), ("f", "m5", 6, [])],
                                   "e string, m string, pos int, tags array<string>")
    assert dict(L.best_model(models, ["e"], "m", "pos", "tags").collect()) == {"e": "m2", "f": "m4"}
    with pytest.raises(ValueError):
        L.best_model(models.limit(0), ["e"], "m", "pos", "tags")
    chain = spark.createDataFrame([(1, None)] + [(i, i - 1) for i in range(2, 40)], "v int, p int")
    got = {r["v"]: (r["root"], r["depth"]) for r in L.version_lineage(chain, "v", "p").collect()}
    assert got == {i: (1, i - 1) for i in range(1, 40)}
    loop = spark.createDataFrame([(1, 2), (2, 1)], "v int, p int")
    with pytest.raises(ValueError):
        L.version_lineage(loop, "v", "p", max_rounds=3)


def test_hidden_properties(spark):
    body = ('{"nodes":[{"_id":"n","pipeline_component_id":{"metadata":{"name":"sample"},"interfaces":{"properties":'
            '[{"name":"ratio","type":"float"},{"name":"seed","type":"int","hidden":true}]}}}]}')
    r = N.node_properties(spark.createDataFrame([(1, body)], "t int, body string"), "t", "body").first()
    assert (r["node_id"], r["name"], r["properties"]) == ("n", "sample", {"ratio": "float"})


@pytest.mark.parametrize("bounds", [(-10, -5, 3, 4), (-90, -30, 1, 15), (-5, 0, 2, 4)])
def test_valid_windows(bounds):
    S.TimeWindow(*bounds)


@pytest.mark.parametrize("bounds", [(-10, -90, 1, 15), (90, -15, 1, 15), (-10, -5, 4, 3), (-10, -5, -3, 4), (-10, -1, 1, 15)])
def test_wrong_windows(bounds):
    with pytest.raises(ValueError):
        S.TimeWindow(*bounds)


def test_windows_cross_chunk_edges(spark, monkeypatch):
    monkeypatch.setattr(S, "MIN_CHUNK_STEPS", 1)
    steps = [s for s in range(-40, 160) if s % 7 != 3]
    pdf = pd.DataFrame({"step": steps, "v": np.sin(steps)})
    df, w = spark.createDataFrame(pdf), S.TimeWindow(-6, -2, 1, 2)
    got = S.derivation_aggs(df, [], "step", ["v"], w).toPandas().set_index("step")
    lags = S.derivation_lags(df, [], "step", ["v"], w).toPandas().set_index("step")
    values = dict(zip(pdf.step, pdf.v))
    assert len(got) == len(lags) == len(steps)
    for t in steps:
        past = [values[s] for s in range(t - 6, t - 1) if s in values]
        assert got.loc[t, "v_count"] == len(past)
        if past:
            assert got.loc[t, "v_mean"] == pytest.approx(np.mean(past))
        for h in range(2, 7):
            want = values.get(t - h)
            assert (np.isnan(lags.loc[t, f"v_lag{h}"]) if want is None else lags.loc[t, f"v_lag{h}"] == pytest.approx(want))


def test_future_enters_only_a_priori(spark):
    rows = [("a", t, float(t), float(t * 10)) for t in range(30)]
    df = spark.createDataFrame(rows, "g string, step int, v double, known double")
    out = S.forecast_targets(df, ["g"], "step", "v", S.TimeWindow(-10, -5, 3, 4), ["known"]).where("step = 5").orderBy("horizon").collect()
    assert [(r["horizon"], r["label"], r["known_ahead"]) for r in out] == [(3, 8.0, 80.0), (4, 9.0, 90.0)]


def test_correlation_with_gaps_and_constants(spark):
    rows = [(float(i), 2.0 * i, 5.0, 1.0 if i == 0 else None) for i in range(50)] + [(None, 7.0, 5.0, None), (3.0, None, 5.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    df = df.withColumns({f"e{i}": F.col("b") + F.rand(i) for i in range(20)})
    got = {(r["a"], r["b"]): r["score"] for r in A.correlation_matrix(df).collect()}
    assert len(got) == 24 * 24 and got["a", "b"] == pytest.approx(1.0)
    assert got["a", "c"] is None and got["d", "a"] is None and got["c", "c"] == 1.0
