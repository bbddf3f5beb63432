"""Training, scoring and explanation invariants; an ONNX model written by hand."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.operators import confidence as C, features as E, predict as D, train as M
from lumenfold.operators.metrics import multiclass_metrics, regression_metrics
from lumenfold.operators.roles import ColumnRoles
from lumenfold.plans.text_queries import contained_in
from lumenfold.sources.readers import image_folder


@pytest.fixture(scope="module")
def reg(spark):
    return spark.range(400).select(
        F.col("id"), (F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("c"),
        ((F.col("id") % 20) * 3.0 + F.when(F.col("id") % 3 == 0, 10.0).otherwise(0.0)).alias("t")).cache()


ROLES = ColumnRoles(target="t", id="id")


def rmse(df):
    return regression_metrics(df, "t", "prediction", names=["rmse"]).first()[0]


def test_fit_beats_the_mean_and_keeps_rows(reg):
    spread = reg.agg(F.stddev_pop("t")).first()[0]
    for code in ("LR", "DT", "ET", "XGB"):
        out = M.fit_model(reg, ROLES, "regression", code).transform(reg)
        assert out.count() == 400 and out.columns == [*reg.columns, "prediction"] and rmse(out) < spread * 0.75


def test_target_does_not_leak_into_inputs(reg):
    model = M.fit_model(reg, ROLES, "regression", "LR", ("freq", "tenc", "Counter"))
    assert set(model.encoder.inputs) >= {"a", "b", "c_freq", "c_tenc"}
    assert not {"t", "_y", "id"} & set(model.encoder.inputs)
    unseen = reg.limit(5).withColumn("c", F.lit("new")).drop("t")
    assert model.transform(unseen).where("prediction is not null").count() == 5


def test_importance_is_sorted(reg):
    out = M.feature_importance(M.fit_model(reg, ROLES, "regression", "RF")).collect()
    assert [f for f in out[0].asDict()] == ["feature", "importance"] and out[0]["feature"] == "a"
    assert [r["importance"] for r in out] == sorted((r["importance"] for r in out), reverse=True)


def test_out_of_fold_covers_each_row_once(reg):
    out = M.cross_validation(reg, ROLES, "regression", "LR", 3)
    assert out.count() == 400 and out.select("id").distinct().count() == 400 and rmse(out) < 3


def test_user_folds_and_cap(reg):
    df = reg.withColumn("f", (F.col("id") % 2).cast("int"))
    out = M.cross_validation(df, ColumnRoles(target="t", id="id", fold="f"), "regression", "DT")
    assert out.count() == 400 and out.select("fold").distinct().count() == 2
    assert M.fit_model(reg, ROLES, "regression", "LR", cap=1).encoder.inputs == ["a"]


def test_multiclass_boosting_gives_probabilities(spark):
    df = spark.range(150).select("id", (F.col("id") % 3).alias("t"), ((F.col("id") % 3) * 2.0).alias("x"))
    out = M.fit_model(df, ROLES, "multiclassification", "XGB").transform(df)
    sums = out.select((F.col("pred_0") + F.col("pred_1") + F.col("pred_2")).alias("s"), "prediction", "t")
    assert sums.where(F.abs(F.col("s") - 1) > 1e-9).isEmpty() and sums.where("prediction <> cast(t as string)").isEmpty()


def test_experiment_tags_and_blend(reg):
    board, models = M.fit_regression(reg, ROLES, M.TrainingConfig(advanced=(), normal=("LR",), simple=("DT",), with_blend=True,
                                                                  features=("freq",)))
    rows = board.collect()
    assert {r["name"] for r in rows} == {"LR-normal", "DT-simple", "blend"} and set(models) == {"LR-normal", "DT-simple"}
    assert sum("best" in r["tags"] for r in rows) == sum("fastest" in r["tags"] for r in rows) == 1


def test_naive_bayes_joins_the_leaderboard(spark):
    df = spark.range(200).select("id", F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("c"),
                                 F.when(F.col("id") % 3 == 0, "yes").otherwise("no").alias("t"))
    board, models = M.fit_classification(df, ROLES, M.TrainingConfig(advanced=(), normal=("NBC",), features=("freq",)))
    assert board.first()["score"] == pytest.approx(1.0)
    assert models["NBC-normal"].transform(df).where("prediction <> t").isEmpty()


def test_configs():
    assert M.TrainingConfig.preset("quick").simple == ["DT"] and "pca" not in M.TrainingConfig.preset("base").features
    assert "NN" not in M.TrainingConfig.preset("quick").advanced and M.TrainingConfig.preset("nano").features == []
    with pytest.raises(ValueError):
        M.TrainingConfig(simple=("XGB",))
    with pytest.raises(ValueError):
        M.learner("NN", "regression", 3)
    from pyspark.ml.regression import LinearRegression
    assert [len(M.param_grid(LinearRegression(), "LR", p)) for p in M.PROFILES] == [1, 4, 12]


def test_explain_any_sums_for_linear(reg):
    model = M.fit_model(reg, ROLES, "regression", "LR")
    out = D.explain(model, reg, "id")
    assert out.count() == 400 * len(model.encoder.inputs)
    mean = model.transform(reg).agg(F.avg("prediction")).first()[0]
    total = out.groupBy("id").agg(F.sum("contribution").alias("s")).join(model.transform(reg), "id")
    assert total.where(F.abs(F.col("prediction") - mean - F.col("s")) > 1e-6).isEmpty()
    with pytest.raises(ValueError):
        D.explain_linear(reg, "id", {"a": 1.0}, "text-similarity")


def test_conformal_values(spark):
    cal = spark.createDataFrame([("a", 0.9, 0.1), ("b", 0.4, 0.6), ("a", 0.7, 0.3)], "y string, a double, b double")
    new = spark.createDataFrame([(1, 0.75, 0.25)], "id int, a double, b double")
    r = D.confidence_classification(new, cal, "id", "y", {"a": "a", "b": "b"}).first()
    # oddness: calibration .1 .4 .3; the row .25 as a (2 at least as odd), .75 as b (none)
    assert r["credibility"] == pytest.approx(3 / 4) and r["confidence"] == pytest.approx(1 - 1 / 4)


def test_regression_quantile_columns(spark):
    res = spark.createDataFrame([(float(i),) for i in range(101)], "r double")
    out = D.confidence_regression(spark.createDataFrame([(10.0,)], "p double"), res, "p", "r", "y").first().asDict()
    assert out == {"p": 10.0, **{f"y_quantile={q}": 10.0 + q for q in D.QUANTILES}}


# --- ONNX: y = x . w + b with w, b below; protobuf fields written out -------------------------------------------

def _int(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def _field(number, value):
    if isinstance(value, int):
        return _int(number << 3) + _int(value)
    value = value.encode() if isinstance(value, str) else value
    return _int(number << 3 | 2) + _int(len(value)) + value


def _tensor(name, dims, values):
    return b"".join(_field(1, d) for d in dims) + _field(2, 1) + _field(8, name) + _field(9, struct.pack(f"<{len(values)}f", *values))


def _value(name, columns):
    shape = _field(1, _field(2, "n")) + _field(1, _field(1, columns))
    return _field(1, name) + _field(2, _field(1, _field(1, 1) + _field(2, shape)))


def linear_onnx(weights, bias):
    mul = _field(1, "x") + _field(1, "w") + _field(2, "m") + _field(4, "MatMul")
    add = _field(1, "m") + _field(1, "b") + _field(2, "y") + _field(4, "Add")
    graph = (_field(1, mul) + _field(1, add) + _field(2, "g") + _field(5, _tensor("w", [len(weights), 1], weights))
             + _field(5, _tensor("b", [1], [bias])) + _field(11, _value("x", len(weights))) + _field(12, _value("y", 1)))
    return _field(1, 8) + _field(7, graph) + _field(8, _field(2, 13))


def test_onnx_scoring(spark):
    pytest.importorskip("onnxruntime")
    df = spark.range(50).select("id", F.col("id").cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b")).repartition(4)
    out = M.score_external_onnx(df, linear_onnx([2.0, -1.0], 0.5), ["a", "b"], ["y"])
    assert out.count() == 50 and out.where(F.abs(F.col("y") - (2 * F.col("a") - F.col("b") + 0.5)) > 1e-4).isEmpty()
    with pytest.raises(ValueError):
        M.score_external_onnx(df, b"", ["zz"], ["y"])


def test_evaluate_needs_a_model(reg):
    with pytest.raises(ValueError):
        M.evaluate_external(reg, {}, "id", "t", "p")


def test_image_experiment(spark, tmp_path):
    from test_files import png
    for i in range(24):
        png(tmp_path / f"i{i}.png", (i * 10, 100, 250 - i * 10))
    labels = spark.createDataFrame([(i, f"i{i}.png", float(i)) for i in range(24)], "id int, file string, t double")
    board, _ = M.fit_images(labels, image_folder(spark, str(tmp_path)), ColumnRoles(target="t", id="id", filename="file"), "regression",
                            M.TrainingConfig(advanced=(), normal=("LR",), features=()))
    assert board.first()["score"] < np.std(range(24))


def test_user_folds_with_gaps(reg):
    df = reg.withColumn("f", F.when(F.col("id") % 4 > 0, F.col("id") % 4))
    roles = ColumnRoles(target="t", id="id", fold="f")
    rows, folds = M._search_folds(df, roles)
    assert folds == 4 and {(r.f, r._cv_fold) for r in rows.collect()} == {(None, 0), (1, 1), (2, 2), (3, 3)}
    assert M.fit_model(df, roles, "regression", "LR", profile="normal").params
    assert M.cross_validation(df, roles, "regression", "LR").count() == 400


def test_naive_bayes_with_many_classes(spark):
    """Classes are rows of the counts; probabilities are those of a plain count by hand."""
    df = spark.range(4000).select("id", (F.col("id") % 400).cast("string").alias("y"), F.concat(F.lit("v"), F.col("id") % 13).alias("c"),
                                  F.when(F.col("id") % 5 > 0, F.concat(F.lit("w"), F.col("id") % 3)).alias("d"))
    out = {r["id"]: r for r in M.naive_bayes(df, df.where("id < 40").union(spark.createDataFrame([(-1, "0", "new", "w0")], df.schema)), "y", ["c", "d"], "id").collect()}
    rows = [(i % 400, f"v{i % 13}", f"w{i % 3}" if i % 5 else None) for i in range(4000)]
    for i, c, d in [(7, "v7", "w1"), (10, "v10", None), (-1, "new", "w0")]:
        odds = []
        for k in range(400):
            own = [r for r in rows if r[0] == k]
            odds.append(len(own) / 4000 * (1 + sum(r[1] == c for r in own)) / (len(own) + 13) * (1 + sum(r[2] == d for r in own)) / (len(own) + 4))
        assert all(abs(out[i][f"pred_{k}"] - odds[k] / sum(odds)) < 1e-9 for k in range(400))


def test_naive_bayes_weights(spark):
    df = spark.createDataFrame([(1, "a", "x", 3.0), (2, "b", "x", 1.0), (3, "b", "z", 1.0)], "id long, y string, c string, w double")
    twice = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "x"), (4, "b", "x"), (5, "b", "z")], "id long, y string, c string")
    got, want = M.naive_bayes(df, df.where("id = 2"), "y", ["c"], "id", "w").first(), M.naive_bayes(twice, twice.where("id = 4"), "y", ["c"], "id").first()
    assert abs(got["pred_a"] - want["pred_a"]) < 1e-12


def test_null_dates_and_empty_columns(spark):
    df = spark.range(300).select("id", (F.col("id") % 11).cast("double").alias("a"), F.lit(None).cast("double").alias("e"),
                                 F.when(F.col("id") % 3 > 0, F.expr("date_add(date'2024-01-01', cast(id as int))")).alias("d"),
                                 (F.col("id") % 11 + F.when(F.col("id") % 3 == 0, 50).otherwise(0)).cast("double").alias("t"))
    model = M.fit_model(df, ROLES, "regression", "LR", ("Date",))
    assert "d_missing" in model.encoder.inputs and rmse(model.transform(df)) < 5
    axes = E.pca(df, ["a", "e"], 2).select("pca").first()[0]
    assert len(axes) == 1
    assert E.kmean(df, ["a", "e"], 3).select("cluster").distinct().count() == 3
    with pytest.raises(ValueError, match="no numeric column"):
        E.pca(df, ["e"], 1)


def test_quadratic_kappa_needs_every_true_class(spark):
    df = spark.createDataFrame([("a", 0.9, 0.1), ("b", 0.2, 0.8), ("c", 0.5, 0.5)], "y string, pa double, pb double")
    with pytest.raises(Exception, match="true class c"):
        multiclass_metrics(df, "y", {"a": "pa", "b": "pb"}, names=["qkappa"]).collect()
    assert abs(multiclass_metrics(df, "y", {"a": "pa", "b": "pb"}, names=["accuracy"]).first()[0] - 2 / 3) < 1e-12


def test_short_items_are_found_in_documents(spark):
    items = spark.createDataFrame([(1, "one"), (2, "two words"), (3, "three inner words"), (4, "absent"), (5, "")], "item_id long, p string")
    docs = spark.createDataFrame([(10, "someone said two wordsmiths"), (11, "xx three inner words"), (12, ""), (13, None)], "doc_id long, text string")
    got = {tuple(r) for r in contained_in(items, docs, "item_id", "p", "doc_id", "text").collect()}
    assert got == {(1, 10), (2, 10), (3, 11)}
    assert contained_in(items.where("false"), docs, "item_id", "p", "doc_id", "text").count() == 0


@pytest.fixture(scope="module")
def noisy(spark):
    """A line with skewed noise, and three classes of unequal size and difficulty."""
    noise = -F.ln(1 - F.rand(5)) * 4
    x = F.col("id") * 37 % 101
    return spark.range(4000).select("id", x.cast("double").alias("x"), (x * 2.0 + noise).alias("t"),
                                    F.when(x + F.randn(9) * 12 > 80, "hi").when(x + F.randn(11) * 25 < 40, "lo").otherwise("mid").alias("k"),
                                    F.when(x + F.randn(13) * 30 > 70, 1).otherwise(0).alias("b")).cache()


def test_quantiles_cover_what_they_say(noisy):
    train, test = noisy.where("id % 2 = 0").select("id", "x", "t"), noisy.where("id % 2 = 1").select("id", "x", "t")
    out = D.predict(M.fit_model(train, ROLES, "regression", "LR", confidence=True), test, confidence=True)
    assert out.count() == 2000 and [c for c in out.columns if "quantile" in c] == [f"t_quantile={q}" for q in D.QUANTILES]
    share = out.agg(*[F.avg((F.col("t") <= F.col(f"`t_quantile={q}`")).cast("double")).alias(f"q{q}") for q in D.QUANTILES]).first()
    assert all(abs(share[f"q{q}"] - q / 100) < 0.025 for q in D.QUANTILES)
    with pytest.raises(ValueError, match="without calibration"):
        D.predict(M.fit_model(train, ROLES, "regression", "LR"), test, confidence=True)


@pytest.mark.parametrize("problem,target", [("multiclassification", "k"), ("classification", "b")])
def test_p_values_cover_every_class(noisy, problem, target):
    roles = ColumnRoles(target=target, id="id")
    train, test = (noisy.where(f"id % 2 = {i}").select("id", "x", target) for i in (0, 1))
    model = M.fit_model(train, roles, problem, "LR", confidence=True)
    scored = model.transform(test)
    probs = {c: f"pred_{c}" for c in model.classes}
    own = C.p_values(scored, model.calibration, probs)
    p_true = F.coalesce(*[F.when(F.col(target).cast("string") == c, F.col("_pv")[i]) for i, c in enumerate(model.classes)])
    for r in own.groupBy(target).agg(*[F.avg((p_true > e).cast("double")).alias(f"e{int(100 * e)}") for e in (0.05, 0.2, 0.5)], F.count(F.lit(1)).alias("n")).collect():
        assert all(abs(r[f"e{int(100 * e)}"] - (1 - e)) < 0.02 + 2 * (e * (1 - e) / r["n"]) ** 0.5 for e in (0.05, 0.2, 0.5)), r
    out = D.predict(model, test, confidence=True)
    assert out.count() == 2000 and out.where("confidence between 0 and 1 and credibility > 0 and credibility <= 1").count() == 2000


def test_p_values_against_a_plain_count(spark):
    rows = [("a", 0.9, 0.1), ("a", 0.4, 0.6), ("a", 0.4, 0.6), ("b", 0.2, 0.8), ("b", 0.7, 0.3)]
    oof = spark.createDataFrame(rows, "y string, pa double, pb double")
    got = C.p_values(spark.createDataFrame([(0.4, 0.6), (0.95, 0.05), (0.05, 0.95)], "pa double, pb double"),
                     C.calibrate_classes(oof, "y", {"a": "pa", "b": "pb"}), {"a": "pa", "b": "pb"}).collect()
    for r in got:
        for i, (c, p) in enumerate((("a", r["pa"]), ("b", r["pb"]))):
            own = [1 - (x[1] if c == "a" else x[2]) for x in rows if x[0] == c]
            assert abs(r["_pv"][i] - (sum(s >= 1 - p for s in own) + 1) / (len(own) + 1)) < 1e-12


def test_blend_is_chosen_out_of_fold(noisy):
    df = noisy.select("id", "x", "t")
    board, models = M.fit_regression(df, ROLES, M.TrainingConfig(advanced=(), normal=("LR",), simple=("DT",), with_blend=True))
    blend = models.blend
    assert abs(sum(blend.weights.values()) - 1) < 1e-12 and blend.transform(df).columns == [*df.columns, "prediction"]
    rows = {r["name"]: r for r in board.collect()}
    assert rows["blend"]["fit_seconds"] > 0 and rows["blend"]["score"] <= 1.02 * min(rows["LR-normal"]["score"], rows["DT-simple"]["score"])


def test_greedy_selection_against_every_step(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(size=80)
    preds = {n: y + rng.normal(0, s, 80) + b for n, s, b in (("a", 1.0, 0.0), ("b", 0.6, 0.9), ("c", 0.7, -0.8), ("d", 3.0, 0.0))}
    tables = {n: spark.createDataFrame([(i, float(y[i]), float(p[i])) for i in range(80)], "id long, t double, prediction double") for n, p in preds.items()}
    names, chosen, least = sorted(preds), [], np.inf
    for _ in range(20):
        error, n = min((np.mean((np.mean([preds[m] for m in [*chosen, n]], axis=0) - y) ** 2), n) for n in names)
        if error >= least:
            break
        chosen, least = [*chosen, n], error
    got = M.blend_weights(tables, ROLES, "regression", [])
    assert all(abs(got[n] - chosen.count(n) / len(chosen)) < 1e-12 for n in names) and len(set(chosen)) > 1


def test_contributions_add_up(noisy):
    for code, problem, target in (("CB", "regression", "t"), ("DT", "regression", "t"), ("LR", "regression", "t"), ("XGB", "multiclassification", "k"), ("RF", "classification", "b")):
        df = noisy.where("id < 400").select("id", "x", F.concat(F.lit("s"), F.col("id") % 4).alias("s"), target)
        model = M.fit_model(df, ColumnRoles(target=target, id="id"), problem, code)
        rows = D.explanations(model, df, "id").collect()
        assert len(rows) == 400 and all(abs(r["base"] + sum(r["contributions"]) - r["output"]) < 1e-6 for r in rows)
        if problem == "regression":
            want = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
            assert all(abs(want[r["id"]] - r["output"]) < 1e-6 for r in rows)
        long = D.explain(model, df, "id")
        assert long.columns == ["id", "feature", "contribution"] and long.count() == 400 * len(rows[0]["contributions"])


def test_every_feature_module_reaches_the_inputs(spark):
    df = spark.range(240).select("id", (F.col("id") % 9).cast("double").alias("a"), (F.col("id") % 4).cast("double").alias("b"), F.concat(F.lit("k"), F.col("id") % 3).alias("c"),
                                 F.when(F.col("id") % 2 == 0, "the red fox runs far away").otherwise("a blue whale swims deep down").alias("words"),
                                 F.when(F.col("id") % 2 == 0, 10.0).otherwise(20.0).alias("t"))
    model = M.fit_model(df, ROLES, "regression", "LR", tuple(E.MODULES))
    kinds = {n.rsplit("_", 1)[0] for n in model.encoder.inputs}
    assert {"axis", "cluster", "words_tfidf", "words_word2vec", "words_embedding"} <= kinds and {"c_freq", "c_tenc", "a_x_b"} <= set(model.encoder.inputs)
    assert model.encoder.texts == ["words"] and "words_freq" not in model.encoder.inputs
    assert rmse(model.transform(df)) < 0.5
    odd = spark.createDataFrame([(1, None, 2.0, None, None), (2, 1.0, None, "new", "never seen")], "id long, a double, b double, c string, words string")
    assert model.transform(odd).where("prediction is not null").count() == 2
