"""Training, scoring, confidence and explanation on orders and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfold.operators import predict as D, train as M, trees as TR
from lumenfold.operators.roles import ColumnRoles, split_holdout
from lumenfold.plans.catalog import (REGRESSION_SQL, STATUS_SQL, STATUSES, class_probs, register, regression_rows, rounded,
                                     sql_hash, status_rows, table)
from lumenfold.session import cut_lineage

REGRESSION_ROLES = ColumnRoles(target="l_extendedprice", id="line_id")
BINARY_ROLES = ColumnRoles(target="is_final", id="o_orderkey", time="o_orderdate")
MULTI_ROLES = ColumnRoles(target="o_orderstatus", id="o_orderkey", time="o_orderdate")


def regression_table(spark, sf_dir):
    """Order totals from the size, quantity and discount of the order's lines."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("price"), F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"),
        F.count(F.lit(1)).alias("n_lines"), F.max("l_returnflag").alias("flag"))
    return lines.select(F.col("l_orderkey").alias("line_id"), F.col("price").alias("l_extendedprice"), "quantity", "discount",
                        "n_lines", "flag")


def binary_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority",
                         (F.col("o_orderstatus") == "F").cast("int").cast("string").alias("is_final"))


def multi_table(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")


@register("m01_lr_regression", """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
    round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem""")
def linear_regression(spark, sf_dir):
    out = M.linear_fit(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return out.select(F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


def _fit_predict(key, rows, roles, problem, code):
    @register(key)
    def run(spark, sf_dir):
        df = rows(spark, sf_dir)
        model = M.fit_model(df, roles, problem, code)
        return model.transform(df).drop("o_totalprice", "o_orderdate", "o_orderpriority")


_fit_predict("m01_lr_regression_many", regression_table, REGRESSION_ROLES, "regression", "LR")
_fit_predict("m02_lr_classification", binary_table, BINARY_ROLES, "classification", "LR")
_fit_predict("m02_lr_multiclassification", multi_table, MULTI_ROLES, "multiclassification", "LR")
_fit_predict("m03_dt", regression_table, REGRESSION_ROLES, "regression", "DT")
_fit_predict("m04_rf", binary_table, BINARY_ROLES, "classification", "RF")
_fit_predict("m05_et", regression_table, REGRESSION_ROLES, "regression", "ET")
_fit_predict("m06_xgb", regression_table, REGRESSION_ROLES, "regression", "XGB")
_fit_predict("m06_lgb", binary_table, BINARY_ROLES, "classification", "LGB")
_fit_predict("m06_cb_multiclassification", multi_table, MULTI_ROLES, "multiclassification", "CB")
_fit_predict("m07_nn", binary_table, BINARY_ROLES, "classification", "NN")


NB_COUNTS = """n AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS nf, count(*) FILTER (o_orderstatus = 'O') AS no,
    count(*) FILTER (o_orderstatus = 'P') AS np FROM o),
c1 AS (SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o,
    count(*) FILTER (o_orderstatus = 'P') AS p, count(*) OVER () AS v FROM o GROUP BY o_orderpriority),
c2 AS (SELECT y, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o,
    count(*) FILTER (o_orderstatus = 'P') AS p, count(*) OVER () AS v FROM o GROUP BY y)"""


@register("m08_nbc", f"""WITH o AS (SELECT *, year(o_orderdate) AS y FROM orders), {NB_COUNTS},
l AS (SELECT o_orderkey, {", ".join(f'''ln(n{c} / n.n::DOUBLE) + ln((c1.{c} + 1) / (n{c} + c1.v)::DOUBLE)
    + ln((c2.{c} + 1) / (n{c} + c2.v)::DOUBLE) AS s{c}''' for c in "fop")}
    FROM o JOIN c1 USING (o_orderpriority) JOIN c2 USING (y), n)
SELECT o_orderkey, {", ".join(f'round(exp(s{c}) / (exp(sf) + exp(so) + exp(sp)), 6) AS "pred_{c.upper()}"' for c in "fop")} FROM l""")
def naive_bayes(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    return rounded(M.naive_bayes(rows, rows, "o_orderstatus", ["o_orderpriority", "y"], "o_orderkey"))


def _candidates(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")) \
        .groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("y"),
                                   F.sum(F.col("l_quantity") * F.col("p_retailprice")).alias("a"),
                                   (F.sum("l_quantity") * 1500).alias("b"), (F.count(F.lit(1)) * 40000.0).alias("c"),
                                   (F.sum("p_size") * 1000.0).alias("d"))
    return rows


CANDIDATES_SQL = """(SELECT l_orderkey, sum(l_extendedprice) AS y, sum(l_quantity * p_retailprice) AS a,
    sum(l_quantity) * 1500 AS b, count(*) * 40000.0::DOUBLE AS c, sum(p_size) * 1000.0::DOUBLE AS d
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)"""


@register("m09_blend", f"""WITH t AS (SELECT * FROM {CANDIDATES_SQL} r), s AS (SELECT unnest(['a', 'b', 'c', 'd']) AS m, unnest([
    avg(pow(y - a, 2)), avg(pow(y - b, 2)), avg(pow(y - c, 2)), avg(pow(y - d, 2))]) AS e FROM t),
top AS (SELECT m FROM s ORDER BY e, m LIMIT 3), long AS (SELECT l_orderkey, unnest(['a', 'b', 'c', 'd']) AS m, unnest([a, b, c, d]) AS p FROM t)
SELECT l_orderkey, round(avg(p), 2) AS p FROM long JOIN top USING (m) GROUP BY l_orderkey""")
def blend(spark, sf_dir):
    rows = _candidates(spark, sf_dir)
    tables = {m: rows.select("l_orderkey", F.col(m).alias("p")) for m in "abcd"}
    board = M.evaluate_external(rows, tables, "l_orderkey", "y", "p", metrics=["rmse"]).collect()
    return rounded(M.blend(tables, {r["model"]: r["rmse"] for r in board}, "l_orderkey", "p"), 2)


@register("m09_blend_weights", f"""WITH t AS (SELECT * FROM {CANDIDATES_SQL} r), e1 AS (SELECT unnest(['a', 'b', 'c', 'd']) AS m, unnest([
    avg(pow(y - a, 2)), avg(pow(y - b, 2)), avg(pow(y - c, 2)), avg(pow(y - d, 2))]) AS e FROM t),
one AS (SELECT m, e FROM e1 ORDER BY e, m LIMIT 1), pick AS (SELECT t.*, one.m AS m1, CASE one.m WHEN 'a' THEN a WHEN 'b' THEN b WHEN 'c' THEN c ELSE d END AS p1 FROM t, one),
e2 AS (SELECT unnest(['a', 'b', 'c', 'd']) AS m, unnest([avg(pow(y - (a + p1) / 2, 2)), avg(pow(y - (b + p1) / 2, 2)), avg(pow(y - (c + p1) / 2, 2)),
    avg(pow(y - (d + p1) / 2, 2))]) AS e FROM pick), two AS (SELECT e2.m FROM e2, one WHERE e2.e < one.e ORDER BY e2.e, e2.m LIMIT 1),
chosen AS (SELECT m FROM one UNION ALL SELECT m FROM two)
SELECT n.m AS model, (SELECT count(*) FROM chosen c WHERE c.m = n.m) / (SELECT count(*) FROM chosen)::DOUBLE AS weight FROM (SELECT unnest(['a', 'b', 'c', 'd']) AS m) n""")
def blend_weights(spark, sf_dir):
    """Two steps of the greedy selection over given scores."""
    rows = _candidates(spark, sf_dir)
    tables = {m: rows.select("l_orderkey", "y", F.col(m).alias("prediction")) for m in "abcd"}
    weights = M.blend_weights(tables, ColumnRoles(target="y", id="l_orderkey"), "regression", [], rounds=2)
    return spark.createDataFrame(sorted(weights.items()), "model string, weight double")


GAINS_SQL = " UNION ALL ".join(f"""SELECT '{c}' AS feature, {c} AS threshold, gl AS g, hl AS h FROM (SELECT {c}, sum(sum(m - l_extendedprice)) OVER w AS gl,
    sum(count(*)) OVER w AS hl FROM lineitem, mean GROUP BY {c} WINDOW w AS (ORDER BY {c})) z""" for c in ("l_quantity", "l_discount", "l_tax"))


@register("m06_first_split_gains", f"""WITH mean AS (SELECT avg(l_extendedprice) AS m, count(*) AS n FROM lineitem), cuts AS ({GAINS_SQL})
SELECT feature, threshold, round(g * g / (h + 1) + g * g / (n - h + 1), -3) AS gain FROM cuts, mean WHERE h >= 2 AND n - h >= 2""")
def first_split_gains(spark, sf_dir):
    """Second-order gain of every first split of a boosted tree."""
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_extendedprice")
    return rounded(TR.root_gains(lines, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice"), -3, "gain")


@register("m06_better_than_mean", """WITH t AS (SELECT l_orderkey, sum(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey),
s AS (SELECT count(*) AS n, round(stddev_pop(price), 2) AS mean_rmse FROM t)
SELECT unnest(['CB', 'ET', 'LGB', 'XGB']) AS model, n, mean_rmse, true AS better FROM s""")
def better_than_mean(spark, sf_dir):
    """Training loss of the four tree learners against that of the mean."""
    df = cut_lineage(regression_table(spark, sf_dir))
    out = None
    for code in ("CB", "ET", "LGB", "XGB"):
        scored = M.fit_model(df, REGRESSION_ROLES, "regression", code).transform(df)
        error = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("l_extendedprice"), 2)))
        one = scored.agg(F.lit(code).alias("model"), F.count(F.lit(1)).alias("n"), F.round(F.stddev_pop("l_extendedprice"), 2).alias("mean_rmse"),
                         (error < 0.75 * F.stddev_pop("l_extendedprice")).alias("better"))
        out = one if out is None else out.unionByName(one)
    return out


@register("m20_evaluate_external", "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{m}' AS model, round(sqrt(avg(pow(y - {m}, 2))), 2) AS rmse, round(avg(abs(y - {m})), 2) AS mae,
    round(median(abs(y - {m})), 2) AS mer FROM {CANDIDATES_SQL} r""" for m in "abcd") + ") u")
def evaluate_external(spark, sf_dir):
    rows = _candidates(spark, sf_dir)
    tables = {m: rows.select("l_orderkey", F.col(m).alias("p")) for m in "abcd"}
    return rounded(M.evaluate_external(rows, tables, "l_orderkey", "y", "p", metrics=["rmse", "mae", "mer"]), 2)


LOSS_SQL = "-avg(ln(least(greatest(CASE y WHEN 'F' THEN {0} WHEN 'O' THEN {1} ELSE {2} END, 1e-15), 1 - 1e-15)))"


def _two_classifiers(spark, sf_dir):
    """Probabilities of the order states, and the same with two states exchanged."""
    rows = status_rows(spark, sf_dir)
    return rows, rows.select("id", "y", F.col("p1").alias("p0"), F.col("p0").alias("p1"), "p2")


@register("m20_evaluate_external_classes", f"""SELECT 'a' AS model, round({LOSS_SQL.format("p0", "p1", "p2")}, 6) AS log_loss FROM {STATUS_SQL} r
UNION ALL SELECT 'b', round({LOSS_SQL.format("p1", "p0", "p2")}, 6) FROM {STATUS_SQL} r""")
def evaluate_external_classes(spark, sf_dir):
    a, b = _two_classifiers(spark, sf_dir)
    return rounded(M.evaluate_external(a, {"a": a, "b": b}, "id", "y", class_probs(STATUSES), "multiclassification", ["log_loss"]))


@register("d06_compare_classifiers", f"""WITH t AS (SELECT * FROM {STATUS_SQL} r)
SELECT count(*) AS n, round(avg((p2 > p0 AND p2 > p1)::INT), 6) AS agreement, round(avg(abs(p0 - p1)), 6) AS mean_delta, round({LOSS_SQL.format("p0", "p1", "p2")}, 6) AS log_loss_main,
    round({LOSS_SQL.format("p1", "p0", "p2")}, 6) AS log_loss_challenger, round({LOSS_SQL.format("p1", "p0", "p2")} - ({LOSS_SQL.format("p0", "p1", "p2")}), 6) AS log_loss_delta FROM t""")
def compare_classifiers(spark, sf_dir):
    a, b = _two_classifiers(spark, sf_dir)
    return rounded(D.compare_classifiers(a, b, "id", class_probs(STATUSES), a, "y")[1])


@register("d08_classification_summary", f"""SELECT round({LOSS_SQL.format("p0", "p1", "p2")}, 6) AS score, count(p0) AS predictions_count, 'weight' AS missing_columns,
    0.0::DOUBLE AS duration FROM {STATUS_SQL} r""")
def classification_summary(spark, sf_dir):
    return rounded(D.prediction_summary(status_rows(spark, sf_dir), "y", class_probs(STATUSES), table(spark, sf_dir, "lineitem"),
                                        {"l_quantity": "double", "weight": "double"}, problem="multiclassification"), 6, "score")


@register("m11_tuned_fit")
def tuned_fit(spark, sf_dir):
    df = regression_table(spark, sf_dir)
    model = M.fit_model(df, REGRESSION_ROLES, "regression", "LR", profile="normal")
    return model.transform(df)


@register("m13_cross_validation")
def cross_validation(spark, sf_dir):
    return M.cross_validation(regression_table(spark, sf_dir), REGRESSION_ROLES, "regression", "LR", 3)


@register("m15_feature_importance")
def feature_importance(spark, sf_dir):
    return M.feature_importance(M.fit_model(regression_table(spark, sf_dir), REGRESSION_ROLES, "regression", "RF"))


@register("m16_leaderboard")
def leaderboard(spark, sf_dir):
    config = M.TrainingConfig(advanced=(), normal=("LR",), simple=("DT",), with_blend=True)
    return M.fit_regression(regression_table(spark, sf_dir), REGRESSION_ROLES, config)[0]


@register("m17_fit_classification")
def fit_classification(spark, sf_dir):
    config = M.TrainingConfig(advanced=(), normal=("LR",), simple=("DT",))
    return M.fit_classification(binary_table(spark, sf_dir), BINARY_ROLES, config)[0]


@register("m17_fit_multiclassification")
def fit_multiclassification(spark, sf_dir):
    config = M.TrainingConfig(advanced=(), normal=("LR", "NBC"), simple=("DT",))
    return M.fit_multiclassification(multi_table(spark, sf_dir), MULTI_ROLES, config)[0]


@register("m17_fit_with_text", f"""SELECT count(*) AS n, true AS accurate, 'axis,cluster,text_embedding,text_tfidf,text_word2vec' AS modules FROM documents
    WHERE {sql_hash("(doc_id::VARCHAR || 'holdout')")} / 4294967296.0 < 0.2""")
def fit_with_text(spark, sf_dir):
    """English or not, from the text and axis modules of an experiment."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars", (F.col("lang") == "en").cast("string").alias("english"))
    roles = ColumnRoles(target="english", id="doc_id")
    config = M.TrainingConfig(advanced=(), normal=("LR",), features=("text_tfidf", "text_word2vec", "text_embedding", "pca", "kmean"))
    _, models = M.fit_classification(docs, roles, config)
    _, holdout = split_holdout(docs, 0.2, ["doc_id"])
    kinds = sorted({n.rsplit("_", 1)[0] for n in models["LR-normal"].encoder.inputs} - {"n"})
    hit = F.avg((F.col("prediction") == F.col("english")).cast("double"))
    return models["LR-normal"].transform(holdout).agg(F.count(F.lit(1)).alias("n"), (hit > 0.85).alias("accurate"), F.lit(",".join(kinds)).alias("modules"))


# --- prediction ---------------------------------------------------------------------------------------------------

@register("d01_predict")
def predict(spark, sf_dir):
    df = regression_table(spark, sf_dir)
    train, _ = split_holdout(df, 0.2, ["line_id"])
    return D.predict(M.fit_model(train, REGRESSION_ROLES, "regression", "LR"), df)


def _priced(spark, sf_dir):
    return _candidates(spark, sf_dir).select("l_orderkey", "y", F.col("a").alias("p"))


@register("d02_confidence_regression", f"""WITH t AS MATERIALIZED (SELECT l_orderkey, y, a AS p FROM {CANDIDATES_SQL} r),
s AS MATERIALIZED (SELECT quantile_cont(y - p, [{", ".join(str(q / 100) for q in D.QUANTILES)}]) AS q FROM t)
SELECT l_orderkey, {", ".join(f'round(p + q[{i}], 4) AS "y_quantile={q}"' for i, q in enumerate(D.QUANTILES, 1))} FROM t, s""")
def confidence_regression(spark, sf_dir):
    rows = _priced(spark, sf_dir)
    out = D.confidence_regression(rows.select("l_orderkey", "p"), rows.select((F.col("y") - F.col("p")).alias("r")), "p", "r", "y")
    return rounded(out.drop("p"), 4)


@register("d03_confidence_classification", f"""WITH t AS (SELECT * FROM {STATUS_SQL} r),
cal AS (SELECT 1 - (CASE y WHEN 'F' THEN p0 WHEN 'O' THEN p1 ELSE p2 END) AS s, 1 AS n FROM t),
asked AS (SELECT id, 1 - unnest([p0, p1, p2]) AS s FROM t),
cum AS (SELECT s, sum(sum(n)) OVER () - coalesce(sum(sum(n)) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ge,
    sum(sum(n)) OVER () AS total FROM (SELECT * FROM cal UNION ALL SELECT s, 0 FROM asked) u GROUP BY s),
pv AS (SELECT id, list_sort(list((ge + 1) / (total + 1)), 'DESC') AS pv FROM asked JOIN cum USING (s) GROUP BY id)
SELECT id, round(1 - pv[2], 6) AS confidence, round(pv[1], 6) AS credibility FROM pv""")
def confidence_classification(spark, sf_dir):
    rows = status_rows(spark, sf_dir)
    return rounded(D.confidence_classification(rows, rows, "id", "y", class_probs(STATUSES)))


@register("d04_explain_linear", """SELECT c_custkey, unnest(['c_acctbal', 'c_nationkey']) AS feature, round(unnest([
    0.5 * (c_acctbal - (SELECT avg(c_acctbal) FROM customer)), -2.0 * (c_nationkey - (SELECT avg(c_nationkey) FROM customer))]), 4)
    AS contribution FROM customer""")
def explain_linear(spark, sf_dir):
    return rounded(D.explain_linear(table(spark, sf_dir, "customer"), "c_custkey", {"c_acctbal": 0.5, "c_nationkey": -2.0}), 4)


FOLD_SQL = f"{sql_hash('(l_orderkey::VARCHAR || chr(102) || chr(111) || chr(108) || chr(100))')} % 5"


@register("d02_confidence_fitted", f"""WITH t AS MATERIALIZED (SELECT l_orderkey AS line_id, sum(l_extendedprice) AS y, sum(l_quantity) AS x,
    {FOLD_SQL} AS fold FROM lineitem GROUP BY l_orderkey),
fits AS (SELECT f.fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM t JOIN (SELECT DISTINCT fold FROM t) f ON t.fold <> f.fold GROUP BY f.fold),
q AS MATERIALIZED (SELECT quantile_cont(y - (a * x + b), [{", ".join(str(q / 100) for q in D.QUANTILES)}]) AS q FROM t JOIN fits USING (fold)),
whole AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM t)
SELECT line_id, round(a * x + b) AS prediction, {", ".join(f'round(a * x + b + q[{i}]) AS "y_quantile={q}"' for i, q in enumerate(D.QUANTILES, 1))}
FROM t, whole, q""")
def confidence_fitted(spark, sf_dir):
    """Predictions of a fitted line with the percentiles of its own out-of-fold residuals."""
    df = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("line_id")).agg(
        F.sum("l_extendedprice").alias("y"), F.sum("l_quantity").alias("x"))
    model = M.fit_model(df, ColumnRoles(target="y", id="line_id"), "regression", "LR", confidence=True)
    return rounded(D.predict(model, df, confidence=True).drop("x", "y"), 0)


@register("d03_confidence_fitted")
def confidence_fitted_classes(spark, sf_dir):
    """Confidence and credibility of a fitted classifier, ranked among the rows of each class."""
    df = multi_table(spark, sf_dir)
    train, holdout = split_holdout(df, 0.2, ["o_orderkey"])
    model = M.fit_model(train, MULTI_ROLES, "multiclassification", "LR", confidence=True)
    return D.predict(model, holdout, confidence=True).drop("o_totalprice", "o_orderdate", "o_orderpriority")


@register("d04_explain_trees", """SELECT l_orderkey AS line_id, 0.0::DOUBLE AS gap FROM lineitem GROUP BY l_orderkey""")
def explain_trees(spark, sf_dir):
    """What is left of each prediction of a boosted model when its base and all contributions are taken off."""
    df = cut_lineage(regression_table(spark, sf_dir))
    model = M.fit_model(df, REGRESSION_ROLES, "regression", "XGB")
    total = F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    predicted = model.transform(df).select("line_id", "prediction")
    both = D.explanations(model, df, "line_id").join(predicted, "line_id")
    return both.select("line_id", F.abs(F.round(F.col("prediction") - F.col("base") - total, 4)).alias("gap"))


@register("d04_explain_any")
def explain_any(spark, sf_dir):
    df = regression_table(spark, sf_dir)
    return D.explain(M.fit_model(df, REGRESSION_ROLES, "regression", "DT"), df, "line_id")


@register("d06_main_challenger", f"""WITH t AS (SELECT * FROM {CANDIDATES_SQL} r) SELECT count(*) AS n,
    round(avg((abs(b - a) <= 5000)::INT), 6) AS agreement, round(avg(b - a), 2) AS mean_delta, round(sqrt(avg(pow(y - a, 2))), 2) AS rmse_main,
    round(sqrt(avg(pow(y - b, 2))), 2) AS rmse_challenger,
    round(sqrt(avg(pow(y - b, 2))) - sqrt(avg(pow(y - a, 2))), 2) AS rmse_delta FROM t""")
def main_challenger(spark, sf_dir):
    rows = _candidates(spark, sf_dir)
    _, out = D.score_main_challenger(rows.select("l_orderkey", F.col("a").alias("p")), rows.select("l_orderkey", F.col("b").alias("p")),
                                     "l_orderkey", "p", rows, "y", 5000.0)
    return out.select("n", F.round("agreement", 6).alias("agreement"),
                      *[F.round(c, 2).alias(c) for c in ("mean_delta", "rmse_main", "rmse_challenger", "rmse_delta")])


@register("d07_holdout_predictions")
def holdout_predictions(spark, sf_dir):
    train, holdout = split_holdout(regression_table(spark, sf_dir), 0.2, ["line_id"])
    models = {c: M.fit_model(train, REGRESSION_ROLES, "regression", c) for c in ("LR", "DT")}
    return D.holdout_predictions(models, holdout, ["line_id", "l_extendedprice"])


@register("d08_prediction_summary", f"""SELECT round(sqrt(avg(pow(y - p, 2))), 3) AS score, count(p) AS predictions_count,
    'colour,weight' AS missing_columns, 0.0::DOUBLE AS duration FROM {REGRESSION_SQL} r""")
def prediction_summary(spark, sf_dir):
    return rounded(D.prediction_summary(regression_rows(spark, sf_dir), "y", "p", table(spark, sf_dir, "lineitem"),
                                        {"l_quantity": "double", "weight": "double", "colour": "string"}), 3, "score")
