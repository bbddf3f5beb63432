"""Feature engineering and time series on the standard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfold.operators import features as E, forecasting as X, joins as J, timeseries as S
from lumenfold.operators.roles import assign_folds
from lumenfold.plans.catalog import register, rounded, sql_hash, table
from lumenfold.plans.table_queries import TOKENS_SQL


@register("f01_counter", """SELECT c_custkey, ((c_acctbal = 0)::INT + (c_nationkey = 0)::INT) AS n_zero,
    (c_acctbal < 0)::INT AS n_negative, ((c_acctbal > 0)::INT + (c_nationkey > 0)::INT) AS n_positive,
    (c_acctbal > 9000)::INT AS n_null, (c_mktsegment = 'BUILDING')::INT AS n_empty,
    (1 + (c_mktsegment <> 'BUILDING')::INT) AS n_filled
    FROM (SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal FROM customer)""".replace(
    "(c_acctbal > 0)::INT", "(c_acctbal > 0 AND c_acctbal <= 9000)::INT"))
def counter(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumns({
        "c_acctbal": F.when(F.col("c_acctbal") <= 9000, F.col("c_acctbal")),
        "c_mktsegment": F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))})
    return E.counter(rows, ["c_acctbal", "c_nationkey"], ["c_name", "c_mktsegment"]).select(
        "c_custkey", "n_null", "n_zero", "n_negative", "n_positive", "n_empty", "n_filled")


@register("f02_date", """SELECT event_id, year(ts)::INT AS ts_year, quarter(ts)::INT AS ts_quarter, month(ts)::INT AS ts_month,
    day(ts)::INT AS ts_day, (isodow(ts) - 1)::INT AS ts_weekday, dayofyear(ts)::INT AS ts_yearday, weekofyear(ts)::INT AS ts_week,
    hour(ts)::INT AS ts_hour, (isodow(ts) >= 6)::INT AS ts_is_weekend, (ts::DATE - DATE '1970-01-01')::INT AS ts_epoch_days
    FROM events""")
def date_features(spark, sf_dir):
    return E.date_features(table(spark, sf_dir, "events").select("event_id", "ts"), "ts").drop("ts")


@register("f03_freq", """SELECT c_custkey, round(coalesce(n / (SELECT count(*) FROM orders), 0), 9) AS c_custkey_freq
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def frequency_encoding(spark, sf_dir):
    train = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return rounded(E.frequency_encode(train, table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey"), 9)


TFIDF_SQL = f"""words AS (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
vocab AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY term
    ORDER BY count(*) DESC, term LIMIT 1000)"""


@register("f04_text_tfidf", f"""WITH {TFIDF_SQL}
SELECT doc_id, term, tf, round(tf * idf, 6) AS weight FROM tf JOIN vocab USING (term)""")
def text_tfidf(spark, sf_dir):
    return rounded(E.text_tfidf(table(spark, sf_dir, "documents"), "doc_id", "text", 1000))


@register("f05_text_word2vec")
def text_word2vec(spark, sf_dir):
    return E.text_word2vec(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", 16).select("doc_id", "text_vector")


@register("f06_text_embedding")
def text_embedding(spark, sf_dir):
    return E.text_embedding(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", 8) \
        .select("doc_id", "sentence_vector")


FOLD_SQL = f"({sql_hash('''o_orderkey::VARCHAR || 'fold' ''')} % 5)"


@register("f07_tenc", f"""WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice AS y, {FOLD_SQL} AS fold FROM orders),
cells AS (SELECT fold, o_custkey, sum(y) AS s, count(*) AS n FROM o GROUP BY ALL),
folds AS (SELECT fold, (sum(sum(y)) OVER () - sum(y)) / (sum(count(*)) OVER () - count(*)) AS prior FROM o GROUP BY fold),
oof AS (SELECT fold, o_custkey, sum(s) OVER v - s AS s, sum(n) OVER v - n AS n FROM cells WINDOW v AS (PARTITION BY o_custkey))
SELECT o_orderkey, 'train' AS part, round((s + 10 * prior) / (n + 10), 4) AS o_custkey_tenc
FROM o JOIN oof USING (fold, o_custkey) JOIN folds USING (fold)
UNION ALL SELECT c_custkey, 'new', round(coalesce((s + 10 * m) / (n + 10), m), 4) FROM customer
    LEFT JOIN (SELECT o_custkey, sum(y) AS s, count(*) AS n FROM o GROUP BY o_custkey) ON o_custkey = c_custkey,
    (SELECT avg(y) AS m FROM o)""")
def target_encoding(spark, sf_dir):
    train = assign_folds(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 5, ["o_orderkey"])
    coded = E.target_encode_train(train, "o_custkey", "o_totalprice", "fold")
    new = E.target_encode(train, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey")),
                          "o_custkey", "o_totalprice")
    out = coded.select("o_orderkey", F.lit("train").alias("part"), "o_custkey_tenc").unionByName(
        new.select(F.col("o_custkey").alias("o_orderkey"), F.lit("new").alias("part"), "o_custkey_tenc"))
    return rounded(out, 4)


@register("f08_poly", """SELECT p_partkey, round(p_size * p_size, 4) AS p_size_x_p_size,
    round(p_retailprice * p_retailprice, 4) AS p_retailprice_x_p_retailprice,
    round(p_size * p_retailprice, 4) AS p_size_x_p_retailprice FROM part""")
def polynomial(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return rounded(E.polynomial(rows, ["p_size", "p_retailprice"]).drop("p_size", "p_retailprice"), 4)


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("f09_pca")
def pca(spark, sf_dir):
    return E.pca(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS), LINE_NUMBERS, 2)


@register("f10_kmean")
def kmean(spark, sf_dir):
    return E.kmean(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS), LINE_NUMBERS, 5)


@register("f11_select_features", """WITH t AS (SELECT * FROM lineitem),
num AS (SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'l_linenumber']) AS feature, unnest([abs(corr(l_quantity, l_extendedprice)),
    abs(corr(l_discount, l_extendedprice)), abs(corr(l_tax, l_extendedprice)), abs(corr(l_linenumber, l_extendedprice))]) AS score FROM t),
cells AS (SELECT 'l_returnflag' AS feature, l_returnflag AS v, count(*) AS n, avg(l_extendedprice) AS m FROM t GROUP BY ALL
    UNION ALL SELECT 'l_linestatus', l_linestatus, count(*), avg(l_extendedprice) FROM t GROUP BY ALL),
cat AS (SELECT feature, sqrt(sum(n * pow(m - (SELECT avg(l_extendedprice) FROM t), 2))
    / ((SELECT var_pop(l_extendedprice) FROM t) * sum(n))) AS score FROM cells GROUP BY feature)
SELECT feature, round(score, 6) AS score FROM (SELECT * FROM num UNION ALL SELECT * FROM cat) ORDER BY score DESC, feature LIMIT 4""")
def select_features(spark, sf_dir):
    return rounded(E.select_features(table(spark, sf_dir, "lineitem"), "l_extendedprice",
                                     ["l_quantity", "l_discount", "l_tax", "l_linenumber"], ["l_returnflag", "l_linestatus"], 4))


@register("e01_dataset_embedding")
def dataset_embedding(spark, sf_dir):
    return E.dataset_embedding(table(spark, sf_dir, "part"), "p_partkey", "p_name", 3)


# --- time series --------------------------------------------------------------------------------------------------

WINDOW = S.TimeWindow(-10, -5, 3, 4)
SERIES_SQL = """s AS (SELECT user_id, (ts::DATE - DATE '1970-01-01')::INT AS step, sum(value) AS v, count(*)::DOUBLE AS n
    FROM events GROUP BY ALL)"""


def series(spark, sf_dir):
    return S.build_series(table(spark, sf_dir, "events"), ["user_id"], "ts", {"v": F.col("value"), "n": F.lit(1.0)})


@register("j08_derivation_range_join", f"""WITH {SERIES_SQL} SELECT a.user_id, a.step AS t, b.step - a.step AS offset,
    round(b.v, 4) AS v_past FROM s a JOIN s b ON a.user_id = b.user_id AND b.step BETWEEN a.step - 10 AND a.step - 5""")
def derivation_range_join(spark, sf_dir):
    return rounded(J.derivation_range_join(series(spark, sf_dir), ["user_id"], "step", "v", -10, -5), 4)


@register("t02_derivation_lags", f"WITH {SERIES_SQL} SELECT user_id, step, " + ", ".join(
    f"round(first(v) OVER (PARTITION BY user_id ORDER BY step RANGE BETWEEN {h} PRECEDING AND {h} PRECEDING), 4) AS v_lag{h}"
    for h in range(5, 11)) + " FROM s")
def derivation_lags(spark, sf_dir):
    return rounded(S.derivation_lags(series(spark, sf_dir), ["user_id"], "step", ["v"], WINDOW).drop("v", "n"), 4)


@register("t03_derivation_aggs", f"""WITH {SERIES_SQL} SELECT user_id, step, round(avg(v) OVER w, 4) AS v_mean,
    round(min(v) OVER w, 4) AS v_min, round(max(v) OVER w, 4) AS v_max, round(stddev_samp(v) OVER w, 4) AS v_std,
    count(v) OVER w AS v_count FROM s
    WINDOW w AS (PARTITION BY user_id ORDER BY step RANGE BETWEEN 10 PRECEDING AND 5 PRECEDING)""")
def derivation_aggs(spark, sf_dir):
    return rounded(S.derivation_aggs(series(spark, sf_dir), ["user_id"], "step", ["v"], WINDOW).drop("v", "n"), 4)


@register("t04_forecast_targets", f"""WITH {SERIES_SQL} SELECT a.user_id, a.step, b.step - a.step AS horizon, round(b.v, 4) AS label
    FROM s a JOIN s b ON a.user_id = b.user_id AND b.step BETWEEN a.step + 3 AND a.step + 4""")
def forecast_targets(spark, sf_dir):
    return rounded(S.forecast_targets(series(spark, sf_dir), ["user_id"], "step", "v", WINDOW), 4)


@register("t05_attach_apriori", f"""WITH {SERIES_SQL} SELECT a.user_id, a.step, b.step - a.step AS horizon, round(b.v, 4) AS label,
    b.n AS n_ahead FROM s a JOIN s b ON a.user_id = b.user_id AND b.step BETWEEN a.step + 3 AND a.step + 4""")
def attach_apriori(spark, sf_dir):
    return rounded(S.attach_apriori(series(spark, sf_dir), ["user_id"], "step", "v", WINDOW, ["n"]), 4)


@register("t06_series_groups", """SELECT user_id, event_type, (ts::DATE - DATE '1970-01-01')::INT AS step, round(sum(value), 4) AS v
    FROM events GROUP BY ALL""")
def series_groups(spark, sf_dir):
    return rounded(S.build_series(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", {"v": F.col("value")}), 4)


@register("t06_series_without_groups", """WITH d AS (SELECT (o_orderdate::DATE - DATE '1970-01-01')::INT AS step,
    count(*)::DOUBLE AS v FROM orders GROUP BY ALL) SELECT step, v, round(avg(v) OVER w, 4) AS v_mean,
    min(v) OVER w AS v_min, max(v) OVER w AS v_max, round(stddev_samp(v) OVER w, 4) AS v_std,
    count(v) OVER w AS v_count FROM d WINDOW w AS (ORDER BY step RANGE BETWEEN 90 PRECEDING AND 30 PRECEDING)""")
def series_without_groups(spark, sf_dir):
    daily = S.build_series(table(spark, sf_dir, "orders"), [], "o_orderdate", {"v": F.lit(1.0)})
    return rounded(S.derivation_aggs(daily, [], "step", ["v"], S.TimeWindow(-90, -30, 1, 15)), 4)


@register("t08_fit_timeseries")
def fit_timeseries(spark, sf_dir):
    return S.fit_timeseries(series(spark, sf_dir), ["user_id"], "step", "v", WINDOW, ["n"])[1]


SPEC = X.SeriesSpec(("user_id",), "step", "v", WINDOW, ("n",))
TAIL_SQL = f"""{SERIES_SQL}, last AS (SELECT user_id, max(step) AS last FROM s GROUP BY user_id), known AS (SELECT *, last(v) OVER (PARTITION BY user_id ORDER BY step
    RANGE BETWEEN 10 PRECEDING AND 5 PRECEDING) AS naive FROM s), rows AS (SELECT a.user_id, a.step, b.step - a.step AS horizon, b.v AS label, a.naive, b.step - last AS ahead, a.step - last AS since
    FROM known a JOIN s b ON a.user_id = b.user_id AND b.step BETWEEN a.step + 3 AND a.step + 4 JOIN last ON last.user_id = a.user_id)"""


@register("t08_tail_rows", f"""WITH {TAIL_SQL} SELECT user_id, step, horizon, round(label, 4) AS label, round(coalesce(naive, 0), 4) AS naive FROM rows
    WHERE since <= -4 AND ahead > -4""")
def tail_rows(spark, sf_dir):
    """The held-out rows of the experiment: origins before the last four steps of a series, targets within them."""
    rows = X.supervised(series(spark, sf_dir), SPEC)
    return rounded(X.within(rows, SPEC, 4, 4).select("user_id", "step", "horizon", "label", "naive"), 4)


@register("t08_better_than_naive", f"""WITH {TAIL_SQL}, mean AS (SELECT avg(label) AS m FROM rows WHERE ahead <= -4)
SELECT count(*) AS n, round(sqrt(avg(pow(label - coalesce(naive, m), 2))), 3) AS naive_rmse, true AS better FROM rows, mean WHERE since <= -4 AND ahead > -4""")
def better_than_naive(spark, sf_dir):
    """The best model of the experiment against the naive forecast on the tails."""
    board, models, tail = X.fit_forecasts(series(spark, sf_dir), SPEC, ("LR",), folds=2)
    naive = board.where("name = 'naive'").first()["tail_score"]
    error = F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2)))
    return tail.agg(F.count(F.lit(1)).alias("n"), F.round(F.lit(naive), 3).alias("naive_rmse"), (error < naive).alias("better"))


@register("t08_forecast_new_series", f"""WITH {SERIES_SQL}, last AS (SELECT user_id, max(step) AS step FROM s GROUP BY user_id), known AS (SELECT *, last(v) OVER (PARTITION BY user_id
    ORDER BY step RANGE BETWEEN 10 PRECEDING AND 5 PRECEDING) AS naive FROM s)
SELECT user_id, step, unnest([3, 4]) AS horizon, round(coalesce(naive, 0), 4) AS naive, true AS predicted FROM known JOIN last USING (user_id, step)""")
def forecast_new_series(spark, sf_dir):
    """A model of the users with even ids forecasts every user: one row for each horizon."""
    every = series(spark, sf_dir)
    _, models, _ = X.fit_forecasts(every.where("user_id % 2 = 0"), SPEC, ("LR",), folds=1)
    return rounded(models["LR"].forecast(every).select("user_id", "step", "horizon", "naive", F.col("prediction").isNotNull().alias("predicted")), 4)


@register("t09_seasonal_naive", f"""WITH {SERIES_SQL} SELECT user_id, step, round(last(v) OVER (PARTITION BY user_id ORDER BY step
    RANGE BETWEEN 10 PRECEDING AND 5 PRECEDING), 4) AS naive FROM s""")
def seasonal_naive(spark, sf_dir):
    return rounded(S.seasonal_naive(series(spark, sf_dir), ["user_id"], "step", "v", WINDOW).drop("v", "n"), 4)
