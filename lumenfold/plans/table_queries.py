"""Roles, joins, profiles, drift, registry and nested data on the standard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfold.operators import analysis as G, drift as D, joins as J, nested as N, profile as A, registry as L, roles as P
from lumenfold.operators.roles import ColumnRoles
from lumenfold.plans.catalog import (BINARY_SQL, STATUS_SQL, TIED_SQL, binary_rows, register, rounded, sql_hash,
                                     status_rows, table, tied_rows)
from lumenfold.plans.metric_queries import counts, grouped_scores
from lumenfold.session import scratch_path

# --- sources and roles --------------------------------------------------------------------------------------------


@register("s02_load_parquet", "SELECT * FROM customer")
def load_parquet(spark, sf_dir):
    from lumenfold.sources.readers import load_parquet as load
    return load(spark, f"{sf_dir}/customer.parquet")


ORDER_ROLES = ColumnRoles(target="o_totalprice", id="o_orderkey", time="o_orderdate", groups=("o_orderstatus",),
                          apriori=("o_orderpriority",))


@register("p01_assign_roles", """SELECT o_totalprice, o_orderkey, o_orderdate, o_orderstatus, o_orderpriority
    FROM orders""")
def assign_roles(spark, sf_dir):
    return P.assign_roles(table(spark, sf_dir, "orders"), ColumnRoles(
        **{**ORDER_ROLES.__dict__, "drop": ("o_custkey",)}))


@register("p02_drop_list", "SELECT p_partkey, p_name, p_retailprice FROM part")
def drop_list(spark, sf_dir):
    return P.drop_columns(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


@register("p03_normalize_nulls", """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
    CASE WHEN o_totalprice >= 100000 THEN o_totalprice END AS price FROM orders""")
def normalize_nulls(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", "null").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_totalprice") < 100000, float("nan")).otherwise(F.col("o_totalprice")).alias("price"))
    return P.normalize_nulls(rows)


@register("p04_pred_label", f"""SELECT id, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 'F' WHEN p1 >= p2 THEN 'O' ELSE 'P' END
    AS pred_label FROM {STATUS_SQL} r""")
def pred_label(spark, sf_dir):
    rows = status_rows(spark, sf_dir).select("id", F.col("p0").alias("pred_F"), F.col("p1").alias("pred_O"),
                                             F.col("p2").alias("pred_P"))
    return P.pred_label(rows).select("id", "pred_label")


@register("p05_apply_threshold", f"SELECT id, (p >= 0.5)::INT AS label FROM {BINARY_SQL} r")
def apply_threshold(spark, sf_dir):
    return binary_rows(spark, sf_dir).select("id", P.apply_threshold("p").alias("label"))


CONTRACT = {"value": "double", "user_id": "bigint", "event_type": "int", "k_text": "int", "absent": "double"}
UNIT_SQL = """(SELECT *, CASE WHEN event_type = 'error' THEN 'n/a' ELSE regexp_extract(props, '[0-9]+') END AS k_text
    FROM events)"""


def unit_inputs(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn(
        "k_text", F.when(F.col("event_type") == "error", "n/a").otherwise(F.regexp_extract("props", "[0-9]+", 0)))


@register("p06_contract_report", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {str(c != 'absent').lower()} AS present, "
    + (f"count({c}) AS non_null, count(try_cast({c} AS {t})) AS castable" if c != "absent" else "0 AS non_null, 0 AS castable")
    + f", count(*) AS n_rows FROM {UNIT_SQL} e" for c, t in CONTRACT.items()) + ") u")
def contract_report(spark, sf_dir):
    return P.contract_report(unit_inputs(spark, sf_dir), CONTRACT)


@register("p07_type_policy", f"""SELECT event_id, 'best_effort' AS policy, 'kept' AS part, try_cast(k_text AS INT) AS k_text
    FROM {UNIT_SQL} e UNION ALL
    SELECT event_id, 'strict', CASE WHEN try_cast(k_text AS INT) IS NULL THEN 'rejected' ELSE 'kept' END,
    try_cast(k_text AS INT) FROM {UNIT_SQL} e""")
def type_policy(spark, sf_dir):
    rows, contract = unit_inputs(spark, sf_dir), {"k_text": "int"}
    kept, _ = P.type_policy(rows, contract)
    good, bad = P.type_policy(rows, contract, "strict")

    def shape(df, policy, part):
        return df.select("event_id", F.lit(policy).alias("policy"), F.lit(part).alias("part"),
                         F.col("k_text").try_cast("int").alias("k_text"))
    return shape(kept, "best_effort", "kept").unionByName(shape(good, "strict", "kept")) \
        .unionByName(shape(bad, "strict", "rejected"))


@register("p08_sample", f"SELECT * FROM events WHERE {sql_hash('event_id::VARCHAR')} / 4294967296.0 < 0.3")
def sample(spark, sf_dir):
    return P.sample(table(spark, sf_dir, "events"), 0.3, ["event_id"])


@register("p09_split_holdout", f"""SELECT o_orderkey, CASE WHEN {sql_hash("o_orderkey::VARCHAR || 'holdout'")}
    / 4294967296.0 < 0.2 THEN 'holdout' ELSE 'train' END AS part FROM orders""")
def split_holdout(spark, sf_dir):
    train, holdout = P.split_holdout(table(spark, sf_dir, "orders"), 0.2, ["o_orderkey"])
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(
        holdout.select("o_orderkey", F.lit("holdout").alias("part")))


@register("p10_assign_folds", f"""SELECT o_orderkey, ({sql_hash("o_orderkey::VARCHAR || 'fold'")} % 5)::INT AS hash_fold,
    year(o_orderdate)::INT AS user_fold FROM orders""")
def assign_folds(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    rows = P.assign_folds(rows, 5, ["o_orderkey"], name="hash_fold")
    return P.assign_folds(rows, fold_column="year", name="user_fold").select("o_orderkey", "hash_fold", "user_fold")


# --- joins --------------------------------------------------------------------------------------------------------

@register("j01_join_holdout", f"""SELECT id, round(p, 6) AS p, o_totalprice FROM {BINARY_SQL} b JOIN orders ON id = o_orderkey""")
def join_holdout(spark, sf_dir):
    truth = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    return rounded(J.join_holdout(binary_rows(spark, sf_dir).select("id", "p"), truth, "id"), 6, "p")


@register("j02_join_logged", "SELECT event_id, props, event_type, value FROM events")
def join_logged(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return J.join_logged(events.select("event_id", "props", "event_type"), events.select("event_id", "value"), "event_id")


@register("j02_join_logged_by_position", "SELECT row_number() OVER () - 1 AS row, event_id, value FROM events")
def join_logged_by_position(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return J.join_logged(events.select("event_id"), events.select("value"))


@register("j02_join_logged_files", """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row, o_orderkey, o_totalprice, o_custkey FROM orders""")
def join_logged_files(spark, sf_dir):
    """Two logs of the same orders, cut into files of different and unequal sizes."""
    orders = table(spark, sf_dir, "orders")
    top = orders.agg(F.max("o_orderkey").cast("double")).first()[0] or 1.0
    share = F.col("o_orderkey") / F.lit(top)
    logs = []
    for cuts, columns in (((0.05, 0.5, 0.6), ["o_orderkey", "o_totalprice"]), ((0.3, 0.31, 0.32, 0.9, 0.95), ["o_custkey"])):
        path = scratch_path(spark, "log")
        part = sum(((share > c).cast("int") for c in cuts), F.lit(0))
        orders.withColumn("_part", part).repartitionByRange(len(cuts) + 1, "_part", "o_orderkey").sortWithinPartitions("o_orderkey").select(*columns).write.parquet(path)
        logs.append(spark.read.schema(orders.select(*columns).schema).parquet(path))
    return J.join_logged(*logs)


@register("j04_compare_main_challenger", """SELECT coalesce(m.o_orderkey, c.o_orderkey) AS o_orderkey, m.p AS main,
    c.p AS challenger, round(c.p - m.p, 4) AS delta
    FROM (SELECT o_orderkey, o_totalprice AS p FROM orders WHERE o_orderstatus <> 'P') m
    FULL JOIN (SELECT o_orderkey, o_totalprice * 1.5 AS p FROM orders WHERE o_orderpriority <> '1-URGENT') c
    ON m.o_orderkey = c.o_orderkey""")
def compare_main_challenger(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    main = orders.where("o_orderstatus <> 'P'").select("o_orderkey", F.col("o_totalprice").alias("p"))
    challenger = orders.where("o_orderpriority <> '1-URGENT'").select("o_orderkey", (F.col("o_totalprice") * 1.5).alias("p"))
    return rounded(J.compare_main_challenger(main, challenger, "o_orderkey", "p"), 4, "delta")


@register("j07_apply_encoding", """SELECT c_custkey, coalesce(n_orders, 0) AS n_orders FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) m ON o_custkey = c_custkey""")
def apply_encoding(spark, sf_dir):
    mapping = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")) \
        .agg(F.count(F.lit(1)).alias("n_orders"))
    return J.apply_encoding(table(spark, sf_dir, "customer").select("c_custkey"), mapping, "c_custkey", "n_orders", 0)


# --- profiles -----------------------------------------------------------------------------------------------------

PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def profiled_lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))


@register("a01_numeric_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count(*) - count({v}) AS missing, count({v}) AS count, round(min({v}), 4) AS min,
    round(max({v}), 4) AS max, round(avg({v}), 4) AS mean, round(stddev_samp({v}), 4) AS std,
    round(quantile_cont({v}, 0.5), 4) AS median FROM lineitem"""
    for c in PROFILED for v in ["nullif(l_discount, 0)" if c == "l_discount" else c]))
def numeric_profile(spark, sf_dir):
    return rounded(A.numeric_profile(profiled_lines(spark, sf_dir), PROFILED), 4)


FREQUENT = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@register("a02_categorical_profile", f"""SELECT feature, value, n, round(n / total, 6) AS frequency, rank::INT AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rank,
    sum(n) OVER (PARTITION BY feature) AS total FROM ({" UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c}::VARCHAR AS value, count(*) AS n FROM orders GROUP BY ALL" for c in FREQUENT)}) u) r
    WHERE rank <= 10""")
def categorical_profile(spark, sf_dir):
    return rounded(A.categorical_profile(table(spark, sf_dir, "orders"), FREQUENT), 6, "frequency")


TOKENS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@register("a03_text_profile", f"""SELECT lang, token, n, rank::INT AS rank FROM (SELECT *,
    row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rank FROM (SELECT lang, token, count(*) AS n
    FROM (SELECT lang, unnest({TOKENS_SQL}) AS token FROM documents) t GROUP BY ALL) c) r WHERE rank <= 20""")
def text_profile(spark, sf_dir):
    return A.text_profile(table(spark, sf_dir, "documents"), "text", 20, ["lang"])


def _type_sql(source: str, kinds: dict[str, str]) -> str:
    def one(c, kind):
        if kind == "int":
            rule = f"CASE WHEN count(DISTINCT {c}) <= 20 THEN 'ordinal' ELSE 'linear' END"
        elif kind == "str":
            rule = (f"CASE WHEN avg(len(regexp_extract_all({c}, '\\S+'))) >= 5 AND count(DISTINCT {c}) / count({c}) > 0.5 "
                    "THEN 'textual' ELSE 'categorical' END")
        else:
            rule = f"'{kind}'"
        return f"SELECT '{c}' AS feature, {rule} AS type" + (f" FROM {source}" if kind in ("int", "str") else "")
    return " UNION ALL ".join(one(c, k) for c, k in kinds.items())


TYPED = {"documents": {"doc_id": "int", "text": "str", "lang": "str", "source": "str", "n_chars": "int"},
         "orders": {"o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "str", "o_totalprice": "linear",
                    "o_orderdate": "date", "o_orderpriority": "str"},
         "lineitem": {"l_linenumber": "int", "l_quantity": "linear", "l_returnflag": "str", "l_shipdate": "date"}}
TYPES_SQL = " UNION ALL ".join(_type_sql(t, kinds) for t, kinds in TYPED.items())


@register("a04_infer_feature_type", TYPES_SQL)
def infer_feature_type(spark, sf_dir):
    parts = [A.infer_feature_types(table(spark, sf_dir, t), list(kinds)) for t, kinds in TYPED.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("a05_feature_type_distribution", f"SELECT type, count(*) AS n_features FROM ({TYPES_SQL}) t GROUP BY type")
def feature_type_distribution(spark, sf_dir):
    return A.feature_type_distribution(infer_feature_type(spark, sf_dir))


@register("a06_dropped_features", """SELECT unnest(['never', 'always', 'key_text', 'price_again']) AS feature,
    unnest(['all_null', 'constant', CASE WHEN (SELECT count(DISTINCT o_orderkey) = count(*) FROM orders) THEN 'unique_id' END,
    'duplicate']) AS reason""")
def dropped_features(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return A.dropped_features(rows.withColumns({
        "never": F.when(F.col("o_orderkey") < -1, "x"), "always": F.when(F.col("o_orderkey") >= 0, "same"),
        "key_text": F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")), "price_again": F.col("o_totalprice")}))


@register("a07_correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round({'avg(1.0::DOUBLE)' if a == b else f'corr({a}, {b})'}, 6) AS score FROM lineitem"
    for a in PROFILED for b in PROFILED))
def correlation_matrix(spark, sf_dir):
    return rounded(A.correlation_matrix(table(spark, sf_dir, "lineitem"), PROFILED), 6)


@register("a08_feature_role_info", """WITH s AS (SELECT count(*) AS n, min(o_totalprice) AS a, max(o_totalprice) AS b,
    avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd, quantile_cont(o_totalprice, 0.5) AS md FROM orders)
SELECT 'o_totalprice' AS name, 'linear' AS type, 'target' AS role, unnest(['missing', 'count', 'min', 'max', 'mean', 'std',
    'median']) AS stat, round(unnest([0.0, n, a, b, m, sd, md]), 3) AS value FROM s
UNION ALL SELECT 'o_orderstatus', 'categorical', 'group', unnest(['missing', 'count']), unnest([0.0, n]) FROM s
UNION ALL SELECT 'o_orderpriority', 'categorical', 'apriori', unnest(['missing', 'count']), unnest([0.0, n]) FROM s
UNION ALL SELECT 'o_orderdate', 'date', 'time', unnest(['missing', 'count']), unnest([0.0, n]) FROM s""")
def feature_role_info(spark, sf_dir):
    info = A.feature_role_info(table(spark, sf_dir, "orders"), ORDER_ROLES,
                               ["o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate"])
    return info.select("name", "type", "role", F.explode("stats").alias("stat", "value")) \
        .withColumn("value", F.round("value", 3))


# --- drift and usage ----------------------------------------------------------------------------------------------

CUT = "2024-01-16"


def event_halves(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    ts, cut = F.col("ts"), F.lit(CUT).cast("timestamp_ntz")
    return events.where(ts < cut), events.where(ts >= cut)


HALVES_SQL = f"""ev AS (SELECT *, (props::JSON->>'k')::DOUBLE AS k, (ts < '{CUT}'::TIMESTAMP) AS is_ref FROM events),
long AS (SELECT 'value' AS feature, value AS v, is_ref FROM ev UNION ALL SELECT 'k', k, is_ref FROM ev)"""


@register("a09_drift_psi", f"""WITH {HALVES_SQL},
edges AS (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM long WHERE is_ref GROUP BY feature),
binned AS (SELECT feature, len(list_filter(e, lambda x: x < v))::VARCHAR AS bin, is_ref FROM long JOIN edges USING (feature)
    UNION ALL SELECT 'event_type', event_type, is_ref FROM ev),
cells AS (SELECT feature, bin, sum(is_ref::INT) AS r, sum((NOT is_ref)::INT) AS c FROM binned GROUP BY ALL),
shares AS (SELECT feature, greatest(r / sum(r) OVER (PARTITION BY feature), 1e-6) AS r,
    greatest(c / sum(c) OVER (PARTITION BY feature), 1e-6) AS c FROM cells)
SELECT feature, round(sum((c - r) * ln(c / r)), 6) AS psi FROM shares GROUP BY feature""")
def drift_psi(spark, sf_dir):
    return rounded(D.drift_psi(*event_halves(spark, sf_dir), ["value", "k"], ["event_type"]))


@register("a10_drift_ks", f"""WITH {HALVES_SQL},
cells AS (SELECT feature, v, sum(is_ref::INT) AS r, sum((NOT is_ref)::INT) AS c FROM long GROUP BY ALL),
cum AS (SELECT feature, abs(sum(r) OVER w / sum(r) OVER (PARTITION BY feature) - sum(c) OVER w / sum(c) OVER (PARTITION BY feature)) AS gap
    FROM cells WINDOW w AS (PARTITION BY feature ORDER BY v))
SELECT feature, round(max(gap), 6) AS ks FROM cum GROUP BY feature""")
def drift_ks(spark, sf_dir):
    return rounded(D.drift_ks(*event_halves(spark, sf_dir), ["value", "k"]))


LOG_SQL = f"""(SELECT *, CASE WHEN {sql_hash('user_id::VARCHAR')} % 4 = 0 THEN 'challenger' ELSE 'main' END AS role,
    (CASE WHEN ts < '{CUT}'::TIMESTAMP THEN 1 ELSE 2 END) AS version FROM events)"""


def prediction_log(spark, sf_dir):
    from lumenfold.functions.hashing import hash_bucket
    return table(spark, sf_dir, "events").withColumns({
        "role": F.when(hash_bucket(4, "user_id") == 0, "challenger").otherwise("main"),
        "version": F.when(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"), 1).otherwise(2)})


@register("a11_deployment_usage", f"SELECT ts::DATE AS day, role, version, count(*) AS n FROM {LOG_SQL} l GROUP BY ALL")
def deployment_usage(spark, sf_dir):
    return D.deployment_usage(prediction_log(spark, sf_dir), "ts")


@register("a11_deployment_usage_rollup", f"""SELECT day, role, version, count(*) AS n FROM (SELECT ts::DATE AS day, role, version
    FROM {LOG_SQL} l) g GROUP BY ROLLUP (day, role, version)""")
def deployment_usage_rollup(spark, sf_dir):
    return D.deployment_usage(prediction_log(spark, sf_dir), "ts", totals=True)


KINDS = ["click", "view", "purchase", "error", "login"]


@register("a12_project_counts", "SELECT user_id, " + ", ".join(
    f"count(*) FILTER (event_type = '{k}') AS n_{k}" for k in KINDS) + " FROM events GROUP BY user_id")
def project_counts(spark, sf_dir):
    return D.project_counts(table(spark, sf_dir, "events"), "user_id", "event_type", KINDS)


# --- classification analysis --------------------------------------------------------------------------------------

for _key, _sql, _rows in (("g01_optimal_threshold", BINARY_SQL, binary_rows), ("g01_optimal_threshold_tied", TIED_SQL, tied_rows)):
    @register(_key, f"""SELECT grp, round(p, 6) AS threshold, round(f1, 6) AS f1 FROM (SELECT *,
        row_number() OVER (PARTITION BY grp ORDER BY round(f1, 12) DESC, p DESC) AS r FROM (SELECT grp, p,
        2 * (pos_total - pos_below) / (pos_total + pos_total + neg_total - pos_below - neg_below) AS f1
        FROM {grouped_scores(_sql)} s) f) z WHERE r = 1""")
    def optimal_threshold(spark, sf_dir, rows=_rows):
        return rounded(G.optimal_threshold(rows(spark, sf_dir), "y", "p", ["grp"]))


@register("g02_dynamic_performance", f"""SELECT grp, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision", round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM (SELECT grp, tp::DOUBLE AS tp, fp::DOUBLE AS fp,
    fn::DOUBLE AS fn, tn::DOUBLE AS tn FROM {counts(BINARY_SQL, t=0.6)} c) d""")
def dynamic_performance(spark, sf_dir):
    return rounded(G.dynamic_performance(binary_rows(spark, sf_dir), "y", "p", 0.6, ["grp"]))


@register("g03_chart_curves", f"""SELECT grp, round(p, 6) AS threshold, round(found / pos_total, 6) AS tpr,
    round((n - found) / neg_total, 6) AS fpr, round(found / n, 6) AS "precision",
    round(n / (pos_total + neg_total), 6) AS share, round((found / n) / (pos_total / (pos_total + neg_total)), 6) AS lift
    FROM (SELECT *, pos_total - pos_below AS found, pos_total + neg_total - pos_below - neg_below AS n
    FROM {grouped_scores(TIED_SQL)} s) t""")
def chart_curves(spark, sf_dir):
    return rounded(G.chart_curves(tied_rows(spark, sf_dir), "y", "p", ["grp"]))


# --- registry -----------------------------------------------------------------------------------------------------

MODELS_SQL = """(SELECT p_brand AS experiment, p_name || '-' || p_partkey AS model, p_partkey AS pos,
    p_size > 45 AS is_best, p_size < 2 AND p_type = 'ECONOMY' AS is_fast FROM part)"""


def models(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("experiment"), F.concat_ws("-", "p_name", "p_partkey").alias("model"),
        F.col("p_partkey").alias("pos"), F.array_compact(F.array(
            F.when(F.col("p_size") > 45, "best"),
            F.when((F.col("p_size") < 2) & (F.col("p_type") == "ECONOMY"), "fastest"))).alias("tags"))


@register("l01_best_model", f"""SELECT experiment, coalesce(arg_max(model, pos) FILTER (is_best), arg_min(model, pos)) AS best_model
    FROM {MODELS_SQL} m GROUP BY experiment""")
def best_model(spark, sf_dir):
    return L.best_model(models(spark, sf_dir), ["experiment"], "model", "pos", "tags")


@register("l02_fastest_model", f"""SELECT experiment, coalesce(arg_max(model, pos) FILTER (is_fast), arg_min(model, pos)) AS fastest_model
    FROM {MODELS_SQL} m GROUP BY experiment""")
def fastest_model(spark, sf_dir):
    return L.fastest_model(models(spark, sf_dir), ["experiment"], "model", "pos", "tags")


@register("l03_latest_version", """SELECT o_custkey, o_orderkey AS latest, o_orderdate FROM (SELECT *, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) t WHERE r = 1""")
def latest_version(spark, sf_dir):
    return L.latest_version(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderdate")


@register("l04_version_lineage", """WITH RECURSIVE v AS (SELECT o_orderkey AS id,
    CASE WHEN o_orderkey > 0 AND o_orderstatus <> 'P' THEN o_orderkey // 3 END AS parent FROM orders),
    walk AS (SELECT id, id AS root, 0 AS depth FROM v WHERE parent IS NULL
    UNION ALL SELECT v.id, walk.root, walk.depth + 1 FROM v JOIN walk ON v.parent = walk.id)
    SELECT id AS version, root, depth FROM walk""")
def version_lineage(spark, sf_dir):
    versions = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("version"),
        F.when((F.col("o_orderkey") > 0) & (F.col("o_orderstatus") != "P"), F.expr("o_orderkey div 3")).alias("parent"))
    return L.version_lineage(versions, "version", "parent")


@register("l05_new_version", """SELECT o_orderkey, coalesce(flag, o_orderstatus) AS o_orderstatus,
    round(coalesce(price, o_totalprice), 2) AS o_totalprice FROM orders LEFT JOIN (SELECT l_orderkey, min(l_returnflag) AS flag,
    max(l_extendedprice) AS price FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) l ON l_orderkey = o_orderkey""")
def new_version(spark, sf_dir):
    base = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")) \
        .agg(F.min("l_returnflag").alias("o_orderstatus"), F.max("l_extendedprice").alias("o_totalprice"))
    return rounded(L.new_version(base, changed, "o_orderkey"), 2)


@register("l07_recent_runs", """SELECT user_id, event_id, ts, recency::INT AS recency FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS recency FROM events) t WHERE recency <= 15""")
def recent_runs(spark, sf_dir):
    return L.recent_runs(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), "user_id", "ts", "event_id")


@register("l10_collect_predictions", """SELECT 'orders' AS source, o_orderkey AS id, o_totalprice AS prediction,
    o_orderstatus AS label FROM orders UNION ALL SELECT 'customers', c_custkey, c_acctbal, NULL FROM customer""")
def collect_predictions(spark, sf_dir):
    return L.collect_predictions({
        "orders": table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("prediction"),
                                                        F.col("o_orderstatus").alias("label")),
        "customers": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("prediction"))})


# --- nested data --------------------------------------------------------------------------------------------------

def templates(spark, sf_dir):
    """One template per part, as JSON text: an import node, and a sample node that hides its seed on small parts."""
    def prop(name, kind, hidden):
        return F.struct(F.lit(name).alias("name"), kind.alias("type"), hidden.alias("hidden"))

    def node(suffix, name, *props):
        return F.struct(F.concat_ws("-", "p_partkey", F.lit(suffix)).alias("_id"), F.struct(
            F.struct(name.alias("name")).alias("metadata"),
            F.struct(F.array(*props).alias("properties")).alias("interfaces")).alias("pipeline_component_id"))
    no = F.lit(None).cast("boolean")
    body = F.to_json(F.struct(F.array(
        node("in", F.col("p_name"), prop("path", F.lit("str"), no), prop("brand", F.col("p_type"), F.lit(False))),
        node("sample", F.lit("sample"), prop("ratio", F.lit("float"), no),
             prop("seed", F.lit("int"), F.col("p_size") < 10))).alias("nodes")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("template_id"), body.alias("body"))


@register("n01_node_properties", """SELECT p_partkey AS template_id, p_partkey || '-in' AS node_id, p_name AS name,
    unnest(['path', 'brand']) AS property, unnest(['str', p_type]) AS type FROM part
    UNION ALL SELECT p_partkey, p_partkey || '-sample', 'sample', 'ratio', 'float' FROM part
    UNION ALL SELECT p_partkey, p_partkey || '-sample', 'sample', 'seed', 'int' FROM part WHERE p_size >= 10""")
def node_properties(spark, sf_dir):
    return N.node_properties(templates(spark, sf_dir), "template_id", "body").select(
        "template_id", "node_id", "name", F.explode("properties").alias("property", "type"))


@register("n02_run_template", f"""SELECT o_orderkey, o_totalprice FROM orders
    WHERE {sql_hash('o_orderkey::VARCHAR')} / 4294967296.0 < 0.25""")
def run_template(spark, sf_dir):
    return N.run_template(lambda: table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 0.25, ["o_orderkey"])


@register("n03_node_params_to_rows", """SELECT p_partkey, unnest(['brand', 'size']) AS name,
    unnest([p_brand, p_size::VARCHAR]) AS value FROM part""")
def node_params_to_rows(spark, sf_dir):
    params = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string"))
    return N.node_params_to_rows(table(spark, sf_dir, "part"), "p_partkey", params)


ORDER_COLUMNS = [("o_orderkey", "bigint", "id"), ("o_custkey", "bigint", "feature"), ("o_orderstatus", "string", "group"),
                 ("o_totalprice", "double", "target"), ("o_orderdate", "timestamp_ntz", "time"),
                 ("o_orderpriority", "string", "apriori")]


@register("n04_schema_report", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS type, '{r}' AS role, round(1 - count({c}) / count(*), 6) AS null_share FROM orders"
    for c, t, r in ORDER_COLUMNS))
def schema_report(spark, sf_dir):
    return rounded(A.schema_report(table(spark, sf_dir, "orders"), ORDER_ROLES), 6)
