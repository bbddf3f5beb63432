"""Streams over events, each with its batch twin as oracle; files written from the tables and read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lumenfold.functions.hashing import hash_bucket
from lumenfold.functions.ranking import exact_percentiles
from lumenfold.plans.catalog import register, rounded, sql_hash, table
from lumenfold.session import scratch_path
from lumenfold.sources import readers as R, writers as K
from lumenfold.streaming import jobs as W


def event_stream(spark, sf_dir):
    return W.file_stream(spark, sf_dir, "events.parquet", table(spark, sf_dir, "events").schema, "ts")


def three_days(spark, sf_dir, again: str | None = None):
    """The events as a stream of three files by time, one a batch; again: what else the second and third file bring, as SQL on (ts, part)."""
    path, events = scratch_path(spark, "events"), table(spark, sf_dir, "events")
    part = F.when(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"), 0).when(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"), 1).otherwise(2)
    for i in range(3):
        rows = events.where(part == i)
        if again and i:
            rows = rows.union(events.withColumn("part", F.lit(i)).where(again).drop("part"))
        rows.coalesce(1).write.mode("append").parquet(path)
    return W.file_stream(spark, path, "*.parquet", events.schema, "ts", 1)


@register("w01_stream_score", """SELECT event_id, round(s * k + i, 4) AS prediction FROM (SELECT event_id,
    (props::JSON->>'k')::DOUBLE AS k FROM events) e, (SELECT regr_slope(value, k) AS s, regr_intercept(value, k) AS i
    FROM (SELECT value, (props::JSON->>'k')::DOUBLE AS k FROM events) t) m""")
def stream_score(spark, sf_dir):
    def unit(df):
        return df.withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    vector = VectorAssembler(inputCols=["k"], outputCol="f")
    model = LinearRegression(featuresCol="f", labelCol="value", solver="normal").fit(vector.transform(unit(table(spark, sf_dir, "events"))))
    out, state = W.fresh_paths(spark, "score")
    W.stream_score(event_stream(spark, sf_dir),
                   lambda s: model.transform(vector.transform(unit(s))).select("event_id", "prediction"), out, state)
    return rounded(spark.read.parquet(out), 4)


@register("w02_stream_log_predictions", """SELECT event_id, event_type, value, 'challenger' AS role, 3 AS version FROM events""")
def stream_log_predictions(spark, sf_dir):
    out, state = W.fresh_paths(spark, "log")
    W.stream_log_predictions(event_stream(spark, sf_dir), ["event_id", "event_type"], ["value"], "challenger", out, state, last_version=3)
    return spark.read.parquet(out).select("input.event_id", "input.event_type", "output.value", "role", "version")


ROLE_SQL = f"CASE WHEN {sql_hash('user_id::VARCHAR')} % 4 = 0 THEN 'challenger' ELSE 'main' END"


@register("w03_stream_usage", f"SELECT strftime(ts, '%Y-%m-%d') AS day, {ROLE_SQL} AS role, count(*) AS n FROM events GROUP BY ALL")
def stream_usage(spark, sf_dir):
    """Three batches, and a restart without new data; each batch writes the windows it changed."""
    rows = three_days(spark, sf_dir).withColumn("role", F.when(hash_bucket(4, "user_id") == 0, "challenger").otherwise("main"))
    paths = W.fresh_paths(spark, "usage")
    W.changed_result(W.usage_windows(rows, "ts", "role"), *paths, ["window_start", "role"])
    out = W.changed_result(W.usage_windows(rows, "ts", "role"), *paths, ["window_start", "role"])
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "role", "n")


@register("w04_stream_drift", """WITH edges AS (SELECT quantile_cont(value, [0.2, 0.4, 0.6, 0.8]) AS e FROM events),
b AS (SELECT ts, len(list_filter(e, lambda x: x < value)) AS bin FROM events, edges),
ref AS (SELECT bin, count(*) / (SELECT count(*) FROM b) AS r FROM b GROUP BY bin),
w AS (SELECT unnest([d, d - INTERVAL 5 DAY]) AS w0, bin FROM (SELECT TIMESTAMP '1970-01-01' + INTERVAL 5 DAY * (epoch(ts)::BIGINT // 432000) AS d, bin FROM b)),
c AS (SELECT w0, bin, count(*) AS c FROM w GROUP BY ALL), n AS (SELECT w0, sum(c) AS n FROM c GROUP BY w0)
SELECT strftime(n.w0, '%Y-%m-%d') AS window_start, round(sum((greatest(coalesce(c, 0) / n, 1e-6) - r)
    * ln(greatest(coalesce(c, 0) / n, 1e-6) / r)), 6) AS psi FROM n CROSS JOIN ref LEFT JOIN c ON c.w0 = n.w0 AND c.bin = ref.bin GROUP BY n.w0""")
def stream_drift(spark, sf_dir):
    from lumenfold.operators.drift import bin_number
    events = table(spark, sf_dir, "events")
    edges = list(exact_percentiles(events, F.col("value"), [0.2, 0.4, 0.6, 0.8]).first())
    cut = F.array(*[F.lit(e) for e in edges])
    counts = {r["bin"]: r["n"] for r in events.groupBy(bin_number(F.col("value"), cut).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = [counts.get(i, 0) / sum(counts.values()) for i in range(5)]
    windows = W.drift_windows(three_days(spark, sf_dir), "ts", "value", edges, "10 days", "5 days")
    out = W.window_psi(W.changed_result(windows, *W.fresh_paths(spark, "drift"), ["window_start", "bin"]), shares)
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), F.round("psi", 6).alias("psi"))


SUCCESS = [("click", "done"), ("view", "done")]
FAILURE = [("error", "failed")]


@register("w05_resource_status", """WITH l AS (SELECT user_id, event_type, arg_max(CASE WHEN value > 20 THEN 'failed' WHEN value > 2 THEN 'done'
    ELSE 'running' END, (ts, event_id)) AS v FROM events GROUP BY ALL)
SELECT user_id, CASE WHEN bool_or(event_type = 'error' AND v = 'failed') THEN 'failed' WHEN bool_or(event_type = 'click' AND v = 'done')
    AND bool_or(event_type = 'view' AND v = 'done') THEN 'done' ELSE 'running' END AS status FROM l GROUP BY user_id""")
def resource_status(spark, sf_dir):
    """State per resource over three batches, and a restart without new data."""
    paths = W.fresh_paths(spark, "status")
    rows = three_days(spark, sf_dir).withColumn("state", F.when(F.col("value") > 20, "failed").when(F.col("value") > 2, "done")
                                                .otherwise("running"))
    changes = W.status_changes(rows, "user_id", "event_type", "state", "ts", "event_id", SUCCESS, FAILURE)
    W.changed_result(changes, *paths, ["user_id"])
    return W.changed_result(changes, *paths, ["user_id"]).select("user_id", "status")


@register("w06_late_duplicates", "SELECT event_id, value FROM events")
def late_duplicates(spark, sf_dir):
    """Every record arrives twice; one copy is kept."""
    stream = event_stream(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    out, state = W.fresh_paths(spark, "dedup")
    W.append_stream(W.drop_late_duplicates(stream, "ts", ["event_id"], "40 days").select("event_id", "value"), out, state)
    return spark.read.parquet(out)


@register("w06_late_rows", "SELECT event_id, value FROM events")
def late_rows(spark, sf_dir):
    """The second batch repeats days that the watermark still covers, the third one days long gone: neither changes the result."""
    again = "(part = 1 and ts >= timestamp_ntz'2024-01-08' and ts < timestamp_ntz'2024-01-11') or (part = 2 and ts < timestamp_ntz'2024-01-03')"
    out, state = W.fresh_paths(spark, "late")
    W.append_stream(W.drop_late_duplicates(three_days(spark, sf_dir, again), "ts", ["event_id"], "5 days").select("event_id", "value"), out, state)
    return spark.read.parquet(out)


@register("s14_snapshot", "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders")
def snapshot(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    K.write_snapshot(rows, path, datetime(2024, 1, 1))
    K.write_snapshot(rows.withColumn("o_totalprice", F.col("o_totalprice") * 2), path, datetime(2024, 2, 1))
    return R.read_snapshot(spark, path)


@register("k10_export_log", "SELECT 'nightly' AS exporter, count(*) AS n_rows, 'done' AS status FROM customer")
def export_log(spark, sf_dir):
    path = scratch_path(spark, "exports")
    rows = table(spark, sf_dir, "customer")
    target = K.export_prediction(rows, f"{path}/data", "deployment")
    K.export_log(spark, f"{path}/log", "nightly", target, spark.read.parquet(target).count())
    K.export_log(spark, f"{path}/log", "weekly", target, 0, "failed")
    return K.list_exports(spark, f"{path}/log", "nightly").select("exporter", "n_rows", "status")


# --- files written from the tables and read back ------------------------------------------------------------------

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("s01_load_csv", "SELECT * FROM customer")
def load_csv(spark, sf_dir):
    target = K.write_csv(table(spark, sf_dir, "customer"), scratch_path(spark, "csv"), separator=";")
    return R.load_csv(spark, target, ";", CUSTOMER_SCHEMA)


@register("s03_sniff_formats", "SELECT c_custkey, c_acctbal FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def sniff_formats(spark, sf_dir):
    """Customers as Parquet and suppliers as CSV under one root, told apart by their first bytes."""
    root = scratch_path(spark, "mixed")
    table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").write.parquet(f"{root}/kind=a")
    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal")) \
        .write.option("header", True).csv(f"{root}/kind=b")
    return R.load_directory(spark, f"{root}/kind=*", schema="c_custkey bigint, c_acctbal double")


@register("s10_file_inventory", "SELECT 'parquet' AS extension, true AS has_files, true AS has_bytes")
def file_inventory(spark, sf_dir):
    root = scratch_path(spark, "files")
    K.write_dataset(table(spark, sf_dir, "orders"), f"{root}/orders")
    return R.inventory_totals(R.file_inventory(spark, root)).select("extension", (F.col("n_files") > 0).alias("has_files"),
                                                                    (F.col("bytes") > 0).alias("has_bytes"))


@register("k01_write_csv", """SELECT c_custkey, replace(printf('%.2f', c_acctbal), '.', ',')::VARCHAR AS c_acctbal FROM customer""")
def write_csv(spark, sf_dir):
    target = K.write_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), scratch_path(spark, "csv"),
                         encoding="ISO-8859-1", separator="|", decimal=",", thousands=".")
    rows = R.load_csv(spark, target, "|", "c_custkey bigint, c_acctbal string")
    number = F.replace(F.replace("c_acctbal", F.lit("."), F.lit("")), F.lit(","), F.lit(".")).cast("decimal(20,2)")
    return rows.select("c_custkey", F.replace(number.cast("string"), F.lit("."), F.lit(",")).alias("c_acctbal"))


@register("k02_write_dataset", "SELECT * FROM customer")
def write_dataset(spark, sf_dir):
    target = K.write_dataset(table(spark, sf_dir, "customer"), scratch_path(spark, "zip"), "zip")
    return R.load_csv(spark, target, schema=CUSTOMER_SCHEMA)


@register("k04_write_replace", "SELECT s_suppkey, s_acctbal FROM supplier")
def write_replace(spark, sf_dir):
    path = scratch_path(spark, "replace")
    K.write_dataset(table(spark, sf_dir, "supplier"), path)
    return R.load_parquet(spark, K.write_dataset(table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), path, mode="replace"))


@register("k06_write_timestamp", "SELECT * FROM supplier")
def write_timestamp(spark, sf_dir):
    return R.load_parquet(spark, K.write_dataset(table(spark, sf_dir, "supplier"), scratch_path(spark, "stamped"), mode="timestamp"))


@register("k08_export_prediction", "SELECT o_orderkey, o_totalprice, 'experiment' AS prediction_type FROM orders")
def export_prediction(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return R.load_parquet(spark, K.export_prediction(rows, scratch_path(spark, "prediction"), "experiment"))
