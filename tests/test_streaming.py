"""Streams against their batch twins."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lumenfold.streaming import jobs as W


@pytest.fixture()
def stream(spark, small):
    schema = spark.read.parquet(f"{small}/events.parquet").schema
    return W.file_stream(spark, small, "events.parquet", schema, "ts")


def test_log_appends_and_restarts_without_copies(spark, stream):
    out, state = W.fresh_paths(spark, "t")
    for _ in range(2):  # the second run finds nothing new
        W.stream_log_predictions(stream, ["event_id"], ["value"], "main", out, state)
    rows = spark.read.parquet(out)
    assert rows.count() == 1000 and rows.select("role", "version").distinct().collect() == [("main", 1)]
    with pytest.raises(ValueError):
        W.stream_log_predictions(stream, ["event_id"], ["value"], "other", out, state)


def test_usage_equals_batch(spark, stream, small):
    got = W.latest_result(W.usage_windows(stream.withColumn("role", F.lit("main")), "ts", "role"), *W.fresh_paths(spark, "t"))
    want = spark.read.parquet(f"{small}/events.parquet").groupBy(F.to_date("ts").alias("d")).count()
    assert sorted((r["window_start"].date(), r["n"]) for r in got.collect()) == sorted((r["d"], r["count"]) for r in want.collect())


def test_duplicates_go(spark, stream):
    out, state = W.fresh_paths(spark, "t")
    twice = stream.withColumn("c", F.explode(F.array(F.lit(1), F.lit(2))))
    W.append_stream(W.drop_late_duplicates(twice, "ts", ["event_id"], "40 days").select("event_id"), out, state)
    assert spark.read.parquet(out).count() == 1000


def test_status_rules(spark):
    rows = spark.createDataFrame([
        ("both", "copy", "done", 1), ("both", "drift", "done", 1), ("late", "copy", "failed", 1), ("late", "copy", "done", 2),
        ("late", "drift", "done", 1), ("half", "copy", "done", 1), ("bad", "copy", "done", 1), ("bad", "drift", "done", 1),
        ("bad", "state", "failed", 3)], "r string, k string, v string, t int")
    latest = W.latest_values(rows, "r", "k", "v", ["t"])
    got = dict(W.resource_status(latest, "r", "k", [("copy", "done"), ("drift", "done")], [("state", "failed")]).collect())
    assert got == {"both": "done", "late": "done", "half": "running", "bad": "failed"}
    with pytest.raises(ValueError):
        W.resource_status(latest, "r", "k", [("copy", "done"), ("copy", "ok")], [])


@pytest.fixture()
def feed(spark, tmp_path):
    """A function that adds one file of (r, k, v, ts, n) rows, and the stream that reads one file a batch."""
    schema = "r string, k string, v string, ts timestamp, n long"
    folder = str(tmp_path / "in")

    def add(*rows):
        data = [(r, k, v, datetime.fromisoformat(t), i) for i, (r, k, v, t) in enumerate(rows)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)
    add(("seed", "x", "y", "2024-01-01T00:00:00"))
    return add, lambda: W.file_stream(spark, folder, "*.parquet", spark.read.parquet(folder).schema, files_a_batch=1)


def test_status_is_kept_changed_and_freed(spark, feed):
    add, stream = feed
    paths = W.fresh_paths(spark, "t")

    def run():
        changes = W.status_changes(stream(), "r", "k", "v", "ts", "n", [("copy", "done"), ("drift", "done")], [("state", "failed")], "1 day", "10 days")
        counts = W.write_changes(changes, *paths)
        return dict(W.merged_changes(spark, paths[0], ["r"], changes.schema).select("r", "status").collect()), counts
    add(("a", "copy", "done", "2024-01-02T00:00:00"), ("b", "copy", "done", "2024-01-02T01:00:00"))
    assert run()[0] == {"seed": "running", "a": "running", "b": "running"}
    # the newest record of a key counts, in whatever order records come
    add(("a", "drift", "done", "2024-01-03T00:00:00"), ("b", "state", "failed", "2024-01-03T00:00:00"), ("b", "state", "fine", "2024-01-02T00:00:00"))
    assert run()[0] == {"seed": "running", "a": "done", "b": "failed"}
    assert run()[0] == {"seed": "running", "a": "done", "b": "failed"}  # a restart without new data
    add(("c", "copy", "done", "2024-02-20T00:00:00"))
    add(("c", "drift", "done", "2024-02-21T00:00:00"))
    status, counts = run()
    assert status == {"seed": "expired", "a": "expired", "b": "expired", "c": "done"} and counts["state"] == 1


def test_windows_are_updated_freed_and_late_rows_counted(spark, feed):
    add, stream = feed
    paths = W.fresh_paths(spark, "t")

    def run():
        rows = W.usage_windows(stream().withColumn("role", F.lit("main")), "ts", "role", "1 day", "1 day")
        counts = W.write_changes(rows, *paths)
        merged = W.merged_changes(spark, paths[0], ["window_start", "role"], rows.schema)
        return {r["window_start"].day: r["n"] for r in merged.collect()}, counts
    add(("a", "", "", "2024-01-01T05:00:00"), ("a", "", "", "2024-01-02T05:00:00"))
    assert run()[0] == {1: 2, 2: 1}
    add(("a", "", "", "2024-01-02T06:00:00"), ("a", "", "", "2024-01-09T00:00:00"))
    assert run()[0] == {1: 2, 2: 2, 9: 1}
    add(("a", "", "", "2024-01-02T07:00:00"), ("a", "", "", "2024-01-10T00:00:00"))  # the first one comes too late
    days, counts = run()
    assert days == {1: 2, 2: 2, 9: 1, 10: 1} and counts["late"] == 1 and counts["state"] <= 2
