"""Structured Streaming jobs: scoring, prediction logs, usage, drift, resource status, late duplicates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lumenfold.operators.drift import bin_number, psi_of
from lumenfold.session import scratch_path

# Roles of a logged prediction and states of a resource.
ROLES = ("main", "challenger")
STATES = ("done", "running", "failed", "pending")


def file_stream(spark: SparkSession, directory: str, file_name: str, schema: T.StructType, ts: str | None = None,
                files_a_batch: int = 1000) -> DataFrame:
    """Files of one name pattern as an append stream; the time column becomes a zoned timestamp for watermarks."""
    rows = spark.readStream.schema(schema).option("pathGlobFilter", file_name).option("maxFilesPerTrigger", files_a_batch).parquet(directory)
    return rows.withColumn(ts, F.col(ts).cast("timestamp")) if ts else rows


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run what is there through an exactly-once file sink."""
    stream.writeStream.format("parquet").outputMode("append").option("path", path) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest_result(stream: DataFrame, path: str, checkpoint: str, finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run a complete-mode aggregate; each micro-batch replaces the result of its own number, the newest one is read."""
    def keep(batch: DataFrame, number: int) -> None:
        out = finish(batch) if finish else batch
        out.write.mode("overwrite").parquet(f"{path}/batch={number}")
    stream.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start().awaitTermination()
    every = stream.sparkSession.read.parquet(path)
    return every.where(F.col("batch") == every.agg(F.max("batch")).scalar()).drop("batch")


def write_changes(stream: DataFrame, path: str, checkpoint: str) -> dict[str, int]:
    """Run an update-mode stream: each micro-batch writes only the rows that changed in it, under its own number, so a batch
    that is run again replaces itself. Returns the rows dropped as too late and the rows of state left, by the stream's own count."""
    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    query = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    steps = [[o for o in p["stateOperators"]] for p in query.recentProgress]
    return {"late": sum(o["numRowsDroppedByWatermark"] for ops in steps for o in ops), "state": sum(o["numRowsTotal"] for o in steps[-1]) if steps else 0}


def merged_changes(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """The newest row of each key among the changes of all batches, one shuffle by key."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    rest = [c for c in schema.names if c not in keys]
    newest = F.max_by(F.struct(*rest), "batch").alias("_newest")
    return rows.groupBy(*keys).agg(newest).select(*[c if c in keys else F.col(f"_newest.{c}").alias(c) for c in schema.names])


def changed_result(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """write_changes, then the merged result; a restart without new data reads what is there."""
    write_changes(stream, path, checkpoint)
    return merged_changes(stream.sparkSession, path, keys, stream.schema)


def stream_score(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> None:
    """Score unit records as they come."""
    append_stream(transform(stream), path, checkpoint)


def stream_log_predictions(stream: DataFrame, inputs: Sequence[str], outputs: Sequence[str], role: str, path: str,
                           checkpoint: str, version: int | None = None, last_version: int = 1) -> None:
    """Append (input, output, role, version) records; the version defaults to the last one deployed."""
    if role not in ROLES:
        raise ValueError(f"role must be one of {ROLES}")
    rows = stream.select(F.struct(*inputs).alias("input"), F.struct(*outputs).alias("output"), F.lit(role).alias("role"),
                         F.lit(last_version if version is None else version).alias("version"))
    append_stream(rows, path, checkpoint)


def usage_windows(rows: DataFrame, ts: str, role: str, size: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Predictions per role and tumbling window."""
    return rows.withWatermark(ts, delay).groupBy(F.window(ts, size).alias("w"), role).agg(F.count(F.lit(1)).alias("n")) \
        .select(F.col("w.start").alias("window_start"), role, "n")


def drift_windows(rows: DataFrame, ts: str, value: str, edges: Sequence[float], size: str, slide: str, delay: str = "1 day") -> DataFrame:
    """Counts per sliding window and bin of a fixed reference."""
    cut = F.array(*[F.lit(float(e)) for e in edges])
    return rows.withWatermark(ts, delay).groupBy(F.window(ts, size, slide).alias("w"), bin_number(F.col(value), cut).alias("bin")) \
        .agg(F.count(F.lit(1)).alias("c")).select(F.col("w.start").alias("window_start"), "bin", "c")


def window_psi(counts: DataFrame, shares: Sequence[float]) -> DataFrame:
    """PSI per window against the reference shares, empty bins included."""
    wide = counts.groupBy("window_start").agg(F.sum("c").alias("total"), *[
        F.sum(F.when(F.col("bin") == i, F.col("c")).otherwise(0)).alias(f"c{i}") for i in range(len(shares))])
    terms = [psi_of(F.lit(float(s)), F.col(f"c{i}"), F.lit(1.0), F.col("total")) for i, s in enumerate(shares)]
    return wide.select("window_start", sum(terms[1:], terms[0]).alias("psi"))


def latest_values(rows: DataFrame, resource: str, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """Newest value per (resource, key)."""
    return rows.groupBy(resource, key).agg(F.max(F.struct(*order, F.col(value).alias("_v"))).alias("m")) \
        .select(resource, key, F.col("m._v").alias("value"))


def resource_status(latest: DataFrame, resource: str, key: str, success: Sequence[tuple[str, str]],
                    failure: Sequence[tuple[str, str]]) -> DataFrame:
    """failed if any failure check holds, done if all success checks hold, else running."""
    if len({k for k, _ in success}) != len(success):
        raise ValueError("success checks need distinct keys")

    def holds(k: str, v: str) -> Column:
        return F.coalesce(F.bool_or((F.col(key) == k) & (F.col("value") == v)), F.lit(False))
    failed, done = F.lit(False), F.lit(True)
    for k, v in failure:
        failed = failed | holds(k, v)
    for k, v in success:
        done = done & holds(k, v)
    return latest.groupBy(resource).agg(F.when(failed, "failed").when(done, "done").otherwise("running").alias("status"))


def status_of(latest: dict[str, str], success: Sequence[tuple[str, str]], failure: Sequence[tuple[str, str]]) -> str:
    if any(latest.get(k) == v for k, v in failure):
        return "failed"
    return "done" if all(latest.get(k) == v for k, v in success) else "running"


def status_changes(rows: DataFrame, resource: str, key: str, value: str, ts: str, order: str, success: Sequence[tuple[str, str]],
                   failure: Sequence[tuple[str, str]], delay: str = "1 day", idle: str = "60 days") -> DataFrame:
    """(resource, status, since) whenever a resource's status changes, from a state kept per resource.

    The state holds the newest (time, order, value) of each key. A resource without records for the idle time gets the status
    `expired`, and its state is freed by an event-time timer. Before the shuffle every task keeps only the newest record of
    each (resource, key) of a batch, so a resource with a large share of the records sends few of them.
    """
    if len({k for k, _ in success}) != len(success):
        raise ValueError("success checks need distinct keys")
    kind = rows.schema[resource].dataType.simpleString()
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)

    def newest(batches):
        for b in batches:
            yield b.sort_values([ts, order]).groupby([resource, key], dropna=False).tail(1)

    def follow(group, batches, state: GroupState):
        if state.hasTimedOut:
            at = state.getCurrentWatermarkMs()
            state.remove()
            yield pd.DataFrame({resource: [group[0]], "status": ["expired"], "since": [pd.Timestamp(at, unit="ms", tz="UTC").tz_localize(None)]})
            return
        before, known = None, {}
        if state.exists:
            keys, times, orders, values, before = state.get
            known = {k: (t, o, v) for k, t, o, v in zip(keys, times, orders, values)}
        for b in batches:
            for k, t, o, v in zip(b[key], b[ts], b[order], b[value]):
                entry = (int(t.value // 1000), int(o), v)
                if k not in known or entry[:2] >= known[k][:2]:
                    known[k] = entry
        status, last = status_of({k: v for k, (_, _, v) in known.items()}, success, failure), max(t for t, _, _ in known.values())
        state.update(([*known], [t for t, _, _ in known.values()], [o for _, o, _ in known.values()], [v for _, _, v in known.values()], status))
        state.setTimeoutTimestamp(max(last // 1000 + idle_ms, state.getCurrentWatermarkMs() + 1))
        if status != before:
            yield pd.DataFrame({resource: [group[0]], "status": [status], "since": [pd.Timestamp(last, unit="us")]})

    slim = rows.select(resource, key, value, ts, F.col(order).cast("long").alias(order))
    return slim.mapInPandas(newest, slim.schema).withWatermark(ts, delay).groupBy(resource).applyInPandasWithState(
        follow, f"{resource} {kind}, status string, since timestamp",
        "keys array<string>, times array<long>, orders array<long>, vals array<string>, status string", "update", GroupStateTimeout.EventTimeTimeout)


def drop_late_duplicates(stream: DataFrame, ts: str, keys: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """First record of each key; later copies within the delay are dropped, and the state expires with the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def fresh_paths(spark: SparkSession, label: str) -> tuple[str, str]:
    base = scratch_path(spark, label)
    return f"{base}/out", f"{base}/state"
