"""Writing tables: CSV with local number formats, datasets, write modes, JDBC, snapshots and the export log."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Write modes per kind of target, file extensions, and kinds of predictions.
TABLE_MODES = ("replace", "append")
FILE_MODES = ("timestamp", "safe", "replace")
EXTENSIONS = ("zip", "parquet", "csv")
PREDICTION_KINDS = ("deployment", "experiment")
_SAVE_MODE = {"safe": "errorifexists", "timestamp": "errorifexists", "replace": "overwrite", "append": "append"}


def check_mode(mode: str, is_table: bool) -> None:
    allowed = TABLE_MODES if is_table else FILE_MODES
    if mode not in allowed:
        raise ValueError(f"write mode must be one of {allowed} here")


def target_path(path: str, mode: str, now: datetime | None = None) -> str:
    """The path itself, or with one time suffix taken on the driver."""
    check_mode(mode, is_table=False)
    if mode != "timestamp":
        return path
    return f"{path.rstrip('/')}_{(now or datetime.now(timezone.utc)).strftime('%Y%m%dT%H%M%S%f')}"


def localised(df: DataFrame, decimal: str = ".", thousands: str = "", digits: int = 6) -> DataFrame:
    """Real columns as text with the given decimal mark and grouping mark."""
    if decimal == "." and thousands == "":
        return df
    reals = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType))]
    out = {}
    for c in reals:
        text = F.format_number(F.col(c), digits)
        text = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
        out[c] = F.replace(F.replace(F.replace(text, F.lit(","), F.lit("\u0000")), F.lit("."), F.lit(decimal)),
                           F.lit("\u0000"), F.lit(thousands))
    return df.withColumns(out)


def write_csv(df: DataFrame, path: str, mode: str = "safe", encoding: str = "UTF-8", separator: str = ",",
              decimal: str = ".", thousands: str = "", compression: str = "none") -> str:
    target = target_path(path, mode)
    localised(df, decimal, thousands).write.mode(_SAVE_MODE[mode]).options(
        header=True, sep=separator, encoding=encoding, compression=compression).csv(target)
    return target


def write_dataset(df: DataFrame, path: str, extension: str = "parquet", mode: str = "safe") -> str:
    """parquet, csv, or zip (compressed CSV parts, so that many tasks can write)."""
    if extension not in EXTENSIONS:
        raise ValueError(f"extension must be one of {EXTENSIONS}")
    if extension == "parquet":
        target = target_path(path, mode)
        df.write.mode(_SAVE_MODE[mode]).parquet(target)
        return target
    return write_csv(df, path, mode, compression="gzip" if extension == "zip" else "none")


def export_prediction(df: DataFrame, path: str, kind: str, extension: str = "parquet", mode: str = "safe") -> str:
    if kind not in PREDICTION_KINDS:
        raise ValueError(f"kind must be one of {PREDICTION_KINDS}")
    return write_dataset(df.withColumn("prediction_type", F.lit(kind)), path, extension, mode)


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append", driver: str | None = None,
               options: dict | None = None) -> None:
    check_mode(mode, is_table=True)
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    (writer.option("driver", driver) if driver else writer).mode(_SAVE_MODE[mode]).save()


def write_snapshot(df: DataFrame, path: str, at: datetime) -> None:
    """Keep df as the state at a time; writing the same time again replaces only that state."""
    df.withColumn("snapshot_ts", F.lit(at)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("snapshot_ts").parquet(path)


LOG_SCHEMA = "exporter string, target string, n_rows bigint, status string, finished_at timestamp"


def export_log(spark: SparkSession, log_path: str, exporter: str, target: str, n_rows: int, status: str = "done") -> None:
    if status not in ("done", "failed", "running", "pending"):
        raise ValueError("unknown status")
    row = [(exporter, target, n_rows, status, datetime.now(timezone.utc).replace(tzinfo=None))]
    spark.createDataFrame(row, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log_path)


def list_exports(spark: SparkSession, log_path: str, exporter: str | None = None) -> DataFrame:
    rows = spark.read.schema(LOG_SCHEMA).parquet(log_path)
    return rows if exporter is None else rows.where(F.col("exporter") == exporter)
