"""Joins the modelling workflows need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenfold.functions.skew import lookup_join
from lumenfold.session import cut_lineage


def join_holdout(predictions: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """Predictions with their truth; rows without a partner drop out."""
    return predictions.join(truth, key)


def row_numbers(df: DataFrame, name: str = "row") -> DataFrame:
    """Rows numbered densely in file order (files by path), so that two tables with aligned rows can be joined.

    Where a row stands comes from the files themselves and not from the scan's partitions, which pack files by size: Parquet
    gives each row its index within the file; of other formats, the rows of a block are counted on from the block's start.
    Only the row counts of files or blocks go through a window. A frame that is no file scan has no positions and is refused.
    """
    try:
        located = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
        located.schema
    except AnalysisException:
        raise ValueError("rows have a position only in a frame that is read from files") from None
    try:
        rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
        rows.schema
        where, sizes = ["_file"], rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    except AnalysisException:
        rows = cut_lineage(located.withColumn("_id", F.monotonically_increasing_id()))
        where, sizes = ["_file", "_block"], rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy(F.lit(0)).orderBy(*where).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    placed = lookup_join(rows, starts, where)
    at = F.col("_at") if "_at" in rows.columns else F.col("_id") - F.col("_first")
    return placed.withColumn(name, F.col("_start") + at).select(*df.columns, name)


def join_logged(inputs: DataFrame, outputs: DataFrame, key: str | None = None) -> DataFrame:
    """Logged inputs next to logged outputs, by key, or by position when there is no key."""
    if key is not None:
        return inputs.join(outputs, key)
    return row_numbers(inputs, "row").join(row_numbers(outputs, "row"), "row")


def join_images(rows: DataFrame, images: DataFrame, filename: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their image or NULLs, rows whose image is missing)."""
    return rows.join(images, filename, "left"), rows.join(images.select(filename), filename, "left_anti")


def compare_main_challenger(main: DataFrame, challenger: DataFrame, key: str, value: str) -> DataFrame:
    """Both predictions per row, also when only one side has the row, and their difference."""
    both = main.select(key, F.col(value).alias("main")).join(
        challenger.select(key, F.col(value).alias("challenger")), key, "full_outer")
    return both.withColumn("delta", F.col("challenger") - F.col("main"))


def truth_semi_anti(queries: DataFrame, items: DataFrame, true_id: str, item_id: str) -> tuple[DataFrame, DataFrame]:
    """(queries whose true item is in the catalogue, queries whose true item is not)."""
    ids = items.select(F.col(item_id).alias(true_id)).distinct()
    return queries.join(ids, true_id, "left_semi"), queries.join(ids, true_id, "left_anti")


def apply_encoding(df: DataFrame, mapping: DataFrame, key: str, value: str, default) -> DataFrame:
    """Look value up by key (the mapping is unique on key); unseen keys get the default."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return lookup_join(df, mapping.select(key, value), [key]).withColumn(value, F.coalesce(value, fallback))


def derivation_range_join(series: DataFrame, groups: Sequence[str], step: str, value: str, start: int,
                          end: int) -> DataFrame:
    """Pairs of a row at t and a row of the same series at t' with t + start <= t' <= t + end.

    The window is a fixed number of integer steps, so the range turns into equality on (groups, step): each row
    asks for its own steps and a long series spreads over many tasks.
    """
    asked = series.select(*groups, F.col(step).alias("t"),
                          F.explode(F.sequence(F.lit(start), F.lit(end))).alias("offset")) \
        .withColumn(step, F.col("t") + F.col("offset"))
    return asked.join(series.select(*groups, step, value), [*groups, step]) \
        .select(*groups, "t", "offset", F.col(value).alias(f"{value}_past"))
