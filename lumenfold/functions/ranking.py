"""Running totals and exact percentiles over a global order, without a single-task sort.

Rows are first collapsed to distinct scores, then cut into quantile buckets. Only the bucket totals (a few
thousand rows) go through a window of their own; inside a bucket a partitioned window finishes the sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def bucket_count(spark: SparkSession) -> int:
    """Buckets grow with the cluster: four per shuffle partition, 16 to 10,000."""
    return max(16, min(10_000, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _bucketed(df: DataFrame, score: Column, measures: dict[str, Column], groups: Sequence[str]) -> DataFrame:
    """(groups, score, measures, bucket): one row per distinct score, bucket increasing with score."""
    n = bucket_count(df.sparkSession)
    rows = df.select(*groups, score.cast("double").alias("score"),
                     *[c.alias(m) for m, c in measures.items()]).where(F.col("score").isNotNull())
    sketch = F.percentile_approx("score", [i / n for i in range(1, n)], 4 * n)
    cuts = rows.select("score").agg(sketch).first()[0] or [0.0]
    splits = [-math.inf, *sorted({c for c in cuts if math.isfinite(c)} or {0.0}), math.inf]
    distinct = rows.groupBy(*groups, "score").agg(*[F.sum(m).alias(m) for m in measures])
    return Bucketizer(inputCol="score", outputCol="bucket", splits=splits, handleInvalid="keep").transform(distinct)


def _offsets(rows: DataFrame, measures: Sequence[str], groups: Sequence[str]) -> DataFrame:
    """Per (groups, bucket): totals of the buckets before it, of itself, and of the whole group."""
    part = list(groups) or [F.lit(0)]
    whole = Window.partitionBy(*part)
    before = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*groups, "bucket").agg(*[F.sum(m).alias(f"{m}_own") for m in measures])
    columns = []
    for m in measures:
        columns += [F.coalesce(F.sum(f"{m}_own").over(before), F.lit(0)).alias(f"{m}_before"),
                    F.sum(f"{m}_own").over(whole).alias(f"{m}_total"), F.col(f"{m}_own")]
    return totals.select(*groups, "bucket", *columns)


def prefix_sums(df: DataFrame, score: Column, measures: dict[str, Column], groups: Sequence[str] = ()) -> DataFrame:
    """One row per (groups, distinct score) with, for each measure m: m, m_below (smaller scores), m_total."""
    names, groups = list(measures), list(groups)
    rows = _bucketed(df, score, measures, groups)
    joined = rows.join(_offsets(rows, names, groups), [*groups, "bucket"])
    inside = Window.partitionBy(*groups, "bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = [(F.col(f"{m}_before") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"{m}_below") for m in names]
    return joined.select(*groups, "score", *names, *below, *[f"{m}_total" for m in names])


def exact_percentiles(df: DataFrame, value: Column, probs: Sequence[float], groups: Sequence[str] = (),
                      name: str = "q") -> DataFrame:
    """Exact interpolated percentiles per group as columns name_0, name_1, ...

    Only buckets that hold a wanted position are sorted; the rest is dropped before the window.
    """
    groups = list(groups)
    rows = _bucketed(df, value, {"n": F.lit(1)}, groups)
    wanted = [p * (F.col("n_total") - 1) for p in probs]
    bounds = [f(w) for w in wanted for f in (F.floor, F.ceil)]
    holds = F.lit(False)
    for b in bounds:
        holds = holds | ((b >= F.col("n_before")) & (b < F.col("n_before") + F.col("n_own")))
    joined = rows.join(_offsets(rows, ["n"], groups).where(holds), [*groups, "bucket"])
    inside = Window.partitionBy(*groups, "bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    placed = joined.withColumn("n_below", F.col("n_before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("n_below") <= position) & (position < F.col("n_below") + F.col("n")), F.col("score")))

    picks = []
    for i, w in enumerate(wanted):
        picks += [at(F.floor(w)).alias(f"lo_{i}"), at(F.ceil(w)).alias(f"hi_{i}"), F.max(w - F.floor(w)).alias(f"f_{i}")]
    found = placed.groupBy(*groups).agg(*picks)
    return found.select(*groups, *[(F.col(f"lo_{i}") + F.col(f"f_{i}") * (F.col(f"hi_{i}") - F.col(f"lo_{i}")))
                                   .alias(f"{name}_{i}") for i in range(len(probs))])


def weighted_median(df: DataFrame, value: Column, weight: Column, groups: Sequence[str] = (),
                    name: str = "median") -> DataFrame:
    """Per group: midpoint of the values where the running weight reaches and passes half; the usual median at weight 1."""
    ranked = prefix_sums(df, value, {"w": weight}, groups)
    upto, half = F.col("w_below") + F.col("w"), F.col("w_total") / 2
    return ranked.groupBy(*groups).agg(
        ((F.min(F.when(upto >= half, F.col("score"))) + F.min(F.when(upto > half, F.col("score")))) / 2).alias(name))
