"""Derivation and forecast windows over series with an integer step.

A long series is cut into chunks of consecutive steps; each row also visits the next chunk if rows there look back
at it. Windows then run per (series, chunk), so neither one long series nor a table without groups ends in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window, functions as F

MIN_CHUNK_STEPS = 256


@dataclass(frozen=True)
class TimeWindow:
    """Steps before now that features may use, and steps ahead to forecast."""

    derivation_start: int
    derivation_end: int
    forecast_start: int
    forecast_end: int

    def __post_init__(self):
        ds, de, fs, fe = self.derivation_start, self.derivation_end, self.forecast_start, self.forecast_end
        if ds >= de or fs >= fe:
            raise ValueError("a window must start before it ends")
        if max(ds, de) > 0:
            raise ValueError("the derivation window lies in the past (bounds <= 0)")
        if min(fs, fe) < 0:
            raise ValueError("the forecast window lies ahead (bounds >= 0)")
        if de > 2 * fs - fe:
            raise ValueError("derivation_end must not exceed 2 * forecast_start - forecast_end")


def day_step(time: str | Column) -> Column:
    """Integer step: days since 1970-01-01."""
    return F.unix_date(F.to_date(F.col(time) if isinstance(time, str) else time))


def build_series(df: DataFrame, groups: Sequence[str], time: str, sums: dict[str, Column]) -> DataFrame:
    """One row per series and day, values summed."""
    return df.groupBy(*groups, day_step(time).alias("step")).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def _with_frames(series: DataFrame, groups: Sequence[str], step: str, span: int, columns) -> DataFrame:
    """Add window columns (built from a Window) that look back at most span steps."""
    width = max(MIN_CHUNK_STEPS, 4 * span)

    def chunk(s: Column) -> Column:
        return F.floor(s / F.lit(width))
    home = chunk(F.col(step))
    spread = series.withColumn("_home", home).withColumn(
        "_chunk", F.explode(F.array_distinct(F.array(home, chunk(F.col(step) + span)))))
    frame = Window.partitionBy(*groups, "_chunk").orderBy(step)
    return spread.withColumns(columns(frame)).where(F.col("_chunk") == F.col("_home")).drop("_home", "_chunk")


def derivation_lags(series: DataFrame, groups: Sequence[str], step: str, values: Sequence[str],
                    window: TimeWindow) -> DataFrame:
    """Value at every step of the derivation window before t, NULL where the series has no such step."""
    back = range(-window.derivation_start, -window.derivation_end - 1, -1)

    def columns(frame):
        return {f"{v}_lag{h}": F.first(v).over(frame.rangeBetween(-h, -h)) for v in values for h in back}
    return _with_frames(series, groups, step, -window.derivation_start, columns)


def derivation_aggs(series: DataFrame, groups: Sequence[str], step: str, values: Sequence[str],
                    window: TimeWindow) -> DataFrame:
    """mean, min, max, std and count over [t + start, t + end]."""
    def columns(frame):
        w = frame.rangeBetween(window.derivation_start, window.derivation_end)
        out = {}
        for v in values:
            out |= {f"{v}_mean": F.avg(v).over(w), f"{v}_min": F.min(v).over(w), f"{v}_max": F.max(v).over(w),
                    f"{v}_std": F.stddev_samp(v).over(w), f"{v}_count": F.count(v).over(w)}
        return out
    return _with_frames(series, groups, step, -window.derivation_start, columns)


def seasonal_naive(series: DataFrame, groups: Sequence[str], step: str, target: str, window: TimeWindow,
                   name: str = "naive") -> DataFrame:
    """Baseline forecast: the last known value inside the derivation window."""
    def columns(frame):
        w = frame.rangeBetween(window.derivation_start, window.derivation_end)
        return {name: F.last(target, ignorenulls=True).over(w)}
    return _with_frames(series, groups, step, -window.derivation_start, columns)


def forecast_targets(series: DataFrame, groups: Sequence[str], step: str, target: str, window: TimeWindow,
                     apriori: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """One row per t and horizon h with the target at t + h, and the a-priori columns as of t + h.

    keep names columns of t to carry along; nothing else from after t enters.
    """
    now = series.select(*groups, F.col(step).alias("_t"), *keep, F.explode(
        F.sequence(F.lit(window.forecast_start), F.lit(window.forecast_end))).alias("horizon")) \
        .withColumn(step, F.col("_t") + F.col("horizon"))
    later = series.select(*groups, step, F.col(target).alias("label"), *[F.col(c).alias(f"{c}_ahead") for c in apriori])
    return now.join(later, [*groups, step]).select(*groups, F.col("_t").alias(step), *keep, "horizon", "label",
                                                   *[f"{c}_ahead" for c in apriori])


def attach_apriori(series: DataFrame, groups: Sequence[str], step: str, target: str, window: TimeWindow,
                   apriori: Sequence[str]) -> DataFrame:
    return forecast_targets(series, groups, step, target, window, apriori)


def fit_timeseries(series: DataFrame, groups: Sequence[str], step: str, target: str, window: TimeWindow,
                   apriori: Sequence[str] = (), learner=None):
    """Regression of the target at t + h on the derivation window, the horizon and the a-priori columns.

    Returns (model, predictions with columns groups, step, horizon, label, naive, prediction): one for every label. An input that is
    missing, as the spread of a single point, counts as 0, with an indicator column beside it.
    """
    past = seasonal_naive(derivation_aggs(series, groups, step, [target], window), groups, step, target, window)
    inputs = [f"{target}_{a}" for a in ("mean", "min", "max", "std", "count")] + ["naive"]
    rows = forecast_targets(past, groups, step, target, window, apriori, keep=inputs)
    features = [*inputs, "horizon", *[f"{c}_ahead" for c in apriori]]
    gaps = {f"_no_{c}": F.col(c).isNull().cast("double") for c in features}
    labelled = rows.where(F.col("label").isNotNull()).withColumns(gaps)
    filled = labelled.withColumns({f"_in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    ready = VectorAssembler(inputCols=[*[f"_in_{c}" for c in features], *gaps], outputCol="features").transform(filled)
    model = (learner or LinearRegression(regParam=1e-3)).fit(ready)
    return model, model.transform(ready).select(*groups, step, "horizon", "label", "naive", "prediction")
