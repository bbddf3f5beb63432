"""A time series experiment: rolling-origin folds, a held-out tail of every series, a leaderboard, and forecasts of new series.

Everything a row knows is known at its origin t: the derivation window before t, the horizon h, the target's weekday and the
a-priori columns as of t + h. The tail of a series is its last `tail` steps; a row belongs to the tail, or to a fold's
validation, if t + h lies in it and t before it, and to the training rows if t + h lies before it. Rows whose origin and
target straddle a bound belong to neither, so no target is seen early.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from lumenfold.functions.skew import lookup_join
from lumenfold.operators.metrics import ASCENDING, regression_metrics
from lumenfold.operators.roles import ColumnRoles
from lumenfold.operators.timeseries import TimeWindow, derivation_aggs, forecast_targets, seasonal_naive
from lumenfold.operators.train import FittedModel, fit_model
from lumenfold.session import cut_lineage

BOARD = "name string, code string, metric string, fold_score double, tail_score double, fit_seconds double, tags array<string>"
ROLES = ColumnRoles(target="label", id="row_id")
NAIVE = "naive"


@dataclass(frozen=True)
class SeriesSpec:
    """Which columns of a table with one row per series and step mean what."""

    groups: Sequence[str]
    step: str
    target: str
    window: TimeWindow
    apriori: Sequence[str] = field(default_factory=tuple)

    @property
    def past(self) -> list[str]:
        return [f"{self.target}_{a}" for a in ("mean", "min", "max", "std", "count")] + [NAIVE]

    @property
    def inputs(self) -> list[str]:
        return [*self.past, "horizon", "weekday", *[f"{c}_ahead" for c in self.apriori]]


def _known(series: DataFrame, spec: SeriesSpec) -> DataFrame:
    past = derivation_aggs(series, spec.groups, spec.step, [spec.target], spec.window)
    return seasonal_naive(past, spec.groups, spec.step, spec.target, spec.window)


def _ready(rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Inputs without gaps, each with an indicator beside it, and a key for every row."""
    rows = rows.withColumn("weekday", F.pmod(F.col(spec.step) + F.col("horizon"), F.lit(7)).cast("double"))
    gaps = {f"no_{c}": F.col(c).isNull().cast("double") for c in spec.past}
    key = F.concat_ws("|", *[F.col(g).cast("string") for g in spec.groups], F.col(spec.step).cast("string"), F.col("horizon").cast("string"))
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in spec.inputs}
    return rows.withColumns(gaps).withColumns(filled).withColumn("row_id", key)


def supervised(series: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row for each (series, t, h) with a label, its inputs and the last step of its series (last)."""
    rows = forecast_targets(_known(series, spec), spec.groups, spec.step, spec.target, spec.window, spec.apriori, keep=spec.past)
    last = series.groupBy(*spec.groups).agg(F.max(spec.step).alias("last"))
    rows = _ready(rows.where(F.col("label").isNotNull()), spec)
    return lookup_join(rows, last, list(spec.groups)) if spec.groups else rows.withColumn("last", last.scalar())


def before(rows: DataFrame, spec: SeriesSpec, back: int) -> DataFrame:
    """Rows whose target lies before the bound `back` steps from the end of the series."""
    return rows.where(F.col(spec.step) + F.col("horizon") <= F.col("last") - back)


def within(rows: DataFrame, spec: SeriesSpec, back: int, tail: int) -> DataFrame:
    """Rows with an origin before that bound and a target among the tail steps behind it."""
    at = F.col(spec.step) + F.col("horizon") - (F.col("last") - back)
    return rows.where((F.col(spec.step) <= F.col("last") - back) & (at > 0) & (at <= tail))


@dataclass
class ForecastModel:
    """A fitted learner with the columns it needs, or the naive forecast, which takes the mean label where no value is known."""

    name: str
    spec: SeriesSpec
    model: FittedModel | None
    mean: float = 0.0

    def score(self, rows: DataFrame) -> DataFrame:
        keep = [*self.spec.groups, self.spec.step, "horizon", *(["label"] if "label" in rows.columns else []), NAIVE]
        if self.model is None:
            return rows.select(*keep, F.when(F.col(f"no_{NAIVE}") == 0, F.col(NAIVE)).otherwise(F.lit(self.mean)).alias("prediction"))
        return self.model.transform(rows).select(*keep, "prediction")

    def forecast(self, series: DataFrame, future: DataFrame | None = None) -> DataFrame:
        """(groups, step, horizon, naive, prediction): one row for each horizon from the last step of every series.

        future gives the a-priori columns of steps to come; what it lacks counts as 0.
        """
        spec = self.spec
        last = series.groupBy(*spec.groups).agg(F.max(spec.step).alias("last"))
        known = _known(series, spec)
        known = known.join(last, list(spec.groups)) if spec.groups else known.withColumn("last", last.scalar())
        horizons = F.sequence(F.lit(spec.window.forecast_start), F.lit(spec.window.forecast_end))
        rows = known.where(F.col(spec.step) == F.col("last")).select(*spec.groups, spec.step, *spec.past, F.explode(horizons).alias("horizon"))
        if spec.apriori and future is not None:
            ahead = future.select(*spec.groups, F.col(spec.step).alias("_to"), *[F.col(c).alias(f"{c}_ahead") for c in spec.apriori])
            rows = rows.withColumn("_to", F.col(spec.step) + F.col("horizon")).join(ahead, [*spec.groups, "_to"], "left").drop("_to")
        else:
            rows = rows.withColumns({f"{c}_ahead": F.lit(None).cast("double") for c in spec.apriori})
        return self.score(_ready(rows, spec))


def fit_forecasts(series: DataFrame, spec: SeriesSpec, codes: Sequence[str] = ("LR", "XGB"), folds: int = 3, tail: int | None = None,
                  metric: str = "rmse") -> tuple[DataFrame, dict[str, ForecastModel], DataFrame]:
    """(leaderboard, models, tail predictions of the best model).

    A model is judged on the folds, each a tail further back than the one before and learned from what lies before it; the
    best by its mean score over the folds is tagged. The tail has no part in any choice. The naive forecast is on the board too.
    """
    tail = tail or spec.window.forecast_end
    rows = cut_lineage(supervised(series, spec))
    inputs = ["row_id", "label", *spec.inputs, *[f"no_{c}" for c in spec.past]]

    def learn(code: str, part: DataFrame) -> ForecastModel:
        if code == NAIVE:
            return ForecastModel(code, spec, None, float(part.agg(F.avg("label")).first()[0] or 0.0))
        return ForecastModel(code, spec, fit_model(part.select(*inputs), ROLES, "regression", code, ()))

    def judge(model: ForecastModel, part: DataFrame) -> float | None:
        value = regression_metrics(model.score(part), "label", "prediction", names=[metric]).first()[0]
        return None if value is None else float(value)

    board, models = [], {}
    for code in [NAIVE, *codes]:
        scores = [judge(learn(code, before(rows, spec, k * tail)), within(rows, spec, k * tail, tail)) for k in range(folds + 1, 1, -1)]
        known = [s for s in scores if s is not None]
        start = time.time()
        models[code] = learn(code, before(rows, spec, tail))
        seconds = time.time() - start
        board.append((code, code, metric, sum(known) / len(known) if known else None, judge(models[code], within(rows, spec, tail, tail)), seconds))
    sign = 1 if metric in ASCENDING else -1
    best = min((r for r in board if r[3] is not None), key=lambda r: (sign * r[3], r[0]), default=board[0])[0]
    lines = [(*r, ["best"] if r[0] == best else []) for r in board]
    return series.sparkSession.createDataFrame(lines, BOARD), models, models[best].score(within(rows, spec, tail, tail))
