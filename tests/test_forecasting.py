"""The time series experiment on series with a weekly shape."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.operators import forecasting as X
from lumenfold.operators.timeseries import TimeWindow

SPEC = X.SeriesSpec(("g",), "step", "v", TimeWindow(-10, -4, 1, 3), ("promo",))


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(2)
    rows = [(g, s, float(50 + 10 * g + 20 * ((s + 3) % 7 in (1, 2)) + 8 * (s % 5 == 0) + rng.normal(0, 2)), float(s % 5 == 0))
            for g in range(4) for s in range(100 + 9 * g) if rng.random() > 0.03]
    return spark.createDataFrame(rows, "g int, step int, v double, promo double").cache()


def test_folds_see_nothing_of_their_future(series):
    rows = X.supervised(series, SPEC)
    ends = {r["g"]: r["last"] for r in series.groupBy("g").agg(F.max("step").alias("last")).collect()}
    for back in (3, 6):
        learned, judged = X.before(rows, SPEC, back).collect(), X.within(rows, SPEC, back, 3).collect()
        assert learned and judged
        assert all(r["step"] + r["horizon"] <= ends[r["g"]] - back for r in learned)
        assert all(r["step"] <= ends[r["g"]] - back < r["step"] + r["horizon"] <= ends[r["g"]] - back + 3 for r in judged)
        assert not {r["row_id"] for r in learned} & {r["row_id"] for r in judged}
    truth = {(r["g"], r["step"]): r["v"] for r in series.collect()}
    for r in rows.limit(500).collect():
        past = [truth[r["g"], s] for s in range(r["step"] - 10, r["step"] - 3) if (r["g"], s) in truth]
        assert r["label"] == truth[r["g"], r["step"] + r["horizon"]] and r["v_count"] == len(past)
        assert abs(r["v_mean"] - (np.mean(past) if past else 0)) < 1e-9 and r["promo_ahead"] == float((r["step"] + r["horizon"]) % 5 == 0)


def test_leaderboard_beats_the_naive_forecast(series):
    board, models, tail = X.fit_forecasts(series, SPEC, ("LR", "DT"), folds=2)
    rows = {r["name"]: r for r in board.collect()}
    assert set(rows) == {"naive", "LR", "DT"} == set(models)
    best = [r for r in rows.values() if r["tags"]]
    assert len(best) == 1 and best[0]["fold_score"] == min(r["fold_score"] for r in rows.values())
    assert best[0]["tail_score"] < 0.8 * rows["naive"]["tail_score"]
    assert tail.columns == ["g", "step", "horizon", "label", "naive", "prediction"] and tail.where("prediction is null").count() == 0


def test_forecasts_of_new_series(spark, series):
    _, models, _ = X.fit_forecasts(series.where("g < 3"), SPEC, ("LR",), folds=1)
    new = series.where("g = 3 and step < 80").union(spark.createDataFrame([(9, 5, 7.0, 0.0)], series.schema))
    future = spark.range(80, 90).selectExpr("3 as g", "cast(id as int) as step", "cast(id % 5 = 0 as double) as promo")
    got = models["LR"].forecast(new, future).orderBy("g", "horizon").collect()
    ends = {r["g"]: r["last"] for r in new.groupBy("g").agg(F.max("step").alias("last")).collect()}
    assert [(r["g"], r["step"], r["horizon"]) for r in got] == [(g, ends[g], h) for g in (3, 9) for h in (1, 2, 3)]
    assert all(r["prediction"] is not None for r in got)
    assert [r["prediction"] for r in models["naive"].forecast(new).where("g = 9").collect()] == [models["naive"].mean] * 3


def test_a_single_series_without_groups(series):
    one = series.where("g = 0").drop("g")
    spec = X.SeriesSpec((), "step", "v", SPEC.window)
    board, models, tail = X.fit_forecasts(one, spec, ("LR",), folds=1)
    assert board.count() == 2 and models["LR"].forecast(one).count() == 3 and tail.count() == 6
