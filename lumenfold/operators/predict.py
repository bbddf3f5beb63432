"""Scoring, confidence, explanation, and the comparison of deployed models."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from lumenfold.functions.ranking import exact_percentiles, prefix_sums
from lumenfold.functions.skew import hot_key_join
from lumenfold.operators import trees as TR
from lumenfold.operators.confidence import QUANTILES
from lumenfold.operators.joins import compare_main_challenger
from lumenfold.operators.metrics import DEFAULT_METRIC, problem_metrics, regression_metrics, top_class
from lumenfold.operators.registry import collect_predictions
from lumenfold.operators.roles import contract_report

# The explainable problems.
EXPLAINABLE = ["regression", "classification", "multiclassification"]


def predict(model, df: DataFrame, confidence: bool = False) -> DataFrame:
    """One output row per input row; with confidence also the quantiles, or confidence and credibility, of a calibrated model."""
    return model.with_confidence(df) if confidence else model.transform(df)


def confidence_regression(scored: DataFrame, residuals: DataFrame, prediction: str, residual: str, target: str) -> DataFrame:
    """Add <target>_quantile=q: the prediction plus the q-th percentile of the out-of-fold residuals."""
    shifts = exact_percentiles(residuals, F.col(residual), [q / 100 for q in QUANTILES])
    packed = shifts.select(F.struct("*")).scalar()
    rows = scored.withColumn("_s", packed)
    return rows.select(*scored.columns, *[(F.col(prediction) + F.col(f"_s.q_{i}")).alias(f"{target}_quantile={q}")
                                          for i, q in enumerate(QUANTILES)])


def confidence_classification(scored: DataFrame, calibration: DataFrame, row_id: str, truth: str,
                              probs: dict[str, str]) -> DataFrame:
    """(id, confidence, credibility) by conformal p-values.

    A class's p-value is the share of calibration rows at least as odd as the row would be with that class
    (oddness = 1 - probability). Credibility is the largest p-value, confidence 1 - the second largest.
    """
    p_true = F.coalesce(*[F.when(F.col(truth) == c, F.col(p)) for c, p in probs.items()])
    known = calibration.select((1 - p_true).alias("score"), F.lit(1).alias("n"))
    asked = scored.select(row_id, F.explode(F.array(*[1 - F.col(p) for p in probs.values()])).alias("score"))
    ranked = prefix_sums(known.unionByName(asked.select("score", F.lit(0).alias("n"))), F.col("score"), {"n": F.col("n")})
    share = ranked.select("score", ((F.col("n_total") - F.col("n_below") + 1) / (F.col("n_total") + 1)).alias("pv"))
    values = hot_key_join(asked, share, ["score"]).groupBy(row_id) \
        .agg(F.sort_array(F.collect_list("pv"), asc=False).alias("pv"))
    return values.select(row_id, (1 - F.col("pv")[1]).alias("confidence"), F.col("pv")[0].alias("credibility"))


def _explainable(problem: str) -> None:
    if problem not in EXPLAINABLE:
        raise ValueError(f"only {EXPLAINABLE} can be explained")


def explain_linear(df: DataFrame, row_id: str, coefficients: dict[str, float], problem: str = "regression") -> DataFrame:
    """(id, feature, contribution): coefficient times the distance from the mean of the table."""
    _explainable(problem)
    means = df.select(F.struct(*[F.avg(c).alias(c) for c in coefficients])).scalar()
    rows = df.withColumn("_m", means)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), (F.lit(float(w)) * (F.col(c) - F.col(f"_m.{c}"))).alias("contribution"))
                      for c, w in coefficients.items()])
    return rows.select(row_id, F.explode(cells).alias("e")).select(row_id, "e.feature", "e.contribution")


def explanations(model, df: DataFrame, row_id: str) -> DataFrame:
    """(id, output, base, contributions): one array of contributions per row, in the order of the model's features.

    Contributions are exact Shapley values and add up to output - base. Of trees, a feature left open takes either way by the
    share of training rows that went there (path-dependent); of linear models, it takes its mean. The output is the
    prediction of a number, the score before the link function of boosted or linear classes (of the last class), or the mean
    class probability of a forest. Every row is explained where it stands.
    """
    _explainable(model.problem)
    stage, classes = model.stages.stages[-1], len(model.classes)
    encoded = model.encoder.apply(df)
    if isinstance(stage, TR.TreeStage):
        ensemble, rows, x = stage.ensemble, stage.encoded(encoded), TR.inputs_array(stage.inputs)
    elif hasattr(stage, "trees") or hasattr(stage, "depth"):
        ensemble, rows, x = TR.from_spark(stage, classes), model.stages.transform(encoded), vector_to_array("_features")
    elif hasattr(stage, "coefficientMatrix") or hasattr(stage, "coefficients"):
        matrix = hasattr(stage, "coefficientMatrix")
        weights = (stage.coefficientMatrix.toArray()[-1] if matrix else stage.coefficients.toArray()).tolist()
        base = float(stage.interceptVector[-1] if matrix else stage.intercept)
        parts = F.zip_with(vector_to_array("_features"), F.array(*[F.lit(float(w)) for w in weights]), lambda a, w: a * w)
        out = model.stages.transform(encoded).select(row_id, F.lit(base).alias("base"), parts.alias("contributions"))
        total = F.aggregate("contributions", F.lit(0.0), lambda a, v: a + v)
        return out.select(row_id, (total + F.col("base")).alias("output"), "base", "contributions")
    else:
        raise ValueError(f"{model.code} has no exact explanation")
    n, output = (len(stage.inputs) if isinstance(stage, TR.TreeStage) else len(model.encoder.inputs)), len(ensemble.base) - 1
    run, base = TR.shapley(ensemble, n, output)  # small tables of the leaves, sent along with the function

    @F.pandas_udf("struct<output:double,contributions:array<double>>")
    def explained(x: pd.Series) -> pd.DataFrame:
        rows = TR.rows_of(x)
        return pd.DataFrame({"output": ensemble.margins(rows)[:, output], "contributions": list(run(rows))})

    return rows.select(row_id, explained(x).alias("_e")).select(row_id, "_e.output", F.lit(base).alias("base"), "_e.contributions")


def explain(model, df: DataFrame, row_id: str) -> DataFrame:
    """(id, feature, contribution) of any fitted model: exact Shapley values of trees and linear models, else the change of the
    output when a feature moves to its mean."""
    _explainable(model.problem)
    stage = model.stages.stages[-1]
    if not any(hasattr(stage, x) for x in ("ensemble", "trees", "depth", "coefficients", "coefficientMatrix")):
        return neutral_changes(model, df, row_id)
    names = F.array(*[F.lit(c) for c in (stage.inputs if isinstance(stage, TR.TreeStage) else model.encoder.inputs)])
    cells = F.arrays_zip(names.alias("feature"), F.col("contributions").alias("contribution"))
    return explanations(model, df, row_id).select(row_id, F.explode(cells).alias("e")).select(row_id, F.col("e.feature").alias("feature"), F.col("e.contribution").alias("contribution"))


def neutral_changes(model, df: DataFrame, row_id: str) -> DataFrame:
    """(id, feature, contribution) of a model without a closed form: each row is scored once more for every feature, in one pass."""
    encoded, inputs = model.encoder.apply(df), model.encoder.inputs
    value = F.col("prediction") if model.problem == "regression" else F.col(f"pred_{model.classes[-1]}")
    means = encoded.select(F.struct(*[F.avg(c).alias(c) for c in inputs])).scalar()
    wide = encoded.withColumn("_m", means).withColumn("_which", F.explode(F.array(*[F.lit(c) for c in ["", *inputs]])))
    moved = wide.withColumns({c: F.when(F.col("_which") == c, F.col(f"_m.{c}")).otherwise(F.col(c)) for c in inputs})
    scored = model.score_encoded(moved).select(row_id, "_which", value.alias("_v"))
    base = F.max(F.when(F.col("_which") == "", F.col("_v"))).over(Window.partitionBy(row_id))
    return scored.withColumn("contribution", base - F.col("_v")).where(F.col("_which") != "") \
        .select(row_id, F.col("_which").alias("feature"), "contribution")


def score_main_challenger(main: DataFrame, challenger: DataFrame, key: str, value: str, truth: DataFrame | None = None,
                          target: str | None = None, tolerance: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(row comparison, summary): agreement within the tolerance and, with truth, the rmse of both and their difference."""
    both = compare_main_challenger(main, challenger, key, value)
    agree = F.avg((F.abs(F.col("delta")) <= tolerance).cast("double")).alias("agreement")
    counts = both.agg(F.count(F.lit(1)).alias("n"), agree, F.avg("delta").alias("mean_delta"))
    if truth is None:
        return both, counts
    joined = both.join(truth.select(key, target), key)
    long = joined.select(target, F.explode(F.create_map(F.lit("main"), F.col("main"), F.lit("challenger"),
                                                        F.col("challenger"))).alias("role", "p"))
    errors = regression_metrics(long, target, "p", ["role"], names=["rmse"])
    pair = errors.agg(F.max(F.when(F.col("role") == "main", F.col("rmse"))).alias("rmse_main"),
                      F.max(F.when(F.col("role") == "challenger", F.col("rmse"))).alias("rmse_challenger"))
    packed = pair.select(F.struct("*")).scalar()
    return both, counts.withColumn("_p", packed).select("n", "agreement", "mean_delta", "_p.rmse_main", "_p.rmse_challenger",
                                                       (F.col("_p.rmse_challenger") - F.col("_p.rmse_main")).alias("rmse_delta"))


def compare_classifiers(main: DataFrame, challenger: DataFrame, key: str, probs: dict[str, str], truth: DataFrame | None = None, target: str | None = None,
                        metric: str = "log_loss") -> tuple[DataFrame, DataFrame]:
    """(row comparison, summary) of two classifiers: both classes and half the sum of the probabilities' differences per row; share of
    rows with the same class, mean difference and, with truth, the metric of both. Rows of one side only count in the comparison."""
    both = main.select(key, *[F.col(f"`{p}`").alias(f"_m{i}") for i, p in enumerate(probs.values())]).join(
        challenger.select(key, *[F.col(f"`{p}`").alias(f"_c{i}") for i, p in enumerate(probs.values())]), key, "full_outer")
    sides = {side: {c: F.col(f"_{side[0]}{i}") for i, c in enumerate(probs)} for side in ("main", "challenger")}
    gap = sum((F.abs(F.col(f"_m{i}") - F.col(f"_c{i}")) for i in range(len(probs))), F.lit(0.0)) / 2
    rows = both.withColumns({**{side: top_class(columns) for side, columns in sides.items()}, "delta": gap})
    compared = rows.select(key, "main", "challenger", "delta")
    counts = compared.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("main") == F.col("challenger")).cast("double")).alias("agreement"),
                          F.avg("delta").alias("mean_delta"))
    if truth is None:
        return compared, counts
    joined = both.join(truth.select(key, target), key)
    long = joined.select(target, F.explode(F.array(*[F.struct(F.lit(side).alias("role"), *[columns[c].alias(f"p{i}") for i, c in enumerate(probs)])
                                                     for side, columns in sides.items()])).alias("e")).select(target, "e.*")
    scores = problem_metrics(long.where(F.col("p0").isNotNull()), target, {c: f"p{i}" for i, c in enumerate(probs)}, "multiclassification", ["role"], [metric])
    pair = scores.agg(*[F.max(F.when(F.col("role") == side, F.col(metric))).alias(f"{metric}_{side}") for side in sides])
    packed = pair.select(F.struct("*")).scalar()
    return compared, counts.withColumn("_p", packed).select("n", "agreement", "mean_delta", f"_p.{metric}_main", f"_p.{metric}_challenger",
                                                            (F.col(f"_p.{metric}_challenger") - F.col(f"_p.{metric}_main")).alias(f"{metric}_delta"))


def holdout_predictions(models: dict[str, object], holdout: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predictions of every model on the same rows."""
    return collect_predictions({name: m.transform(holdout).select(*keep, "prediction") for name, m in models.items()}, "model")


def prediction_summary(predictions: DataFrame, target: str, prediction: str | dict[str, str], inputs: DataFrame, contract: dict[str, str],
                       seconds: float = 0.0, problem: str = "regression", metric: str | None = None) -> DataFrame:
    """One row: score (by default rmse, auc or log loss), number of predictions, missing input columns, duration."""
    missing = contract_report(inputs, contract).where(~F.col("present")).select(
        F.array_join(F.sort_array(F.collect_list("column_name")), ",")).scalar()
    score = problem_metrics(predictions, target, prediction, problem, names=[metric or DEFAULT_METRIC[problem]]).scalar()
    counted = next(iter(prediction.values())) if isinstance(prediction, dict) else prediction
    return predictions.agg(F.count(F.col(f"`{counted}`")).alias("predictions_count")).select(
        score.alias("score"), "predictions_count", missing.alias("missing_columns"), F.lit(float(seconds)).alias("duration"))
