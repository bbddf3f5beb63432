"""Confidence of fitted models from out-of-fold scores: residual percentiles, and conformal p-values by class."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from lumenfold.functions.ranking import exact_percentiles, prefix_sums

# The percentiles reported around a regression prediction.
QUANTILES = [1, 5, 10, 25, 50, 75, 95, 99]
#: Steps to which the calibration scores of a class are kept; all of them count, and a p-value is at most one step too large.
GRID = 1000


@dataclass
class ClassScores:
    """Calibration scores of a class: ascending cuts, the number of scores at or above each, their number, and whether every score is a cut."""

    cuts: list[float]
    at_least: list[int]
    n: int
    whole: bool = True


@dataclass
class Calibration:
    """What a model keeps of its out-of-fold table: residual percentiles (regression) or scores by class."""

    shifts: list[float] | None = None
    classes: dict[str, ClassScores] | None = None


def calibrate_regression(oof: DataFrame, target: str, prediction: str = "prediction") -> Calibration:
    row = exact_percentiles(oof, F.col(target) - F.col(prediction), [q / 100 for q in QUANTILES]).first()
    return Calibration(shifts=[float(x or 0.0) for x in row or [0.0] * len(QUANTILES)])


def calibrate_classes(oof: DataFrame, target: str, probs: dict[str, str], grid: int = GRID) -> Calibration:
    """Oddness (1 - probability of the true class) of the rows of each class, ranked among rows of the same class."""
    p_true = F.coalesce(*[F.when(F.col(target).cast("string") == c, F.col(f"`{p}`")) for c, p in probs.items()])
    rows = oof.select(F.col(target).cast("string").alias("class"), (1 - p_true).alias("s")).where("s is not null")
    ranked = prefix_sums(rows, F.col("s"), {"n": F.lit(1)}, ["class"])
    step = F.floor(F.col("n_below") * grid / F.col("n_total"))
    # the first score of each step stands for the step: at most grid rows a class
    kept = ranked.groupBy("class", step.alias("step")).agg(F.min("score").alias("cut"), F.min("n_below").alias("below"), F.max("n_total").alias("n"),
                                                                F.count(F.lit(1)).alias("scores"))
    out = {c: ClassScores([], [], 0) for c in probs}
    for r in kept.orderBy("class", "cut").collect():
        own = out[r["class"]]
        own.cuts.append(float(r["cut"]))
        own.at_least.append(int(r["n"] - r["below"]))
        own.n, own.whole = int(r["n"]), own.whole and r["scores"] == 1
    return Calibration(classes=out)


def with_quantiles(scored: DataFrame, calibration: Calibration, target: str, prediction: str = "prediction") -> DataFrame:
    """Add <target>_quantile=q: the prediction plus the q-th percentile of the out-of-fold residuals."""
    return scored.withColumns({f"{target}_quantile={q}": F.col(prediction) + F.lit(s) for q, s in zip(QUANTILES, calibration.shifts)})


def p_values(scored: DataFrame, calibration: Calibration, probs: dict[str, str]) -> DataFrame:
    """Add _pv: for each class the share of its calibration rows at least as odd as the row would be with that class.

    The scores of a class are looked up by binary search in its cuts; no row moves.
    """
    out, values = scored, []
    for i, (c, p) in enumerate(probs.items()):
        own = calibration.classes[c]
        splits = [-math.inf, *own.cuts, math.inf]
        out = out.withColumn(f"_odd{i}", 1 - F.col(f"`{p}`"))
        if len(splits) < 3:
            out = out.withColumn(f"_at{i}", F.lit(0.0))
        else:
            out = Bucketizer(inputCol=f"_odd{i}", outputCol=f"_at{i}", splits=splits, handleInvalid="keep").transform(out)
        counts = F.array(*[F.lit(n) for n in (own.n, *own.at_least, 0)])
        at = F.col(f"_at{i}").cast("int")
        if own.whole and own.cuts:  # between two scores, the lower one is less odd than the row
            at = at + (F.col(f"_odd{i}") > F.get(F.array(*[F.lit(x) for x in splits[:-1]]), at)).cast("int")
        values.append((F.coalesce(F.get(counts, at), F.lit(0)) + 1) / (own.n + 1))
    return out.withColumn("_pv", F.array(*values)).drop(*[f"_{k}{i}" for i in range(len(probs)) for k in ("odd", "at")])


def with_confidence(scored: DataFrame, calibration: Calibration, probs: dict[str, str]) -> DataFrame:
    """Add credibility (the largest p-value) and confidence (1 - the second largest)."""
    ranked = F.sort_array("_pv", asc=False)
    return p_values(scored, calibration, probs).withColumns({"confidence": 1 - ranked[1], "credibility": ranked[0]}).drop("_pv")
