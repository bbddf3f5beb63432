"""Threshold analysis of binary classifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lumenfold.operators.metrics import _binary_rows, confusion_sums, label_formulas, ranked_scores, ratio0


def optimal_threshold(df: DataFrame, y: str, p: str, groups: Sequence[str] = ()) -> DataFrame:
    """Score that maximises F1 when used as threshold (p >= threshold is positive); the highest one on ties."""
    ranked = ranked_scores(df, y, p, groups)
    found = F.col("pos_total") - F.col("pos_below")
    called = found + F.col("neg_total") - F.col("neg_below")
    f1 = 2 * found / (F.col("pos_total") + called)
    order = F.struct(F.round(f1, 12).alias("f1"), F.col("score").alias("threshold"))
    return ranked.groupBy(*groups).agg(F.max(order).alias("best")).select(*groups, "best.threshold", "best.f1")


def dynamic_performance(df: DataFrame, y: str, p: str, threshold: float = 0.5, groups: Sequence[str] = (),
                        weight: str | None = None) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and f1 at a threshold; one aggregate."""
    threshold = float(threshold)
    if not 0 <= threshold <= 1:
        raise ValueError("the threshold must lie between 0 and 1")
    rows = _binary_rows(df, y, p, list(groups), weight)
    sums = rows.groupBy(*groups).agg(*[c.alias(k) for k, c in confusion_sums(
        F.col("y"), F.col("p") >= threshold, F.col("w")).items()])
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    scores = label_formulas(tp, fp, fn, tn)
    return sums.select(*groups, tp, fp, fn, tn, scores["accuracy"].alias("accuracy"), ratio0(tp, tp + fp).alias("precision"),
                       ratio0(tp, tp + fn).alias("recall"), scores["F1"].alias("f1"))


def chart_curves(df: DataFrame, y: str, p: str, groups: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score: ROC (tpr, fpr), precision, share of rows called positive, lift."""
    ranked = ranked_scores(df, y, p, groups)
    found = F.col("pos_total") - F.col("pos_below")
    false = F.col("neg_total") - F.col("neg_below")
    called, everything = found + false, F.col("pos_total") + F.col("neg_total")
    return ranked.select(*groups, F.col("score").alias("threshold"), ratio0(found, F.col("pos_total")).alias("tpr"),
                         ratio0(false, F.col("neg_total")).alias("fpr"), ratio0(found, called).alias("precision"),
                         (called / everything).alias("share"),
                         ratio0(found / called, F.col("pos_total") / everything).alias("lift"))
