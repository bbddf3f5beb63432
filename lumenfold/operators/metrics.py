"""Model quality metrics as aggregates: any grouping, optional row weights, every metric of a family in one pass.

Order-based metrics (auc, gini, aucpr, lift) share one running-totals pass over distinct scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from lumenfold.functions.ranking import exact_percentiles, prefix_sums, weighted_median

# Metric names per kind of problem, and the default of each kind.
REGRESSION = ["rmse", "rmsle", "mape", "mae", "mse", "rmspe", "mer", "R2", "smape"]
CLASSIFICATION = ["auc", "log_loss", "error_rate_binary", "accuracy", "F05", "F1", "F2", "F3", "F4", "mcc", "gini",
                  "aucpr", "lift_at_0.1", "lift_at_0.2", "lift_at_0.3", "lift_at_0.4", "lift_at_0.5", "lift_at_0.6",
                  "lift_at_0.7", "lift_at_0.8", "lift_at_0.9"]
MULTICLASS = ["log_loss", "error_rate_multi", "macroF1", "auc", "accuracy", "qkappa", "map_at_3", "map_at_5",
              "map_at_10"]
CLUSTERING = ["silhouette", "calinski_harabaz"]
TEXT_SIMILARITY = ["accuracy_at_k", "mrr_at_k"]
DEFAULT_METRIC = {"regression": "rmse", "classification": "auc", "multiclassification": "log_loss",
                  "text-similarity": "accuracy_at_k"}

# Metrics where smaller is better.
ASCENDING = {"rmse", "rmsle", "mape", "mae", "mse", "rmspe", "mer", "smape", "log_loss", "error_rate_binary",
             "error_rate_multi"}

F_BETA = {"F05": 0.5, "F1": 1.0, "F2": 2.0, "F3": 3.0, "F4": 4.0}
CLIP = 1e-15


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _check(names: Sequence[str], known: Sequence[str]) -> list[str]:
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}, known are {list(known)}")
    return list(names)


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return a / F.nullif(b.cast("double"), F.lit(0.0))


def ratio0(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(ratio(a, b), F.lit(0.0))


def weighted_mean(x: Column, w: Column) -> Column:
    return ratio(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))


def _weights(weight: str | Column | None) -> Column:
    return F.lit(1.0) if weight is None else _col(weight).cast("double")


def _join_rows(left: DataFrame, right: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Put two results per group side by side; two one-row results when there are no groups."""
    if groups:
        extra = [F.col(f"`{c}`") for c in right.columns if c not in groups]
        r = right.select(*[F.col(g).alias(f"_{g}") for g in groups], *extra)
        cond = F.lit(True)
        for g in groups:
            cond = cond & left[g].eqNullSafe(r[f"_{g}"])
        return left.join(r, cond).drop(*[f"_{g}" for g in groups])
    packed = right.select(F.struct("*").alias("s")).scalar()
    return left.withColumn("_s", packed).select(*[F.col(f"`{c}`") for c in left.columns], "_s.*")


def regression_metrics(df: DataFrame, y: str | Column, p: str | Column, groups: Sequence[str] = (),
                       weight: str | Column | None = None, names: Sequence[str] = REGRESSION) -> DataFrame:
    """Columns: groups, then one per requested metric. Rows without truth or prediction do not count."""
    names, groups = _check(names, REGRESSION), list(groups)
    rows = df.select(*groups, _col(y).cast("double").alias("y"), _col(p).cast("double").alias("p"),
                     _weights(weight).alias("w")).where(F.col("y").isNotNull() & F.col("p").isNotNull())
    yc, pc, w = F.col("y"), F.col("p"), F.col("w")
    err, rel = yc - pc, (yc - pc) / F.nullif(yc, F.lit(0.0))
    log_err = F.log1p(F.greatest(pc, F.lit(0.0))) - F.log1p(F.greatest(yc, F.lit(0.0)))
    spread = (F.var_pop(yc) * F.count(yc) if weight is None
              else F.sum(w * yc * yc) - F.sum(w * yc) * F.sum(w * yc) / F.sum(w))
    formulas = {
        "rmse": F.sqrt(weighted_mean(err * err, w)),
        "rmsle": F.sqrt(weighted_mean(log_err * log_err, w)),
        "mape": weighted_mean(F.abs(rel), w),
        "mae": weighted_mean(F.abs(err), w),
        "mse": weighted_mean(err * err, w),
        "rmspe": F.sqrt(weighted_mean(rel * rel, w)),
        "R2": 1 - ratio(F.sum(w * err * err), spread),
        "smape": weighted_mean(F.coalesce(2 * F.abs(err) / F.nullif(F.abs(yc) + F.abs(pc), F.lit(0.0)), F.lit(0.0)), w),
    }
    plain = [n for n in names if n != "mer"]
    medians = None
    if "mer" in names and weight is None:
        # only the bucket that holds a group's middle is sorted
        medians = exact_percentiles(rows, F.abs(err), [0.5], groups, "mer").withColumnRenamed("mer_0", "mer")
    elif "mer" in names:
        medians = weighted_median(rows, F.abs(err), w, groups, "mer")
    if not plain:
        return medians.select(*groups, "mer")
    out = rows.groupBy(*groups).agg(*[formulas[n].alias(n) for n in plain])
    if medians is not None:
        out = _join_rows(out, medians, groups)
    return out.select(*groups, *names)


def confusion_sums(y: Column, hit: Column, w: Column) -> dict[str, Column]:
    """tp, fp, fn, tn as weighted sums over boolean truth and prediction."""
    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, w).otherwise(0.0))
    return {"tp": total(y & hit), "fp": total(~y & hit), "fn": total(y & ~hit), "tn": total(~y & ~hit)}


def _binary_rows(df, y, p, groups, weight) -> DataFrame:
    return df.select(*groups, (_col(y).cast("int") == 1).alias("y"), _col(p).cast("double").alias("p"),
                     _weights(weight).alias("w")).where(F.col("y").isNotNull() & F.col("p").isNotNull())


def ranked_scores(df: DataFrame, y: str | Column, p: str | Column, groups: Sequence[str] = (),
                  weight: str | Column | None = None) -> DataFrame:
    """Per distinct score: pos, neg (weights), the sums below it and the totals. Base of every order metric."""
    rows = _binary_rows(df, y, p, list(groups), weight)
    return prefix_sums(rows, F.col("p"), {"pos": F.when(F.col("y"), F.col("w")).otherwise(0.0),
                                          "neg": F.when(F.col("y"), 0.0).otherwise(F.col("w"))}, groups)


RANK_METRICS = ["auc", "gini", "aucpr"] + [f"lift_at_0.{t}" for t in range(1, 10)]


def rank_metrics(ranked: DataFrame, groups: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Order metrics from the running totals: row terms first, then plain sums, then the quotients.

    For lift, the score group that holds the cut-off counts pro rata, so ties need no order.
    """
    pos, neg = F.col("pos"), F.col("neg")
    lifts = {n: float(n.rsplit("_", 1)[1]) for n in names if n.startswith("lift_at_")}
    everything = F.col("pos_total") + F.col("neg_total")
    found = F.col("pos_total") - F.col("pos_below")
    called = everything - F.col("pos_below") - F.col("neg_below")
    rows = ranked.withColumns({"n": pos + neg, "above": called - pos - neg}).select(
        *groups, "pos", "n", "above", "pos_total", "neg_total", everything.alias("all_total"),
        (pos * (F.col("neg_below") + neg / 2)).alias("area"),
        F.when(called > 0, pos * found / called).otherwise(0.0).alias("hits"))
    sums = [F.sum("area").alias("area"), F.sum("hits").alias("hits"),
            *[F.max(t).alias(t) for t in ("pos_total", "neg_total", "all_total")]]
    for i, r in enumerate(lifts.values()):
        room = F.least(F.greatest(r * F.col("all_total") - F.col("above"), F.lit(0.0)), F.col("n"))
        sums.append(F.sum(F.when(F.col("n") > 0, pos * room / F.col("n")).otherwise(0.0)).alias(f"top{i}"))
    total = rows.groupBy(*groups).agg(*sums)
    auc = ratio(F.col("area"), F.col("pos_total") * F.col("neg_total"))
    out = {"auc": auc, "gini": 2 * auc - 1, "aucpr": ratio(F.col("hits"), F.col("pos_total"))}
    for i, (name, r) in enumerate(lifts.items()):
        out[name] = ratio(F.col(f"top{i}") / r, F.col("pos_total"))
    return total.select(*groups, *[out[n].alias(n) for n in names])


def label_formulas(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Metrics that need only the confusion counts."""
    n = tp + fp + fn + tn
    product = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    out = {
        "error_rate_binary": ratio(fp + fn, n),
        "accuracy": ratio(tp + tn, n),
        "mcc": ratio0(tp * tn - fp * fn, F.sqrt(product)),
    }
    for name, b in F_BETA.items():
        out[name] = ratio0((1 + b * b) * tp, (1 + b * b) * tp + b * b * fn + fp)
    return out


def binary_metrics(df: DataFrame, y: str | Column, p: str | Column, groups: Sequence[str] = (),
                   weight: str | Column | None = None, threshold: float = 0.5,
                   names: Sequence[str] = CLASSIFICATION) -> DataFrame:
    """Columns: groups, then one per requested metric; y is 0/1 (or boolean), p the probability of 1."""
    names, groups = _check(names, CLASSIFICATION), list(groups)
    by_rank = [n for n in names if n in RANK_METRICS]
    by_label = [n for n in names if n not in by_rank]
    ranked = rank_metrics(ranked_scores(df, y, p, groups, weight), groups, by_rank) if by_rank else None
    if not by_label:
        return ranked.select(*groups, *[F.col(f"`{n}`") for n in names])
    rows = _binary_rows(df, y, p, groups, weight)
    yc, pc, w = F.col("y"), F.col("p"), F.col("w")
    safe = F.least(F.greatest(pc, F.lit(CLIP)), F.lit(1 - CLIP))
    sums = rows.groupBy(*groups).agg(
        *[c.alias(k) for k, c in confusion_sums(yc, pc >= threshold, w).items()],
        (-weighted_mean(F.when(yc, F.ln(safe)).otherwise(F.ln(1 - safe)), w)).alias("log_loss"))
    formulas = {**label_formulas(*[F.col(k) for k in ("tp", "fp", "fn", "tn")]), "log_loss": F.col("log_loss")}
    out = sums.select(*groups, *[formulas[n].alias(n) for n in by_label])
    if ranked is not None:
        out = _join_rows(out, ranked, groups)
    return out.select(*groups, *[F.col(f"`{n}`") for n in names])


def top_class(probs: dict[str, Column]) -> Column:
    """Class with the largest probability; the first one given wins ties."""
    best = F.greatest(*probs.values()) if len(probs) > 1 else next(iter(probs.values()))
    return F.coalesce(*[F.when(p == best, F.lit(c)) for c, p in probs.items()])


def multiclass_metrics(df: DataFrame, y: str | Column, probs: dict[str, str | Column], groups: Sequence[str] = (),
                       weight: str | Column | None = None, names: Sequence[str] = MULTICLASS) -> DataFrame:
    """probs maps each class label to its probability column; class order is the order for qkappa and ties.

    A true class without a probability counts as an error in every metric but qkappa, which has no place for it and raises.
    """
    names, groups = _check(names, MULTICLASS), list(groups)
    classes = list(probs)
    rows = df.select(*groups, _col(y).cast("string").alias("y"), _weights(weight).alias("w"),
                     *[_col(c).cast("double").alias(f"p{i}") for i, c in enumerate(probs.values())]
                     ).where(F.col("y").isNotNull())
    pcols = {c: F.col(f"p{i}") for i, c in enumerate(classes)}
    index = {c: F.lit(i) for i, c in enumerate(classes)}
    p_true = F.coalesce(*[F.when(F.col("y") == c, pcols[c]) for c in classes])
    rows = rows.withColumns({"label": top_class(pcols), "p_true": p_true})
    yc, label, w, pt = F.col("y"), F.col("label"), F.col("w"), F.col("p_true")
    ahead = sum((F.when((pcols[c] > pt) | ((pcols[c] == pt) & (F.lit(c) < yc)), 1).otherwise(0) for c in classes),
                F.lit(0))
    place = F.when(pt.isNotNull(), 1 + ahead)
    unknown = F.raise_error(F.concat(F.lit("no probability is given for the true class "), yc)).cast("int")
    i = F.coalesce(*[F.when(yc == c, index[c]) for c in classes], unknown).cast("double")
    j = F.coalesce(*[F.when(label == c, index[c]) for c in classes]).cast("double")

    f1s, present = [], []
    for c in classes:
        s = confusion_sums(yc == c, label == c, w)
        f1s.append(ratio0(2 * s["tp"], 2 * s["tp"] + s["fn"] + s["fp"]))
        present.append(F.when(s["tp"] + s["fn"] + s["fp"] > 0, 1.0).otherwise(0.0))
    expected = (weighted_mean(i * i, w) + weighted_mean(j * j, w) - 2 * weighted_mean(i, w) * weighted_mean(j, w))
    safe = F.least(F.greatest(pt, F.lit(CLIP)), F.lit(1 - CLIP))
    formulas = {
        "log_loss": -weighted_mean(F.ln(safe), w),
        "error_rate_multi": weighted_mean((label != yc).cast("double"), w),
        "accuracy": weighted_mean((label == yc).cast("double"), w),
        "macroF1": ratio(sum(f1s, F.lit(0.0)), sum(present, F.lit(0.0))),
        "qkappa": 1 - ratio(weighted_mean((i - j) * (i - j), w), expected),
        **{f"map_at_{k}": weighted_mean(F.when(place <= k, 1.0 / place).otherwise(0.0), w) for k in (3, 5, 10)},
    }
    plain = [n for n in names if n != "auc"]
    area = None
    if "auc" in names:
        long = rows.select(*groups, "y", "w", F.explode(F.array(*[
            F.struct(F.lit(c).alias("class"), pcols[c].alias("p")) for c in classes])).alias("e")
        ).select(*groups, "w", "e.class", "e.p", (F.col("y") == F.col("e.class")).alias("hit"))
        each = rank_metrics(ranked_scores(long, "hit", "p", [*groups, "class"], "w"), [*groups, "class"], ["auc"])
        area = each.groupBy(*groups).agg(F.avg("auc").alias("auc"))
        if not plain:
            return area
    out = rows.groupBy(*groups).agg(*[formulas[n].alias(n) for n in plain])
    if area is not None:
        out = _join_rows(out, area, groups)
    return out.select(*groups, *names)


def silhouette(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """Squared-Euclidean silhouette from cluster sums (one number for the whole table)."""
    rows = df.select(F.col(cluster).cast("double").alias("prediction"),
                     array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    value = ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(rows)
    return df.sparkSession.createDataFrame([(float(value),)], "silhouette double")


def calinski_harabaz(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """(between / (k - 1)) / (within / (n - k)) from per-cluster vector sums; one pass over the rows."""
    vec = F.col(vector).cast("array<double>")
    square = F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x)
    sums = df.groupBy(F.col(cluster).alias("c")).agg(
        Summarizer.sum(array_to_vector(vec)).alias("s"), F.count(F.lit(1)).alias("n"), F.sum(square).alias("sq"))
    parts = sums.select("n", "sq", vector_to_array("s").alias("s"))
    own = F.aggregate("s", F.lit(0.0), lambda acc, x: acc + x * x) / F.col("n")
    head = parts.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("sq").alias("sq"),
                     F.sum(own).alias("own"))
    whole = parts.select(F.posexplode("s").alias("d", "x")).groupBy("d").agg(F.sum("x").alias("x")) \
        .agg(F.sum(F.col("x") * F.col("x")).alias("centre"))
    row = _join_rows(head, whole, [])
    between = F.col("own") - F.col("centre") / F.col("n")
    within = F.col("sq") - F.col("own")
    return row.select(ratio(ratio(between, F.col("k") - 1), ratio(within, F.col("n") - F.col("k")))
                      .alias("calinski_harabaz"))


def retrieval_metrics(queries: DataFrame, matches: DataFrame, query_id: str, item_id: str, rank: str, true_id: str,
                      k: int) -> DataFrame:
    """accuracy_at_k and mrr_at_k over all queries; a query whose true item is not in the first k scores 0."""
    hits = matches.where(F.col(rank) <= k).join(queries.select(query_id, F.col(true_id).alias("_true")), query_id) \
        .where(F.col(item_id) == F.col("_true")).groupBy(query_id).agg(F.min(rank).alias("_rank"))
    found = queries.select(query_id).join(hits, query_id, "left")
    return found.agg(F.avg(F.when(F.col("_rank").isNotNull(), 1.0).otherwise(0.0)).alias("accuracy_at_k"),
                     F.avg(F.coalesce(1.0 / F.col("_rank"), F.lit(0.0))).alias("mrr_at_k"))


def evaluate(df: DataFrame, problem: str, metric: str | None = None, **args) -> DataFrame:
    """One metric by name; each kind of problem has its default."""
    if problem not in DEFAULT_METRIC:
        raise ValueError(f"problem must be one of {sorted(DEFAULT_METRIC)}")
    metric = metric or DEFAULT_METRIC[problem]
    if problem == "text-similarity":
        _check([metric], TEXT_SIMILARITY)
        return retrieval_metrics(df, **args).select(metric)
    run = {"regression": regression_metrics, "classification": binary_metrics,
           "multiclassification": multiclass_metrics}[problem]
    return run(df, names=[metric], **args)


def problem_metrics(df: DataFrame, y: str, value: str | dict[str, str], problem: str, groups: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """Metrics of scored rows by kind of problem; value: the prediction or the probability of class 1, or the probability column of each class."""
    if problem == "multiclassification":
        return multiclass_metrics(df, y, {c: F.col(f"`{p}`") for c, p in value.items()}, groups, **({"names": names} if names else {}))
    if problem not in ("regression", "classification"):
        raise ValueError(f"unknown problem {problem}")
    run = regression_metrics if problem == "regression" else binary_metrics
    return run(df, y, value, groups, **({"names": names} if names else {}))
