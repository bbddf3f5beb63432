"""Metrics and classification analysis on orders, lineitem and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfold.operators import metrics as M
from lumenfold.plans.catalog import (BINARY_SQL, PRIORITIES, PRIORITY_SQL, REGRESSION_SQL, STATUS_SQL, STATUSES,
                                     TIED_SQL, binary_rows, class_probs, priority_rows, register, regression_rows,
                                     rounded, status_rows, table, tied_rows)

# --- regression ---------------------------------------------------------------------------------------------------

REGRESSION_FORMULAS = {
    "rmse": "sqrt(avg((y - p) * (y - p)))",
    "rmsle": "sqrt(avg(pow(ln(1 + greatest(p, 0)) - ln(1 + greatest(y, 0)), 2)))",
    "mape": "avg(abs((y - p) / nullif(y, 0)))",
    "mae": "avg(abs(y - p))",
    "mse": "avg((y - p) * (y - p))",
    "rmspe": "sqrt(avg(pow((y - p) / nullif(y, 0), 2)))",
    "mer": "median(abs(y - p))",
    "R2": "1 - sum((y - p) * (y - p)) / nullif(sum(y * y) - sum(y) * sum(y) / count(*), 0)",
    "smape": "avg(coalesce(2 * abs(y - p) / nullif(abs(y) + abs(p), 0), 0))",
}
DIGITS = {"mse": 1, "rmse": 4, "mae": 4}


def _regression(name, digits):
    def run(spark, sf_dir):
        return rounded(M.regression_metrics(regression_rows(spark, sf_dir), "y", "p", ["p_brand"], names=[name]), digits)
    return run


for _i, _name in enumerate(M.REGRESSION, 1):
    _d = DIGITS.get(_name, 6)
    register(f"r{_i:02d}_{_name.lower()}",
             f'SELECT p_brand, round({REGRESSION_FORMULAS[_name]}, {_d}) AS "{_name}" FROM {REGRESSION_SQL} t GROUP BY p_brand'
             )(_regression(_name, _d))


@register("r00_regression_metrics", "SELECT p_brand, " + ", ".join(
    f'round({REGRESSION_FORMULAS[n]}, {DIGITS.get(n, 6)}) AS "{n}"' for n in M.REGRESSION)
    + f" FROM {REGRESSION_SQL} t GROUP BY p_brand")
def regression_all(spark, sf_dir):
    out = M.regression_metrics(regression_rows(spark, sf_dir), "y", "p", ["p_brand"])
    return out.select("p_brand", *[F.round(n, DIGITS.get(n, 6)).alias(n) for n in M.REGRESSION])


WEIGHTED_FORMULAS = {
    "rmse": "sqrt(sum(w * (y - p) * (y - p)) / sum(w))",
    "mape": "sum(w * abs((y - p) / y)) / sum(w)",
    "mae": "sum(w * abs(y - p)) / sum(w)",
    "R2": "1 - sum(w * (y - p) * (y - p)) / (sum(w * y * y) - sum(w * y) * sum(w * y) / sum(w))",
}


@register("m14_weighted_regression", "SELECT p_brand, " + ", ".join(
    f'round({f}, 4) AS "{n}"' for n, f in WEIGHTED_FORMULAS.items()) + f" FROM {REGRESSION_SQL} t GROUP BY p_brand")
def weighted_regression(spark, sf_dir):
    return rounded(M.regression_metrics(regression_rows(spark, sf_dir), "y", "p", ["p_brand"], "w",
                                        list(WEIGHTED_FORMULAS)), 4)


# --- binary -------------------------------------------------------------------------------------------------------

def grouped_scores(rows: str, weight: str = "1.0") -> str:
    """Per (grp, score): weights of each class, sums of smaller scores, totals."""
    return f"""(SELECT grp, p, pos, neg,
        coalesce(sum(pos) OVER w, 0) AS pos_below, coalesce(sum(neg) OVER w, 0) AS neg_below,
        sum(pos) OVER (PARTITION BY grp) AS pos_total, sum(neg) OVER (PARTITION BY grp) AS neg_total
        FROM (SELECT grp, p, sum(y * {weight}) AS pos, sum((1 - y) * {weight}) AS neg FROM {rows} r GROUP BY grp, p) g
        WINDOW w AS (PARTITION BY grp ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


AUC = "sum(pos * (neg_below + neg / 2)) / (max(pos_total) * max(neg_total))"
RANK_FORMULAS = {
    "auc": AUC,
    "gini": f"2 * {AUC} - 1",
    "aucpr": "sum(pos * (pos_total - pos_below) / (pos_total + neg_total - pos_below - neg_below)) / max(pos_total)",
    **{f"lift_at_0.{t}": f"""(sum(pos * least(greatest(0.{t} * (pos_total + neg_total)
        - (pos_total + neg_total - pos_below - neg_below - pos - neg), 0), pos + neg) / (pos + neg))
        / (0.{t} * max(pos_total + neg_total))) / (max(pos_total) / max(pos_total + neg_total))""" for t in range(1, 10)},
}


def counts(rows: str, weight: str = "1.0", t: float = 0.5) -> str:
    return f"""(SELECT grp, sum({weight} * (y = 1 AND p >= {t})::INT) AS tp, sum({weight} * (y = 0 AND p >= {t})::INT) AS fp,
        sum({weight} * (y = 1 AND p < {t})::INT) AS fn, sum({weight} * (y = 0 AND p < {t})::INT) AS tn,
        sum({weight} * -(y * ln(least(greatest(p, 1e-15), 1 - 1e-15))
            + (1 - y) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)))) / sum({weight}) AS ll
        FROM {rows} r GROUP BY grp)"""


def _fbeta(b):
    return f"coalesce((1 + {b * b}) * tp / nullif((1 + {b * b}) * tp + {b * b} * fn + fp, 0), 0)"


LABEL_FORMULAS = {
    "log_loss": "ll",
    "error_rate_binary": "(fp + fn) / (tp + fp + fn + tn)",
    "accuracy": "(tp + tn) / (tp + fp + fn + tn)",
    **{n: _fbeta(b) for n, b in M.F_BETA.items()},
    "mcc": "coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0)",
}


def binary_sql(names, rows=BINARY_SQL, weight="1.0") -> str:
    by_rank = [n for n in names if n in RANK_FORMULAS]
    by_label = [n for n in names if n in LABEL_FORMULAS]
    parts = []
    if by_rank:
        cols = ", ".join(f'round({RANK_FORMULAS[n]}, 6) AS "{n}"' for n in by_rank)
        parts.append(f"(SELECT grp, {cols} FROM {grouped_scores(rows, weight)} s GROUP BY grp)")
    if by_label:
        cols = ", ".join(f'round({LABEL_FORMULAS[n]}, 6) AS "{n}"' for n in by_label)
        parts.append(f"(SELECT grp, {cols} FROM {counts(rows, weight)} s)")
    return f"SELECT * FROM {parts[0]} a" + (f" JOIN {parts[1]} b USING (grp)" if len(parts) == 2 else "")


def _binary(name):
    def run(spark, sf_dir):
        return rounded(M.binary_metrics(binary_rows(spark, sf_dir), "y", "p", ["grp"], names=[name]))
    return run


for _i, _name in enumerate(M.CLASSIFICATION, 1):
    register(f"c{_i:02d}_{_name.lower().replace('.', '_')}", binary_sql([_name]))(_binary(_name))


@register("c00_binary_metrics", binary_sql(M.CLASSIFICATION))
def binary_all(spark, sf_dir):
    return rounded(M.binary_metrics(binary_rows(spark, sf_dir), "y", "p", ["grp"]))


@register("c00_binary_metrics_tied", binary_sql(M.CLASSIFICATION, TIED_SQL))
def binary_tied(spark, sf_dir):
    return rounded(M.binary_metrics(tied_rows(spark, sf_dir), "y", "p", ["grp"]))


@register("m14_weighted_binary", binary_sql(["auc", "log_loss", "accuracy", "F1", "mcc", "aucpr"], weight="w"))
def weighted_binary(spark, sf_dir):
    return rounded(M.binary_metrics(binary_rows(spark, sf_dir), "y", "p", ["grp"], "w",
                                    names=["auc", "log_loss", "accuracy", "F1", "mcc", "aucpr"]))


# --- multiclass ---------------------------------------------------------------------------------------------------

def multi_parts(rows: str, classes: list[str]) -> str:
    """Rows with label, true-class probability, its rank, and class numbers."""
    k = len(classes)
    best = "greatest(" + ", ".join(f"p{i}" for i in range(k)) + ")"
    label = "CASE " + " ".join(f"WHEN p{i} = {best} THEN '{c}'" for i, c in enumerate(classes)) + " END"
    pt = "CASE y " + " ".join(f"WHEN '{c}' THEN p{i}" for i, c in enumerate(classes)) + " END"
    number = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(classes))
    ahead = " + ".join(f"(p{i} > pt OR (p{i} = pt AND '{c}' < y))::INT" for i, c in enumerate(classes))
    return f"""(SELECT *, 1 + {ahead} AS place, CASE y {number} END AS i, CASE label {number} END AS j
        FROM (SELECT *, {label} AS label, {pt} AS pt FROM {rows} r1) r2)"""


def multi_sql(names, rows, classes) -> str:
    base = multi_parts(rows, classes)
    k = len(classes)
    f1 = [f"coalesce(2.0 * sum((y = '{c}' AND label = '{c}')::INT) / nullif(sum((y = '{c}')::INT) + sum((label = '{c}')::INT), 0), 0)"
          for c in classes]
    seen = [f"(sum((y = '{c}' OR label = '{c}')::INT) > 0)::INT" for c in classes]
    areas = " UNION ALL ".join(f"SELECT grp || '~{i}' AS grp, p{i} AS p, (y = '{c}')::INT AS y FROM {rows} z{i}"
                               for i, c in enumerate(classes))
    formulas = {
        "log_loss": "-avg(ln(least(greatest(pt, 1e-15), 1 - 1e-15)))",
        "error_rate_multi": "avg((label <> y)::INT)",
        "accuracy": "avg((label = y)::INT)",
        "macroF1": f"({' + '.join(f1)}) / ({' + '.join(seen)})",
        "qkappa": f"1 - (sum((i - j) * (i - j)) / ({(k - 1) ** 2}.0 * count(*))) / "
                  f"((avg(i * i) + avg(j * j) - 2 * avg(i) * avg(j)) / {(k - 1) ** 2}.0)",
        **{f"map_at_{n}": f"avg(CASE WHEN place <= {n} THEN 1.0 / place ELSE 0 END)" for n in (3, 5, 10)},
    }
    area = f"""(SELECT split_part(grp, '~', 1) AS grp, round(avg(auc), 6) AS auc FROM
        (SELECT grp, {AUC} AS auc FROM {grouped_scores('(' + areas + ')')} s GROUP BY grp) t GROUP BY 1)"""
    plain = [n for n in names if n != "auc"]
    cols = ", ".join(f'round({formulas[n]}, 6) AS "{n}"' for n in plain)
    main = f"(SELECT grp, {cols} FROM {base} m GROUP BY grp)"
    if names == ["auc"]:
        return f"SELECT * FROM {area} a"
    return f"SELECT * FROM {main} a" + (f" JOIN {area} b USING (grp)" if "auc" in names else "")


def _multi(name):
    def run(spark, sf_dir):
        return rounded(M.multiclass_metrics(priority_rows(spark, sf_dir), "y", class_probs(PRIORITIES), ["grp"],
                                            names=[name]))
    return run


for _i, _name in enumerate(M.MULTICLASS, 1):
    register(f"b{_i:02d}_{_name.lower()}", multi_sql([_name], PRIORITY_SQL, PRIORITIES))(_multi(_name))


@register("b00_multiclass_metrics", multi_sql(M.MULTICLASS, STATUS_SQL, STATUSES))
def multiclass_all(spark, sf_dir):
    return rounded(M.multiclass_metrics(status_rows(spark, sf_dir), "y", class_probs(STATUSES), ["grp"]))


# --- clustering ---------------------------------------------------------------------------------------------------

CLUSTER_SUMS = """
WITH v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
c AS (SELECT label, d, sum(x) AS s FROM v GROUP BY label, d),
n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
q AS (SELECT vec_id, label, sum(x * x) AS sq FROM v GROUP BY vec_id, label)"""


@register("u01_silhouette", CLUSTER_SUMS + """,
psi AS (SELECT label, sum(sq) AS psi FROM q GROUP BY label),
dots AS (SELECT v.vec_id, c.label AS other, sum(v.x * c.s) AS dot FROM v JOIN c USING (d) GROUP BY v.vec_id, c.label),
dist AS (SELECT q.vec_id, q.label, dots.other, n.n, (q.sq + psi.psi / n.n - 2 * dots.dot / n.n) AS m
    FROM q JOIN dots USING (vec_id) JOIN n ON n.label = dots.other JOIN psi ON psi.label = dots.other),
ab AS (SELECT vec_id, max(CASE WHEN label = other THEN n END) AS n,
    max(CASE WHEN label = other THEN m * n / nullif(n - 1, 0) END) AS a, min(CASE WHEN label <> other THEN m END) AS b
    FROM dist GROUP BY vec_id)
SELECT round(avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette
FROM ab""")
def silhouette(spark, sf_dir):
    return rounded(M.silhouette(table(spark, sf_dir, "embeddings"), "label", "embedding"))


@register("u02_calinski_harabaz", CLUSTER_SUMS + """,
own AS (SELECT sum(s * s / n) AS own FROM c JOIN n USING (label)),
mid AS (SELECT sum(t * t) AS mid FROM (SELECT d, sum(s) AS t FROM c GROUP BY d) z),
tot AS (SELECT count(*) AS n, count(DISTINCT label) AS k, sum(sq) AS sq FROM q)
SELECT round(((own - mid / n) / (k - 1)) / ((sq - own) / (n - k)), 6) AS calinski_harabaz FROM own, mid, tot""")
def calinski(spark, sf_dir):
    return rounded(M.calinski_harabaz(table(spark, sf_dir, "embeddings"), "label", "embedding"))


# --- metric by name -----------------------------------------------------------------------------------------------

@register("g04_score_by_name", f"""SELECT 'regression' AS problem, 'rmse' AS metric,
    round({REGRESSION_FORMULAS['rmse']}, 4) AS score FROM {REGRESSION_SQL} t
UNION ALL SELECT 'classification', 'auc', round(auc, 4) FROM (SELECT {AUC} AS auc FROM
    {grouped_scores(BINARY_SQL.replace('o_orderpriority AS grp', "'all' AS grp"))} s) t
UNION ALL SELECT 'multiclassification', 'log_loss',
    round(-avg(ln(least(greatest(pt, 1e-15), 1 - 1e-15))), 4) FROM {multi_parts(STATUS_SQL, STATUSES)} m""")
def score_by_name(spark, sf_dir):
    args = {"regression": (regression_rows(spark, sf_dir), {"y": "y", "p": "p"}),
            "classification": (binary_rows(spark, sf_dir), {"y": "y", "p": "p"}),
            "multiclassification": (status_rows(spark, sf_dir), {"y": "y", "probs": class_probs(STATUSES)})}
    out = None
    for problem, (rows, kw) in args.items():
        metric = M.DEFAULT_METRIC[problem]
        one = M.evaluate(rows, problem, **kw).select(F.lit(problem).alias("problem"), F.lit(metric).alias("metric"),
                                                     F.round(metric, 4).alias("score"))
        out = one if out is None else out.unionByName(one)
    return out
