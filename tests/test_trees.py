"""Boosted and extra trees against plain numpy, and explanations against all orders of the features."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.operators import train as M, trees as TR
from lumenfold.operators.roles import ColumnRoles

ROLES = ColumnRoles(target="t", id="id")


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(600).select(
        F.col("id"), (F.col("id") * 7 % 23).cast("double").alias("a"), (F.col("id") * 5 % 11).cast("double").alias("b"), (F.col("id") % 3).cast("double").alias("c"),
        F.concat(F.lit("s"), F.col("id") * 3 % 5).alias("s"),
        ((F.col("id") * 7 % 23) * 2.0 + F.when(F.col("id") * 5 % 11 > 6, 15.0).otherwise(0.0) * (F.col("id") % 3) + (F.col("id") * 3 % 5)).alias("t")).cache()


def arrays(df, inputs=("a", "b", "c")):
    rows = df.orderBy("id").collect()
    return np.array([[r[c] for c in inputs] for r in rows]), np.array([r["t"] for r in rows])


def first_tree(x, y, depth, penalty, step):
    """Predictions of one level-wise squared-error tree by exhaustive search."""
    g = y.mean() - y

    def grow(rows, level):
        s = lambda r: g[r].sum() ** 2 / (len(r) + penalty)
        best = None
        if level < depth:
            for f in range(x.shape[1]):
                for t in np.unique(x[rows, f])[:-1]:
                    low, high = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                    if min(len(low), len(high)) >= TR.MIN_ROWS:
                        gain = s(low) + s(high) - s(rows)
                        if gain > TR.MIN_GAIN and (best is None or gain > best[0] + 1e-9):
                            best = (gain, low, high)
        if best is None:
            out[rows] = -step * g[rows].sum() / (len(rows) + penalty)
        else:
            grow(best[1], level + 1)
            grow(best[2], level + 1)
    out = np.zeros(len(y))
    grow(np.arange(len(y)), 0)
    return y.mean() + out


def test_first_level_wise_tree(data):
    x, y = arrays(data)
    model = TR.boost(data, ["a", "b", "c"], "t", "identity", 1, "level", 1, 0.5, 3, 8, 1.0)
    assert np.allclose(model.margins(x)[:, 0], first_tree(x, y, 3, 1.0, 0.5))


@pytest.mark.parametrize("growth", ["level", "leaf", "symmetric"])
def test_loss_falls_and_limits_hold(data, growth, monkeypatch):
    monkeypatch.setattr(TR, "REBASE", 2)  # margins are written back on the way
    x, y = arrays(data)
    model = TR.boost(data, ["a", "b", "c"], "t", "identity", 1, growth, 5, 0.5, 3, 6, 1.0)
    assert np.mean((model.margins(x)[:, 0] - y) ** 2) < 0.15 * y.var()
    for t in model.trees:
        leaves = [i for i, f in enumerate(t.feature) if f < 0]
        assert len(leaves) <= (6 if growth == "leaf" else 8) and abs(sum(t.cover[i] for i in leaves) - 600) < 1e-9
        if growth == "symmetric":
            paths = [{(f, th) for f, th in zip(t.feature, t.threshold) if f >= 0}]
            assert len(paths[0]) <= 3


def test_leaf_wise_takes_the_largest_gain_next(data):
    tree = TR.boost(data, ["a", "b", "c"], "t", "identity", 1, "leaf", 1, 0.5, 9, 5, 1.0).trees[0]
    order = [tree.gain[i] for i in sorted((i for i, f in enumerate(tree.feature) if f >= 0), key=lambda i: tree.left[i])]
    hanging = {0: tree.gain[0]}
    for g in order:
        assert g == max(hanging.values())
        node = max(hanging, key=lambda i: hanging[i])
        del hanging[node]
        hanging |= {c: tree.gain[c] for c in (tree.left[node], tree.right[node]) if tree.feature[c] >= 0}


def test_weights_count_as_copies(spark, data):
    weighted = data.withColumn("w", F.when(F.col("id") % 4 == 0, 3.0).otherwise(1.0))
    copies = weighted.withColumn("k", F.explode(F.array_repeat(F.lit(1), F.col("w").cast("int"))))
    x, _ = arrays(data)
    a = TR.boost(weighted, ["a", "b"], "t", "identity", 1, "level", 2, 0.5, 2, 4, 1.0, "w").margins(x)
    b = TR.boost(copies, ["a", "b"], "t", "identity", 1, "level", 2, 0.5, 2, 4, 1.0).margins(x)
    assert np.allclose(a, b)


def test_three_classes_share_their_steps(data):
    df = data.withColumn("y", F.when(F.col("a") > 15, 2.0).when(F.col("b") > 6, 1.0).otherwise(0.0))
    stage = TR.fit_trees(df, ["a", "b", "c"], "XGB", "multiclassification", 3, label="y", rounds=6)
    out = stage.transform(df).select("y", "prediction", "_p").collect()
    assert np.mean([r["y"] == r["prediction"] for r in out]) > 0.98 and all(abs(sum(r["_p"]) - 1) < 1e-9 for r in out)
    assert len(stage.ensemble.trees) == 3 * 6


def test_ordered_statistics_see_earlier_blocks_only(spark, data):
    out, stats = TR.ordered_statistics(data.withColumn("s", F.when(F.col("id") < 500, F.col("s"))), ["s"], "t", 1, ["id"])
    rows = out.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(TR.BLOCKS))).collect()
    mean = np.mean([r["t"] for r in rows])
    for r in rows[::37]:
        own = [o["t"] for o in rows if o["s"] == r["s"] and o["s"] is not None and o["block"] < r["block"]]
        assert abs(r["_ots_0_0"] - (sum(own) + mean) / (len(own) + 1)) < 1e-9
    new = stats.apply(spark.createDataFrame([("never",), ("s1",)], "s string")).collect()
    assert abs(new[0]["_ots_0_0"] - mean) < 1e-9 and abs(new[1]["_ots_0_0"] - mean) > 1e-6


def test_extra_trees_are_drawn_from_the_seed(data):
    x, y = arrays(data)
    model = TR.extra_trees(data, ["a", "b", "c"], "t", 0, trees=15, depth=4)
    cuts = TR.feature_cuts(data, ["a", "b", "c"])
    for t, tree in enumerate(model.trees):
        f = tree.feature[0]
        assert tree.threshold[0] == cuts[f][TR.drawn(t, 0, f, 0, len(cuts[f]))]
        low = x[:, f] <= tree.threshold[0]
        assert tree.cover[tree.left[0]] == low.sum()
        want = y[low].sum() ** 2 / low.sum() + y[~low].sum() ** 2 / (~low).sum() - y.sum() ** 2 / len(y)
        assert abs(tree.gain[0] - want) < 1e-6 * want
    assert len({tree.threshold[0] for tree in model.trees}) > 3
    assert np.mean((model.margins(x)[:, 0] - y) ** 2) < 0.6 * y.var()
    classes = TR.extra_trees(data.withColumn("y", (F.col("t") > 30).cast("double")), ["a", "b", "c"], "y", 2, trees=5, depth=4)
    assert np.allclose(classes.margins(x).sum(1), 1)


def conditional(tree, x, known, node=0):
    """Expected leaf value of a tree when only the features in known are given."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node][0]
    l, r = tree.left[node], tree.right[node]
    if f in known:
        return conditional(tree, x, known, l if x[f] <= tree.threshold[node] else r)
    return (tree.cover[l] * conditional(tree, x, known, l) + tree.cover[r] * conditional(tree, x, known, r)) / tree.cover[node]


def test_shapley_values_are_the_mean_over_all_orders(data):
    x, _ = arrays(data)
    model = TR.boost(data, ["a", "b", "c"], "t", "identity", 1, "level", 3, 0.5, 4, 16, 1.0)
    run, base = TR.shapley(model, 3, 0)
    got = run(x)
    assert np.allclose(got.sum(1) + base, model.margins(x)[:, 0])
    for row in x[::97]:
        want = np.zeros(3)
        for order in permutations(range(3)):
            known = set()
            for f in order:
                before = sum(conditional(t, row, known) for t in model.trees)
                known.add(f)
                want[f] += (sum(conditional(t, row, known) for t in model.trees) - before) / 6
        assert np.allclose(run(row[None])[0], want)


def test_search_over_tree_settings(data, monkeypatch):
    """The deeper of two settings fits better on every fold."""
    with monkeypatch.context() as m:
        m.setattr(M, "tree_grid", lambda code, profile: [{"rounds": 1, "depth": d, "step": 1.0} for d in (1, 3)])
        assert M.fit_model(data, ROLES, "regression", "XGB", profile="normal").params["depth"] == 3
    for code, size in (("XGB", 4), ("LGB", 4), ("CB", 4), ("ET", 4)):
        assert len(M.tree_grid(code, "normal")) == size and len(M.tree_grid(code, "advanced")) == 12 and M.tree_grid(code, "quick") == [{}]


def test_spark_trees_become_ensembles(data):
    for code in ("DT", "RF"):
        model = M.fit_model(data, ROLES, "regression", code)
        scored = model.score_encoded(model.encoder.apply(data))
        from pyspark.ml.functions import vector_to_array
        rows = scored.select(vector_to_array("_features").alias("x"), "prediction").collect()
        own = TR.from_spark(model.stages.stages[-1], 1).margins(np.array([r["x"] for r in rows]))[:, 0]
        assert np.allclose(own, [r["prediction"] for r in rows])


@pytest.mark.parametrize("code,problem", [("XGB", "regression"), ("LGB", "classification"), ("CB", "multiclassification"), ("ET", "regression"), ("ET", "multiclassification")])
def test_rows_of_the_same_bins_are_merged(spark, monkeypatch, code, problem):
    """The same trees from a few merged rows as from all rows, weights of zero included."""
    classes = {"regression": 0, "classification": 2, "multiclassification": 3}[problem]
    y = "CAST((id * 7 % 5 + id % 4 + id * 3 % 11) % {0} AS double)".format(classes) if classes else "id * 7 % 5 * 2.0 + id % 4 * (id % 9) + 0.25 * (id * 3 % 11)"
    df = spark.range(4000).selectExpr("id", "CAST(id * 7 % 5 AS double) AS a", "CAST(id % 4 AS double) AS b", "CAST(id * 5 % 3 AS double) AS w", f"{y} AS _y").repartition(3).cache()
    given = dict(inputs=["a", "b"], code=code, problem=problem, n_classes=classes, weight="w")
    want = TR.fit_trees(df, **given).ensemble
    monkeypatch.setattr(TR, "ROWS_A_TASK", 500)
    read = []
    stored = TR._stored
    monkeypatch.setattr(TR, "_stored", lambda t: read.append(stored(t)) or read[-1])
    stage = TR.fit_trees(df, **given)
    assert read[1].count() <= 5 * 4 * max(1, classes if problem == "multiclassification" else 1)
    got = stage.ensemble
    assert [t.feature for t in got.trees] == [t.feature for t in want.trees] and [t.threshold for t in got.trees] == [t.threshold for t in want.trees]
    for a, b in zip(got.trees, want.trees):
        assert np.allclose(a.value, b.value) and np.allclose(a.cover, b.cover)
    if not classes:
        rows = stage.transform(df.withColumn("a", F.when(F.col("id") > 5, F.col("a")))).orderBy("id").collect()
        x = np.array([[np.nan if r["a"] is None else r["a"], r["b"]] for r in rows])
        assert np.allclose([r["prediction"] for r in rows], got.outputs(x)[:, 0])
