"""Boosted trees and extremely randomised trees, grown from aggregates over binned rows, and their exact explanations.

Features are cut into at most BINS bins once; the binned table is stored and every growing step is one aggregate over it. A
task sums gradients and second derivatives by (node, feature, bin) for the rows it reads, Spark adds the sums up, and the
driver, which only sees nodes x features x bins, chooses the splits. Trees are sent along with each step; after REBASE rounds
the margins reached so far are written into the table, so a step never has to evaluate more than that many trees.

* level-wise growth with second-order gain (XGB): all leaves of a level are split in one step;
* leaf-wise growth (LGB): the leaf of the largest gain is split next, up to a number of leaves;
* symmetric trees (CB): one split for a whole level, and ordered target statistics for string columns: a row's category is
  encoded with the targets of the rows of earlier blocks of a hashed order only;
* several classes: one softmax model with a tree per class and round, all grown in the same steps;
* extra trees (ET): thresholds drawn at random within the bounds of the path, one aggregate per level for all trees.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenfold.functions.skew import lookup_join
from lumenfold.session import cut_lineage, scratch_path

BINS, REBASE, BLOCKS, SMOOTH, ROWS_A_TASK = 64, 10, 16, 1.0, 100_000
#: Rows of the same bins are merged if that leaves a table so many times smaller.
MERGED = 4
#: Growth, rounds, step size, depth or number of leaves, and the penalty of leaf values.
BOOSTERS = {"XGB": dict(growth="level", rounds=12, step=0.25, depth=4, leaves=16, penalty=1.0),
            "LGB": dict(growth="leaf", rounds=10, step=0.25, depth=6, leaves=8, penalty=1.0),
            "CB": dict(growth="symmetric", rounds=15, step=0.25, depth=3, leaves=8, penalty=1.0)}
MIN_GAIN, MIN_ROWS, SEED = 1e-9, 2, 7


@dataclass
class Tree:
    """Node 0 is the root; a row goes left where x[feature] <= threshold. Leaves have feature -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    value: list[list[float]] = field(default_factory=lambda: [[0.0]])

    def split(self, node: int, feature: int, threshold: float, gain: float, covers: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.threshold[node], self.gain[node] = feature, threshold, gain
        for side, cover in zip((self.left, self.right), covers):
            side[node] = len(self.feature)
            for name, x in (("feature", -1), ("threshold", 0.0), ("left", 0), ("right", 0), ("cover", float(cover)), ("gain", 0.0), ("value", self.value[node])):
                getattr(self, name).append(x)
        return self.left[node], self.right[node]

    def at(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of x (rows x features)."""
        node = np.zeros(len(x), np.min_scalar_type(len(self.feature)))
        kind, todo = node.dtype.type, [0]
        while todo:  # a node comes before its children, so a row is moved once a level
            i = todo.pop()
            f, left, right = self.feature[i], self.left[i], self.right[i]
            if f < 0:
                continue
            here = node == i
            low = here & (x[:, f] <= self.threshold[i])
            # unsigned, so that differences and sums come out right whatever the order of the numbers
            node += here * kind((right - i) % (1 << 8 * node.itemsize))
            node += low * kind((left - right) % (1 << 8 * node.itemsize))
            todo += [left, right]
        return node

    def with_cuts(self, cuts: list[np.ndarray]) -> Tree:
        """The same tree on values instead of bins."""
        threshold = [float(cuts[f][int(t)]) if f >= 0 else 0.0 for f, t in zip(self.feature, self.threshold)]
        return Tree(self.feature, threshold, self.left, self.right, self.cover, self.gain, self.value)


@dataclass
class Ensemble:
    """Sum of trees with vector leaves and a base; link: identity, logistic, softmax or mean (leaves are probabilities)."""

    trees: list[Tree]
    base: np.ndarray
    link: str

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.base, (len(x), 1))
        for t in self.trees:
            out += np.array(t.value)[t.at(x)]
        return out

    def outputs(self, x: np.ndarray) -> np.ndarray:
        """Predictions (one column) or probabilities of the classes."""
        return linked(self.margins(x), self.link)


def linked(margins: np.ndarray, link: str) -> np.ndarray:
    if link == "logistic":
        p = 1 / (1 + np.exp(-margins))
        return np.concatenate([1 - p, p], axis=1)
    if link == "softmax":
        e = np.exp(margins - margins.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)
    return margins


# --- binning ------------------------------------------------------------------------------------------------------

def feature_cuts(df: DataFrame, inputs: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Ascending thresholds of each feature: all values but the largest where they are few, else quantiles."""
    x = [F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in inputs]
    number = df.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(x)]).first()
    few = [number[i] <= bins // 2 for i in range(len(inputs))]  # the count is an estimate, so the sets stay bounded either way
    asked = [F.collect_set(c) if f else F.percentile_approx(c, [j / bins for j in range(1, bins)], 10_000) for c, f in zip(x, few)]
    found = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(asked)]).first()
    return [np.array(sorted(set(found[i] or ())), float)[:(-1 if f else None)][:bins - 1] for i, f in enumerate(few)]


def _bins(batches, cuts, n):
    for batch in batches:
        out = np.zeros((batch.num_rows, n), np.uint8)
        for i in range(n):
            x = batch.column(f"x{i}").to_numpy(zero_copy_only=False).astype(float)
            out[:, i] = np.searchsorted(cuts[i], x)  # NULL and NaN come last
        packed = pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer((np.arange(len(out) + 1) * n).astype(np.int32)), pa.py_buffer(out.tobytes())])
        yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("w"), batch.column("m"), packed], ["y", "w", "m", "bins"])


def binned(df: DataFrame, inputs: Sequence[str], label: str, weight: str | None, cuts: list[np.ndarray], base: np.ndarray) -> DataFrame:
    """(y, w, m, bins): label, weight, margins so far and one byte a feature; stored."""
    rows = df.select(F.col(label).cast("double").alias("y"), (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("w"),
                     F.array(*[F.lit(float(b)) for b in base]).alias("m"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)])
    n = len(inputs)
    return _stored(rows.mapInArrow(lambda batches: _bins(batches, cuts, n), "y double, w double, m array<double>, bins binary"))


def _stored(df: DataFrame) -> DataFrame:
    """The table, written once; a small one is read by few tasks, as every step of growing runs over it."""
    spark = df.sparkSession
    path = scratch_path(spark, "trees")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    return out.coalesce(max(1, -(-out.count() // ROWS_A_TASK)))


def _merged(table: DataFrame, classes: bool, base: np.ndarray) -> DataFrame:
    """Rows of the same bins as one row of their whole weight and mean label, where most rows are such; by class if labels are classes.

    No tree tells such rows apart, so they keep the same margins, and every sum over them is linear in the label.
    """
    keys = ["bins", "y"] if classes else ["bins"]
    n, cells = table.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*keys))).first()
    if n <= ROWS_A_TASK or cells * MERGED > n:
        return table
    w = F.sum("w")
    y = [] if classes else [F.when(w != 0, F.sum(F.col("w") * F.col("y")) / w).otherwise(0.0).alias("y")]
    m = F.array(*[F.lit(float(b)) for b in base]).alias("m")
    return _stored(table.groupBy(*keys).agg(w.alias("w"), *y).select("y", "w", m, "bins"))


def _arrays(batch, n: int, outputs: int):
    """(labels, weights, margins, bins) of a batch."""
    packed = batch.column("bins")
    _, starts, data = packed.buffers()
    first = np.frombuffer(starts, np.int32)[packed.offset] if batch.num_rows else 0
    # by feature, as trees and sums read one feature at a time
    bins = np.asfortranarray(np.frombuffer(data, np.uint8)[first:first + batch.num_rows * n].reshape(-1, n)) if batch.num_rows else np.zeros((0, n), np.uint8)
    m = batch.column("m").flatten().to_numpy().reshape(-1, outputs).copy()
    return batch.column("y").to_numpy(), batch.column("w").to_numpy(), m, bins


# --- boosting -----------------------------------------------------------------------------------------------------

def derivatives(y: np.ndarray, m: np.ndarray, link: str) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss by the margins (rows x outputs)."""
    if link == "identity":
        return m - y[:, None], np.ones_like(m)
    p = linked(m, link)
    if link == "logistic":
        return p[:, 1:] - y[:, None], p[:, 1:] * p[:, :1]
    return p - (np.arange(m.shape[1]) == y[:, None]), p * (1 - p)


def sums(table: DataFrame, n: int, link: str, outputs: int, trees: list[Tree], growing: list[Tree], active: list[list[int]]) -> dict[tuple[int, int], np.ndarray]:
    """(output, node) -> (features x bins x 3): sums of gradients, second derivatives and weights, over the rows of each active node."""
    slots = [(k, node) for k, nodes in enumerate(active) for node in nodes]

    def run(batches):
        total = np.zeros((len(slots), n, BINS, 3))
        for batch in batches:
            y, w, m, bins = _arrays(batch, n, outputs)
            for t in trees:
                m += np.array(t.value)[t.at(bins)]
            g, h = derivatives(y, m, link)
            for k, nodes in enumerate(active):
                if not nodes:
                    continue
                at = np.full(len(growing[k].feature), len(nodes))  # rows of other nodes go to one more slot
                at[nodes] = np.arange(len(nodes))
                place = at[growing[k].at(bins)] * BINS
                size, first = (len(nodes) + 1) * BINS, slots.index((k, nodes[0]))
                parts = (g[:, k] * w, h[:, k] * w, w)
                for f in range(n):
                    cell = place + bins[:, f]
                    for i, x in enumerate(parts):
                        total[first:first + len(nodes), f, :, i] += np.bincount(cell, x, size).reshape(-1, BINS)[:-1]
        s, f, b = np.nonzero(total[:, :, :, 2])
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (s, f, b)] + [pa.array(total[s, f, b, i]) for i in range(3)], ["s", "f", "b", "g", "h", "n"])

    found = table.mapInArrow(run, "s int, f int, b int, g double, h double, n double").groupBy("s", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
    out = np.zeros((len(slots), n, BINS, 3))
    for r in found.collect():  # nodes x features x bins
        out[r.s, r.f, r.b] = r.g, r.h, r.n
    return dict(zip(slots, out))


def gains(hist: np.ndarray, penalty: float) -> np.ndarray:
    """Second-order gain of each (feature, bin) threshold of a node; minus infinity where a side has too few rows."""
    low = hist.cumsum(1)[:, :-1]
    total = hist[:1].sum(1)[:, None]
    high = total - low

    def score(x):
        return x[..., 0] ** 2 / (x[..., 1] + penalty)
    out = score(low) + score(high) - score(total)
    return np.where((low[..., 2] >= MIN_ROWS) & (high[..., 2] >= MIN_ROWS), out, -np.inf)


def _grow(tree: Tree, node: int, hist: np.ndarray, f: int, b: int, gain: float, k: int, outputs: int, step: float, penalty: float) -> tuple[int, int]:
    """Split a node and give both children their values."""
    low, total = hist[f, :b + 1].sum(0), hist[f].sum(0)
    children = tree.split(node, f, b, gain, (low[2], total[2] - low[2]))
    for child, s in zip(children, (low, total - low)):
        tree.value[child] = [-step * s[0] / (s[1] + penalty) if i == k else 0.0 for i in range(outputs)]
    return children


def boost(df: DataFrame, inputs: Sequence[str], label: str, link: str, outputs: int, growth: str, rounds: int, step: float, depth: int, leaves: int,
          penalty: float, weight: str | None = None) -> Ensemble:
    """A boosted ensemble of the encoded rows; label: the number, or the number of the class."""
    n = len(inputs)
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    if link == "softmax":
        share = df.agg(*[(F.sum(F.when(F.col(label) == k, w)) / F.sum(w)).alias(f"s{k}") for k in range(outputs)]).first()
        base = np.log(np.clip([share[k] or 0.0 for k in range(outputs)], 1e-6, 1))
    else:
        mean = df.agg((F.sum(F.col(label) * w) / F.sum(w)).alias("m")).first()[0] or 0.0
        base = np.array([mean if link == "identity" else math.log(max(mean, 1e-6) / max(1 - mean, 1e-6))])
    cuts = feature_cuts(df, inputs)
    table = _merged(binned(df, inputs, label, weight, cuts, base), link == "softmax", base)
    trees, fresh = [], []
    for _ in range(rounds):
        if len(fresh) >= REBASE * outputs:
            table, fresh = _rebased(table, n, outputs, fresh), []
        growing = [Tree(value=[[0.0] * outputs]) for _ in range(outputs)]
        _ROUNDS[growth](lambda active: sums(table, n, link, outputs, fresh, growing, active), growing, outputs, step, depth, leaves, penalty)
        trees += growing
        fresh += growing
    return Ensemble([t.with_cuts(cuts) for t in trees], base, link)


def _rebased(table: DataFrame, n: int, outputs: int, trees: list[Tree]) -> DataFrame:
    """The table with the margins after the given trees."""
    def run(batches):
        for batch in batches:
            _, _, m, bins = _arrays(batch, n, outputs)
            for t in trees:
                m += np.array(t.value)[t.at(bins)]
            lists = pa.ListArray.from_arrays((np.arange(len(m) + 1) * outputs).astype(np.int32), pa.array(m.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("w"), lists, batch.column("bins")], ["y", "w", "m", "bins"])
    return _stored(table.mapInArrow(run, table.schema))


def _best(hist: np.ndarray, penalty: float) -> tuple[float, int, int]:
    g = gains(hist, penalty)
    at = np.unravel_index(int(g.argmax()), g.shape)
    return float(g[at]), int(at[0]), int(at[1])


def _level_round(ask, growing, outputs, step, depth, leaves, penalty):
    active = [[0] for _ in growing]
    for level in range(depth):
        hists, following = ask(active), [[] for _ in growing]
        for (k, node), hist in hists.items():
            if level == 0:
                growing[k].cover[0] = hist[0].sum(0)[2]
            gain, f, b = _best(hist, penalty)
            if gain > MIN_GAIN:
                following[k] += _grow(growing[k], node, hist, f, b, gain, k, outputs, step, penalty)
        active = following
        if not any(active):
            break


def _leaf_round(ask, growing, outputs, step, depth, leaves, penalty):
    active, known, size, levels = [[0] for _ in growing], [{} for _ in growing], [1] * len(growing), [{0: 0} for _ in growing]
    while True:
        for (k, node), hist in ask(active).items() if any(active) else ():
            if node == 0:
                growing[k].cover[0] = hist[0].sum(0)[2]
            known[k][node] = (*_best(hist, penalty), hist)
        active, done = [[] for _ in growing], True
        for k, tree in enumerate(growing):
            if size[k] >= leaves or not known[k]:
                continue
            node = max(known[k], key=lambda i: (known[k][i][0], -i))
            gain, f, b, hist = known[k].pop(node)
            if gain <= MIN_GAIN:
                known[k].clear()
                continue
            children = _grow(tree, node, hist, f, b, gain, k, outputs, step, penalty)
            levels[k] |= dict.fromkeys(children, levels[k][node] + 1)
            size[k], done = size[k] + 1, False
            active[k] = [c for c in children if levels[k][c] < depth] if size[k] < leaves else []
        if done:
            return


def _symmetric_round(ask, growing, outputs, step, depth, leaves, penalty):
    active = [[0] for _ in growing]
    for level in range(depth):
        hists, following = ask(active), [[] for _ in growing]
        for k, tree in enumerate(growing):
            own = {node: hists[k, node] for node in active[k]}
            if not own:
                continue
            if level == 0:
                tree.cover[0] = own[0][0].sum(0)[2]
            each = [np.where(np.isfinite(g := gains(h, penalty)), g, 0.0) for h in own.values()]
            total = np.sum(each, axis=0)
            f, b = np.unravel_index(int(total.argmax()), total.shape)
            if total[f, b] > MIN_GAIN:
                for (node, hist), g in zip(own.items(), each):
                    following[k] += _grow(tree, node, hist, int(f), int(b), float(g[f, b]), k, outputs, step, penalty)
        active = following
        if not any(active):
            break


_ROUNDS = {"level": _level_round, "leaf": _leaf_round, "symmetric": _symmetric_round}


def root_gains(df: DataFrame, inputs: Sequence[str], label: str, penalty: float = 1.0) -> DataFrame:
    """(feature, threshold, gain) of every first split of a squared-error booster."""
    cuts = feature_cuts(df, inputs)
    base = np.array([df.agg(F.avg(label)).first()[0]])
    hist = sums(binned(df, inputs, label, None, cuts, base), len(inputs), "identity", 1, [], [Tree()], [[0]])[0, 0]
    g = gains(hist, penalty)
    rows = [(c, float(t), float(g[i, b])) for i, c in enumerate(inputs) for b, t in enumerate(cuts[i]) if np.isfinite(g[i, b])]
    return df.sparkSession.createDataFrame(rows, "feature string, threshold double, gain double")


# --- ordered target statistics --------------------------------------------------------------------------------------

@dataclass
class TargetStatistics:
    """Encoding of string columns by smoothed means of the targets: of earlier rows in training, of all rows afterwards."""

    columns: list[str]
    targets: int
    totals: list[DataFrame]
    prior: list[float]

    @property
    def names(self) -> list[str]:
        return [f"_ots_{i}_{k}" for i in range(len(self.columns)) for k in range(self.targets)]

    def _encoded(self, df: DataFrame, lookups: list[DataFrame], keys: list[str]) -> DataFrame:
        for i, (c, look) in enumerate(zip(self.columns, lookups)):
            df = lookup_join(df.withColumn("_value", F.col(c).cast("string")), look, ["_value", *keys])
            for k in range(self.targets):
                df = df.withColumn(f"_ots_{i}_{k}", (F.coalesce(f"_s{k}", F.lit(0.0)) + SMOOTH * self.prior[k]) / (F.coalesce("_n", F.lit(0.0)) + SMOOTH))
            df = df.drop("_value", "_n", *[f"_s{k}" for k in range(self.targets)])
        return df

    def apply(self, df: DataFrame) -> DataFrame:
        return self._encoded(df, self.totals, [])


def _targets(label: str, outputs: int) -> list[Column]:
    return [F.col(label).cast("double")] if outputs == 1 else [(F.col(label) == k).cast("double") for k in range(outputs)]


def ordered_statistics(df: DataFrame, columns: Sequence[str], label: str, outputs: int, order: Sequence[str]) -> tuple[DataFrame, TargetStatistics]:
    """(df with the statistics of earlier blocks, statistics for other rows). order: columns whose hash puts rows into BLOCKS blocks.

    Counts by (value, block) are few whatever a value's share of the rows is; running totals go over BLOCKS rows a value.
    """
    targets = _targets(label, outputs)
    df = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(BLOCKS)))
    prior = df.agg(*[F.avg(t) for t in targets]).first()
    before = Window.partitionBy("_value").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    parts, totals = [], []
    names = ["_n", *[f"_s{k}" for k in range(len(targets))]]
    for c in columns:
        cells = cut_lineage(df.groupBy(F.col(c).cast("string").alias("_value"), "_block").agg(
            F.count(F.lit(1)).cast("double").alias("_n"), *[F.sum(t).alias(f"_s{k}") for k, t in enumerate(targets)]))
        parts.append(cells.select("_value", "_block", *[F.coalesce(F.sum(x).over(before), F.lit(0.0)).alias(x) for x in names]))
        totals.append(cut_lineage(cells.groupBy("_value").agg(*[F.sum(x).alias(x) for x in names])))
    out = TargetStatistics(list(columns), len(targets), totals, [p or 0.0 for p in prior])
    return out._encoded(df, parts, ["_block"]).drop("_block"), out


# --- extra trees ----------------------------------------------------------------------------------------------------

def drawn(tree: int, node: int, feature: int, low: int, high: int) -> int:
    """The threshold's bin of a node and feature: uniform on low .. high - 1, given by the seed and the three numbers."""
    return int(np.random.Generator(np.random.PCG64([SEED, tree, node, feature])).integers(low, high)) if high > low else -1


def extra_trees(df: DataFrame, inputs: Sequence[str], label: str, classes: int, trees: int = 20, depth: int = 5, weight: str | None = None) -> Ensemble:
    """Extremely randomised trees on all rows; classes 0 for a number. One aggregate per level for all trees."""
    n, outputs = len(inputs), max(1, classes)
    cuts = feature_cuts(df, inputs)
    table = _merged(binned(df, inputs, label, weight, cuts, np.zeros(1)), classes > 0, np.zeros(1))
    grown = [Tree(value=[[0.0] * outputs]) for _ in range(trees)]
    bounds = [{0: [(0, len(c)) for c in cuts]} for _ in range(trees)]
    active = [[0] for _ in range(trees)]
    for level in range(depth):
        slots = [(t, node, [drawn(t, node, f, *bounds[t][node][f]) for f in range(n)]) for t, nodes in enumerate(active) for node in nodes]
        low, total = _left_sums(table, n, classes, grown, slots)
        active = [[] for _ in range(trees)]
        for s, (t, node, threshold) in enumerate(slots):
            tree, whole = grown[t], total[s]
            if level == 0:
                tree.cover[0], tree.value[0] = whole[0], _leaf(whole, classes)
            gain = np.array([_purity(low[s, f], classes) + _purity(whole - low[s, f], classes) - _purity(whole, classes)
                             if threshold[f] >= 0 and min(low[s, f, 0], whole[0] - low[s, f, 0]) >= MIN_ROWS else -np.inf for f in range(n)])
            f = int(gain.argmax())
            if gain[f] <= MIN_GAIN:
                continue
            children = tree.split(node, f, threshold[f], float(gain[f]), (low[s, f, 0], whole[0] - low[s, f, 0]))
            for child, x, side in zip(children, (low[s, f], whole - low[s, f]), (0, 1)):
                tree.value[child] = _leaf(x, classes)
                a, b = bounds[t][node][f]
                bounds[t][child] = [*bounds[t][node][:f], (a, threshold[f]) if side == 0 else (threshold[f] + 1, b), *bounds[t][node][f + 1:]]
            active[t] += children
        if not any(active):
            break
    for tree in grown:
        tree.value = [[v / trees for v in x] for x in tree.value]
    return Ensemble([t.with_cuts(cuts) for t in grown], np.zeros(outputs), "mean" if classes else "identity")


def _leaf(x: np.ndarray, classes: int) -> list[float]:
    """Class shares, or the mean, from sums (weight, then weight by class or weighted target and its square)."""
    return (x[1:] / max(x[0], 1e-300)).tolist() if classes else [float(x[1] / max(x[0], 1e-300))]


def _purity(x: np.ndarray, classes: int) -> float:
    """What a split is to make large: sum of squared class weights, or squared target sum, by weight."""
    if x[0] <= 0:
        return 0.0
    return float((x[1:] ** 2).sum() / x[0]) if classes else float(x[1] ** 2 / x[0])


def _left_sums(table: DataFrame, n: int, classes: int, grown: list[Tree], slots):
    """Sums of the rows left of each node's thresholds (slots x features x sums) and of all its rows (slots x sums)."""
    width = 1 + max(1, classes)

    def run(batches):
        low, total = np.zeros((len(slots), n, width)), np.zeros((len(slots), width))
        for batch in batches:
            y, w, _, bins = _arrays(batch, n, 1)
            parts = [w] + ([w * (y == k) for k in range(classes)] if classes else [w * y])
            leaf = [t.at(bins) for t in grown]
            for s, (t, node, threshold) in enumerate(slots):
                rows = np.flatnonzero(leaf[t] == node)
                own = np.stack([p[rows] for p in parts], 1)
                total[s] += own.sum(0)
                low[s] += (bins[rows] <= np.array(threshold)).T.astype(float) @ own
        s = np.repeat(np.arange(len(slots)), n + 1)
        flat = np.concatenate([low, total[:, None]], 1).reshape(-1, width)
        yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(np.tile(np.arange(n + 1), len(slots)).astype(np.int32)),
                                          pa.ListArray.from_arrays((np.arange(len(flat) + 1) * width).astype(np.int32), pa.array(flat.ravel()))], ["s", "f", "x"])

    found = table.mapInArrow(run, "s int, f int, x array<double>").groupBy("s", "f").agg(*[F.sum(F.col("x")[i]).alias(f"x{i}") for i in range(width)])
    out = np.zeros((len(slots), n + 1, width))
    for r in found.collect():  # nodes of a level x features
        out[r.s, r.f] = [r[f"x{i}"] for i in range(width)]
    return out[:, :n], out[:, n]


# --- the fitted stage -------------------------------------------------------------------------------------------------

def inputs_array(inputs: Sequence[str]) -> Column:
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in inputs])


def rows_of(column) -> np.ndarray:
    return np.array(column.tolist(), float) if len(column) else np.zeros((0, 1))


class TreeStage:
    """A fitted ensemble as a pipeline of one stage: transform adds prediction (and probabilities _p for classes)."""

    def __init__(self, ensemble: Ensemble, inputs: Sequence[str], statistics: TargetStatistics | None = None):
        self.ensemble, self.inputs, self.statistics = ensemble, list(inputs), statistics

    @property
    def stages(self) -> list:
        return [self]

    @property
    def featureImportances(self):
        total = np.zeros(len(self.inputs))
        for t in self.ensemble.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    total[f] += g
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def encoded(self, df: DataFrame) -> DataFrame:
        return df if self.statistics is None else self.statistics.apply(df)

    def transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.ensemble)

        @F.pandas_udf("array<double>")
        def outputs(x: pd.Series) -> pd.Series:
            return pd.Series(list(shared.value.outputs(rows_of(x))))

        @F.pandas_udf("double")
        def number(*x: pd.Series) -> pd.Series:
            return pd.Series(shared.value.outputs(np.stack(x).T)[:, 0])  # by feature, as trees read one at a time

        if self.ensemble.link == "identity" and self.inputs:
            return self.encoded(df).withColumn("prediction", number(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in self.inputs]))
        out = self.encoded(df).withColumn("_out", outputs(inputs_array(self.inputs)))
        if self.ensemble.link == "identity":
            return out.withColumn("prediction", F.col("_out")[0]).drop("_out")
        best = F.array_position("_p", F.array_max("_p")) - 1
        return out.withColumnRenamed("_out", "_p").withColumn("prediction", best.cast("double"))


def fit_trees(df: DataFrame, inputs: Sequence[str], code: str, problem: str, n_classes: int, label: str = "_y", weight: str | None = None,
              strings: Sequence[str] = (), order: Sequence[str] = (), **settings) -> TreeStage:
    """Fit XGB, LGB, CB or ET on encoded rows. strings and order serve the ordered statistics of CB."""
    if code == "ET":
        return TreeStage(extra_trees(df, inputs, label, 0 if problem == "regression" else n_classes, weight=weight, **settings), inputs)
    link, outputs = ("identity", 1) if problem == "regression" else ("logistic", 1) if n_classes == 2 else ("softmax", n_classes)
    statistics = None
    if code == "CB" and strings:
        df, statistics = ordered_statistics(df, strings, label, outputs, order)
        inputs = [*inputs, *statistics.names]
    return TreeStage(boost(df, inputs, label, link, outputs, weight=weight, **{**BOOSTERS[code], **settings}), inputs, statistics)


# --- explanations -----------------------------------------------------------------------------------------------------

def leaf_paths(tree: Tree) -> list[tuple[int, list[tuple[int, float, float, float]]]]:
    """(leaf, [(feature, low, high, share)]): a row passes where low < x <= high; share: the part of the cover that goes this way."""
    out, stack = [], [(0, {})]
    while stack:
        node, path = stack.pop()
        f = tree.feature[node]
        if f < 0:
            out.append((node, [(k, *v) for k, v in path.items()]))
            continue
        low, high, share = path.get(f, (-math.inf, math.inf, 1.0))
        for child, bounds in ((tree.left[node], (low, min(high, tree.threshold[node]))), (tree.right[node], (max(low, tree.threshold[node]), high))):
            part = tree.cover[child] / tree.cover[node] if tree.cover[node] else 0.5
            stack.append((child, {**path, f: (*bounds, share * part)}))
    return out


def path_weights(shares: Sequence[float]) -> np.ndarray:
    """For every pattern of passed conditions (2 ** m) the Shapley values (m) of the game 'all pass', where a condition left open passes by its share."""
    m = len(shares)
    weight = [math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)]
    out = np.zeros((1 << m, m))
    for pattern in range(1 << m):
        passed = [float(pattern >> j & 1) for j in range(m)]
        for i in range(m):
            poly = np.ones(1)
            for j in range(m):
                if j != i:
                    poly = np.convolve(poly, [shares[j], passed[j]])
            out[pattern, i] = (passed[i] - shares[i]) * float(np.dot(poly, weight))
    return out


def shapley(ensemble: Ensemble, n: int, output: int):
    """(function of rows x features giving their contributions, base): exact path-dependent values of one margin; both add up to it."""
    leaves, base = [], float(ensemble.base[output])
    for tree in ensemble.trees:
        for leaf, path in leaf_paths(tree):
            v = tree.value[leaf][output]
            base += v * math.prod(p[3] for p in path)
            if path and v:
                leaves.append(([p[0] for p in path], np.array([p[1] for p in path]), np.array([p[2] for p in path]), v * path_weights([p[3] for p in path])))

    def run(x: np.ndarray) -> np.ndarray:
        x = np.where(np.isnan(x), np.inf, x)
        out = np.zeros((len(x), n))
        for features, low, high, table in leaves:
            own = x[:, features]
            passed = (own > low) & ((own <= high) | (high == np.inf))
            # a feature stands once in a path, so the columns are distinct
            out[:, features] += table[passed @ (1 << np.arange(len(features)))]
        return out
    return run, base


def from_spark(model, outputs: int) -> Ensemble:
    """A fitted decision tree or forest of Spark as an ensemble on its feature vector."""
    members = list(model.trees) if hasattr(model, "trees") else [model]
    regress = not hasattr(model, "numClasses")
    trees = []
    for m in members:
        tree, stack = Tree(), [(m._call_java("rootNode"), 0)]
        while stack:
            node, i = stack.pop()
            stats = node.impurityStats()
            tree.cover[i] = float(stats.count())
            if regress:
                tree.value[i] = [float(node.prediction()) / len(members)]
            else:
                counts = np.array(list(stats.stats()), float)
                tree.value[i] = (counts / counts.sum() / len(members)).tolist()
            if node.subtreeDepth() > 0:
                split = node.split()
                children = tree.split(i, split.featureIndex(), split.threshold(), max(0.0, float(node.gain())), (0.0, 0.0))
                stack += [(node.leftChild(), children[0]), (node.rightChild(), children[1])]
        trees.append(tree)
    return Ensemble(trees, np.zeros(1 if regress else outputs), "identity" if regress else "mean")
