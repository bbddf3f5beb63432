"""Running totals, percentiles, hot-key joins and top-k against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.functions import topk
from lumenfold.functions.hashing import hash_share
from lumenfold.functions.ranking import exact_percentiles, prefix_sums, weighted_median
from lumenfold.functions.skew import hot_key_join, lookup_join
from lumenfold.operators import textsim as X
from lumenfold.operators.joins import derivation_range_join, join_logged, row_numbers
from lumenfold.session import cut_lineage


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one score; the rest crowd into a narrow range; two NULLs."""
    rng = np.random.default_rng(3)
    scores = [0.5] * 1000 + list(0.1 + rng.random(1900) * 1e-6) + list(rng.random(100)) + [None, None]
    rows = [(float(s) if s is not None else None, "ab"[i % 2]) for i, s in enumerate(scores)]
    return rows, spark.createDataFrame(rows, "x double, g string").repartition(5).cache()


def test_prefix_sums_under_skew(skewed):
    rows, df = skewed
    got = {(r["g"], r["score"]): r for r in prefix_sums(df, F.col("x"), {"n": F.lit(1)}, ["g"]).collect()}
    for g in "ab":
        mine = np.array([x for x, h in rows if h == g and x is not None])
        for v in np.unique(mine):
            r = got.pop((g, v))
            assert (r["n"], r["n_below"], r["n_total"]) == ((mine == v).sum(), (mine < v).sum(), len(mine))
    assert not got


def test_exact_percentiles(skewed):
    rows, df = skewed
    probs = [0.0, 0.01, 0.37, 0.5, 0.9, 1.0]
    for r in exact_percentiles(df, F.col("x"), probs, ["g"]).collect():
        mine = [x for x, h in rows if h == r["g"] and x is not None]
        assert np.allclose([r[f"q_{i}"] for i in range(len(probs))], np.quantile(mine, probs), atol=1e-12)


def test_weighted_median(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 1.0), (10.0, 1.0)], "x double, w double")
    assert weighted_median(df, F.col("x"), F.col("w")).first()[0] == 2.5
    assert weighted_median(df, F.col("x"), F.when(F.col("x") == 10, 9.0).otherwise(F.col("w"))).first()[0] == 10.0


def test_hot_key_join_equals_plain_join(spark):
    left = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
                                    .otherwise(F.col("id") % 97 + 100).alias("k"), "id")
    right = spark.range(0, 150).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "inner"):
        want = sorted(left.join(right, "k", how).select("id", "v").collect())
        assert sorted(hot_key_join(left, right, ["k"], how).select("id", "v").collect()) == want
        assert sorted(lookup_join(left, right, ["k"], how).select("id", "v").collect()) == want
        assert sorted(lookup_join(left, right, ["k"], how, max_rows=10).select("id", "v").collect()) == want


def test_hash_share_is_even(spark):
    r = spark.range(5000).select(hash_share("id").alias("h")).agg(F.min("h"), F.max("h"), F.avg("h")).first()
    assert 0 <= r[0] and r[1] < 1 and abs(r[2] - 0.5) < 0.02


def test_row_numbers_follow_file_order(spark, tmp_path):
    spark.range(0, 1000, 1, 7).write.parquet(str(tmp_path / "t"))
    out = row_numbers(spark.read.parquet(str(tmp_path / "t"))).orderBy("row").collect()
    assert [r["row"] for r in out] == list(range(1000))


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_positions_of_unequal_files(spark, tmp_path, kind):
    """Row i of one table meets row i of the other, however their files are cut and packed into partitions."""
    cuts = {"left": [0, 40, 4000, 4100, 12000], "right": [0, 7000, 7001, 7900, 7950, 8000, 12000]}
    for side, at in cuts.items():
        for i, (a, b) in enumerate(zip(at, at[1:])):
            folder = str(tmp_path / side)
            part = spark.range(a, b, 1, 1).select(F.col("id").alias(side), F.lit("x" * (i % 3)).alias(f"pad_{side}"))
            getattr(part.write.mode("append"), kind)(f"{folder}-{i}")
    read = {side: spark.read.schema(f"{side} long, pad_{side} string").format(kind).load([str(tmp_path / f"{side}-{i}") for i in range(len(at) - 1)])
            for side, at in cuts.items()}
    out = join_logged(read["left"], read["right"])
    assert out.columns == ["row", "left", "pad_left", "right", "pad_right"]
    assert out.count() == 12000 and out.where("left <> right or left <> row").count() == 0


def test_large_csv_is_numbered_over_its_blocks(spark, tmp_path):
    spark.range(0, 30000, 1, 1).select("id", F.lit("y" * 40).alias("t")).write.csv(str(tmp_path / "c"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = spark.read.schema("id long, t string").csv(str(tmp_path / "c"))
        out = row_numbers(df)
        assert df.rdd.getNumPartitions() > 4 and out.where("row <> id").count() == 0 and out.count() == 30000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_positions_need_files(spark):
    with pytest.raises(ValueError, match="read from files"):
        row_numbers(spark.range(5))
    with pytest.raises(ValueError, match="read from files"):
        row_numbers(spark.range(5).groupBy("id").count())


def test_range_join_keeps_window(spark):
    s = spark.createDataFrame([("a", t, float(t)) for t in (0, 1, 2, 5)], "g string, step int, v double")
    got = {(r["t"], r["offset"], r["v_past"]) for r in derivation_range_join(s, ["g"], "step", "v", -3, -1).collect()}
    assert got == {(1, -1, 0.0), (2, -2, 0.0), (2, -1, 1.0), (5, -3, 2.0)}


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12)) * 3
    points = np.concatenate([centres[i % 6] + rng.normal(size=12) for i in range(400)]).reshape(400, 12)
    points[50] = points[51]
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, e array<double>")
    return points / np.linalg.norm(points, axis=1, keepdims=True), cut_lineage(X.dense_vectors(df, "id", "e"))


def brute(unit, k):
    scores = np.round(unit @ unit.T, 9)
    return {q: [int(i) for i in np.lexsort((np.arange(len(unit)), -scores[q]))[:k]] for q in range(len(unit))}


def as_lists(found):
    out = {}
    for r in found.orderBy("id", "rank").collect():
        out.setdefault(r["id"], []).append(r["item"])
    return out


def test_topk_three_ways(vectors, monkeypatch):
    unit, df = vectors
    items = df.withColumnRenamed("id", "item")
    want = brute(unit, 5)
    assert as_lists(topk.exact_topk(df, items, 5, "id", "item")) == want
    monkeypatch.setattr(topk, "CELL_ROWS", 70)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 30)
    monkeypatch.setattr(topk, "SHARED_ITEMS", 90)
    assert as_lists(topk.exact_topk(df, items, 5, "id", "item")) == want  # too many rows to share: grid
    few = items.where("item < 80")
    got = as_lists(topk.exact_topk(df, few, 5, "id", "item"))
    scores = np.round(unit @ unit[:80].T, 9)
    assert got == {q: [int(i) for i in np.lexsort((np.arange(80), -scores[q]))[:5]] for q in range(400)}


def test_sparse_topk_matches_dense(spark):
    rows = [(1, ["a", "b"], [0.6, 0.8]), (2, ["b"], [1.0]), (3, ["c"], [1.0])]
    df = spark.createDataFrame(rows, "id bigint, terms array<string>, weights array<double>") \
        .select("id", F.struct("terms", "weights").alias("vector"))
    got = [(r["id"], r["item"], r["score"]) for r in
           X.search_brute_force(df, df.withColumnRenamed("id", "item"), 2, "id", "item").orderBy("id", "rank").collect()]
    assert got == [(1, 1, 1.0), (1, 2, 0.8), (2, 2, 1.0), (2, 1, 0.8), (3, 3, 1.0)]


@pytest.mark.parametrize("search,bound", [("cluster_pruning", 0.6), ("ivf_opq", 0.6), ("hkm", 0.6), ("lsh", 0.6)])
def test_approximate_search_recall(vectors, search, bound, monkeypatch):
    unit, df = vectors
    monkeypatch.setattr(topk, "CELL_ROWS", 60)  # hot cells are cut up
    want = brute(unit, 10)
    got = as_lists(X.SEARCH_FUNCTIONS[search](df, df.withColumnRenamed("id", "item"), 10, "id", "item"))
    recall = np.mean([len(set(got.get(q, [])) & set(w)) / 10 for q, w in want.items()])
    assert recall >= bound
    assert all(len(set(v)) == len(v) <= 10 for v in got.values())


def test_flips_come_by_cost():
    rng = np.random.default_rng(1)
    for row in rng.normal(size=(20, 5)):
        got = X.flips(row[None], 5, 20)[0].tolist()
        cost = {s: sum(row[i] ** 2 for i in range(5) if s >> i & 1) for s in range(32) if bin(s).count("1") <= X.MAX_FLIPS}
        assert len(set(got)) == 20 and got[0] == 0 and [cost[s] for s in got] == sorted(cost.values())[:20]


def test_work_grows_less_than_squared(spark, monkeypatch):
    """Compared pairs of clustered vectors from n to 4 n, and the recall of both."""
    rng = np.random.default_rng(6)
    counted = {}
    plain = topk.celled_topk

    def counting(q, i, k, sparse):
        both = q.groupBy("b").agg(F.count(F.lit(1)).alias("n")).join(i.groupBy("b").agg(F.count(F.lit(1)).alias("m")), "b")
        counted[name, size] = both.agg(F.sum(F.col("n") * F.col("m"))).first()[0]
        return plain(q, i, k, sparse)
    monkeypatch.setattr(X, "celled_topk", counting)
    for size in (400, 1600):
        centres = rng.normal(size=(round(size ** 0.5), 12)) * 3
        v = centres[rng.integers(0, len(centres), size)] + rng.normal(size=(size, 12)) * 0.6
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vector array<double>").cache()
        want = np.argsort(-(v @ v.T), axis=1)[:, :10]
        for name in ("hkm", "lsh"):
            got = as_lists(X.SEARCH_FUNCTIONS[name](df, df.withColumnRenamed("id", "item"), 10, "id", "item"))
            assert np.mean([len(set(got.get(q, [])) & set(want[q].tolist())) / 10 for q in range(size)]) >= 0.88
    for name in ("hkm", "lsh"):
        assert counted[name, 1600] < 10 * counted[name, 400] and counted[name, 1600] < 0.5 * 1600 ** 2 * (8 if name == "lsh" else 1)


def test_search_arguments(vectors):
    _, df = vectors
    for k in (0, -1, 2.5, True):
        with pytest.raises(ValueError):
            X.similarity_predict(df, df, "id", "id", "e", "e", k=k)
    sparse = df.select("id", F.struct(F.array(F.lit("a")).alias("terms"), F.array(F.lit(1.0)).alias("weights")).alias("vector"))
    with pytest.raises(ValueError):
        X.search_lsh(sparse, sparse, 3, "id", "id")


def test_null_keys_are_kept_apart(spark, monkeypatch):
    from lumenfold.functions import skew
    left = spark.range(6000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN id % 5 WHEN id % 3 = 1 THEN 7 END AS k")
    right = spark.createDataFrame([(0, "a"), (7, "h"), (None, "n")], "k long, v string")
    got = skew.hot_key_join(left, right, ["k"]).groupBy("k", "v").count().collect()
    assert {(r.k, r.v): r["count"] for r in got} == {(0, "a"): 400, (7, "h"): 2000, (None, None): 2000, **{(i, None): 400 for i in range(1, 5)}}
    assert skew.hot_key_join(left, right, ["k"], "inner").count() == 2400


def test_one_vector_per_row(spark):
    from lumenfold.operators import features as E
    df = spark.range(100).selectExpr("id", "CASE WHEN id % 10 > 0 THEN 1.0D * id END AS a", "CASE WHEN id % 7 > 0 THEN id * 0.5D ELSE double('NaN') END AS b")
    assert E.pca(df, ["a", "b"]).count() == 100 == E.kmean(df, ["a", "b"], 2).count()
    assert E.pca(df, ["a", "b"]).columns == ["id", "a", "b", "pca"]
