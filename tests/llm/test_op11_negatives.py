import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.llm.op11_negatives import ORACLE, Codes, Queries, hard_negatives, intervals, op11, rotations


def brute(rows, is_anchor, positives=5, negatives=3):
    """rows: (id, label, vector) that take part, equal rows once."""
    width = max((len(v) for _, _, v in rows), default=0)
    own = [(i, label, [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (width - len(v))) for i, label, v in rows]
    out = []
    for a in own:
        if not is_anchor(a[0]):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in own if b is not a))
        for s, i, _ in [x for x in scored if x[2] == a[1]][:positives]:
            fits = [x for x in scored if x[2] != a[1] and -50 * s <= -100 * x[0] <= -95 * s][:negatives]
            out += [(a[0], i, n + 1, j, -s, -t) for n, (t, j, _) in enumerate(fits)]
    return sorted(out)


def got(df, condition=None, **options):
    condition = F.col("id") % 50 == 0 if condition is None else condition
    return sorted(tuple(r) for r in hard_negatives(df, condition, "vec_id", "label", "embedding", **options).collect())


def test_whole_small_table(spark, small):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 50 == 0)
    assert sorted(tuple(r) for r in op11(spark, small).collect()) == want and len(want) > 100


def test_sql_gives_the_same(spark, small):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    assert sorted(con.execute(ORACLE).fetchall()) == sorted(tuple(r) for r in op11(spark, small).collect())


@pytest.mark.parametrize("dim", [3, 64, 100])
def test_intervals_are_certain(dim):
    rng = np.random.default_rng(dim)
    v = np.concatenate([rng.integers(-200, 200, (300, dim)), np.zeros((1, dim), int), rng.integers(-1, 2, (50, dim)), np.full((1, dim), 10 ** 6)]).astype(np.int64)
    v = np.concatenate([v, v[:20] + rng.integers(-2, 3, (20, dim))])
    turns = rotations(dim)
    queries, codes = Queries(v, turns), Codes(v, turns)
    mid, half = intervals(queries, codes, np.arange(len(v)))
    score = v @ v.T
    assert (np.abs(score - mid) <= half).all()
    assert (codes.residual < 0.25 * codes.length + 1e-6).mean() > 0.9


def test_many_labels_blocks_ties_and_clusters(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(0, 0.3, (12, 20))
    rows = []
    for i in range(900):
        v = centers[i % 12] + (0 if i % 3 else rng.normal(0, 0.05, 20))  # exact copies make ties
        label = 0 if i % 2 else int(rng.integers(0, 200))
        rows.append((i * 5 + 3, label, [float(np.float32(x)) for x in v]))
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    for size in ((64, 40), (8192, 1024)):
        assert got(df, F.col("id") % 7 == 0, rows_a_block=size[0], anchors_a_block=size[1]) == brute(rows, lambda i: i % 7 == 0)


def test_edge_rows(spark):
    rows = [(50, 1, [1.0, 2.0]), (50, 1, [1.0, 2.0]), (100, 1, [1.0]), (1, 1, [1.0, 1.9]), (2, 2, [0.9, 1.7]), (3, 2, [0.5, 1.2]), (4, 3, []), (5, 3, [1.0, 1.5, 7.0]),
            (150, 9, [1.0, 1.0]), (50, 1, [1.5, 2.0]), (200, 4, [-1.0, -1.0]), (7, 4, [1.0, 1.0]), (250, 5, [0.0, 0.0]), (8, 5, [0.0]), (2, 2, [0.9, 1.75])]
    bad = [(None, 1, [1.0]), (300, None, [1.0]), (350, 1, None), (400, 1, [1.0, None]), (450, 1, [float("nan")]), (9, 2, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, label int, embedding array<float>").selectExpr("*", "1 as id", "2 as block", "3 as variant")
    assert got(df) == brute([r for i, r in enumerate(rows) if r not in rows[:i]], lambda i: i % 50 == 0)
    assert got(df.where("false")) == []
    assert got(df, F.lit(False)) == []
    with pytest.raises(Exception, match="too large"):
        got(spark.createDataFrame([(50, 1, [1e30]), (1, 1, [1.0])], "vec_id long, label int, embedding array<float>"))
