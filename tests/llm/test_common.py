import numpy as np
import pytest

from lumenfold.llm.common import components, fresh


def order(kind, n):
    return {"ascending": np.arange(n), "descending": np.arange(n)[::-1], "random": np.random.default_rng(1).permutation(n),
            "zigzag": np.column_stack([np.arange(n // 2), n - 1 - np.arange(n // 2)]).ravel()}[kind]


@pytest.mark.parametrize("kind", ["descending", "random", "zigzag"])
def test_long_chains(spark, kind):
    ids = order(kind, 2000) + 10
    edges = spark.createDataFrame([(int(a), int(b)) for a, b in zip(ids, ids[1:])], "a long, b long")
    assert {r.component for r in components(edges).collect()} == {10}


def test_random_graph(spark):
    rng = np.random.default_rng(4)
    pairs = rng.integers(0, 400, (330, 2))
    label = np.arange(400)
    for _ in range(400):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    edges = spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {int(n): int(label[n]) for p in pairs if p[0] != p[1] for n in p}
    assert components(edges.where("false")).count() == 0


def test_free_names(spark):
    assert fresh(spark.createDataFrame([], "x int, X_ int"), "x") == "x__"
