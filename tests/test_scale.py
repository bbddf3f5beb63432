"""Steps that grow with the tables: nothing of a vocabulary's size on the driver, stored inputs, small lookups, fast trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.functions import topk
from lumenfold.operators import features as E, textsim as X, train as M, trees as TR, wordvectors as W
from lumenfold.operators.roles import ColumnRoles
from lumenfold.plans import text_queries as TQ


def texts(spark, n=400):
    rng = np.random.default_rng(4)
    topics = [[f"sea{i}" for i in range(12)], [f"hill{i}" for i in range(12)]]
    rows = [(i, " ".join(rng.choice(topics[i % 2], 30))) for i in range(n)]
    return spark.createDataFrame([*rows, (n, ""), (n + 1, None), (n + 1, "sea1 sea1 once")], "id long, text string").repartition(4)


def test_word_vectors_in_a_table(spark, monkeypatch):
    """The mean of a text with the whole table broadcast, and with most words joined."""
    rows = texts(spark).withColumn("words", E.tokens("text"))
    for most in (200_000, 5):
        monkeypatch.setattr(W, "BROADCAST_ROWS", most)
        monkeypatch.setattr(W, "WORDS_A_MODEL", 20 if most == 5 else 200_000)
        model = W.fit_word_vectors(rows, "words", 6, max_iter=30)
        table = {r["term"]: (r["n"], np.array(r["vector"])) for r in model.table.collect()}
        assert len(table) == 25 and sum(n for n, _ in table.values()) == 400 * 30 + 3 and len(model.frequent.value[0]) == (25 if most > 5 else 5 if model.least == 0 else len(model.frequent.value[0])) <= most
        got = model.mean(rows, "words", "v").collect()
        assert len(got) == 403
        for r in got:
            want = np.mean([table[w][1] for w in r["words"]], 0) if r["words"] else np.zeros(6)
            assert np.allclose(r["v"], want)
        unit = {w: v / np.linalg.norm(v) for w, (_, v) in table.items()}
        near = np.mean([unit["sea1"] @ unit[f"sea{i}"] for i in range(2, 12)])
        assert near > np.mean([unit["sea1"] @ unit[f"hill{i}"] for i in range(12)]) + 0.2


def test_rare_terms_are_joined(spark, monkeypatch):
    counts = spark.createDataFrame([(d, f"t{t}", 1 + d % 3) for d in range(40) for t in range(12) if d % (t + 1) == 0], "d long, term string, tf long")
    vocab = E.vocabulary(counts, F.lit(40))
    want = sorted(map(tuple, E.weigh_terms(counts, "d", vocab).collect()))
    monkeypatch.setattr(E, "BROADCAST_ROWS", 3)
    few = E.weigh_terms(counts, "d", vocab)
    assert sorted(map(tuple, few.collect())) == want and len(want) == counts.count()


def test_vectors_from_packed_counts(spark, monkeypatch):
    """The same vectors as from long counts, with all terms sent to the tasks and with most of them joined; counts shuffle nothing."""
    rows = [(i, " ".join(f"t{j}" for j in range(12) if i % (j + 1) == 0 for _ in range(1 + i % 3))) for i in range(60)]
    docs = spark.createDataFrame([*rows, (60, ""), (61, None), (62, "t0")], "d long, text string").repartition(3).withColumn("words", E.tokens("text"))
    vocab = X.cut_lineage(E.vocabulary(E.term_counts(docs, "d", "words"), F.lit(63)))
    want = {r["d"]: r["vector"] for r in X.tfidf_vectors(E.term_counts(docs, "d", "words"), "d", vocab).collect()}
    packed = X.packed_counts(docs, "d", "words")
    assert packed.count() == 61 and packed.inputFiles()
    for most in (200_000, 3):
        monkeypatch.setattr(E, "BROADCAST_ROWS", most)
        monkeypatch.setattr(X, "BROADCAST_ROWS", most)
        got = X.packed_vectors(packed, "d", vocab)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        got = {r["d"]: r["vector"] for r in got.collect()}
        assert got.keys() == want.keys()
        for d, v in got.items():
            assert v["terms"] == want[d]["terms"] and np.allclose(v["weights"], want[d]["weights"])


def test_few_queries_meet_items_where_they_stand(spark):
    """Sparse items of a catalogue are neither shuffled nor stored for a few queries; ids that come twice go the other way, with the same rows."""
    rng = np.random.default_rng(14)
    texts = [(i, " ".join(f"w{x}" for x in rng.integers(0, 30, 12))) for i in range(300)]
    items = spark.createDataFrame(texts, "item long, text string").repartition(4)
    queries = spark.createDataFrame(texts[::25], "id long, text string")
    qs, its = X.embed(queries, items, "id", "item", "text", "text")
    found = X.search_cluster_pruning(qs, its, 5, "id", "item")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "RepartitionByExpression" not in plan
    want = X.search_cluster_pruning(qs, X.cut_lineage(its), 5, "id", "item")
    unique = X._unique
    try:
        X._unique = lambda *_: False
        old = sorted(map(tuple, X.search_cluster_pruning(qs, its, 5, "id", "item").collect()))
    finally:
        X._unique = unique
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) == old and len(old) == 60


def test_documents_are_searched_once(spark, small):
    assert TQ.query_rows(spark, small).inputFiles() == []


def test_folds_are_stored_once(spark, tmp_path):
    spark.range(90).selectExpr("id", "id % 7 * 1.0D AS a", "id % 7 * 2.0D AS t").write.parquet(str(tmp_path / "t"))
    out = M.cross_validation(spark.read.parquet(str(tmp_path / "t")), ColumnRoles(target="t", id="id"), "regression", "LR", 3)
    assert out.inputFiles() == [] and out.count() == 90


def test_searches_ask_every_fiftieth_row(spark, small):
    queries, items = TQ.asked_pair(spark, small)
    assert queries.where("vec_id % 50 <> 0").count() == 0 and items.count() == TQ.table(spark, small, "embeddings").count()


def test_leaves_by_feature():
    """Leaves as by walking down from the root, whatever the order of the nodes, and the type that keeps them small."""
    rng = np.random.default_rng(2)
    tree, leaves = TR.Tree(), [0]
    for _ in range(120):
        node = leaves.pop(int(rng.integers(len(leaves))))
        leaves += tree.split(node, int(rng.integers(3)), float(rng.integers(64)), 1.0, (1, 1))
    tree.left, tree.right = tree.right, tree.left
    x = np.asfortranarray(rng.integers(0, 65, (500, 3)).astype(np.uint8))
    got = tree.at(x)
    for row, leaf in zip(x, got):
        i = 0
        while tree.feature[i] >= 0:
            i = tree.left[i] if row[tree.feature[i]] <= tree.threshold[i] else tree.right[i]
        assert leaf == i
    assert got.dtype == np.uint8


def test_cells_copy_no_vectors(spark, monkeypatch):
    """Four crowded cells, two of them asked by each query: no vector is shuffled to a cell, and the k best are those of plain numpy."""
    monkeypatch.setattr(topk, "CELL_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(8)
    v, u = rng.normal(size=(300, 6)), rng.normal(size=(90, 6))
    cells = np.where(np.arange(300) < 200, 0, np.arange(300) % 4)
    items = spark.createDataFrame([(int(c), i, x.tolist()) for i, (c, x) in enumerate(zip(cells, v))], "b long, i long, v array<double>")
    lists = spark.createDataFrame([(i, x.tolist(), [i % 4, (i + 1) % 4]) for i, x in enumerate(u)], "q long, v array<double>, bs array<long>")
    found = topk.celled_topk(X._cells_of(topk.dealt(lists)), items, 5, False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    got = {}
    for r in topk.finish(found, 5).orderBy("q", "rank").collect():
        got.setdefault(r["q"], []).append(r["i"])
    for q, x in enumerate(u):
        own = np.flatnonzero((cells == q % 4) | (cells == (q + 1) % 4))
        assert got[q] == own[np.argsort(-(v[own] @ x))[:5]].tolist()


def test_rows_met_in_several_cells_count_once(spark):
    items = spark.createDataFrame([(b, i, [float(i), 1.0]) for b in (0, 1, 2) for i in range(6)], "b long, i long, v array<double>")
    lists = spark.createDataFrame([(7, [1.0, 0.0], [0, 1, 2])], "q long, v array<double>, bs array<long>")
    found = topk.celled_topk(X._cells_of(lists), items, 3, False).groupBy("q", "i").agg(F.max("score").alias("score"))
    assert [(r["i"], r["score"]) for r in topk.finish(found, 3).orderBy("rank").collect()] == [(5, 5.0), (4, 4.0), (3, 3.0)]
    with pytest.raises(Exception, match="a query has no vector"):
        topk.celled_topk(X._cells_of(lists.withColumn("v", F.lit(None).cast("array<double>"))), items, 3, False)


def test_nearest_lists_rank_as_the_exact_search(spark, monkeypatch):
    """Ids that come twice share one list, as in the exact search; centres too many to share go the other way."""
    rng = np.random.default_rng(9)
    rows = spark.createDataFrame([(i % 50, x.tolist()) for i, x in enumerate(rng.normal(size=(60, 4)))], "id long, vector array<double>")
    centres = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(12, 4)))], "centre long, vector array<double>")
    want = {}
    for r in topk.exact_topk(rows, centres, 5, "id", "centre").orderBy("id", "rank").collect():
        want.setdefault(r["id"], []).append(r["centre"])
    assert {r["id"]: r["bs"] for r in topk.nearest_lists(rows, centres, 5, "id", "centre").collect()} == want
    monkeypatch.setattr(topk, "SHARED_ITEMS", 3)
    assert {r["id"]: sorted(r["bs"]) for r in topk.nearest_lists(rows, centres, 5, "id", "centre").collect()} == {k: sorted(v) for k, v in want.items()}


def test_few_pairs_are_scored_twice(spark, monkeypatch):
    """Of all pairs only those near a query's k best come to double precision, and the k best are those of plain numpy, ties by id."""
    import pickle
    rng = np.random.default_rng(11)
    v, u = rng.normal(size=(6000, 16)), rng.normal(size=(200, 16))
    v[5000:5040] = v[:40]
    u[:40] = v[:40]
    done = []
    plain = topk._dots
    monkeypatch.setattr(topk, "_dots", lambda a, b: done.append(len(a)) or plain(a, b))
    block = topk.Asked(pickle.dumps((np.arange(200), u, np.array([0]), np.array([0, 200]), np.arange(200, dtype=np.int32))), 5, False)
    ids = rng.permutation(6000)
    for s in range(0, 6000, 500):
        block.meet(np.zeros(500, int), ids[s:s + 500], v[ids[s:s + 500]])
    got = block.frame(["q", "i", "score"])
    scores = np.round(u @ v.T, 9)
    for q in range(200):
        best = np.lexsort((np.arange(6000), -scores[q]))[:5]
        own = got[got["q"] == q]
        assert own["i"].tolist() == best.tolist() and np.allclose(own["score"], scores[q, best])
    assert sum(done) < 0.02 * 200 * 6000


def test_long_and_odd_vectors(spark):
    """Numbers beyond single precision are compared in double precision; an item without a score is nobody's match."""
    import pickle
    u = np.array([[1e30, 0.0], [0.0, 1.0]])
    v = np.array([[1e30, 0.0], [2e30, 1.0], [np.nan, 3.0], [0.0, 5.0]])
    block = topk.Asked(pickle.dumps((np.arange(2), u, np.array([0]), np.array([0, 2]), np.arange(2, dtype=np.int32))), 2, False)
    block.meet(np.zeros(4, int), np.arange(4), v)
    assert block.frame(["q", "i", "score"]).groupby("q")["i"].apply(list).to_dict() == {0: [1, 0], 1: [3, 1]}


def test_items_need_no_flips(spark, monkeypatch):
    """Items lie in their own buckets, so flips are worked out for queries only, for some rows at a time."""
    rng = np.random.default_rng(12)
    for bits, most in ((5, 7), (6, 1), (4, 16)):
        margins = rng.integers(-3, 4, (300, bits)).astype(float)  # ties
        sets = np.array([sum(1 << i for i in c) for n in range(min(X.MAX_FLIPS, bits) + 1) for c in X.combinations(range(bits), n)])
        cost = np.square(margins) @ (sets[:, None] >> np.arange(bits) & 1).astype(float).T
        assert (X.flips(margins, bits, most) == sets[np.argsort(cost, axis=1, kind="stable")[:, :most]]).all()
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(50, 6)))], "id long, vector array<double>").repartition(1)
    items = rows.withColumnRenamed("id", "item")
    want = [tuple(r) for r in X.search_lsh(rows, items, 3, "id", "item", bits=3, probes=1).orderBy("id", "rank").collect()]

    def none(*_):
        raise AssertionError("flips for rows that visit one bucket")
    monkeypatch.setattr(X, "flips", none)
    monkeypatch.setattr(X, "FLIP_ROWS", 7)
    got = [tuple(r) for r in X.search_lsh(rows, items, 3, "id", "item", bits=3, probes=1).orderBy("id", "rank").collect()]
    assert got == want and len(want) == 150


def test_items_that_come_twice_take_one_place(spark):
    rng = np.random.default_rng(15)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(80, 6)))], "id long, vector array<double>").repartition(1)
    items = rows.withColumnRenamed("id", "item")
    want, got = (sorted(map(tuple, X.search_lsh(rows, its, 4, "id", "item", bits=3, probes=3).collect())) for its in (items, items.union(items).union(items)))
    assert got == want and len(want) == 320


def test_coded_search_reaches_its_recall(spark, monkeypatch):
    """Without clusters the codes leave more than rerank * k candidates; no vector is joined to the pairs, and keys that come twice still work."""
    rng = np.random.default_rng(13)
    v = rng.normal(size=(1500, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vector array<double>").repartition(4).cache()
    want = np.argsort(-(v @ v.T), axis=1)[:, :5]
    items = df.withColumnRenamed("id", "item")
    for rerank in (3, 300):  # 15 candidates are too few; 1500 are all items
        found = X.search_ivf_pq(df, items, 5, "id", "item", nlist=4, slices=4, codes=4, rerank=rerank)
        assert "vector" not in found._jdf.queryExecution().optimizedPlan().toString()
        got = {}
        for r in found.orderBy("id", "rank").collect():
            got.setdefault(r["id"], []).append(r["item"])
        assert np.mean([len(set(got[q]) & set(want[q].tolist())) / 5 for q in range(1500)]) >= 0.9
    few = df.where("id < 60")
    twice = X.search_ivf_pq(few.union(few.where("id < 2")), few.withColumnRenamed("id", "item"), 5, "id", "item", nlist=2, slices=4, codes=4)
    assert twice.count() == 300
