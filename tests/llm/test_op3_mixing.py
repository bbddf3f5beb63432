import math
from collections import Counter, defaultdict

from lumenfold.llm.op3_mixing import exponent, mix_documents, mixed, op3, token_rows


def test_small_table(spark, small):
    docs = {r.doc_id: (r.source, len(r.text.split())) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    out = op3(spark, small).collect()
    assert {r.doc_id for r in out} == set(docs)
    total, used = Counter(), Counter()
    for s, t in docs.values():
        total[s] += t
    for r in out:
        used[r.source] += r.tokens
    largest = max(t for _, t in docs.values())
    passes = {r.source: None for r in out}
    weight = {r.source: r.weight for r in out}
    least = min(weight[s] / total[s] for s in total)
    for s in passes:
        aim = weight[s] / total[s] / least
        assert 1 <= aim <= 2.001
        assert abs(used[s] - aim * total[s]) <= largest
    assert abs(sum(weight.values()) - 1) < 1e-6
    slots = defaultdict(list)
    for r in out:
        slots[r.block].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_targets(spark):
    share = spark.createDataFrame([(0.7,), (0.2,), (0.1,)], "share double")
    a = exponent(share, max_passes=2.0)
    assert abs((0.1 / 0.7) ** (a - 1) - 2.0) < 1e-4
    b = exponent(share, entropy=1.0)
    w = [p ** b for p in (0.7, 0.2, 0.1)]
    assert abs(-sum(x / sum(w) * math.log(x / sum(w)) for x in w) - 1.0) < 1e-4
    assert exponent(share, max_passes=100.0) == 0.0


def test_blocks_carry_the_weights(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 6}", "word " * (5 + i % 4)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixed(token_rows(docs), block_tokens=2000).collect()
    weight = {r.source: r.weight for r in out}
    per = defaultdict(Counter)
    for r in out:
        per[r.block][r.source] += r.tokens
    assert len(per) > 5
    for c in per.values():
        assert all(abs(c[s] / sum(c.values()) - w) < 0.03 for s, w in weight.items())


def test_edge_rows(spark):
    rows = [(1, None, "a b"), (2, "x", None), (2, "x", None), (3, "x", ""), (None, "y", "c d e f"), (4, "y", "g"), (4, "y", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 as copy", "2 as total", "3 as r", "4 as before")
    out = mix_documents(docs)
    assert out.columns == docs.columns
    assert {(r.doc_id, r.source, r.text) for r in out.collect()} == {tuple(r) for r in rows}
    assert mix_documents(docs.where("false")).count() == 0
    assert mix_documents(docs.where("source = 'x'")).count() == 3
