import corpus_pipeline
from lumenfold.llm.common import stored
from tests.llm.test_op2_quality import brute as quality
from tests.llm.test_op6_neardup import brute as groups
from tests.llm.test_op7_decontaminate import brute as overlaps


def test_stages_on_small_table(spark, small):
    """The filtering stages against brute force, each on its own input; the last two keep every row."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, small), name)
        seen[name] = ({r.doc_id: r.text for r in docs.collect()}, [r.asDict() for r in out.collect()])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out
    before, after = seen["quality_rules"]
    assert {r["doc_id"] for r in after} == {d for d, t in before.items() if quality(t)[-1]}
    before, after = seen["near_dedup"]
    assert {r["doc_id"] for r in after} == {d for d, _, c in groups(list(before.items())) if d == c}
    before, after = seen["decontamination"]
    rows = list(before.items())
    gone = set(before) - {r["doc_id"] for r in after}
    want = {d for (d, _), hit in zip(rows, overlaps(rows, items)) if hit}
    assert gone <= want and len(gone) >= 0.95 * len(want)
    before, after = seen["source_mixing"]
    assert {r["doc_id"] for r in after} == set(before)
    assert len(seen["sharding"][1]) == len(after)
    assert {r["shard"] for r in seen["sharding"][1]} == set(range(16))


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "source_mixing", "sharding"]
