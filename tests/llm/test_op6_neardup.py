import re

import pytest

from lumenfold.llm.op6_neardup import near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """{index: (n_shingles, component)} by comparing every two documents."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    post = {}
    for i, s in enumerate(sets):
        for x in s:
            post.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        seen = {}
        for x in s:
            for j in post[x]:
                if j < i:
                    seen[j] = seen.get(j, 0) + 1
        for j, both in seen.items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        for j in range(i):
            if d is not None and rows[j][0] == d:
                root[find(i)] = find(j)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return [(d, len(s), None if d is None else ids[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def got(df):
    return sorted([tuple(r)[:3] for r in df.collect()], key=str)


def test_whole_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = near_duplicates(docs)
    assert got(out) == sorted(brute(rows), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_edge_rows(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w59", "W59").replace("w3 ", "X ")
    chain = base.replace("w3 ", "X ").replace("w50 ", "y ")
    rows = [(9, base), (4, near), (7, base.upper()), (2, chain), (5, None), (6, ""), (1, "one two"), (8, "One  two"), (3, "\t\n "),
            (11, "x y z"), (11, "x y z"), (12, base + " tail"), (12, "quite other words stand here now"), (None, base)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as component_id", "1L as rep", "2 as band")
    assert got(near_duplicates(docs)) == sorted(brute(rows), key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert near_duplicates(docs).count() == 0


@pytest.mark.parametrize("size", [120])
def test_large_group_of_copies(spark, size):
    words = [f"t{i}" for i in range(200)]
    rows = [(i, " ".join(words[:i] + [f"v{i}"] + words[i + 1:])) for i in range(size)]
    assert {r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0}


def test_chain_of_versions(spark):
    """Successive versions of a page, each like the next only, ids descending, are one component."""
    words = [f"w{i}" for i in range(600)]
    rows = [(1000 - v, " ".join(words[2 * v:2 * v + 60])) for v in range(150)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {1000 - 149}
