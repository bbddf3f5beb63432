import hashlib
import re

from lumenfold.llm.op9_substrings import remove_repeats


def brute(rows):
    first, words = {}, []
    for d, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        words.append(w)
        for i in range(len(w) - 49):
            if d is not None:
                key = tuple(w[i:i + 50])
                first[key] = min(first.get(key, d), d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - 49):
            if d is not None and first[tuple(w[i:i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(docs):
    return sorted([tuple(r) for r in remove_repeats(docs).collect()], key=str)


def test_whole_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert got(docs) == want
    assert sum(r[2] for r in want) > 0


def test_edge_rows(spark):
    a = [f"w{i}" for i in range(140)]
    loop = ["again"] * 130
    rows = [(5, " ".join(a)), (9, " ".join(["x"] + a[20:90] + ["é "])), (3, "\n".join(a[60:111])), (7, " ".join(a)), (7, " ".join(a[:55])),
            (4, " ".join(loop)), (6, " ".join(["z"] + loop[:60])), (1, None), (2, ""), (8, " \t"), (None, " ".join(a)), (11, " ".join(a[:49])),
            (12, " ".join(a)), (12, " ".join(a))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as runs", "'s' as spans", "2L as text_hash")
    assert got(docs) == brute(rows)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []
