import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from lumenfold.llm.op7_decontaminate import LEAST, MASKS, clean_rows, decontaminate, op7, overlaps

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def brute(docs, items):
    """Item ids of each document: every item is laid over it at every offset with the equal words that any overlap needs."""
    code = {}
    ids = [(i, np.array([code.setdefault(w, len(code)) for w in split(t)])) for i, t in items]
    out = []
    for _, text in docs:
        d = np.array([code.setdefault(w, len(code)) for w in split(text)])
        place = {}
        for j, w in enumerate(d.tolist()):
            place.setdefault(w, []).append(j)
        hit = set()
        for i, t in ids:
            equal = Counter(j - k for k, w in enumerate(t.tolist()) for j in place.get(w, ()))
            if any(overlaps(t, d, o) for o, n in equal.items() if n >= min(7, len(t))):
                hit.add(i)
        out.append(hit)
    return out


def test_recall_on_small_table(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").where("n_chars < 4000").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = {d: w for (d, _), w in zip(docs, brute(docs, items))}
    got = {r.doc_id: {int(x) for x in r["items"].split(",") if x} for r in op7(spark, small).collect() if r.doc_id in want}
    assert sum(len(w) for w in want.values()) > 0
    assert got == want


def test_edge_rows(spark):
    item = [f"q{i}" for i in range(20)]
    changed = item[:4] + ["other"] + item[5:12] + ["word"] + item[13:]
    rows = [(1, " ".join(["intro"] + item + ["end"])), (2, "x " * 30 + " ".join(changed).upper()), (3, " ".join(item[:10])), (4, None), (5, ""),
            (6, " ".join(item[3:17])), (None, " ".join(item)), (1, "clean words only"), (7, "b c a"), (9, "x a b c y"), (14, "a b d"), (8, "tiny item of eight words stands here now")]
    items = [(10, " ".join(item)), (10, " ".join(item)), (11, "a b c"), (12, None), (13, "tiny item of eight words stands here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as item_id", "'h' as hash", "2 as offsets", "3 as d")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "9 as doc_id")
    got = sorted(((r.doc_id, r.contaminated, r["items"]) for r in decontaminate(docs, bench).collect()), key=str)
    hit = {0: "10", 1: "10", 5: "10", 6: "10", 9: "11", 11: "13"}
    assert got == sorted(((d, i in hit, hit.get(i, "")) for i, (d, _) in enumerate(rows)), key=str)
    kept = clean_rows(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 7, 14]
    assert {r.contaminated for r in decontaminate(docs, bench.where("false")).collect()} == {False}
    assert decontaminate(docs.where("false"), bench).count() == 0


def survives(length, gone):
    """Does a mask fit into a stretch of this length without touching a substituted word?"""
    return any(all(bit == "0" or i + j not in gone for j, bit in enumerate(mask)) for mask in MASKS for i in range(length - len(mask) + 1))


@pytest.mark.parametrize("length", range(LEAST, 26))
def test_masks_find_every_allowed_pattern(length):
    """Longer stretches hold one of 13 to 25 words with at least the same share of equal words."""
    for gone in combinations(range(length), length // 5):
        assert survives(length, set(gone)), gone


def test_every_single_and_double_substitution(spark):
    """Whole items of 8 to 13 words with each allowed pattern of substituted words, through Spark."""
    items = [(n, [f"i{n}w{j}" for j in range(n)]) for n in (8, 9, 10, 11, 12, 13)]
    rows = []
    for n, words in items:
        for gone in combinations(range(n), n // 5):
            rows.append((len(rows), n, " ".join(["pre"] + ["zz" if j in gone else w for j, w in enumerate(words)] + ["post"])))
        rows.append((len(rows), None, " ".join("zz" if j < n // 5 + 1 else w for j, w in enumerate(words))))
    docs = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id long, text string")
    got = {r.doc_id: r["items"] for r in decontaminate(docs, bench).collect()}
    assert got == {d: "" if n is None else str(n) for d, n, _ in rows}
