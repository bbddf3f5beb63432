import re
from collections import Counter

from lumenfold.llm.op2_quality import ORACLES, QUERIES, default_rules, kept_rows, measured_order, quality
from tools.oracle_check import compare, connect


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    count = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if count[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    chars, dup = sum(map(len, w)), len(lines) - len(set(lines))
    failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
    bad = (4 * len(re.findall(r"[#*$%&|<>]", text)) > len(w) or 2 * len(re.findall("[A-Z]", text)) > chars or 2 * text.count("!") > len(w)
           or 2 * dup > len(lines) or not 2 * len(w) <= chars <= 20 * len(w))
    return len(w), chars, len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), failed, not failed and not bad


EDGE = [None, "", " \t\n", "a b c d e", "a b c d e a b c d e " * 40, "\x0b x\x0cy \r z", "é ü ç 😀 " * 3, "A B\nA B\n \nA B", "w " * 3000,
        "\n".join(f"line {i} of this text" for i in range(50)), "# * $ | one two three four five six seven eight nine", "x" * 500]


def test_matches_sql_on_small_table(spark, small):
    ok, note = compare(spark, connect(small), "op2", QUERIES["op2_quality_rules"], ORACLES["op2_quality_rules"], small)
    assert ok, note


def test_edge_rows(spark):
    rows = list(enumerate(EDGE)) + [(None, EDGE[5]), (3, EDGE[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _words", "'x' as kept", "2 as n_words")
    want = sorted([(d, *brute(t)) for d, t in rows], key=str)
    assert sorted([tuple(r) for r in quality(docs).collect()], key=str) == want
    kept = kept_rows(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()]) == sorted(d for d, *m in want if m[-1])


def test_empty_table_and_order(spark, small):
    assert quality(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rules = measured_order(spark.read.parquet(f"{small}/documents.parquet"), default_rules())
    assert {r.name for r in rules} == {r.name for r in default_rules()}
