import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from lumenfold.llm.op12_spelling import ORACLE, Trie, letters, near_words, op12, run_words, spelling_variants, vocabulary


def runs(rows):
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{low}".encode())
            if h % 199 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            if len(low) >= 6:
                yield low


def neighbours(n):
    """Near words by the strings with one letter left out (brute force without any counts)."""
    holes = {}
    for w in n:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1:]), []).append(w)
    near = {w: set() for w in n}
    for w in n:
        for i in range(len(w)):
            near[w].update(x for x in holes[w[:i], w[i + 1:]] if x != w)
            short = w[:i] + w[i + 1:]
            if short in near:
                near[w].add(short)
                near[short].add(w)
    return near


def brute(n):
    near = neighbours(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def words_of(rows):
    return {w: c for w, c in Counter(runs(rows)).items() if c >= 5}


def test_whole_small_tables(spark, small):
    for sf in (small, small.replace("0.001", "0.01")):
        rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
        want = brute(words_of(rows))
        assert sorted(tuple(r) for r in op12(spark, sf).collect()) == want
        assert sum(r[1] is not None for r in want) > 0 and sum(r[4] > 0 for r in want) > 10


def test_sql_gives_the_same(small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    assert sorted(con.execute(ORACLE).fetchall()) == brute(words_of(rows))


def test_dense_words_in_small_blocks(spark, monkeypatch):
    from lumenfold.llm import op12_spelling
    monkeypatch.setattr(op12_spelling, "CHUNK", 40)
    rng = np.random.default_rng(3)
    n = {}
    for size, letters_ in ((6, "ena"), (7, "enx"), (8, "eé"), (6, "qzÿ"), (20, "e")):
        for _ in range(250):
            n["".join(rng.choice(list(letters_), size + rng.integers(0, 2)))] = int(5 * 6 ** rng.integers(0, 5))
    vocab = spark.createDataFrame(list(n.items()), "word string, n long")
    assert sorted(tuple(r) for r in spelling_variants(vocab).collect()) == brute(n)


def test_chain_of_forms(spark):
    words = ["a" * (6 + i) for i in range(14)]
    n = {w: 5 * 6 ** (i % 14) for i, w in enumerate(words)}
    got = {r.word: r for r in spelling_variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert {r.root for r in got.values()} == {words[-1]} and got[words[0]].form == words[1]


def test_words_are_compared_once_each(spark):
    n = {"fellow": 9, "yellow": 9, "mellow": 50, "fellows": 5, "bellows": 7, "fell": 5, "follow": 44, "wolfel": 5}
    pairs = [tuple(r) for r in near_words(spark.createDataFrame(list(n.items()), "word string, n long")).collect()]
    assert len(pairs) == len(set(pairs))
    want = neighbours(n)
    assert {(a, b) for a, b, _ in pairs} == {(a, b) for a in want for b in want[a]}


def test_budgets_of_the_trie():
    words = ["listen", "silent", "tinsel", "listed", "glisten"]
    trie = Trie(letters(words[:4], 6))
    one = np.ones(1, np.int8)
    got = [(int(a), words[b]) for x, y in trie.near(letters(["listen"], 6), one, one) for a, b in zip(x, y)]
    assert got == [(0, "listed")]
    longer = Trie(letters(["glisten", "listens", "enlists"], 7))
    assert sorted(int(b) for _, y in longer.near(letters(["listen"], 6), one, one * 0) for b in y) == [0, 1]


def test_edge_rows(spark):
    rows = [(1, "Señora SEÑORA señora señora"), (None, "señora senora " * 30), (2, None), (3, ""), (4, "12 ..."), (5, "x" * 100_000 + " "), (5, ("y" * 3000 + " ") * 6),
            (5, ("y" * 3000 + " ") * 6), (6, ("y" * 2999 + "z ") * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as r", "4 as d")
    got = sorted(tuple(r) for r in spelling_variants(vocabulary(run_words(docs))).collect())
    assert got == brute(words_of(rows))
    assert spelling_variants(vocabulary(run_words(docs.where("false")))).count() == 0
