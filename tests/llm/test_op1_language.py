import math
import zlib

import numpy as np

from lumenfold.llm.op1_language import ALPHA, BETA, FEATURES, L1, L2, counts, ftrl, identify, op1, softmax, temperature


def test_held_out_accuracy(spark, small):
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    out = op1(spark, small).collect()
    assert sorted(r.doc_id for r in out) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held) >= 0.93 * len(held)


def test_counts_cover_the_whole_text():
    assert counts(None) is None and counts("123 !") is None
    assert counts("ab").sum() == 4 + 3 + 2
    long = "abc déf " * 200_000
    assert counts(long).sum() == 3 * (len(long) + 2) - 3
    assert counts(long).shape == (FEATURES,)


def test_edge_rows(spark):
    train = spark.createDataFrame([("der die und " * 5, "de"), ("the of and " * 5, "en"), (None, "en"), ("x", None)] * 4, "text string, lang string")
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "42 \t"), (4, "the and of the"), (4, "und die der"), (None, "the the of")],
                                 "doc_id long, text string").selectExpr("*", "'zz' as lang", "0 as held_out", "1 as score")
    out = [(r.doc_id, r.lang_pred) for r in identify(docs, train).collect()]
    assert sorted(out, key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "de"), (None, "en")], key=str)
    none = identify(docs, train.where("false"))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert identify(docs.where("false"), train).count() == 0


def test_a_language_of_copies_is_learned(spark):
    """One text 20,000 times is one text to learn from, not a class that a sample may miss."""
    words = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one".split()
    rng = np.random.default_rng(8)
    english = spark.createDataFrame([(" ".join(rng.choice(words, 12)), "en") for _ in range(3000)], "text string, lang string")
    german = spark.range(20000).selectExpr("'der schnelle braune Fuchs springt über den faulen Hund und schläft' as text", "'de' as lang")
    docs = spark.createDataFrame([(1, "der schnelle braune Fuchs springt über den faulen Hund und schläft"), (2, "it was the one that they had")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in identify(docs, english.union(german)).collect()}
    assert got == {1: "de", 2: "en"}


def test_temperature_is_the_best_of_a_grid():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 400)
    logits = rng.normal(0, 1, (400, 3)) + 2 * np.eye(3)[y]
    loss = {t: -np.log(softmax(3 * logits / t)[np.arange(400), y]).mean() for t in np.geomspace(0.1, 15, 400)}
    assert abs(np.log(temperature(3 * logits, y) / min(loss, key=loss.get))) < 0.03


def test_ftrl_against_a_plain_loop():
    """Weights of the vectorised fit are those of a loop over single coordinates."""
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(50, 6, replace=False)), rng.random(6), int(rng.integers(0, 3))) for _ in range(40)]
    z, n = {}, {}

    def weight(f, k):
        a, b = z.get((f, k), 0.0), n.get((f, k), 0.0)
        return 0.0 if abs(a) <= L1 else -(a - math.copysign(L1, a)) / ((BETA + math.sqrt(b)) / ALPHA + L2)

    order = np.random.Generator(np.random.PCG64(1))
    for _ in range(2):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            raw = [sum(weight(f, k) * v for f, v in zip(at, x)) for k in range(3)]
            top = [math.exp(r - max(raw)) for r in raw]
            for f, v in zip(at, x):
                old = [weight(f, k) for k in range(3)]
                for k in range(3):
                    g = (top[k] / sum(top) - (k == y)) * v
                    was = n.get((f, k), 0.0)
                    z[f, k] = z.get((f, k), 0.0) + g - (math.sqrt(was + g * g) - math.sqrt(was)) / ALPHA * old[k]
                    n[f, k] = was + g * g
    got = ftrl(rows, 3, epochs=2)
    assert all(abs(got[f, k] - weight(f, k)) < 1e-9 for f in range(50) for k in range(3)) and (got == 0).any()
