"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Text is lower-cased, every run of non-letters becomes one space, and the n-grams of one to three characters of the whole
text are hashed to FEATURES counters. A feature weighs (1 + log count) * idf, idf from the document frequencies over all
labelled training rows, and a text's vector has length 1. Weights are fitted by follow-the-regularised-leader with
elastic-net penalties (per-coordinate steps; the first penalty leaves unused weights at zero) on a bounded sample: about
TRAIN_ROWS distinct texts in equal parts per language, at least LEAST_PER_CLASS of each (all, if a language has fewer). A quarter of the sample is kept out
of the fit and sets one temperature that makes the probabilities honest.

Cases: `und` with score 0 for null text and text without a letter, and for every text if no labelled row exists. Null labels
are not learned from; repeated texts of a language count once in the fit; extra columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from lumenfold.llm.common import table
from lumenfold.llm.wordhash import mix

BITS, NGRAMS, CHUNK = 15, 3, 1 << 19
FEATURES = 1 << BITS
TRAIN_ROWS, LEAST_PER_CLASS, EPOCHS = 2400, 20, 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-3, 1e-4


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text, taken in chunks; None if it has no letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return None
    code = np.where(letter, code, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    code = np.concatenate([[32], code[keep], [32]]).astype(np.uint64)
    total = np.zeros(FEATURES, np.int64)
    for at in range(0, len(code), CHUNK):
        part = code[at:at + CHUNK + NGRAMS - 1]
        h = np.zeros(len(part), np.uint64)
        for n in range(1, NGRAMS + 1):
            h = (h[:len(part) - n + 1] << np.uint64(21)) | part[n - 1:]
            own = h[:CHUNK]
            total += np.bincount((mix(own + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64), minlength=FEATURES)
            if len(part) <= n:
                break
    return total


def vector(count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(count)
    x = (1 + np.log(count[at])) * idf[at]
    norm = np.sqrt((x * x).sum())
    return at, x / norm if norm else x


def document_frequencies(batches):
    total, rows = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for t in batch.column("text"):
            c = counts(t.as_py())
            if c is not None:
                total += c > 0
                rows += 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, FEATURES), pa.int32()), pa.array(np.concatenate([[rows], total]), pa.int64())],
                                     ["feature", "df"])


def sample_counts(batches):
    for batch in batches:
        out = [(lang.as_py(), h.as_py(), c) for lang, h, t in zip(batch.column("lang"), batch.column("h"), batch.column("text"))
               if (c := counts(t.as_py())) is not None]
        at = [np.flatnonzero(c) for _, _, c in out]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _, _ in out], pa.string()), pa.array([x for _, x, _ in out], pa.int64()),
             pa.array([a.tolist() for a in at], pa.list_(pa.int32())), pa.array([c[a].tolist() for a, (_, _, c) in zip(at, out)], pa.list_(pa.int32()))],
            ["lang", "h", "features", "counts"])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS, seed: int = 1) -> np.ndarray:
    """Weights (features + bias) x classes."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))
    order = np.random.Generator(np.random.PCG64(seed))

    def weights(at):
        zz = z[at]
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange(FEATURES + 1))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm."""
    def loss(t):
        return -np.log(softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean()
    a, b, r = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(rows: DataFrame) -> dict:
    """The model from rows (text, lang): classes, idf, weights and temperature."""
    rows = rows.where("lang is not null and text is not null")
    distinct = rows.select("lang", F.xxhash64("lang", "text").alias("h")).distinct()
    per = {r.lang: r["count"] for r in distinct.groupBy("lang").count().collect()}
    if not per:
        return {"classes": []}
    want = max(LEAST_PER_CLASS, TRAIN_ROWS // len(per))
    df = np.zeros(FEATURES + 1, np.int64)
    for r in rows.select("text").mapInArrow(document_frequencies, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df")).collect():
        df[r.feature + 1] = r.df
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1
    # copies count once: the want lowest hashes of each class, found among about twice as many
    share = F.create_map(*[x for k, c in per.items() for x in (F.lit(k), F.lit(min(1.0, 2 * want / c)))])
    part = F.pmod("h", F.lit(1_000_000))
    hashed = rows.withColumn("h", F.xxhash64("lang", "text")).where(part < share[F.col("lang")] * 1_000_000).dropDuplicates(["h"])
    hashed = hashed.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(part, "h"))).where(F.col("place") <= want)
    classes = sorted(per)
    fit, held = [], []
    for r in sorted(hashed.select("lang", "h", "text").mapInArrow(sample_counts, "lang string, h long, features array<int>, counts array<int>")
                    .toLocalIterator(), key=lambda r: (r.h, r.lang)):
        c = np.zeros(FEATURES, np.int64)
        c[r.features] = r.counts
        at, x = vector(c, idf)
        (held if r.h % 4 == 0 else fit).append((np.append(at, FEATURES), np.append(x, 0.1), classes.index(r.lang)))
    if not fit:
        fit = held
    weights = ftrl(fit, len(classes))
    held = held or fit
    logits = np.array([x @ weights[at] for at, x, _ in held])
    t = temperature(logits, np.array([y for _, _, y in held])) if held else 1.0
    return {"classes": classes, "idf": idf, "weights": weights.astype(np.float32), "temperature": t}


def predictor(model):
    def predict(batches):
        m = model.value
        for batch in batches:
            lang, score = [], []
            for t in batch.column("text"):
                c = counts(t.as_py()) if m["classes"] else None
                if c is None:
                    lang.append("und")
                    score.append(0.0)
                    continue
                at, x = vector(c, m["idf"])
                p = softmax((x @ m["weights"][at] + 0.1 * m["weights"][FEATURES]) / m["temperature"])
                lang.append(m["classes"][int(p.argmax())])
                score.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang), pa.array(score, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])
    return predict


def identify(docs: DataFrame, training: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row of docs by a model of training(text, lang)."""
    model = docs.sparkSession.sparkContext.broadcast(train(training))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.lit(None).cast("boolean") if held_out is None else held_out).alias("held_out"),
                       F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predictor(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op1(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return identify(docs, docs.where(~held).select("text", "lang"), held)


QUERIES = {"op1_language_id": op1}
