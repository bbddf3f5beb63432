"""Word vectors whose vocabulary never sits in one place: skip-gram models of the tasks, averaged by word.

Every task trains skip-gram with negative samples on the texts it reads and keeps vectors of its own words only; beyond
WORDS_A_MODEL words it hands them over and starts anew. A word starts from a vector drawn from its hash, the same in all tasks, and
the averages by word, weighted by occurrences, are the model: a table (term, n, vector). The mean of a text takes the most frequent
words, BROADCAST_ROWS at most, from a broadcast table and all others by a join. No word is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lumenfold.functions.skew import BROADCAST_ROWS
from lumenfold.functions.text import explode_words
from lumenfold.session import cut_lineage

WINDOW, NEGATIVES, SHARED, STEP, BLOCK, POWER = 5, 5, 20, 0.05, 512, 0.75
WORDS_A_MODEL = 200_000


def first_vectors(words, dim: int, seed: int) -> np.ndarray:
    """Uniform in +-0.5 / dim, given by the word and the seed."""
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=False) if len(words) else np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        z = h[:, None] + (np.arange(1, dim + 1, dtype=np.uint64) + np.uint64(seed * 1000)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) / (1 << 53) - 0.5) / dim


class SkipGram:
    """The model of a task's own words."""

    def __init__(self, dim: int, seed: int, task: int):
        self.dim, self.seed, self.at = dim, seed, {}
        self.inner, self.outer, self.n = np.zeros((0, dim)), np.zeros((0, dim)), np.zeros(0)
        self.rng = np.random.default_rng([seed, task])

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Numbers of the words; new ones get their first vectors."""
        coded = words.dictionary_encode()
        terms = coded.dictionary.to_pylist()
        new = [t for t in terms if t not in self.at]
        self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
        self.inner = np.concatenate([self.inner, first_vectors(new, self.dim, self.seed)])
        self.outer = np.concatenate([self.outer, np.zeros((len(new), self.dim))])
        self.n = np.concatenate([self.n, np.zeros(len(new))])
        return np.array([self.at[t] for t in terms], np.int64)[coded.indices.to_numpy()] if terms else np.zeros(0, np.int64)

    def learn(self, text: np.ndarray, word: np.ndarray) -> None:
        """One pass over words and the numbers of their texts, in blocks of BLOCK words."""
        noise = np.cumsum(self.n ** POWER)
        for a in range(0, len(word), BLOCK):
            w, t = word[a:a + BLOCK], text[a:a + BLOCK]
            reach = self.rng.integers(1, WINDOW + 1, len(w))
            centre, context = [], []
            for d in range(1, min(WINDOW, len(w) - 1) + 1):
                same = t[d:] == t[:-d]
                left, right = np.flatnonzero(same & (reach[d:] >= d)), np.flatnonzero(same & (reach[:-d] >= d))
                centre += [w[left + d], w[right]]
                context += [w[left], w[right + d]]
            if centre and sum(map(len, centre)):
                self._step(np.concatenate(centre), np.concatenate(context), np.searchsorted(noise, self.rng.random(SHARED) * noise[-1]))

    def _step(self, centre, context, negative) -> None:
        v, u, noise = self.inner[centre], self.outer[context], self.outer[negative]
        pull = 1 - _logistic((v * u).sum(1))
        push = -_logistic(v @ noise.T) * (NEGATIVES / SHARED)
        _add(self.inner, centre, pull[:, None] * u + push @ noise)
        _add(self.outer, context, pull[:, None] * v)
        _add(self.outer, negative, push.T @ v / np.sqrt(len(centre) / SHARED))

    def batch(self, terms=("term", "n", "vector")) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays((np.arange(len(self.n) + 1) * self.dim).astype(np.int32), pa.array(self.inner.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(list(self.at), pa.string()), pa.array(self.n.astype(np.int64)), lists], list(terms))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _add(table: np.ndarray, rows: np.ndarray, steps: np.ndarray) -> None:
    """Add the steps of each row; those of a row met often are divided by the root of their number, so that frequent words stay bounded."""
    order = np.argsort(rows, kind="stable")
    own, start, n = np.unique(rows[order], return_index=True, return_counts=True)
    table[own] += STEP * np.add.reduceat(steps[order], start) / np.sqrt(n)[:, None]


@dataclass
class WordVectors:
    """The averaged vectors: a stored table (term, n, vector), and the frequent words in a broadcast table."""

    table: DataFrame
    dim: int
    frequent: object
    least: int

    def mean(self, df: DataFrame, words: str, out: str) -> DataFrame:
        """Add the mean vector of the words of each row; unknown words count as zeros, and rows without words get zeros."""
        frequent, dim = self.frequent, self.dim

        @F.pandas_udf("array<double>")
        def known(v: pd.Series) -> pd.Series:
            index, vectors = frequent.value
            flat, row = _flat(v)
            at = index.get_indexer(flat)
            row, at = row[at >= 0], at[at >= 0]
            sums = np.stack([np.bincount(row, vectors[at, j], len(v)) for j in range(dim)], 1) if len(v) else np.zeros((0, dim))
            return pd.Series(list(sums))

        @F.pandas_udf("array<string>")
        def others(v: pd.Series) -> pd.Series:
            index = frequent.value[0]
            flat, row = _flat(v)
            left = index.get_indexer(flat) < 0
            cuts = np.searchsorted(row[left], np.arange(1, len(v)))
            return pd.Series(np.split(flat[left], cuts) if len(v) else [], dtype=object)

        size = F.greatest(F.size(words), F.lit(1))
        if self.least <= 0:
            return df.withColumn("_sum", known(words)).withColumn(out, F.transform("_sum", lambda x: x / size)).drop("_sum")
        rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))  # stored, so that the numbers stay as they are
        rare = explode_words(rows, others(words), "_row").join(self.table.where(F.col("n") < self.least).select("term", "vector"), "term")
        sums = rare.groupBy("_row").agg(F.array(*[F.sum(F.col("vector")[j]) for j in range(dim)]).alias("_rare"))
        zeros = F.array_repeat(F.lit(0.0), dim)
        both = F.zip_with("_sum", F.coalesce("_rare", zeros), lambda x, y: (x + y) / size)
        return rows.withColumn("_sum", known(words)).join(sums, "_row", "left").withColumn(out, both).drop("_row", "_sum", "_rare")


def _flat(v: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """All words of the rows, and their row numbers."""
    lists = [x if x is not None else () for x in v]
    sizes = [len(x) for x in lists]
    flat = np.concatenate([np.asarray(x, dtype=object) for x in lists]) if sum(sizes) else np.zeros(0, object)
    return flat, np.repeat(np.arange(len(lists)), sizes)


def fit_word_vectors(rows: DataFrame, words: str, dim: int, seed: int = 7, min_count: int = 1, max_iter: int = 1) -> WordVectors:
    """The model of the words of all rows; words of fewer than min_count occurrences are left out of the table."""
    def train(batches):
        task = TaskContext.get().partitionId()
        model = SkipGram(dim, seed, task)
        for batch in batches:
            lists = batch.column(0)
            word = model.numbers(lists.flatten())
            model.n += np.bincount(word, minlength=len(model.n))
            text = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            for _ in range(max_iter if len(word) else 0):
                model.learn(text, word)
            if len(model.n) >= WORDS_A_MODEL:
                yield model.batch()
                model = SkipGram(dim, seed, task)
        yield model.batch()

    parts = rows.select(words).mapInArrow(train, "term string, n bigint, vector array<double>")
    table = cut_lineage(parts.groupBy("term").agg(F.sum("n").alias("n"), F.array(*[
        F.sum(F.col("vector")[j] * F.col("n")) / F.sum("n") for j in range(dim)]).alias("vector")).where(F.col("n") >= min_count))
    least = frequent_from(table, "n", BROADCAST_ROWS)
    near = table.where(F.col("n") >= least).toPandas()  # BROADCAST_ROWS at most
    vectors = np.stack(near["vector"].tolist()).astype(float) if len(near) else np.zeros((0, dim))
    return WordVectors(table, dim, rows.sparkSession.sparkContext.broadcast((pd.Index(near["term"], dtype=object), vectors)), least)


def frequent_from(table: DataFrame, n: str, most: int) -> int:
    """The least number n that at most `most` rows reach; 0 if all rows are that few. Distinct numbers are few, as their sum is bounded."""
    total, least = 0, 0
    for r in table.groupBy(n).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc(n)).collect():
        total += r["rows"]
        if total > most:
            return r[n] + 1
    return least
