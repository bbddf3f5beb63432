"""Spelling variants by a trie of letter-group counts.

Every word has a frequency vector: how often each group of letters occurs in it. One inserted, deleted or replaced letter
adds at most one to one count (surplus) and takes at most one from another (deficit). The vectors are arranged as a trie, one
level a group; a search walks down it depth first and may spend a budget of one surplus and one deficit on its way. Only the
words at the leaves it reaches are compared letter by letter.

The trie is distributed: its upper levels (length, then the counts of the letters in TOP) are keys that Spark shuffles by, and
every word is sent to the few subtrees that its budget reaches, with what is left of it. A search only goes to words of its
own length or one letter longer, and among equal lengths only upwards, so each pair is met once; both directions come out. A
subtree is cut into blocks of about CHUNK words on either side, so no task holds more, however crowded a subtree is.

Near words of a word number at most (2 * length + 1) times the letters of the alphabet, which bounds every group here.

Cases: null and empty texts have no words; a null doc_id is written as nothing before the colon; repeated rows count each;
ties of n go to the smallest word by code points; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lumenfold.llm.common import stored, table

RUN = "([A-Za-z\\u00C0-\\u00FF]+)"
TOP = "en"
#: Letters with a level of their own below those of TOP, by their share in European prose; all others share REST levels.
ALONE, REST = "tiraosldcuh", 4
CHUNK = 20_000
LEAST_LENGTH, LEAST_N, FACTOR = 6, 5, 5
CELL = "diff int, length int, c0 int, c1 int"


def run_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199) -> DataFrame:
    """(word) for each letter run of at least LEAST_LENGTH letters; the runs whose crc32 every divides lose one letter."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("d"),
                       F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(1))).alias("r"))
    runs = runs.where(F.char_length("r") >= LEAST_LENGTH).withColumn(
        "r", F.translate("r", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    runs = runs.withColumn("h", F.crc32(F.encode(F.concat("d", F.lit(":"), "r"), "UTF-8")))
    at = (F.col("h") % F.char_length("r")).cast("int")
    cut = F.concat(F.substring("r", F.lit(1), at), F.substring("r", at + 2, F.char_length("r")))
    return runs.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("r")).alias("word")).where(F.char_length("word") >= LEAST_LENGTH)


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, n) of the words with at least LEAST_N occurrences."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_N)


def count_of(letter: str) -> Column:
    return F.char_length("word") - F.char_length(F.replace("word", F.lit(letter), F.lit("")))


def _moves() -> list[tuple[int, int, int, int, int]]:
    """(longer by, change of the counts of TOP, surplus and deficit left) of every subtree that a search goes on in."""
    same = [(0, a, b, 1 - (a > 0) - (b > 0), 1 - (a < 0) - (b < 0)) for a in (0, 1) for b in (-1, 0, 1) if (a, b) >= (0, 0)]
    return [m for m in same if min(m[3:]) >= 0] + [(1, 0, 0, 1, 0), (1, 1, 0, 0, 0), (1, 0, 1, 0, 0)]


def group_of() -> np.ndarray:
    """The level of every Latin-1 letter; those of TOP have the last one."""
    out = len(ALONE) + np.arange(256) % REST
    out[[ord(c) for c in ALONE]] = np.arange(len(ALONE))
    out[[ord(c) for c in TOP]] = len(ALONE) + REST
    return out


def letters(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def vectors(codes: np.ndarray) -> np.ndarray:
    """Counts of each group below the upper levels in each word (words x groups)."""
    levels, m = len(ALONE) + REST + 1, len(codes)
    at = group_of()[codes] + np.arange(m)[:, None] * levels
    return np.bincount(at.ravel(), minlength=m * levels).reshape(m, levels)[:, :-1]


class Trie:
    """Words of one length by their vectors; node 0 of a level stands for none, and children[level][node, count] is the next node."""

    def __init__(self, codes: np.ndarray):
        counts = vectors(codes)
        self.order = np.lexsort(counts.T[::-1])
        self.codes, counts = codes[self.order], counts[self.order]
        self.children, node = [], np.ones(len(codes), np.int64)
        for c in counts.T:
            new = np.ones(len(c), bool)
            new[1:] = (np.diff(node) != 0) | (np.diff(c) != 0)
            child = np.cumsum(new)
            step = np.zeros((node[-1] + 1, int(c.max()) + 2), np.int32)
            step[node[new], c[new]] = child[new]
            self.children.append(step)
            node = child
        self.first = np.concatenate([[0], np.flatnonzero(np.diff(node, prepend=0)), [len(codes)]])

    def search(self, counts: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, most: int = 1 << 18):
        """(query, word) of all leaves within the budgets, in bounded pieces; depth first over pieces of the frontier."""
        stack = [(0, np.arange(len(counts)), np.ones(len(counts), np.int64), surplus.astype(np.int8), deficit.astype(np.int8))]
        while stack:
            level, q, node, s, d = stack.pop()
            if level == len(self.children):
                yield q, node
                continue
            if len(q) > most:
                half = len(q) // 2
                stack += [(level, *(x[half:] for x in (q, node, s, d))), (level, *(x[:half] for x in (q, node, s, d)))]
                continue
            step, c = self.children[level], counts[q, level]
            width = step.shape[1]
            found = []
            for change, allowed in ((0, None), (1, s > 0), (-1, (d > 0) & (c > 0))):
                at = np.arange(len(q)) if allowed is None else np.flatnonzero(allowed)
                to = c[at] + change
                at, to = at[to < width], to[to < width]
                child = step[node[at], to]
                at, child = at[child > 0], child[child > 0]
                found.append((q[at], child, s[at] - (change > 0), d[at] - (change < 0)))
            stack.append((level + 1, *(np.concatenate(x) for x in zip(*found))))

    def near(self, codes: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, most: int = 1 << 18):
        """(queries, words as rows of the given codes) that differ by one replaced or, if these words are longer, one inserted letter."""
        for q, leaf in self.search(vectors(codes), surplus, deficit, most):
            size = self.first[leaf + 1] - self.first[leaf]
            for part in np.split(np.arange(len(q)), np.searchsorted(np.cumsum(size), np.arange(most, size.sum(), most))):
                a = np.repeat(q[part], size[part])
                b = np.arange(size[part].sum()) + np.repeat(self.first[leaf[part]] - np.cumsum(size[part]) + size[part], size[part])
                hit = one_edit(codes[a], self.codes[b])
                yield a[hit], self.order[b[hit]]


def one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the rows of x and y, as long or longer by one, differ by exactly one replaced or inserted letter."""
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(1) == 1
    n = x.shape[1]
    head = np.logical_and.accumulate(x == y[:, :n], axis=1).sum(1)
    tail = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= n


def _search(cell: pa.Table) -> pa.Table:
    """Near pairs, both ways, of a cell: a block of words of a subtree and a block of the searches that reach it."""
    side = cell.column("is_query").to_numpy(zero_copy_only=False)
    items, queries = cell.filter(pa.array(~side)), cell.filter(pa.array(side))
    out = [[], [], []]
    if len(items) and len(queries):
        word, n = items.column("word").to_pylist(), items.column("n").to_numpy()
        own, m = queries.column("word").to_pylist(), queries.column("n").to_numpy()
        trie = Trie(letters(word, len(word[0])))
        surplus, deficit = (queries.column(x).to_numpy() for x in ("surplus", "deficit"))
        top = (surplus == 1) & (deficit == 1)  # the same subtree: each pair is met twice
        for a, b in trie.near(letters(own, len(own[0])), surplus, deficit):
            for i, j in zip(a.tolist(), b.tolist()):
                if not top[i] or own[i] < word[j]:
                    out[0] += own[i], word[j]
                    out[1] += word[j], own[i]
                    out[2] += n[j], m[i]
    return pa.table({"word": pa.array(out[0], pa.string()), "near": pa.array(out[1], pa.string()), "near_n": pa.array(out[2], pa.int64())})


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, near, near_n) of all ordered pairs of vocab(word, n) that differ by exactly one letter."""
    placed = vocab.select("word", "n", F.char_length("word").alias("length"), *[count_of(c).alias(f"c{i}") for i, c in enumerate(TOP)])
    moves = F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in zip(("diff", "a", "b", "surplus", "deficit"), m)]) for m in _moves()])
    searches = placed.withColumn("m", F.explode(moves)).select(
        "word", "n", F.col("m.diff").alias("diff"), (F.col("length") + F.col("m.diff")).alias("length"), (F.col("c0") + F.col("m.a")).alias("c0"),
        (F.col("c1") + F.col("m.b")).alias("c1"), F.col("m.surplus").alias("surplus"), F.col("m.deficit").alias("deficit")).where("c1 >= 0")
    cell = ["diff", "length", "c0", "c1"]
    # blocks hold fewer words where words are long
    blocks = F.ceil(F.count(F.lit(1)) * F.greatest(F.col("length"), F.lit(16)) / (16 * CHUNK)).cast("int")
    items = placed.withColumn("diff", F.explode(F.array(F.lit(0), F.lit(1))))
    sizes = stored(items.groupBy(*cell).agg(blocks.alias("item_blocks")).join(searches.groupBy(*cell).agg(blocks.alias("query_blocks")), cell), "cells")
    items = items.join(sizes, cell).select(*cell, F.pmod(F.xxhash64("word"), "item_blocks").alias("i"), F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("j"),
                                           F.lit(False).alias("is_query"), "word", "n", F.lit(0).alias("surplus"), F.lit(0).alias("deficit"))
    searches = searches.join(sizes, cell).select(*cell, F.explode(F.sequence(F.lit(0), F.col("item_blocks") - 1)).alias("i"), F.pmod(F.xxhash64("word"), "query_blocks").alias("j"),
                                                 F.lit(True).alias("is_query"), "word", "n", "surplus", "deficit")
    # dealt by blocks and not by cells, so that the blocks of a crowded subtree spread over the tasks
    blocks = items.unionByName(searches).repartition(*cell, "i", "j")
    return blocks.groupBy(*cell, "i", "j").applyInArrow(_search, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms(word, form): the last word of the chain of forms. A form's n is at least FACTOR times its word's,
    so a chain has at most 27 links and doubling it settles within six rounds."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = stored(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return now


def spelling_variants(vocab: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of vocab(word, n), each word once."""
    vocab = stored(vocab.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    best = near_words(vocab).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("best"))
    known = vocab.join(best, "word", "left")
    follows = -F.col("best.n") >= FACTOR * F.col("n")
    known = stored(known.select("word", F.when(follows, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                F.when(follows, -F.col("best.n")).alias("form_n")), "forms")
    return known.join(roots(known.where("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12(spark, sf_dir) -> DataFrame:
    return spelling_variants(vocabulary(run_words(table(spark, sf_dir, "documents"))))


ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS r FROM documents) x WHERE length(r) >= 6 GROUP BY ALL
), coded AS (
  SELECT r, n, flatten(list_transform(string_split(d || ':' || r, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE
    [192 + (unicode(x) >> 6)::BIGINT, 128 + (unicode(x) & 63)::BIGINT] END)) AS b FROM runs
), hashed AS (
  SELECT r, n, xor(4294967295, list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295)) AS h FROM coded, crc
), v AS (
  SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN left(r, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word, n FROM hashed) x
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), k AS (
  SELECT word, n, left(word, i - 1) || '?' || substr(word, i + 1) AS hole, left(word, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM v) x
), near AS (
  SELECT a.word, b.word AS near, b.n FROM k a JOIN k b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT k.word, v.word, v.n FROM k JOIN v ON v.word = k.less
  UNION SELECT v.word, k.word, k.n FROM k JOIN v ON v.word = k.less
), best AS (
  SELECT word, near, n, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near
), formed AS (
  SELECT v.word, CASE WHEN b.n >= 5 * v.n THEN b.near END AS form, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= 5 * v.n THEN b.n END AS form_n
  FROM v LEFT JOIN best b ON b.word = v.word AND b.place = 1
), chain AS (
  SELECT word, word AS root FROM formed UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.root WHERE formed.form IS NOT NULL
), ends AS (
  SELECT chain.word, chain.root FROM chain JOIN formed ON formed.word = chain.root WHERE formed.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

QUERIES = {"op12_spelling_variants": op12}
ORACLES = {"op12_spelling_variants": ORACLE}
