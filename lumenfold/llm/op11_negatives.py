"""Hard negatives by rotated one-bit codes with exact integer scoring.

Vectors of integers, floor(256 * x), are scored by their inner product. Of every row r, LEVELS codes are stored: r is rotated
by a fixed random rotation R and only the signs are kept, a unit vector s of entries +-1/sqrt(D); with them go the alignment
a = <R r, s> and the length of the residual r - a R's, which is the row of the next level. For a query q,

    <q, r> = a <R q, s> + <q, residual>,   |<q, residual>| <= |residual| * sqrt(|q|^2 - <R q, s>^2)   (Cauchy-Schwarz, as the residual
                                                                                                     is orthogonal to R's)

<R q, s> is estimated by popcounts of the code with the PLANES bit planes of the rotated query; what rounding the query
leaves out has a known length and widens the interval. The interval is thus certain, and every level narrows it. Pairs whose
interval leaves the wanted scores are dropped, all others are scored in integers.

First every anchor's positives are found: a few rows of the highest estimates are scored, and a pair survives if its upper end
reaches the k-th best of them. Then the negatives: a pair survives if its interval meets the positives' windows and reaches
the k-th best score that was found within one. Rows and anchors are packed into blocks by hash and meet in a grid of cells,
one row a cell, so that neither a label nor a number of anchors makes a task larger; each cell returns at most k rows for
each anchor and positive.

Cases: rows with a null id, label or vector, or with a null, NaN or infinite component take no part. Equal rows count once;
different rows of one id are different rows. Shorter vectors are filled up with zeros. Scores that do not fit into 63 bits are
an error. Ties go to the smaller id. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from lumenfold.llm.common import stored, table

LEVELS, PLANES = 4, 6
ROWS, ANCHORS = 4096, 512
#: Pairs looked at together, and rows scored at once for each anchor to find out which scores matter.
TILE, TRIED = 1 << 18, 24
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
#: Relative slack for float rounding in interval ends, far above what sums of D products in double precision lose.
SLACK = 1e-9


@dataclass
class Block:
    """Rows sorted by label: ids, labels, variants (told apart within an id), integer vectors (n x D)."""
    ids: np.ndarray
    labels: np.ndarray
    variants: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, cell: dict, dim: int) -> Block:
        ids, labels, variants = (np.frombuffer(cell[k], np.int64) for k in ("ids", "labels", "variants"))
        return cls(ids, labels, variants, np.frombuffer(cell["vectors"], np.int64).reshape(len(ids), dim))

    def take(self, at) -> Block:
        return Block(self.ids[at], self.labels[at], self.variants[at], self.vectors[at])


def rotations(dim: int, levels: int = LEVELS) -> np.ndarray:
    """Fixed random rotations of at least dim and a multiple of 64 dimensions."""
    full = max(64, -(-dim // 64) * 64)
    rng = np.random.Generator(np.random.PCG64(11))
    return np.stack([np.linalg.qr(rng.standard_normal((full, full)))[0] for _ in range(levels)])


def padded(vectors: np.ndarray, full: int) -> np.ndarray:
    return np.pad(vectors.astype(float), ((0, 0), (0, full - vectors.shape[1])))


def packed(signs: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    return np.packbits(signs, axis=1).view(np.uint64)


class Codes:
    """Codes and alignments of the rows of a block, level by level, and the length of the last residual."""

    def __init__(self, vectors: np.ndarray, turns: np.ndarray):
        full = turns.shape[1]
        rest = padded(vectors, full)
        self.length = np.sqrt((rest * rest).sum(1))
        self.bits, self.ones, self.align = [], [], []
        for turn in turns:
            turned = rest @ turn.T
            up = turned >= 0
            sign = np.where(up, 1.0, -1.0) / np.sqrt(full)
            align = (turned * sign).sum(1)
            rest = rest - align[:, None] * (sign @ turn)
            self.bits.append(packed(up))
            self.ones.append(np.bitwise_count(self.bits[-1]).sum(1, dtype=np.int32))
            self.align.append(align)
        # the stored length covers what rounding may have added to the residual
        self.residual = np.sqrt((rest * rest).sum(1)) + SLACK * self.length

    def stored(self) -> bytes:
        return b"".join(np.ascontiguousarray(x).tobytes() for x in (self.length, self.residual, *self.align, *self.bits))

    @classmethod
    def of(cls, cell: bytes, rows: int, levels: int) -> Codes:
        out, numbers = object.__new__(cls), np.frombuffer(cell, np.float64, rows * (2 + levels)).reshape(-1, rows)
        words = np.frombuffer(cell, np.uint64, offset=numbers.nbytes).reshape(levels, rows, -1)
        out.length, out.residual, out.align, out.bits = numbers[0], numbers[1], list(numbers[2:]), list(words)
        out.ones = [np.bitwise_count(b).sum(1, dtype=np.int32) for b in words]
        return out

    def take(self, at) -> Codes:
        out = object.__new__(Codes)
        out.length, out.residual = self.length[at], self.residual[at]
        out.bits, out.ones, out.align = ([x[at] for x in level] for level in (self.bits, self.ones, self.align))
        return out


class Queries:
    """Bit planes of the rotated queries, level by level, and what their rounding leaves out."""

    def __init__(self, vectors: np.ndarray, turns: np.ndarray):
        self.full = full = turns.shape[1]
        own = padded(vectors, full)
        self.square = (own * own).sum(1)
        self.planes, self.base, self.step, self.total, self.lost = [], [], [], [], []
        for turn in turns:
            turned = own @ turn.T
            base = turned.min(1)
            step = np.maximum((turned.max(1) - base) / ((1 << PLANES) - 1), 1e-300)
            level = np.rint((turned - base[:, None]) / step[:, None]).astype(np.uint8)
            back = base[:, None] + step[:, None] * level
            self.planes.append([packed((level >> b) & 1) for b in range(PLANES)])
            self.base.append(base)
            self.step.append(step)
            self.total.append(level.astype(np.int64).sum(1))
            self.lost.append(np.sqrt(((turned - back) ** 2).sum(1)) + SLACK * np.sqrt(self.square))

    def estimate(self, level: int, at: np.ndarray, bits: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """<R q, s> of the queries at with all codes, but for what rounding the queries leaves out, from popcounts."""
        both = np.zeros((len(at), len(bits)), np.int32)
        for b, plane in enumerate(self.planes[level]):
            own = plane[at]
            for w in range(bits.shape[1]):
                both += np.left_shift(np.bitwise_count(own[:, w, None] & bits[:, w]), b, dtype=np.int32)
        scale = 1 / np.sqrt(self.full)
        out = both * (2 * scale * self.step[level][at])[:, None]
        out -= (scale * (self.base[level] * self.full + self.step[level] * self.total[level])[at])[:, None]
        out += (2 * scale * self.base[level][at])[:, None] * ones
        return out


def intervals(queries: Queries, codes: Codes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(middle, half width) of the scores of the queries at with all rows of codes."""
    mid = np.zeros((len(at), len(codes.length)))
    half = (SLACK * np.sqrt(queries.square[at]))[:, None] * codes.length
    along = mid
    for level in range(len(codes.bits)):
        along = queries.estimate(level, at, codes.bits[level], codes.ones[level])
        mid += codes.align[level] * along
        half += queries.lost[level][at][:, None] * codes.align[level]
    least = np.maximum(np.abs(along) - queries.lost[-1][at][:, None], 0)
    return mid, half + np.sqrt(np.maximum(queries.square[at][:, None] - least * least, 0)) * codes.residual


def exact(anchors: Block, rows: Block, q: np.ndarray, r: np.ndarray, piece: int = 1 << 14) -> np.ndarray:
    """Integer inner products of pairs."""
    out = np.empty(len(q), np.int64)
    for i in range(0, len(q), piece):
        out[i:i + piece] = np.einsum("ij,ij->i", anchors.vectors[q[i:i + piece]], rows.vectors[r[i:i + piece]])
    return out


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, variants: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k of every group by descending score, then id."""
    order = np.lexsort((variants, ids, -score, group))
    g = group[order]
    start = np.flatnonzero(np.diff(g, prepend=-1))
    place = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    return order[place < k]


def kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; minus infinity where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]


def tiles(at: np.ndarray, width: int) -> list[np.ndarray]:
    return np.array_split(at, max(1, -(-len(at) * width // TILE))) if len(at) and width else []


def tried(anchors: Block, rows: Block, at: np.ndarray, near: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """Integer scores of the TRIED rows of the highest guess for each anchor; minus infinity for a guess of minus infinity."""
    n = min(TRIED, guess.shape[1])
    top = np.argpartition(guess, guess.shape[1] - n, axis=1)[:, -n:]
    score = exact(anchors, rows, np.repeat(at, n), near[top.ravel()]).reshape(top.shape)
    return np.where(np.isfinite(np.take_along_axis(guess, top, 1)), score, -np.inf)


def positives_of(anchors: Block, rows: Block, codes: Codes, turns: np.ndarray, k: int):
    """(anchor, row, score): the k best other rows of the same label of each anchor in this block."""
    found, queries = [], Queries(anchors.vectors, turns)
    for label in np.unique(anchors.labels):
        near = np.arange(*np.searchsorted(rows.labels, [label, label + 1]))
        part = codes.take(near)
        for at in tiles(np.flatnonzero(anchors.labels == label), len(near)):
            mid, half = intervals(queries, part, at)
            other = (anchors.ids[at][:, None] != rows.ids[near]) | (anchors.variants[at][:, None] != rows.variants[near])
            # no row below the k-th best score of those that were tried is needed
            floor = kth(tried(anchors, rows, at, near, np.where(other, mid, -np.inf)), k)
            a, b = np.nonzero((mid + half >= floor[:, None]) & other)
            q, r = at[a], near[b]
            score = exact(anchors, rows, q, r)
            top = best(q, score, rows.ids[r], rows.variants[r], k)
            found.append((q[top], r[top], score[top]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3


def negatives_of(anchors: Block, positives: np.ndarray, rows: Block, codes: Codes, turns: np.ndarray, k: int, low: int, high: int):
    """(anchor, positive's place, row, score): the k best rows of other labels within each positive's window in this block.

    positives: scores, anchors x places; low and high: hundredths of a score that bound its window. -1 stands for no positive, as
    the window of any score below 0 is empty.
    """
    queries = Queries(anchors.vectors, turns)
    least = np.where(positives >= 0, -(-low * positives // 100), 1)
    most = np.where(positives >= 0, high * positives // 100, 0)
    every, places, found = np.arange(len(rows.ids)), range(positives.shape[1]), []
    for at in tiles(np.flatnonzero((least <= most).any(1)), len(every)):
        mid, half = intervals(queries, codes, at)
        other = anchors.labels[at][:, None] != rows.labels
        top = most[at].max(1)[:, None]
        scores = tried(anchors, rows, at, every, np.where(other & (mid <= top), mid, -np.inf))
        floor = np.full((len(at), positives.shape[1]), np.inf)
        for p in places:
            low_p, high_p = least[at, p], most[at, p]
            inside = np.where((scores >= low_p[:, None]) & (scores <= high_p[:, None]), scores, -np.inf)
            # no row below a window, or below the k-th best score that was tried within it, is needed
            floor[:, p] = np.where(low_p <= high_p, np.maximum(low_p, kth(inside, k)), np.inf)
        a, b = np.nonzero((mid + half >= floor.min(1)[:, None]) & (mid - half <= top) & other)
        q, r = at[a], b
        score = exact(anchors, rows, q, r)
        for p in places:
            fits = np.flatnonzero((score >= floor[a, p]) & (score <= most[q, p]))
            first = fits[best(q[fits], score[fits], rows.ids[r[fits]], rows.variants[r[fits]], k)]
            found.append((q[first], np.full(len(first), p), r[first], score[first]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 4


def vectors_of(df: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, vector array<long>, variant) of the rows that take part, equal rows once."""
    whole = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    sound = ~F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).where(sound).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("vector"))
    return rows.dropDuplicates().withColumn("variant", F.xxhash64("label", "vector"))


PACKED = "block int, ids binary, labels binary, variants binary, vectors binary, codes binary"


def packer(dim: int, turns):
    """One row for the rows of a block, which the group's hash bounds, with their codes if turns are given."""
    def pack(group: pa.Table) -> pa.Table:
        flat, size = group.column("vector").combine_chunks(), group.column("vector").combine_chunks().value_lengths().to_numpy()
        values = flat.flatten().to_numpy()
        out = np.zeros((len(group), dim), np.int64)
        out[np.repeat(np.arange(len(group)), size), np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
        if float((out.astype(float) ** 2).sum(1).max(initial=0)) >= 2.0 ** 62:
            raise ValueError("components are too large for integer scores of 63 bits")
        order = np.lexsort((group.column("id").to_numpy(), group.column("label").to_numpy()))
        cols = [group.column(k).to_numpy()[order] for k in ("id", "label", "variant")] + [out[order]]
        codes = b"" if turns is None else Codes(cols[-1], turns.value).stored()
        return pa.table([pa.array([group.column("block")[0].as_py()], pa.int32()), *[pa.array([c.astype(np.int64).tobytes()], pa.binary()) for c in cols],
                         pa.array([codes], pa.binary())], names=["block", "ids", "labels", "variants", "vectors", "codes"])
    return pack


def blocks_of(rows: DataFrame, dim: int, size: int, label: str, turns=None) -> tuple[DataFrame, int]:
    """rows packed into blocks of about size rows, and the number of blocks."""
    number = max(1, -(-rows.count() // size))
    own = rows.withColumn("block", F.pmod(F.xxhash64("id", "variant"), F.lit(number)).cast("int"))
    return stored(own.groupBy("block").applyInArrow(packer(dim, turns), PACKED), label), number


def grid(items: DataFrame, n_items: int, anchors: DataFrame, n_anchors: int) -> DataFrame:
    """One row for each pair of an item block and an anchor block: (i, j, item, anchor), dealt out evenly."""
    def side(df, name, own, other, n):
        rows = df.select(F.col("block").alias(own), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(other), F.struct(*[c for c in df.columns if c != "block"]).alias(name))
        # few rows, but much work in each: as many partitions as cells, up to a bound
        return rows.repartition(min(n_items * n_anchors, 4000), "i", "j")
    return side(items, "item", "i", "j", n_anchors).join(side(anchors, "anchor", "j", "i", n_items), ["i", "j"])


def hard_negatives(df: DataFrame, queries, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, rows_a_block: int = ROWS, anchors_a_block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where queries, a condition on `id`, holds.

    A negative's score is between low and high hundredths of the positive's.
    """
    rows = stored(vectors_of(df, id_col, label_col, vector_col), "vectors")
    dim = rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("n")).first().n
    turns = rotations(dim)
    shared = df.sparkSession.sparkContext.broadcast(turns)
    items, n_items = blocks_of(rows, dim, rows_a_block, "blocks", shared)
    anchors, n_anchors = blocks_of(rows.where(queries), dim, anchors_a_block, "anchors")

    def first(batches):
        for batch in batches:
            for cell in batch.to_pylist():
                item, anchor = Block.of(cell["item"], dim), Block.of(cell["anchor"], dim)
                codes = Codes.of(cell["item"]["codes"], len(item.ids), LEVELS)
                q, r, score = positives_of(anchor, item, codes, shared.value, positives)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), cell["j"], np.int32)), *map(pa.array, (
                    anchor.ids[q], anchor.variants[q], item.ids[r], item.variants[r], score))], ["block", "anchor", "a_variant", "positive", "variant", "score"])

    pairs = grid(items, n_items, anchors, n_anchors).mapInArrow(first, "block int, anchor long, a_variant long, positive long, variant long, score long")
    place = F.row_number().over(Window.partitionBy("anchor", "a_variant").orderBy(F.desc("score"), "positive", "variant")) - 1
    pairs = stored(pairs.withColumn("place", place).where(F.col("place") < positives), "positives")

    def scored(group: pa.Table) -> pa.Table:
        """The positives of an anchor block, at most positives for each of its rows."""
        cols = [group.column(k).to_numpy().astype(np.int64).tobytes() for k in ("anchor", "a_variant", "place", "positive", "score")]
        return pa.table([pa.array([group.column("block")[0].as_py()], pa.int32()), *[pa.array([c], pa.binary()) for c in cols]],
                        names=["block", "p_anchor", "p_variant", "p_place", "p_id", "p_score"])

    known = pairs.groupBy("block").applyInArrow(scored, "block int, p_anchor binary, p_variant binary, p_place binary, p_id binary, p_score binary")
    anchors = stored(anchors.join(known, "block"), "anchors")

    def second(batches):
        for batch in batches:
            for cell in batch.to_pylist():
                item, anchor = Block.of(cell["item"], dim), Block.of(cell["anchor"], dim)
                p_anchor, p_variant, p_place, p_id, p_score = (np.frombuffer(cell["anchor"][k], np.int64) for k in ("p_anchor", "p_variant", "p_place", "p_id", "p_score"))
                where = {key: i for i, key in enumerate(zip(anchor.ids.tolist(), anchor.variants.tolist()))}
                at = np.array([where[key] for key in zip(p_anchor.tolist(), p_variant.tolist())], np.int64)
                score, ids = np.full((len(anchor.ids), positives), -1), np.zeros((len(anchor.ids), positives), np.int64)
                score[at, p_place], ids[at, p_place] = p_score, p_id
                codes = Codes.of(cell["item"]["codes"], len(item.ids), LEVELS)
                q, p, r, found = negatives_of(anchor, score, item, codes, shared.value, negatives, low, high)
                yield pa.RecordBatch.from_arrays([*map(pa.array, (anchor.ids[q], anchor.variants[q], p.astype(np.int32), ids[q, p], item.ids[r], item.variants[r],
                                                                  score[q, p], found))],
                                                 ["anchor_id", "a_variant", "place", "positive_id", "negative_id", "variant", "positive_score", "negative_score"])

    out = grid(items, n_items, anchors, n_anchors).mapInArrow(
        second, "anchor_id long, a_variant long, place int, positive_id long, negative_id long, variant long, positive_score long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "a_variant", "place").orderBy(F.desc("negative_score"), "negative_id", "variant"))
    return out.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11(spark, sf_dir) -> DataFrame:
    own = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding")
    return hard_negatives(own, F.col("id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.e::DOUBLE[], b.e::DOUBLE[]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place FROM s WHERE same
), r AS (
  SELECT p.anchor_id, positive_id, positive_score, s.other AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id
  WHERE place <= 5 AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3
"""

QUERIES = {"op11_hard_negatives": op11}
ORACLES = {"op11_hard_negatives": ORACLE}
