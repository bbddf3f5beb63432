"""Benchmark decontamination by spaced seeds: overlaps with test items that tolerate substituted words.

A seed is a fixed mask over consecutive words; the words at its zeros are ignored, so a substituted word there does not
change the hash. Test and training windows are hashed under every mask and joined by hash; training hashes first pass a
bitmap of the test hashes (2 MB, whatever the number of items), which lets through all that can join. Each hit fixes an
item and an offset; the item is then laid over the document at that offset, and the overlap counts if it holds a stretch of
at least STRETCH words (or the whole item, if shorter) of which SHARE or more are equal. The masks find every such overlap of
8 words or more, wherever the substituted words stand (the tests go through all patterns). Items of fewer than LEAST words count
where they occur whole and unchanged; their seed is the whole item.

Words are lower-cased A-Z. Null and empty texts hold nothing; rows may repeat; a null doc_id is searched like any other; equal items are each
reported; with an empty benchmark nothing is contaminated. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lumenfold.llm.common import stored, table
from lumenfold.llm.wordhash import Piece, mix, pieces

MASKS = ("111011", "11010011", "1110001001")
STRETCH, SHARE, LEAST, MAP_BITS = 13, 0.8, 8, 24


def masked(piece: Piece, first: np.ndarray, mask: str) -> np.ndarray:
    """Hashes of the windows from the words first on, under a mask; an item's whole length is part of a seed without zeros."""
    h = np.full(len(first), MASKS.index(mask) + 1 if mask in MASKS else 100 + len(mask), np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            h = h * np.uint64(0x9E3779B97F4A7C15) + piece.hashes[first + j]
    return mix(h)


def seeds(piece: Piece, short=()) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every window under every mask, and of all windows of the lengths short."""
    at = [(mask, piece.starts_of(len(mask))) for mask in (*MASKS, *("1" * n for n in short))]
    return np.concatenate([first for _, first in at]), np.concatenate([masked(piece, first, mask) for mask, first in at])


def own_seeds(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """The same for items: short ones have only themselves."""
    size = np.repeat(piece.counts, piece.counts)
    at = [(mask, first[size[first] >= LEAST]) for mask in MASKS for first in [piece.starts_of(len(mask))]]
    at += [("1" * n, piece.first[:-1][piece.counts == n]) for n in range(1, LEAST)]
    return np.concatenate([first for _, first in at]), np.concatenate([masked(piece, first, mask) for mask, first in at])


def _rows(batch, ids, p, at, hashes):
    row = np.searchsorted(p.first, at, "right") - 1
    columns = [pa.array(hashes.view(np.int64)), *[batch.column(c).take(pa.array(p.row + row)) for c in ids],
               pa.array((at - p.first[row]).astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, ["hash", *ids, "pos"])


def item_seeds(batches):
    for batch in batches:
        for p in pieces(batch.column("text"), lower=True):
            yield _rows(batch, ["item_id"], p, *own_seeds(p))


def item_lengths(batches):
    """Numbers of words below LEAST that items have."""
    for batch in batches:
        n = np.unique(np.concatenate([p.counts for p in pieces(batch.column("text"))] or [np.empty(0, np.int64)]))
        yield pa.RecordBatch.from_arrays([pa.array(n[(n > 0) & (n < LEAST)].astype(np.int32))], ["n"])


def training_seeds(bitmap, short):
    def find(batches):
        bits = bitmap.value
        for batch in batches:
            for p in pieces(batch.column("text"), lower=True):
                at, h = seeds(p, short)
                cell = (h >> np.uint64(64 - MAP_BITS)).astype(np.int64)
                may = (bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
                yield _rows(batch, ["doc_id", "text_hash"], p, at[may], h[may])
    return find


def overlaps(item: np.ndarray, doc: np.ndarray, offset: int) -> bool:
    """Does item, laid over doc at offset, hold a long enough stretch of mostly equal words?"""
    a, b = max(0, -offset), min(len(item), len(doc) - offset)
    need = min(STRETCH, len(item))
    if b - a < need:
        return False
    share = SHARE if len(item) >= LEAST else 1
    total = np.concatenate([[0.0], np.cumsum((item[a:b] == doc[a + offset:b + offset]) - share)])
    return bool((total[need:] - np.minimum.accumulate(total[:len(total) - need]) >= -1e-9).any())


def verify(batches):
    for batch in batches:
        items = [p.hashes[p.first[r]:p.first[r + 1]] for p in pieces(batch.column("item_text"), lower=True) for r in range(p.rows)]
        docs = [p.hashes[p.first[r]:p.first[r + 1]] for p in pieces(batch.column("text"), lower=True) for r in range(p.rows)]
        hit = [any(overlaps(i, d, o) for o in offsets.values.to_pylist()) for i, d, offsets in zip(items, docs, batch.column("offsets"))]
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(hit, pa.bool_())) for c in ("doc_id", "text_hash", "item_id")],
                                         ["doc_id", "text_hash", "item_id"])


def found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id) of all overlaps; docs(doc_id, text, text_hash), benchmark(item_id, text)."""
    spark = docs.sparkSession
    test = stored(benchmark.mapInArrow(item_seeds, "hash long, item_id long, pos int"), "item_seeds")
    cell = F.shiftrightunsigned("hash", 64 - MAP_BITS)
    words = test.select(cell.alias("cell")).groupBy(F.shiftright("cell", 5).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(pmod(cell, 32) AS int)))").alias("bits"))
    bits = np.zeros(1 << (MAP_BITS - 5), np.uint32)
    for r in words.toLocalIterator():  # 2 ** (MAP_BITS - 5) rows at most
        bits[r.w] = r.bits
    shared = spark.sparkContext.broadcast(bits.view(np.uint8))
    lengths = benchmark.mapInArrow(item_lengths, "n int").distinct()
    short = sorted(r.n for r in lengths.collect())  # LEAST - 1 numbers at most
    train = docs.select("doc_id", "text_hash", "text").mapInArrow(training_seeds(shared, short), "hash long, doc_id long, text_hash long, pos int")
    hits = train.join(test.withColumnRenamed("pos", "item_pos"), "hash").select(
        "doc_id", "text_hash", "item_id", (F.col("pos") - F.col("item_pos")).alias("offset"))
    hits = stored(hits.groupBy("doc_id", "text_hash", "item_id").agg(F.collect_set("offset").alias("offsets")), "hits")
    pairs = hits.join(benchmark.select("item_id", F.col("text").alias("item_text")), "item_id")
    # only texts with a hit are moved: a stored table of their keys is small enough to broadcast, or else joined by key
    keys = stored(hits.select(F.col("doc_id").alias("k"), F.col("text_hash").alias("t")).distinct(), "hit_keys")
    text = docs.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "text")
    text = text.join(keys, F.col("d").eqNullSafe(F.col("k")) & (F.col("h") == F.col("t")), "left_semi")
    pairs = pairs.join(text, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
    return pairs.select("doc_id", "text_hash", "item_id", "offsets", "item_text", "text").mapInArrow(
        verify, "doc_id long, text_hash long, item_id long").distinct()


def _prepared(docs, benchmark, id_col, text_col):
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null and item_id is not null")
    return source, items.dropDuplicates(["item_id", "text"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, contaminated, n_items, items) of each row of docs; items: the item ids, ascending, joined by commas."""
    source, items = _prepared(docs, benchmark, id_col, text_col)
    per = found(source, items).groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(
        F.array_sort(F.collect_set("item_id")).alias("ids"))
    out = source.select("doc_id", "text_hash").join(per, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    return out.select("doc_id", F.col("ids").isNotNull().alias("contaminated"), F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce(F.array_join(F.col("ids").cast("array<string>"), ","), F.lit("")).alias("items"))


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs(doc_id, text, ...) without an overlap, with their own columns."""
    source, items = _prepared(docs, benchmark, "doc_id", "text")
    bad = stored(found(source, items).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct(), "overlaps")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(F.col("_d")) & (F.xxhash64(docs["text"]) == F.col("_h")), "left_anti")


def op7(spark, sf_dir) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op7_decontamination": op7}
