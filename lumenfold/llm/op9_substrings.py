"""Repeated passages: windows of 50 words that also start in an earlier document are cut out, by a count-min prefilter.

Every window is known by its minimizer, the smallest hash of the 16-word grams in it, so equal windows have equal
minimizers. Neighbouring windows with one minimizer form a run (about 17 windows).

Pass 1: each partition sketches in how many documents each minimizer occurs (saturating counters, DEPTH rows); the merged
sketch never underestimates, so a window whose minimizer is estimated below two documents repeats nowhere.
Pass 2: only runs estimated repeated go on. They are grouped by their content, known by 128 bits (of runs the minimizer and a hash
of all windows, of windows two rolling hashes; a false match among 1e12 windows has a chance below 1e-14): a run that an earlier document has
as well is removed whole. A run that is the first of its content, but shares its minimizer with other runs, is opened and
its windows are grouped one by one. Nothing is lost, whatever the sketch says: its width only decides how much pass 2 sees.

Cases: null, empty and short texts lose nothing. Rows that repeat a doc_id never cut each other, but each is cut by earlier
documents. Rows with a null doc_id neither cut nor are cut. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lumenfold.llm.common import stored, table
from lumenfold.llm.wordhash import SECOND, folded, mix, pieces

WINDOW, GRAM, DEPTH = 50, 16, 2
#: Counters in a row of the sketch: two for each expected minimizer, within these bounds (the merged bits take 16 MB at most).
MIN_BITS, MAX_BITS, BLOCK_BITS = 16, 26, 16
FLUSH = 1 << 20
RUNS_SCHEMA = ("doc_id long, text_hash long, n_words long, sha string, "
               "runs array<struct<mini:long,content:long,start:int,size:int>>")


def minimizers(piece, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(first words, smallest gram hash) of every window."""
    at = piece.starts_of(window)
    if not len(at):
        return at, np.empty(0, np.uint64)
    low, span, width = piece.rolling(gram), 1, window - gram + 1
    while 2 * span <= width:
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    if span < width:
        low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    return at, low[at]


def runs(piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, windows, minimizer, content hash) of every run of windows with one minimizer."""
    at, mini = minimizers(piece)
    if not len(at):
        return at, at, mini, mini
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (mini[1:] != mini[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at)))
    return at[first], size, mini[first], folded(piece.rolling(WINDOW)[at], first, size)


def cells(mini: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(mini ^ np.uint64(row + 1)) >> np.uint64(64 - bits)).astype(np.int64)


def partition_sketch(bits: int):
    """Sketch of a partition as sparse blocks: (row * blocks + block, cells in it, counts up to 2)."""
    def flush(found):
        mini = np.concatenate(found)
        for row in range(DEPTH):
            cell, n = np.unique(cells(mini, row, bits), return_counts=True)
            block = cell >> BLOCK_BITS
            at = np.flatnonzero(np.diff(block, prepend=-1))
            ends = np.append(at[1:], len(cell)).astype(np.int32)
            bounds = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[at] + (row << max(0, bits - BLOCK_BITS))),
                 pa.ListArray.from_arrays(bounds, pa.array((cell & ((1 << BLOCK_BITS) - 1)).astype(np.int32))),
                 pa.ListArray.from_arrays(bounds, pa.array(np.minimum(n, 2).astype(np.int8)))], ["block", "cells", "counts"])

    def sketch(batches):
        found, held = [], 0
        for batch in batches:
            for p in pieces(batch.column("text")):
                start, _, mini, _ = runs(p)
                row = np.searchsorted(p.first, start, "right")
                order = np.lexsort((mini, row))
                row, mini = row[order], mini[order]
                new = np.ones(len(mini), bool)
                new[1:] = (row[1:] != row[:-1]) | (mini[1:] != mini[:-1])
                found.append(mini[new])
                held += int(new.sum())
                if held >= FLUSH:
                    yield from flush(found)
                    found, held = [], 0
        if held:
            yield from flush(found)
    return sketch


def merge_blocks(batches):
    """Add up the partitions' blocks, one dense block of counters at a time per key; bits: counted twice or more."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        key = batch.column("block").to_numpy()
        cell, count = batch.column("cells"), batch.column("counts")
        for i in range(len(key)):
            t = total.setdefault(int(key[i]), np.zeros(1 << BLOCK_BITS, np.uint8))
            c = cell[i].values.to_numpy()
            t[c] = np.minimum(t[c] + count[i].values.to_numpy().astype(np.uint8), 2)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([np.packbits(t > 1).tobytes() for t in total.values()],
                                                                                 pa.binary())], ["block", "bits"])


def merged_sketch(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(bits of a row's width, packed bits of all rows: estimated in two documents or more)."""
    size = docs.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    bits = int(np.clip(np.ceil(np.log2(2 * size / 100 + 1)), MIN_BITS, MAX_BITS))
    # docs that repeat a doc_id count twice here: an overestimate, as any other
    parts = docs.select("text").mapInArrow(partition_sketch(bits), "block long, cells array<int>, counts array<byte>")
    blocks = parts.repartition("block").mapInArrow(merge_blocks, "block long, bits binary")
    out = np.zeros((DEPTH << bits) // 8, np.uint8)
    for r in blocks.toLocalIterator():  # at most DEPTH * 2 ** MAX_BITS bits
        out[r.block << (BLOCK_BITS - 3):(r.block + 1) << (BLOCK_BITS - 3)] = np.frombuffer(r.bits, np.uint8)
    return bits, out


def repeated_runs(bits: int, shared):
    def rows(batches):
        packed = shared.value
        for batch in batches:
            for p in pieces(batch.column("text")):
                start, size, mini, content = runs(p)
                often = np.ones(len(mini), bool)
                for row in range(DEPTH):
                    c = cells(mini, row, bits) + (row << bits)
                    often &= (packed[c >> 3] >> (7 - (c & 7)).astype(np.uint8) & 1).astype(bool)
                start, size, mini, content = start[often], size[often], mini[often], content[often]
                row = np.searchsorted(p.first, start, "right") - 1
                text = p.data.tobytes()
                sha = [hashlib.sha256(b" ".join(text[a:b].split())).hexdigest() for a, b in zip(p.offsets[:-1], p.offsets[1:])]
                struct = pa.StructArray.from_arrays(
                    [pa.array(mini.view(np.int64)), pa.array(content.view(np.int64)), pa.array((start - p.first[row]).astype(np.int32)),
                     pa.array(size.astype(np.int32))], ["mini", "content", "start", "size"])
                own = pa.ListArray.from_arrays(np.searchsorted(row, np.arange(p.rows + 1)).astype(np.int32), struct)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(p.row, p.rows), batch.column("text_hash").slice(p.row, p.rows),
                     pa.array(p.counts.astype(np.int64)), pa.array(sha), own], ["doc_id", "text_hash", "n_words", "sha", "runs"])
    return rows


def opened(batches):
    """The windows of the chosen runs, one row each."""
    for batch in batches:
        spans, ids, hashes = batch.column("spans"), batch.column("doc_id"), batch.column("text_hash")
        for p in pieces(batch.column("text")):
            every, other, found = p.rolling(WINDOW), p.rolling(WINDOW, SECOND), []
            for r in range(p.rows):
                s = spans[p.row + r].values
                start, size = s.field("start").to_numpy(), s.field("size").to_numpy()
                found.append(np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
            at, row = np.concatenate(found), np.repeat(np.arange(p.rows), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(every[p.first[row] + at].view(np.int64)), pa.array(other[p.first[row] + at].view(np.int64)), ids.take(pa.array(p.row + row)), hashes.take(pa.array(p.row + row)),
                 pa.array(at.astype(np.int32))], ["window", "again", "doc_id", "text_hash", "start"])


def cut(batches):
    """Remove the words that the spans' windows cover."""
    for batch in batches:
        removed, sha = [], []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            words = text.as_py().encode().split()
            depth = np.zeros(len(words) + 1, np.int64)
            start, size = (spans.values.field(x).to_numpy() for x in ("start", "size"))
            np.add.at(depth, start, 1)
            np.add.at(depth, start + size + WINDOW - 1, -1)
            gone = np.cumsum(depth)[:-1] > 0
            removed.append(int(gone.sum()))
            sha.append(hashlib.sha256(b" ".join([words[i] for i in np.flatnonzero(~gone)])).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(removed, pa.int64()), pa.array(sha)],
                                         ["doc_id", "text_hash", "n_removed", "cut_sha"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for each row of docs; see the module's docstring."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.col(text_col)).alias("text_hash"))
    bits, packed = merged_sketch(source.where("doc_id is not null"))
    base = stored(source.mapInArrow(repeated_runs(bits, spark.sparkContext.broadcast(packed)), RUNS_SCHEMA), "runs")
    run = base.where("doc_id is not null").select("doc_id", "text_hash", F.explode("runs").alias("r")).select("doc_id", "text_hash", "r.*")
    # all windows of a run have its minimizer and content: one row for each content, with the first document that has it
    first = stored(run.groupBy("mini", "content").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")), "contents")
    whole = run.join(first.where("lo < hi"), ["mini", "content"]).where("lo < doc_id").select("doc_id", "text_hash", "start", "size")
    several = first.groupBy("mini").agg(F.min("lo").alias("a"), F.max("lo").alias("b")).where("a < b").select("mini")
    heads = first.join(several, "mini", "left_semi").select("mini", "content", F.col("lo").alias("doc_id"))
    part = run.join(heads, ["mini", "content", "doc_id"], "left_semi").groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("start", "size")).alias("spans"))
    window = stored(part.join(source, ["doc_id", "text_hash"])
                    .select("doc_id", "text_hash", "spans", "text")
                    .mapInArrow(opened, "window long, again long, doc_id long, text_hash long, start int"), "windows")
    earlier = window.groupBy("window", "again").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    single = window.join(earlier, ["window", "again"]).where("lo < doc_id").select("doc_id", "text_hash", "start", F.lit(1).alias("size"))
    gone = whole.union(single).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    done = gone.join(source, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "spans", "text").mapInArrow(
        cut, "doc_id long, text_hash long, n_removed long, cut_sha string").dropDuplicates(["doc_id", "text_hash"])
    return base.drop("runs").join(done, ["doc_id", "text_hash"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("cut_sha", "sha").alias("kept_sha256"))


def op9(spark, sf_dir) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


QUERIES = {"op9_repeated_passages": op9}
