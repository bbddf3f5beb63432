"""Mixing sources by temperature: weights from exponentiated token shares, realised as budgeted block permutations.

Shares p of the sources' tokens become weights w proportional to p ** a. The exponent a in [0, 1] is found by bisection
(in SECTIONS parts at a time, one small aggregate each) for a target entropy or for a limit on repetition. The budget is
the smallest that shows every source at least once, so nothing is dropped: the source with the least weight per token
gets one pass, the others up to max_passes.

A source's stream is one random permutation after another of all its documents (one per pass, the last one cut where the
budget is used up), and the mix is cut into blocks: block b takes the same share of every source's stream, so each block
carries the weights. Positions are running totals of tokens over hash buckets; no source is gathered in one task.

Cases: tokens are words; a null or blank text has none and takes the place where its hash falls in every pass. A null
source is a source of its own. Repeated rows are rows of their own. An empty table gives no rows; if no row has a token,
every row is used once. Extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenfold.llm.common import stored, table, words
from lumenfold.llm.op4_sharding import BUCKET_ROWS, running

SECTIONS, STEPS, MAX_PASSES, BLOCK_TOKENS = 16, 6, 2.0, 1 << 20


def _measures(sources: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """{exponent: (entropy of the weights, most passes over a source)} from sources(share)."""
    rows = sources.where("share > 0").select("share", F.explode(F.array(*[F.lit(a) for a in exponents])).alias("a")).withColumn("x", F.pow("share", "a"))
    per = rows.groupBy("a").agg(F.sum("x").alias("z"), F.sum(F.col("x") * F.log("x")).alias("e"), F.max(F.col("x") / F.col("share")).alias("hi"),
                                F.min(F.col("x") / F.col("share")).alias("lo"))
    return {r.a: (math.log(r.z) - r.e / r.z, r.hi / r.lo) for r in per.collect()}


def exponent(sources: DataFrame, max_passes: float | None = MAX_PASSES, entropy: float | None = None) -> float:
    """The smallest exponent whose repetition is within max_passes, or the one whose weights have this entropy (nats)."""
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        grid = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        got = _measures(sources, grid)
        if not got:
            return 1.0
        fine = [a for a in grid if (got[a][0] <= entropy if entropy is not None else got[a][1] <= max_passes + 1e-12)]
        high = min(fine, default=1.0)
        if high == low:
            break
        low = max([a for a in grid if a < high], default=low)
    return high


def plan(rows: DataFrame, max_passes: float | None = MAX_PASSES, entropy: float | None = None) -> DataFrame:
    """source, total (tokens), weight and passes of each source of rows(source, tokens)."""
    totals = stored(rows.groupBy("source").agg(F.sum("tokens").alias("total")), "sources")
    whole = totals.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    sources = totals.withColumn("share", F.col("total") / F.lit(float(max(1, whole))))
    a = exponent(sources, max_passes, entropy)
    sums = sources.where("share > 0").agg(F.sum(F.pow("share", F.lit(a))), F.min(F.pow("share", F.lit(a)) / F.col("share"))).first()
    z, least = (sums[0], sums[1]) if sums[0] else (1.0, 1.0)
    passes = F.when(F.col("share") > 0, F.pow("share", F.lit(a)) / F.col("share") / F.lit(least)).otherwise(1.0)
    return sources.select("source", "total", F.when(F.col("share") > 0, F.pow("share", F.lit(a)) / F.lit(z)).otherwise(0.0).alias("weight"),
                          F.round(passes, 9).alias("passes"))


def mixed(rows: DataFrame, seed: int = 0, max_passes: float | None = MAX_PASSES, entropy: float | None = None,
          block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """rows(doc_id, text_hash, source, tokens), once for each use: with copy, weight, block."""
    n = rows.count()
    planned = plan(rows, max_passes, entropy)
    used = planned.agg(F.coalesce(F.sum(F.col("total") * F.col("passes")), F.lit(0.0))).first()[0]
    blocks = max(1, -(-int(used) // block_tokens))
    p = planned.select(F.col("source").alias("s"), "total", "weight", "passes")
    # one row for each source: Spark broadcasts them while they are few, and splits a hot source's rows otherwise
    every = rows.join(p, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    every = every.withColumn("copy", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("passes"), F.lit(1)).cast("int") - 1)))
    every = every.withColumn("r", F.xxhash64(F.lit(seed), "copy", "doc_id", "text_hash"))
    every = running(every, ["source", "copy"], "tokens", max(16, n // BUCKET_ROWS), ["r"])
    at = (F.col("copy") + F.when(F.col("total") > 0, F.col("before") / F.col("total")).otherwise(0.0)) / F.col("passes")
    return every.withColumn("at", at).where("at < 1 or copy = 0").select(
        "doc_id", "text_hash", "source", "tokens", "copy", "weight", "r",
        F.least(F.floor(F.col("at") * blocks), F.lit(blocks - 1)).cast("long").alias("block"))


def token_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    text: Column = F.col(text_col)
    return stored(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(source_col).alias("source"),
                              F.size(words(text)).cast("long").alias("tokens")), "tokens")


def op3(spark, sf_dir) -> DataFrame:
    """Every use of every document: its block and its slot in the block's permutation."""
    rows = mixed(token_rows(table(spark, sf_dir, "documents")))
    slot = F.row_number().over(Window.partitionBy("block").orderBy("r", "doc_id")) - 1
    return rows.select("doc_id", "source", "tokens", "copy", F.round("weight", 9).alias("weight"), "block", slot.cast("long").alias("slot"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs(doc_id, text, source, ...), each as often as the mix uses it.

    Rows with the same doc_id, text and source get the same number of copies, the largest of theirs.
    """
    uses = mixed(token_rows(docs), **options).groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), F.col("source").alias("_s")).agg(
        (F.max("copy") + 1).alias("_n"))
    same = docs["doc_id"].eqNullSafe(F.col("_d")) & (F.xxhash64(docs["text"]) == F.col("_h")) & docs["source"].eqNullSafe(F.col("_s"))
    return docs.join(uses, same).withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*[docs[c] for c in docs.columns])


QUERIES = {"op3_source_mixing": op3}
