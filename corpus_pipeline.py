"""The corpus pipeline: STAGES in order, each stored and read again as the next one's documents.

Quality rules, near-duplicates and benchmark overlaps take documents out, mixing repeats documents of small sources, and
sharding returns the placement. A stage works on all that the one before kept, and its result is a table of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenfold.llm.common import stored, table
from lumenfold.llm.op2_quality import kept_rows
from lumenfold.llm.op3_mixing import mix_documents
from lumenfold.llm.op4_sharding import balanced_shards
from lumenfold.llm.op6_neardup import near_duplicates
from lumenfold.llm.op7_decontaminate import clean_rows

#: Near-duplicate groups, spaced-seed hits and hash permutations have no plain SQL form; tests use brute force instead.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest doc_id."""
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed by temperature: every document once, those of small sources up to twice."""
    return mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each remaining row's shard and slot."""
    return balanced_shards(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("source_mixing", mix), ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
