"""Shared helpers: stored intermediate tables, table access, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumenfold.session import scratch_path

WORD_SPLIT = "[ \\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df once as Parquet below the shared folder and go on from the files, which outlive lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have: name, with underscores added while it clashes."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text) -> F.Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text column as an array; none where the text is null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), "")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges(a, b): rows (node, component), component being the smallest node reached.

    Every node has a parent, at first its smallest neighbour. In a round a node sees the smallest grandparent among its
    neighbours, hooks itself *and its parent* onto it, and takes its own grandparent as parent. Trees thus join by their
    roots and get flatter at once: a chain of n nodes, in whatever order its ids run, settles in about log2(n) rounds.
    Rounds go on until no parent changes; parents only ever get smaller, so this ends. Every round is a stored table, all
    joins and groups are by key. Nodes without an edge are absent.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("f")), "labels")
    while True:
        of = labels.select(F.col("node").alias("f"), F.col("f").alias("g"))
        known = labels.join(of, "f")
        near = both.join(known, F.col("b") == F.col("node")).groupBy("a").agg(F.min("g").alias("m"))
        step = known.join(near, F.col("node") == F.col("a")).select("node", "f", F.least("g", "m").alias("m"))
        hooks = step.groupBy(F.col("f").alias("root")).agg(F.min("m").alias("h"))
        new = stored(step.join(hooks, F.col("node") == F.col("root"), "left").select(
            "node", F.least("f", "m", "h").alias("f"), F.col("f").alias("old")), "labels")
        labels = new.select("node", "f")
        if not new.where("f <> old").limit(1).count():
            return labels.withColumnRenamed("f", "component")
