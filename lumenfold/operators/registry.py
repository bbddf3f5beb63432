"""Questions to tables of models, versions, runs and prediction results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lumenfold.functions.skew import hot_key_join
from lumenfold.operators.profile import top_per_group
from lumenfold.session import cut_lineage


def tagged_model(models: DataFrame, experiment: Sequence[str], model: str, position: str, is_tagged: Column,
                 name: str) -> DataFrame:
    """Per experiment the last model carrying the tag, else its first model. No window: it combines before the shuffle."""
    return models.groupBy(*experiment).agg(F.coalesce(
        F.max_by(model, F.when(is_tagged, F.col(position))), F.min_by(model, position)).alias(name))


def best_model(models: DataFrame, experiment: Sequence[str], model: str, position: str, tags: str) -> DataFrame:
    require_models(models)
    return tagged_model(models, experiment, model, position, F.array_contains(tags, "best"), "best_model")


def fastest_model(models: DataFrame, experiment: Sequence[str], model: str, position: str, tags: str) -> DataFrame:
    require_models(models)
    return tagged_model(models, experiment, model, position, F.array_contains(tags, "fastest"), "fastest_model")


def require_models(models: DataFrame) -> None:
    if models.isEmpty():
        raise ValueError("no model in the experiment")


def latest_version(versions: DataFrame, experiment: str, version: str, created_at: str) -> DataFrame:
    """Newest version per experiment; equal times go to the larger version."""
    newest = F.struct(F.col(created_at), F.col(version))
    return versions.groupBy(experiment).agg(F.max(newest).alias("_n")) \
        .select(experiment, F.col(f"_n.{version}").alias("latest"), F.col(f"_n.{created_at}").alias(created_at))


def version_lineage(versions: DataFrame, version: str, parent: str, max_rounds: int = 64) -> DataFrame:
    """(version, root, depth) by doubling the known distance each round: log2(longest chain) joins.

    Rows that reached their root leave the join; the shared ancestors they pile up on are joined as hot keys.
    """
    state = cut_lineage(versions.select(
        F.col(version).alias("id"), F.coalesce(F.col(parent), F.col(version)).alias("anc"),
        F.when(F.col(parent).isNull(), 0).otherwise(1).alias("depth"), F.col(parent).isNotNull().alias("open")))
    for _ in range(max_rounds):
        going = state.where("open")
        if going.isEmpty():
            return state.select(F.col("id").alias(version), F.col("anc").alias("root"), "depth")
        ahead = state.select(F.col("id").alias("anc"), F.col("anc").alias("anc2"), F.col("depth").alias("depth2"),
                             F.col("open").alias("open2"))
        moved = hot_key_join(going, ahead, ["anc"]).select(
            "id", F.coalesce("anc2", "anc").alias("anc"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"),
            F.coalesce("open2", F.lit(False)).alias("open"))
        state = cut_lineage(state.where(~F.col("open")).unionByName(moved))
    raise ValueError("the parent chain has a cycle")


def new_version(base: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Copy of each configuration row with the given fields replaced."""
    unknown = [c for c in overrides.columns if c not in base.columns]
    if unknown:
        raise ValueError(f"overrides of unknown fields {unknown}")
    fields = [c for c in overrides.columns if c != key]
    renamed = overrides.select(key, *[F.col(c).alias(f"_new_{c}") for c in fields])
    return base.join(renamed, key, "left").select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in fields else F.col(c) for c in base.columns])


def recent_runs(runs: DataFrame, run: str, ts: str, tie: str, limit: int = 15) -> DataFrame:
    """The most recent executions of each run."""
    if limit < 1:
        raise ValueError("limit must be positive")
    return top_per_group(runs, [run], [F.desc(ts), F.desc(tie)], limit, "recency")


def collect_predictions(tables: dict[str, DataFrame], source: str = "source") -> DataFrame:
    """All prediction tables as one; columns a table lacks are NULL."""
    if not tables:
        raise ValueError("no prediction table")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [t.withColumn(source, F.lit(name)) for name, t in tables.items()])
