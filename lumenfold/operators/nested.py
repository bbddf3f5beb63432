"""Templates of typed steps held as JSON, and the import-sample-export chain they describe."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lumenfold.operators.roles import sample

# Fixed format: the fields of a template that carry node properties.
TEMPLATE_SCHEMA = ("nodes array<struct<_id string, pipeline_component_id struct<metadata struct<name string>, "
                   "interfaces struct<properties array<struct<name string, type string, hidden boolean>>>>>>")


def node_properties(templates: DataFrame, template_id: str, body: str) -> DataFrame:
    """Per node of each template: id, component name and map of property -> type; hidden properties are left out."""
    nodes = templates.select(template_id, F.explode(F.from_json(body, TEMPLATE_SCHEMA)["nodes"]).alias("n"))
    shown = F.filter(F.col("n.pipeline_component_id.interfaces.properties"),
                     lambda p: ~F.coalesce(p["hidden"], F.lit(False)))
    return nodes.select(template_id, F.col("n._id").alias("node_id"),
                        F.col("n.pipeline_component_id.metadata.name").alias("name"),
                        F.map_from_entries(F.transform(shown, lambda p: F.struct(p["name"], p["type"]))).alias("properties"))


def node_params_to_rows(nodes: DataFrame, node_id: str, properties: str | Column) -> DataFrame:
    """{name: value} of each node as rows (name, value)."""
    return nodes.select(node_id, F.explode(F.map_entries(properties)).alias("e")) \
        .select(node_id, F.col("e.key").alias("name"), F.col("e.value").alias("value"))


def run_template(load: Callable[[], DataFrame], ratio: float, keys: Sequence[str],
                 export: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """import -> sample(ratio) -> export; returns the sampled table."""
    out = sample(load(), float(ratio), keys)
    if export is not None:
        export(out)
    return out
