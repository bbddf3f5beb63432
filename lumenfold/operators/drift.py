"""How far a current table has moved from a reference table, and how much a deployment is used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lumenfold.functions.ranking import exact_percentiles, prefix_sums
from lumenfold.operators.profile import unpivot

PSI_FLOOR = 1e-6


def _tagged(reference: DataFrame, current: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    return unpivot(reference, columns, kind).withColumn("is_ref", F.lit(1)).unionByName(
        unpivot(current, columns, kind).withColumn("is_ref", F.lit(0)))


def psi_of(ref: Column, cur: Column, ref_total: Column, cur_total: Column) -> Column:
    """One bin's term (c - r) ln(c / r), shares floored at 1e-6."""
    r = F.greatest(F.coalesce(ref, F.lit(0)) / ref_total, F.lit(PSI_FLOOR))
    c = F.greatest(F.coalesce(cur, F.lit(0)) / cur_total, F.lit(PSI_FLOOR))
    return (c - r) * F.ln(c / r)


def bin_number(value: Column, edges: Column) -> Column:
    """How many edges lie below value."""
    return F.size(F.filter(edges, lambda e: e < value))


def drift_psi(reference: DataFrame, current: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
              bins: int = 10) -> DataFrame:
    """Population stability index per feature: reference quantile bins for numbers, values for categories."""
    cells = []
    if numeric:
        probs = [i / bins for i in range(1, bins)]
        edges = exact_percentiles(unpivot(reference, numeric, "double"), F.col("value"), probs, ["feature"]) \
            .select("feature", F.array(*[f"q_{i}" for i in range(len(probs))]).alias("edges"))
        # one row per column of the table, so the broadcast does not grow with the rows
        rows = _tagged(reference, current, numeric, "double").join(F.broadcast(edges), "feature")
        cells.append(rows.select("feature", bin_number(F.col("value"), F.col("edges")).cast("string").alias("bin"), "is_ref"))
    if categorical:
        cells.append(_tagged(reference, current, categorical, "string").select("feature", F.col("value").alias("bin"), "is_ref"))
    if not cells:
        raise ValueError("name at least one column")
    long = cells[0] if len(cells) == 1 else cells[0].unionByName(cells[1])
    counts = long.groupBy("feature", "bin").agg(F.sum("is_ref").alias("r"), F.sum(1 - F.col("is_ref")).alias("c"))
    totals = counts.groupBy("feature").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    return counts.join(F.broadcast(totals), "feature").groupBy("feature").agg(
        F.sum(psi_of(F.col("r"), F.col("c"), F.nullif(F.col("nr"), F.lit(0)), F.nullif(F.col("nc"), F.lit(0)))).alias("psi"))


def drift_ks(reference: DataFrame, current: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Largest distance between the two distribution functions, per feature."""
    rows = _tagged(reference, current, numeric, "double")
    ranked = prefix_sums(rows, F.col("value"), {"r": F.col("is_ref"), "c": 1 - F.col("is_ref")}, ["feature"])
    gap = F.abs((F.col("r_below") + F.col("r")) / F.nullif(F.col("r_total"), F.lit(0))
                - (F.col("c_below") + F.col("c")) / F.nullif(F.col("c_total"), F.lit(0)))
    return ranked.groupBy("feature").agg(F.max(gap).alias("ks"))


def deployment_usage(log: DataFrame, ts: str, dims: Sequence[str] = ("role", "version"), totals: bool = False) -> DataFrame:
    """Predictions per day and dimension; with totals also the roll-up rows (NULL stands for all)."""
    rows = log.withColumn("day", F.to_date(ts))
    grouped = rows.rollup("day", *dims) if totals else rows.groupBy("day", *dims)
    return grouped.agg(F.count(F.lit(1)).alias("n"))


def project_counts(registry: DataFrame, project: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """Number of resources of each kind per project, in one aggregate."""
    return registry.groupBy(project).agg(*[
        F.count(F.when(F.col(kind) == k, 1)).alias(f"n_{k}") for k in kinds])
