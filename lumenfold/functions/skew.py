"""Joins against lookup tables that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from lumenfold.session import cut_lineage

BROADCAST_ROWS = 200_000
HOT_SHARE = 1e-3


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores before heavy row work, if the input has fewer splits than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True if df is known to have at most max_rows rows (counts at most one row more than that)."""
    return df.limit(max_rows + 1).count() <= max_rows


def hot_key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join to a table that is unique on keys.

    Keys above HOT_SHARE of the left rows number fewer than 1/HOT_SHARE, so their right rows are a bounded
    broadcast; all other keys go through a normal shuffled join. Rows with a NULL key find nothing and are not shuffled.
    """
    keys = list(keys)
    no_key = reduce(or_, [left[k].isNull() for k in keys])
    partnerless, left = left.where(no_key), left.where(~no_key)
    counts = left.groupBy(*keys).count()
    total = left.select(F.count(F.lit(1)).alias("n")).scalar()
    hot = F.broadcast(counts.where(F.col("count") > F.greatest(total * F.lit(HOT_SHARE), F.lit(1000))).select(*keys))
    right_hot = F.broadcast(right.join(hot, keys, "left_semi"))
    left_hot = left.join(hot, keys, "left_semi").join(right_hot, keys, how)
    left_cold = left.join(hot, keys, "left_anti").join(right, keys, how)
    out = left_cold.unionByName(left_hot)
    if how not in ("left", "left_outer", "leftouter"):
        return out
    new = [f for f in right.schema.fields if f.name not in keys]
    return out.unionByName(partnerless.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new]))


def lookup_join(left: DataFrame, mapping: DataFrame, keys: Sequence[str], how: str = "left",
                max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join to a computed lookup table, unique on keys: broadcast if counted small, else a hot-key join.

    The lookup is written once, so the size check does not compute it a second time.
    """
    mapping = cut_lineage(mapping)
    if fits_broadcast(mapping, max_rows):
        return left.join(F.broadcast(mapping), list(keys), how)
    return hot_key_join(left, mapping, keys, how)
