"""Key-hash buckets: the same split on every run, every engine and every partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

HASH_SPAN = 1 << 32


def key_hash(*keys: str | Column, salt: str = "") -> Column:
    """First 32 bits of md5(key [| key ...] salt) as a non-negative bigint."""
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    text = reduce(lambda a, b: F.concat(a, F.lit("|"), b), parts)
    if salt:
        text = F.concat(text, F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_bucket(n: int, *keys: str | Column, salt: str = "") -> Column:
    return key_hash(*keys, salt=salt) % F.lit(n)


def hash_share(*keys: str | Column, salt: str = "") -> Column:
    """Key hash scaled to [0, 1)."""
    return key_hash(*keys, salt=salt) / F.lit(float(HASH_SPAN))
