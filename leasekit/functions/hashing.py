"""Deterministic hash buckets.

A row's bucket depends only on its key and a salt, never on partitioning or
task order, so splits, folds and samples are reproducible on any cluster size
and identical in any engine that has ``md5`` (the DuckDB oracle included).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_hash(key: Column, salt: str) -> Column:
    """Uniform value in [0, 1): first 32 bits of md5(salt || '|' || key) / 2^32."""
    h = F.md5(F.concat(F.lit(f"{salt}|"), key.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def bucket(key: Column, salt: str, n: int) -> Column:
    """Integer bucket in [0, n) from ``unit_hash``."""
    return F.floor(unit_hash(key, salt) * n).cast("int")
