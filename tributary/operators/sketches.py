"""Numbers of keys, and overlaps of key sets, from sketches that merge.

A sketch is a few kilobytes for any number of keys. Those of folders, days or sources are kept as rows and merged at will, so
questions about keys need no second look at the data. Estimates are within ERROR of the truth, of the size of
the merged sets, with a chance of some 997 in 1000.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The logarithm of a sketch's registers.
LOG_K = 14
#: Three standard errors of an estimate.
ERROR = 3 * 1.04 / math.sqrt(1 << LOG_K)


def sketches(rows: DataFrame, key: str, *groups: str) -> DataFrame:
    """A sketch of the keys of each group; tasks send one sketch a group."""
    return rows.groupBy(*groups).agg(F.hll_sketch_agg(key, LOG_K).alias("sketch"))


def merged(parts: DataFrame, *groups: str) -> DataFrame:
    """The sketches of larger groups."""
    return parts.groupBy(*groups).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(parts: DataFrame) -> DataFrame:
    """The groups with `keys`, the number of distinct keys, in place of their sketches."""
    return parts.select(*[c for c in parts.columns if c != "sketch"], F.hll_sketch_estimate("sketch").alias("keys"))


def overlap(a: DataFrame, b: DataFrame) -> tuple[int, int, int]:
    """Distinct keys of a, of b, and of both; the latter within ERROR of the size of their union."""
    both = merged(a).select(F.col("sketch").alias("a")).crossJoin(merged(b).select(F.col("sketch").alias("b")))
    row = both.select(
        F.hll_sketch_estimate("a").alias("a"), F.hll_sketch_estimate("b").alias("b"), F.hll_sketch_estimate(F.hll_union("a", "b")).alias("any"),
    ).first()
    return row["a"] or 0, row["b"] or 0, max((row["a"] or 0) + (row["b"] or 0) - (row["any"] or 0), 0)


def layout(keys: int, row_bytes: int, *, slice_bytes: int = 4 << 30, file_bytes: int = 256 << 20, least_slices: int = 1) -> dict[str, int]:
    """Slices and buckets of a warehouse table for so many keys: a slice is what a task rewrites, a file its share of a folder."""
    size = keys * row_bytes
    slices = max(least_slices, -(-size // slice_bytes))
    return {"buckets": max(1, -(-size // (slices * file_bytes))), "slices": slices}
