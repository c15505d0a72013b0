"""Joining records to a set of keys, where the records may be skewed.

The keys are distinct, so no key multiplies rows; the records keep one row each, and a hot
or missing key makes one long run of them. Adaptive execution splits such a run by size, but
only if both sides of the sort-merge join come straight from a shuffle. Distinct keys come
from an aggregate, whose partitioning a join on the key alone would take over. The join
therefore uses the key together with its hash: that asks for a shuffle of its own on both
sides, which for the key side moves one narrow, deduplicated column.

Whether a side is small enough to be broadcast instead is left to Spark's size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def key_set(rows: DataFrame, key: Column) -> DataFrame:
    """Distinct non-null keys as text: an id read as a number and one read as text agree."""
    return rows.select(key.cast("string").alias("key")).filter(F.col("key").isNotNull()).distinct()


def join_keys(rows: DataFrame, key: Column, keys: DataFrame, how: str) -> DataFrame:
    """``rows`` joined to a ``key_set``; inner and left joins add the column ``key``."""
    text = key.cast("string")
    hashed = keys.withColumn("_hash", F.xxhash64("key"))
    joined = rows.join(hashed, (F.xxhash64(text) == F.col("_hash")) & (text == F.col("key")), how)
    return joined.drop("_hash")
