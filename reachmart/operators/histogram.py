"""Equal-width histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def histogram(rows: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per bin between the column's minimum and maximum; nulls have no bin.

    Both limits come from one scalar subquery over the same rows: it shares their shuffle,
    and no join is involved. Where all values are equal there is one bin.
    """
    rows = rows.select(F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
    low = rows.select(F.min("x")).scalar()
    high = rows.select(F.max("x")).scalar()
    width = (high - low) / bins
    last, only = F.lit(bins - 1).cast("bigint"), F.lit(0).cast("bigint")
    bin_no = F.when(high == low, only).otherwise(F.least(F.floor((F.col("x") - low) / width), last))
    counts = rows.groupBy(bin_no.alias("bin")).agg(F.count("*").alias("customers"))
    return counts.select("bin", (low + F.col("bin") * width).alias("bin_start"), "customers")
