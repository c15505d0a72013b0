"""Shards that all hold the mixture of sources: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reachmart.llm.common import join_by, numbered, renamed, stored


def interleave(
    docs: DataFrame,
    shards: int = 8,
    seed: str = "0",
    stratum: str = "source",
    order: tuple[str, ...] = ("doc_id", "text"),
    bucket_rows: int = 2_000,
) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0, without gaps).

    Rows are shuffled within their source by a seeded hash of the ``order`` columns. The row
    at rank r of n has the fractional rank (r + phase) / n, where the phase, from 0 to 1, is
    fixed by the source; sorted by it, every stretch holds each source in proportion, up to
    one row. The sorted rows are cut into shards whose sizes differ by at most one.

    Ranks are counted without sorting a source or the table in one task: rows fall into
    buckets of about ``bucket_rows`` by their hash (then by their fractional rank), a
    running sum over the bucket sizes gives each bucket's first rank, and only the rows
    of one bucket are sorted together.

    * Null sources are a source of their own, different from the empty text.
    * Rows that agree in all ``order`` columns and the source may change places with each
      other. A null in an ``order`` column is a value like any other.
    * Columns named ``shard`` and ``slot`` are replaced. An empty table stays empty.
    """
    rows, place = numbered(docs, ("shard", "slot"))
    names, order = list(place.values()), tuple(place[name] for name in order)
    source = F.col(place[stratum]).cast("string")
    rows = rows.withColumns(
        {
            "_key": F.coalesce(F.concat(F.lit("="), source), F.lit("")),
            "_h": F.xxhash64(F.lit(seed), *order),
        }
    )
    total = docs.count()
    buckets = max(1, -(-total // bucket_rows))
    rows = rows.withColumn("_bucket", _bucket(_fraction(F.col("_h")), buckets))

    sizes = rows.groupBy("_key", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    of_key = Window.partitionBy("_key")
    offsets = sizes.select(
        "_key",
        "_bucket",
        _rows_before(of_key.orderBy("_bucket")).alias("_before"),
        F.sum("_rows").over(of_key).alias("_n"),
    )
    within = Window.partitionBy("_key", "_bucket").orderBy("_h", *order)
    rank = F.col("_before") + F.row_number().over(within) - 1
    phase = _fraction(F.xxhash64(F.lit(seed), F.lit("phase"), "_key"))
    ranked = rows.join(offsets, ["_key", "_bucket"]).withColumn("_frac", (rank + phase) / F.col("_n"))
    ranked = stored(
        ranked.select(*names, "_key", "_h", "_frac", _bucket(F.col("_frac"), buckets).alias("_bucket")), "ranked"
    )

    sizes = ranked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select("_bucket", _rows_before(Window.orderBy("_bucket")).alias("_before"))
    within = Window.partitionBy("_bucket").orderBy("_frac", F.xxhash64(F.lit(seed), "_key"), "_key", "_h", *order)
    position = F.col("_before") + F.row_number().over(within) - 1
    placed = join_by(ranked, offsets, "_bucket").withColumn("_place", position)
    shard = F.expr(f"cast(_place * {shards} div {max(total, 1)} as int)")
    start = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    cut = placed.withColumn("shard", shard).withColumn("slot", F.col("_place") - start)
    return renamed(cut, place, "shard", "slot")


def _fraction(hashed: Column) -> Column:
    """A 64-bit hash as a number from 0 (included) to 1 (excluded)."""
    return F.shiftrightunsigned(hashed, 11).cast("double") / float(1 << 53)


def _bucket(fraction: Column, buckets: int) -> Column:
    return F.least(F.floor(fraction * buckets), F.lit(buckets - 1)).cast("long")


def _rows_before(window) -> Column:
    before = F.sum("_rows").over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(before, F.lit(0))
