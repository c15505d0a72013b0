"""Connected components of a link table, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reachmart.llm.common import join_by, stored


def connected_components(links: DataFrame) -> DataFrame:
    """Columns ``node``, ``root`` for every node of ``links`` (``a``, ``b``): the least node
    that is reachable.

    Alternates two steps until every node hangs on its root: each node sends its larger
    neighbours to the least node it sees, then its smaller ones. Nothing is collected but
    two numbers per step, and no neighbour list is ever built, so a node with very many
    links costs a grouped minimum and a join that adaptive execution can split. Null ends
    and links of a node to itself are left out.
    """
    pairs = (
        links.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .distinct()
    )
    pairs = stored(pairs, "links")
    before = None
    while True:
        state = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            return pairs
        before = state
        pairs = stored(_smaller(_larger(pairs)), "links")


def _larger(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.min(F.least("node", "root")).alias("least"))
    sent = join_by(both, least, "node").filter("root > node")
    return sent.select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()


def _smaller(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("node").agg(F.min("root").alias("least"))
    sent = join_by(pairs, least, "node").filter("root <> least")
    moved = sent.select(F.col("root").alias("node"), F.col("least").alias("root"))
    return moved.union(least.select("node", F.col("least").alias("root"))).distinct()
