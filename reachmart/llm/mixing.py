"""Mixing sources to target weights: raking to marginals, then calibrated sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reachmart.llm.common import BREAKS, numbered, renamed, stored, unit

# Topics by the form of the text: the first phrase list that a text contains names it.
TOPICS = [
    ("licence", ["licensed under", "Licensed under", "License", "Copyright", "copyright"]),
    ("contact", ["@"]),
    ("table", [" | "]),
    ("markup", ["%%%", "</", "{"]),
]
OTHER_TOPIC = "prose"
_CELLS = 50_000  # cells that one task may rake


def topic(text: Column) -> Column:
    """Topic of a text, by plain phrases; null text has the topic of other texts."""
    chosen = None
    for name, phrases in TOPICS:
        found = F.lit(False)
        for phrase in phrases:
            found = found | F.contains(text, F.lit(phrase))
        chosen = F.when(found, name) if chosen is None else chosen.when(found, name)
    return chosen.otherwise(OTHER_TOPIC)


def words(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), f"{BREAKS}+", -1)
    return F.size(F.array_remove(parts, "")).cast("long")


def _marked(name: str) -> Column:
    """A category as text that tells null from empty."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def rake(
    cells: DataFrame, dims: Sequence[str], power: float = 0.5, sweeps: int = 10, budget: float | None = None
) -> DataFrame:
    """``cells`` (the dims and ``tokens``) with ``share``, the raked share of each cell.

    The target of a category is its share of the tokens to the given power, scaled to one
    within its dimension. In turn, the shares of every dimension's categories are scaled to
    their targets. A sweep ends with the last dimension, so that marginal is met exactly.

    With a ``budget`` there is ``reachable``, too: shares raked in the same sweeps, none above
    what its cell has. A full cell stays at that, and the others of its category are scaled
    to what is left of the target. A category that has less than its target gives all.

    One factor per category and dimension is all that changes, so the cells stay in place
    and only the small factor tables are written in each step; nothing is collected. Cells
    that are few enough for one task carry their factors, and each step groups and merges
    them in that task: a shuffle or a broadcast per table and step fills the driver's memory.
    """
    cells = stored(cells.filter("tokens > 0"), "cells")
    total, n = cells.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not total:
        cells = cells.withColumn("share", F.lit(0.0))
        return cells if budget is None else cells.withColumn("reachable", F.lit(0.0))
    few = n <= _CELLS
    cells = cells.select(*dims, "tokens").coalesce(1) if few else cells
    factors = {}
    raked = cells

    def take(dim: str, found: DataFrame) -> None:
        """Puts the target and the factors of a dimension's categories in place of the last ones."""
        nonlocal raked
        if few:
            kept = raked.drop(*[c for c in found.columns if c != dim])
            raked = stored(kept.join(found.coalesce(1).hint("merge"), dim), "factors").coalesce(1)
        else:
            factors[dim] = stored(found, "factors")

    def with_factors() -> DataFrame:
        now = raked
        for dim in factors:
            now = now.join(factors[dim], dim)
        return now

    for dim in dims:
        sums = cells.groupBy(dim).agg(F.sum("tokens").alias("n"))
        weighted = sums.select(dim, F.pow(F.col("n") / F.lit(float(total)), F.lit(power)).alias("w"))
        whole = weighted.agg(F.sum("w")).first()[0]
        ones = [F.lit(1.0).alias(f"{letter}_{dim}") for letter in ("fg" if budget else "f")]
        take(dim, weighted.select(dim, (F.col("w") / F.lit(whole)).alias(f"target_{dim}"), *ones))
    start = F.col("tokens") / F.lit(float(total))

    def times(letter: str, among: Sequence[str]) -> Column:
        product = start
        for dim in among:
            product = product * F.col(f"{letter}_{dim}")
        return product

    # A cell is full where it would give all its tokens or more.
    most = start / F.lit(float(budget)) if budget else None
    for _ in range(sweeps):
        for dim in dims:
            others = [d for d in dims if d != dim]
            sums = [F.sum(times("f", others)).alias("n"), F.first(f"target_{dim}").alias("target")]
            if budget:
                rest, full = times("g", others), times("g", dims) >= most
                sums += [
                    F.sum(rest).alias("every"),
                    F.sum(F.when(full, 0.0).otherwise(rest)).alias("free"),
                    F.sum(F.when(full, most).otherwise(0.0)).alias("fixed"),
                    F.first(f"g_{dim}").alias("g"),
                ]
            target = F.col("target")
            scaled = [target.alias(f"target_{dim}"), (target / F.col("n")).alias(f"f_{dim}")]
            if budget:
                left = target - F.col("fixed")
                held = F.when(left <= 0, target / F.col("every")).when(F.col("free") > 0, left / F.col("free"))
                scaled.append(held.otherwise(F.col("g")).alias(f"g_{dim}"))
            take(dim, with_factors().groupBy(dim).agg(*sums).select(dim, *scaled))
    shares = [times("f", dims).alias("share")]
    if budget:
        shares.append(F.least(times("g", dims), most).alias("reachable"))
    return with_factors().select(*dims, "tokens", *shares)


def probabilities(raked: DataFrame, budget: float) -> DataFrame:
    """Adds ``weight``, the wanted tokens per token of the corpus, and ``probability``.

    ``budget`` is the wanted part of all tokens. A probability cannot exceed one; it follows
    the column ``reachable`` where there is one, else the share. What full cells cannot give
    and raking has not made up for, the others give in proportion, until the budget is met.
    """
    raked = stored(raked, "raked")
    given = "reachable" if "reachable" in raked.columns else "share"
    total = raked.agg(F.sum("tokens")).first()[0] or 0
    wanted = budget * total

    def per_token(share: str) -> Column:
        return F.when(F.col("tokens") > 0, F.lit(float(wanted)) * F.col(share) / F.col("tokens")).otherwise(0.0)

    raked = raked.withColumns({"weight": per_token("share"), "_given": per_token(given)})
    scale, full = 1.0, -1
    while total:
        over = F.col("_given") * F.lit(scale) >= 1
        cells, tokens, rest = raked.agg(
            F.count(F.when(over, 1)), F.sum(F.when(over, F.col("tokens")).otherwise(0)), F.sum(F.when(over, 0.0).otherwise(F.col(given)))
        ).first()
        if cells == full or not rest:
            break
        full, scale = cells, (wanted - tokens) / (wanted * rest)
    return raked.withColumn("probability", F.least(F.lit(1.0), F.col("_given") * F.lit(scale))).drop("_given")


def margins(chances: DataFrame, dims: Sequence[str], budget: float, power: float = 0.5) -> DataFrame:
    """How well a mixture meets its targets: ``dim``, ``category``, ``target`` and ``reached``
    (parts of the wanted tokens) and ``scarce``, whether the category has fewer tokens than
    its target asks for. ``chances`` are cells with ``tokens`` and ``probability``."""
    chances = chances.filter("tokens > 0")
    names = F.inline(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("category")) for d in dims]))
    given = (F.col("tokens") * F.col("probability")).alias("given")
    sums = chances.select("tokens", given, names).groupBy("dim", "category").agg(F.sum("tokens").alias("n"), F.sum("given").alias("given"))
    total = float(chances.agg(F.sum("tokens")).first()[0] or 0)
    sums = sums.withColumn("w", F.pow(F.col("n") / F.lit(total), F.lit(power)))
    scales = sums.groupBy("dim").agg(F.sum("w").alias("of"))
    target = F.col("w") / F.col("of")
    wanted = F.lit(budget * total)
    return sums.join(scales, "dim").select(
        "dim", "category", target.alias("target"), (F.col("given") / wanted).alias("reached"),
        (F.col("n") < target * wanted).alias("scarce"),
    )


def with_probability(
    docs: DataFrame, dims: Sequence[str], tokens: Column, budget: float, power: float = 0.5, sweeps: int = 10
) -> DataFrame:
    """Adds ``weight`` and ``probability`` to every row, by its cell of ``dims``.

    Rows without tokens have no share in any margin: both are 0.
    """
    keys = [f"_dim{i}" for i in range(len(dims))]
    marked = docs.withColumns({**{k: _marked(d) for k, d in zip(keys, dims)}, "_tokens": tokens})
    cells = marked.groupBy(*keys).agg(F.sum("_tokens").alias("tokens"))
    chances = stored(probabilities(rake(cells, keys, power, sweeps, budget), budget), "chances")
    chances = chances.select(*[F.col(k).alias(f"{k}_c") for k in keys], "weight", "probability")
    # The hash takes the join off the partitioning of one key, so a hot cell can be split.
    same = F.xxhash64(*keys) == F.xxhash64(*[F.col(f"{k}_c") for k in keys])
    for k in keys:
        same = same & (F.col(k) == F.col(f"{k}_c"))
    joined = marked.drop("weight", "probability").join(chances, same, "left")
    some = F.col("_tokens") > 0
    return joined.withColumns(
        {name: F.when(some, F.coalesce(name, F.lit(0.0))).otherwise(0.0) for name in ("weight", "probability")}
    ).drop(*keys, *[f"{k}_c" for k in keys])


def drawn(doc_id: Column, text: Column, seed: str) -> Column:
    """The number from 0 to 1 that decides on a document: fixed by seed and id, or by the
    text where the id is null."""
    return unit(seed, F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))


RESULTS = ("topic", "n_tokens", "weight", "probability", "sampled")


def _mixed(docs: DataFrame, place: dict[str, str], budget: float, power: float, sweeps: int, seed: str) -> DataFrame:
    """Numbered columns and the results."""
    doc_id, text, source, lang = (F.col(place[name]) for name in ("doc_id", "text", "source", "lang"))
    # The draw comes before the join, which then needs no text for it.
    frame = docs.withColumns(
        {"topic": topic(text), "n_tokens": words(text), "source": source, "lang": lang, "_draw": drawn(doc_id, text, seed)}
    )
    chance = with_probability(frame, ["source", "lang", "topic"], F.col("n_tokens"), budget, power, sweeps)
    return chance.withColumn("sampled", F.col("_draw") < F.col("probability"))


def mix(docs: DataFrame, budget: float = 0.5, power: float = 0.5, sweeps: int = 10, seed: str = "mix") -> DataFrame:
    """Every row with ``topic``, ``n_tokens``, ``weight``, ``probability`` and ``sampled``.

    * Null sources and languages are categories of their own, apart from the empty text.
    * ``weight`` is what the targets ask of a token and may exceed one; ``probability`` is raked
      with full cells held at one, see ``rake``. ``margins`` says what is reached.
    * A text without words (null, empty) has no tokens to weigh and is never sampled. A very
      long text counts with all its words.
    * Rows that repeat an id are drawn alike. An empty table stays empty.
    * Columns named like a result are replaced; others pass through.
    """
    rows, place = numbered(docs, RESULTS)
    return renamed(_mixed(rows, place, budget, power, sweeps, seed), place, *RESULTS)


def sample(docs: DataFrame, budget: float = 0.5, power: float = 0.5, sweeps: int = 10, seed: str = "mix") -> DataFrame:
    """The sampled rows of ``docs`` with the same columns."""
    rows, place = numbered(docs)
    return renamed(_mixed(rows, place, budget, power, sweeps, seed).filter("sampled"), place)
