"""SimHash fingerprints of weighted terms, and their neighbours by permuted block tables."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reachmart.llm.common import BREAKS, join_by, stored

BITS = 128  # a fingerprint's two halves are the columns ``high`` and ``low``
HALVES = (("high", 43), ("low", 42))  # with the seeds of their term hashes
RARE = 10  # a term in fewer than 1 of 2 ** RARE documents counts as this rare
STEP = 4  # weights are whole numbers of 1 / STEP bits
HEAVIEST = 255
BROADCAST_ROWS = 1_000_000  # rows of the table of frequent terms that are sent to every task
_LANES = 0x0000000100000001  # two counters of 32 bits share a sum


# --- terms and weights --------------------------------------------------------------------


def _hashes(text: Column) -> Column:
    """The sorted hashes of a text's words, one per occurrence."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BREAKS}+", -1), "")
    return F.sort_array(F.transform(words, lambda word: F.xxhash64(word)))


def frequent_terms(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns ``term`` (a hash) and ``bits``: how many bits of surprise the term's presence
    in a document carries, log2 of documents by documents with it.

    Only terms in at least one of 2 ** RARE documents are listed, of which there are at
    most 2 ** RARE times the mean number of terms of a document, however large the table.
    """
    total = docs.count()
    terms = docs.select(F.explode(F.array_distinct(_hashes(F.col(text)))).alias("term"))
    counted = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * (1 << RARE) >= total)
    bits = F.log2(F.lit(float(total)) / F.col("n"))
    return counted.select("term", F.greatest(bits, F.lit(1 / STEP)).alias("bits"))


def _votes(rows: DataFrame, keys: list[str], frequent: DataFrame) -> DataFrame:
    """``keys`` with ``high`` and ``low``; ``rows`` has the hashes of each text's words as ``_h``.

    A term's weight grows with its rarity and with the logarithm of its count in the text.
    Each bit of its two hashes votes with that weight for or against the same bit of the
    fingerprint. Terms of a text meet in its own task before anything is shuffled.
    """
    n = F.size("_h")
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("_h", i) != F.get("_h", i - 1)))
    none = F.array().cast("array<int>")
    rows = rows.withColumns({"_starts": F.when(n > 0, starts).otherwise(none), "_terms": F.array_distinct("_h")})
    ends = F.concat(F.slice("_starts", 2, F.greatest(F.size("_starts"), F.lit(1))), F.array(n))
    counts = F.zip_with("_starts", ends, lambda a, b: b - a)
    rows = rows.select(*keys, F.explode_outer(F.arrays_zip("_terms", counts.alias("count"))).alias("_t"))
    rows = rows.select(*keys, F.col("_t._terms").alias("term"), F.col("_t.count").alias("count"))
    if frequent.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(frequent), "term", "left")
    else:
        rows = join_by(rows, frequent, "term", "left")
    bits = F.coalesce("bits", F.lit(float(RARE)))
    weight = F.least(F.round(bits * STEP * (1 + F.log2("count"))), F.lit(HEAVIEST)).cast("long")
    weight = F.when(F.col("term").isNotNull(), weight)  # a text without words has a row without a term
    rows = rows.select(*keys, weight.alias("weight"), *[_half(seed).alias(half) for half, seed in HALVES])
    lane = lambda half, i: F.shiftrightunsigned(half, i).bitwiseAND(F.lit(_LANES))
    sums = [
        F.sum(lane(half, i) * F.col("weight")).alias(f"{half}{i}") for half, _ in HALVES for i in range(32)
    ]
    summed = rows.groupBy(*keys).agg(F.sum("weight").alias("weight"), *sums)
    return summed.select(*keys, *[_majority(half).alias(half) for half, _ in HALVES])


def _half(seed: int) -> Column:
    """A term's hash; the second half comes from the first, mixed once more."""
    return F.col("term") if seed == 42 else F.xxhash64("term", F.lit(seed))


def _majority(half: str) -> Column:
    """The bits for which over half of the weight voted; without votes none."""
    weight = F.coalesce("weight", F.lit(0))
    bits = []
    for i in range(32):
        votes = F.coalesce(f"{half}{i}", F.lit(0))
        lanes = ((i, votes.bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(votes, 32)))
        bits += [F.when(lane * 2 > weight, F.shiftleft(F.lit(1).cast("long"), at)).otherwise(0) for at, lane in lanes]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", frequent: DataFrame | None = None) -> DataFrame:
    """``keys``, which together name a row, with its fingerprint as ``high`` and ``low``."""
    frequent = stored(frequent_terms(docs, text), "terms") if frequent is None else frequent
    return _votes(docs.select(*keys, _hashes(F.col(text)).alias("_h")), keys, frequent)


def digits(high: str = "high", low: str = "low") -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(half)), 16, "0") for half in (high, low)])


def distance(a: tuple[str, str], b: tuple[str, str]) -> Column:
    return sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b)), start=F.lit(0))


# --- neighbours ---------------------------------------------------------------------------


def _blocks(number: int) -> list[tuple[int, int]]:
    edges = [BITS * i // number for i in range(number + 1)]
    return list(zip(edges, edges[1:]))


def _cut(high: Column, low: Column, start: int, end: int) -> list[Column]:
    """Bits ``start`` to ``end`` of a fingerprint, counted from the low end, by halves."""
    pieces = []
    for half, first in ((low, 0), (high, 64)):
        a, b = max(start, first) - first, min(end, first + 64) - first
        if a < b:
            shifted = F.shiftrightunsigned(half, a)
            pieces.append(shifted if b == 64 else shifted.bitwiseAND(F.lit((1 << (b - a)) - 1)))
    return pieces


def _tables(radius: int, kept: int) -> list[tuple[int, ...]]:
    return list(combinations(range(radius + kept), kept))


def _entries(fps: DataFrame, radius: int, kept: int) -> DataFrame:
    """A row for each fingerprint and block table, under the table's key."""
    blocks = _blocks(radius + kept)
    high, low = F.col("high"), F.col("low")
    keys = []
    for number, table in enumerate(_tables(radius, kept)):
        pieces = [piece for b in table for piece in _cut(high, low, *blocks[b])]
        keys.append(F.struct(F.lit(number).alias("table"), F.xxhash64(F.lit(number), *pieces).alias("key")))
    return fps.select("*", F.explode(F.array(*keys)).alias("_e")).select(*fps.columns, "_e.table", "_e.key")


def within(queries: DataFrame, fps: DataFrame, radius: int = 4, kept: int = 2) -> DataFrame:
    """All fingerprints of ``fps`` at most ``radius`` bits from one of ``queries``: the columns
    of ``queries`` (``q_high``, ``q_low`` and others), those of ``fps`` and ``distance``.

    The bits are cut into ``radius + kept`` blocks, of which at least ``kept`` agree in every
    such pair. There is a table for each choice of ``kept`` blocks, keyed by these, as if
    they had been permuted to the front. A pair that meets in several tables counts in the
    first one only, which its blocks name, so that no pairs are shuffled to be told apart.
    Both sides should hold a fingerprint once. A key with very many fingerprints is split.
    """
    blocks, tables = _blocks(radius + kept), _tables(radius, kept)
    asked = queries.withColumnsRenamed({"q_high": "high", "q_low": "low"})
    asked = _entries(asked, radius, kept).withColumnsRenamed({"high": "q_high", "low": "q_low"})
    both = _entries(fps, radius, kept).withColumn("_hash", F.xxhash64("key"))
    both = both.join(asked.withColumn("_hash", F.xxhash64("key")), ["_hash", "key", "table"])
    apart = both.withColumn("distance", distance(("high", "low"), ("q_high", "q_low"))).filter(F.col("distance") <= radius)
    differ = [F.col(half).bitwiseXOR(F.col(f"q_{half}")) for half in ("high", "low")]
    agree = [reduce(lambda a, b: a & b, [piece == 0 for piece in _cut(*differ, *block)]) for block in blocks]
    first = F.coalesce(
        *[F.when(reduce(lambda a, b: a & b, [agree[b] for b in table]), F.lit(n)) for n, table in enumerate(tables)]
    )
    return apart.filter(first == F.col("table")).drop("_hash", "key", "table")


def near_counts(rows: DataFrame, asks: Column, radius: int = 4, kept: int = 2) -> DataFrame:
    """``rows`` with ``n_near``: how many other rows' fingerprints lie within ``radius`` bits,
    for the rows that ``asks`` picks, else null. Equal fingerprints are searched once."""
    rows = rows.withColumn("_asks", F.coalesce(asks, F.lit(False)))
    fps = stored(
        rows.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"), F.bool_or("_asks").alias("asked")), "fingerprints"
    )
    queries = fps.filter("asked").select(F.col("high").alias("q_high"), F.col("low").alias("q_low"))
    found = within(queries, fps.select("high", "low", "n"), radius, kept)
    counts = found.groupBy("q_high", "q_low").agg(F.sum("n").alias("n_near"))
    counts = counts.select(F.col("q_high").alias("high"), F.col("q_low").alias("low"), F.lit(True).alias("_asks"), "n_near")
    salted = [frame.withColumn("_hash", F.xxhash64("high", "low")) for frame in (rows, counts)]
    joined = salted[0].join(salted[1], ["_hash", "high", "low", "_asks"], "left").drop("_hash", "_asks")
    return joined.withColumn("n_near", F.col("n_near") - 1)


# --- the documents and their edited texts -------------------------------------------------


def _followers(keys: DataFrame) -> DataFrame:
    """Each key with the next one as ``next_key`` and ``next_h``, in ascending id; the last
    one's is the first.

    Keys are cut into ranges of the id, so no task sorts all of them; what follows the last
    key of a range is the first of the next, found among one row for each range.
    """
    order = [F.asc_nulls_last("doc_id"), F.asc("_key"), F.asc("h")]
    ranged = stored(keys.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "keys")
    within_part = Window.partitionBy("_part").orderBy(*order)
    ranged = ranged.withColumns(
        {
            "_next": F.lead(F.struct("_key", "h")).over(within_part),
            "_nth": F.row_number().over(within_part),
        }
    )
    firsts = ranged.filter("_nth = 1").select("_part", F.struct("_key", "h").alias("_first"))
    by_part = Window.orderBy("_part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("_first").over(by_part), F.first("_first").over(whole))
    firsts = firsts.select("_part", after.alias("_after"))
    found = ranged.join(firsts, "_part").withColumn("_next", F.coalesce("_next", "_after"))
    return found.select(*keys.columns, F.col("_next._key").alias("next_key"), F.col("_next.h").alias("next_h"))


def edited_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each document with the text that has its last quarter replaced by the start of the
    next document: ``doc_id``, ``_key``, ``h``, ``next_key``, ``next_h``, ``n_chars``, ``text``,
    ``edited``, ``twin``, ``copies``.

    Rows of the same id and text are one row here: of ``copies`` such rows each but the last
    is followed by its copy, which is the row with ``twin``.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    id_text = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    rows = rows.withColumns({"_key": id_text, "h": F.xxhash64("text")})
    n_chars = F.char_length("text").cast("long")
    keys = rows.groupBy("doc_id", "_key", "h", n_chars.alias("n_chars")).agg(F.count(F.lit(1)).alias("copies"))
    keys = stored(_followers(keys), "followers")
    texts = rows.select("_key", "h", "text").dropDuplicates(["_key", "h"])
    cut = F.expr("cast(n_chars div 4 as int)")
    following = texts.select(F.col("_key").alias("next_key"), F.col("h").alias("next_h"), F.col("text").alias("_next"))
    inserted = keys.join(following, ["next_key", "next_h"]).withColumn("_inserted", F.left("_next", cut)).drop("_next")
    joined = inserted.join(texts, ["_key", "h"])
    own = F.struct(F.lit(True).alias("twin"), F.left("text", cut).alias("inserted"), (F.col("copies") - 1).alias("copies"))
    last = F.struct(F.lit(False).alias("twin"), F.col("_inserted").alias("inserted"), F.lit(1).cast("long").alias("copies"))
    cases = F.when(F.col("copies") > 1, F.array(last, own)).otherwise(F.array(last))
    joined = joined.withColumn("_case", F.explode(cases))
    kept = F.left("text", F.expr("cast(n_chars - n_chars div 4 as int)"))
    next_of = lambda name, own: F.when(F.col("_case.twin"), F.col(own)).otherwise(F.col(name))
    return joined.select(
        "doc_id", "_key", "h", next_of("next_key", "_key").alias("next_key"), next_of("next_h", "h").alias("next_h"),
        "n_chars", "text", F.concat(kept, F.col("_case.inserted")).alias("edited"), "_case.twin", "_case.copies",
    )


def edited_likeness(
    docs: DataFrame, radius: int = 4, every: int = 100, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are.

    A row per document: ``n_chars``, ``edited_sha256``, ``fingerprint`` and
    ``edited_fingerprint`` (32 hex digits), ``near_edited`` and ``near_next`` (the share of
    equal bits with the edited text's fingerprint and with the next document's), and
    ``n_near``: for documents whose id is divisible by ``every`` the number of other
    documents within ``radius`` bits, by the block tables.

    * A null text counts as empty. Texts without words have the fingerprint zero.
    * Null ids come last in the order of documents; rows of one id follow each other by a
      hash of their text, copies of one row directly. The next of a single row is itself.
    * A text may have some 8 million different words; the sums of more fail.
    * Only the two named columns are read, so others cannot clash. No rows give no rows.
    """
    made = edited_texts(docs, text, doc_id)
    both = made.select(
        *["doc_id", "_key", "h", "next_key", "next_h", "n_chars", "twin", "copies"],
        F.sha2("edited", 256).alias("edited_sha256"),
        F.posexplode(F.array("text", "edited")).alias("side", "text"),
    )
    keys = [c for c in both.columns if c != "text"]
    frequent = stored(frequent_terms(docs, text), "terms")
    voted = stored(fingerprints(both, keys, frequent=frequent), "sides")
    own = voted.filter("side = 0").drop("side")
    edited = voted.filter("side = 1").select("_key", "h", "twin", F.col("high").alias("e_high"), F.col("low").alias("e_low"))
    # A row per id and text: copies have the same fingerprint.
    after = own.filter("not twin").select(
        F.col("_key").alias("next_key"), F.col("h").alias("next_h"), F.col("high").alias("n_high"), F.col("low").alias("n_low")
    )
    rows = own.join(edited, ["_key", "h", "twin"]).join(after, ["next_key", "next_h"])
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"))
    asks = F.pmod(F.col("doc_id"), F.lit(every)) == 0
    rows = near_counts(stored(rows, "rows"), asks, radius)
    likeness = lambda other: 1 - distance(("high", "low"), other).cast("double") / BITS
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digits().alias("fingerprint"),
        digits("e_high", "e_low").alias("edited_fingerprint"),
        likeness(("e_high", "e_low")).alias("near_edited"),
        likeness(("n_high", "n_low")).alias("near_next"),
        "n_near",
    )
