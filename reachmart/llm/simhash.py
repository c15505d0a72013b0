"""Near-duplicate documents by SimHash fingerprints, compared bit plane by bit plane."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from reachmart.llm.common import join_by, numbered, renamed, runs, stored
from reachmart.llm.components import connected_components

BITS = 64
SEED = 42
_HASHES = 1 << 14  # shingle hashes whose bits are counted at a time
# The bits of a byte, each in a byte of its own, so that 255 rows can be added without a carry.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
_BLOCK = 256  # fingerprints of small groups that are compared at a time


# --- fingerprints ----------------------------------------------------------------------


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes; no words: zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts, n = iter([b" ".join(words)]), 1
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, n, _HASHES):
        spread = _SPREAD[hashes[start : start + _HASHES].view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(spread, np.arange(0, len(spread), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, shingle: int = 4, text: str = "text", doc_id: str = "doc_id", mark: Column | None = None
) -> DataFrame:
    """Columns ``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number; and ``mark``,
    a number that the caller tells rows apart by, if one is given."""
    names = ["doc_id", "fp"] if mark is None else ["doc_id", "fp", "mark"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, *marks = batch.columns
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([ids, pa.array(found.view(np.int64)), *marks], names=names)

    kind = docs.schema[doc_id].dataType.simpleString()
    columns = [F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")]
    rows = docs.select(*columns, *([] if mark is None else [mark.alias("mark")]))
    return rows.mapInArrow(run, f"doc_id {kind}, fp long" + ("" if mark is None else ", mark long"))


# --- bit-sliced comparison -------------------------------------------------------------


def near(queries: np.ndarray, targets: np.ndarray, radius: int) -> np.ndarray:
    """Which of ``targets`` are within ``radius`` bits of which of ``queries``: a bool matrix.

    The targets lie as bit planes, 64 of them to a word. Each plane is compared with the
    queries' bit, and the outcome is added to counters that are themselves bit planes, by
    half adders. A query is dropped as soon as all targets are too far away.
    """
    n = len(targets)
    lanes = -(-n // 64)
    bits = np.zeros((BITS, lanes * 64), np.uint8)
    shifts = np.arange(BITS, dtype=np.uint64)
    bits[:, :n] = (targets[None, :] >> shifts[:, None]) & np.uint64(1)
    planes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    wanted = np.zeros((BITS, len(queries)), np.uint64)
    wanted[((queries[None, :] >> shifts[:, None]) & np.uint64(1)).astype(bool)] = ~np.uint64(0)
    padding = np.zeros(lanes * 64, np.uint8)
    padding[n:] = 1
    padding = np.packbits(padding, bitorder="little").view(np.uint64)
    alive = np.arange(len(queries))
    size = max(radius.bit_length(), 1)
    counters = np.zeros((size, len(queries), lanes), np.uint64)
    far = np.broadcast_to(padding, (len(queries), lanes)).copy()
    for plane in range(BITS):
        carry = planes[plane][None, :] ^ wanted[plane, alive][:, None]
        for counter in counters:
            both = counter & carry
            counter ^= carry
            carry = both
        far |= carry
        if plane % 12 == 11:
            beyond = far | _above(counters, radius)
            going = ~(beyond == ~np.uint64(0)).all(axis=1)
            if not going.all():
                alive, far, counters = alive[going], far[going], counters[:, going]
                if not len(alive):
                    break
    result = np.zeros((len(queries), n), bool)
    if len(alive):
        kept = ~(far | _above(counters, radius))
        result[alive] = np.unpackbits(kept.view(np.uint8), axis=1, bitorder="little")[:, :n].astype(bool)
    return result


def _above(counters: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter exceeds ``radius``, from the highest bit down."""
    above = np.zeros(counters.shape[1:], np.uint64)
    equal = np.full(counters.shape[1:], ~np.uint64(0))
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def _roots(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the position of the first one that it is linked to, also over others."""
    linked = near(fps, fps, radius)
    label = linked.argmax(axis=1)
    loose = np.flatnonzero(label != np.arange(len(fps)))
    if not len(loose):
        return label
    part = np.flatnonzero(linked.sum(axis=1) > 1)
    linked = linked[np.ix_(part, part)]
    own = np.arange(len(part), dtype=np.int32)
    while True:
        # Some rows at a time: where all are linked, a list of the links is many times the matrix.
        best = np.concatenate(
            [np.where(linked[i : i + _BLOCK], own, len(part)).min(axis=1) for i in range(0, len(part), _BLOCK)]
        )
        best = best[best]
        if (best == own).all():
            break
        own = best
    label[part] = part[own]
    return label


# --- links -----------------------------------------------------------------------------


def _bands(radius: int) -> list[tuple[int, int]]:
    """Start and width of ``radius + 2`` bands: fingerprints within the radius agree in two."""
    n = radius + 2
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _keys(radius: int) -> Column:
    fp = F.col("fp")

    def band(start: int, width: int) -> Column:
        return F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << width) - 1))

    made = []
    for number, ((a, m), (b, n)) in enumerate(combinations(_bands(radius), 2)):
        bits = F.shiftleft(band(a, m), n).bitwiseOR(band(b, n))
        made.append(F.xxhash64(F.lit(number), bits))
    return F.array(*made)


def _links(fps: DataFrame, radius: int, group: int) -> DataFrame:
    """Links (``a``, ``b``) that connect all fingerprints within ``radius`` of each other.

    Candidates share two bands. Within a group the links form a forest, not all pairs.
    Groups above ``group`` are dealt to several tasks by a hash; what that leaves out is
    compared in a second step, for which only fingerprints that are not yet connected to
    most of their group are sent to all its parts.
    """
    keyed = fps.select("fp", F.explode(_keys(radius)).alias("key"))
    sizes = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "groups")
    parts = F.ceil(F.col("n") / group)
    dealt = join_by(keyed, sizes, "key").withColumn("parts", parts.cast("int"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("fp", "key"), "parts").cast("int"))

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["key", "part"], _BLOCK):
            fps = run.column("fp").to_numpy().view(np.uint64)
            root = _roots(fps, radius)
            moved = np.flatnonzero(root != np.arange(len(fps)))
            if len(moved):
                ends = [pa.array(fps[i].view(np.int64)) for i in (root[moved], moved)]
                yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    sorted_parts = dealt.select("key", "part", "fp").repartition("key", "part").sortWithinPartitions("key", "part")
    links = stored(sorted_parts.mapInArrow(within, "a long, b long").distinct(), "pairs")
    largest = sizes.agg(F.max("n")).first()[0]
    if largest is None or largest <= group:
        return links
    return links.union(_across(dealt.filter("parts > 1"), connected_components(links), radius, group))


def _across(hot: DataFrame, roots: DataFrame, radius: int, group: int) -> DataFrame:
    """Links between the parts of large groups."""
    roots = roots.select(F.col("node").alias("fp"), "root")
    hot = join_by(hot, roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    hot = stored(hot.select("key", "parts", "part", "fp", "root"), "hot")
    by_root = hot.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    most = by_root.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("all"))
    most = most.filter(F.col("all") > F.col("most.n"))
    loose = F.ceil((F.col("all") - F.col("most.n")) / group).cast("int")
    most = stored(most.select("key", F.col("most.root").alias("main"), loose.alias("rounds")), "loose")
    hot = join_by(hot, most, "key")
    targets = hot.withColumn("round", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)))
    queries = hot.filter("root <> main").withColumn("round", F.pmod(F.xxhash64("fp"), "rounds").cast("int"))
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = ["key", "part", "round", "fp", "root"]
    both = targets.select(*columns, F.lit(False).alias("asks"))
    both = both.union(queries.select(*columns, F.lit(True).alias("asks")))
    both = both.repartition("key", "part", "round").sortWithinPartitions("key", "part", "round")

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["key", "part", "round"], 1):
            asks = run.column("asks").to_numpy()
            fps = run.column("fp").to_numpy().view(np.uint64)
            root = run.column("root").to_numpy()
            asking, asked = np.flatnonzero(asks), np.flatnonzero(~asks)
            for start in range(0, len(asking), _BLOCK):
                some = asking[start : start + _BLOCK]
                i, j = np.nonzero(near(fps[some], fps[asked], radius))
                ends = np.stack([root[some[i]], root[asked[j]]], axis=1)
                ends = np.unique(ends[ends[:, 0] != ends[:, 1]], axis=0)
                if len(ends):
                    yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    return both.mapInArrow(between, "a long, b long").distinct()


def simhash_groups(
    docs: DataFrame,
    shingle: int = 4,
    radius: int = 4,
    text: str = "text",
    doc_id: str = "doc_id",
    group: int = 2048,
) -> DataFrame:
    """Every document with its ``fingerprint`` (16 hex digits) and ``component_id``.

    Two documents are linked if their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the least id that is reachable over links. ``group`` is the number
    of fingerprints that one task compares with each other; it does not change the result.

    * A null or empty text has the fingerprint zero and is linked like any other.
    * Null ids keep their row; a component of null ids only has a null id.
    * Rows with the same id keep one row each. An empty table gives an empty result.
    * Only the two named columns are read, so other columns cannot clash.
    """
    found = _grouped(fingerprints(docs, shingle, text, doc_id), radius, group)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def _grouped(hashed: DataFrame, radius: int, group: int = 2048) -> DataFrame:
    """Rows of ``fingerprints`` with ``root``, a fingerprint that names their component, and
    its least id as ``component_id``."""
    hashed = stored(hashed, "fingerprints")
    first = stored(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected_components(_links(first.select("fp"), radius, group))
    roots = roots.select(F.col("node").alias("fp"), "root")
    roots = roots.union(roots.select(F.col("root").alias("fp"), "root").distinct())
    linked = join_by(first, roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    member = stored(join_by(linked, least, "root").select("fp", "root", "component_id"), "members")
    return join_by(hashed, member, "fp")


def one_per_group(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One document of each group of near copies, with the columns of ``docs``.

    It is a row whose id is the least of the group and whose own text is in the group; of
    several such rows the first by text, language and source stays. An id that has different
    texts can thus keep several rows, one for each group that it heads, and a copy under that
    id goes.

    * Null and empty texts have the fingerprint zero and make a group like any other.
    * Rows with a null id cannot be named by a group and stay.
    * A very long text is one fingerprint like any other. An empty table stays empty.
    * Columns of ``docs`` cannot clash with the operator's own.
    """
    rows, place = numbered(docs)
    doc_id, text = F.col(place["doc_id"]), F.col(place["text"])
    mark = F.xxhash64(text)
    groups = _grouped(fingerprints(rows, shingle, place["text"], place["doc_id"], mark), radius)
    heads = groups.filter("doc_id = component_id").select(F.col("doc_id").alias("id"), "mark", "root").distinct()
    kept = rows.withColumn("own", mark).join(heads, (doc_id == F.col("id")) & (F.col("own") == F.col("mark")))
    order = [F.col(place[name]) for name in ("text", "lang", "source") if name in place]
    first = kept.withColumn("nth", F.row_number().over(Window.partitionBy("id", "root").orderBy(*order)))
    whole = first.filter("nth = 1").select(*place.values()).union(rows.filter(doc_id.isNull()))
    return renamed(whole, place)
