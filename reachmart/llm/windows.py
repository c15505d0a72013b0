"""Removal of passages that repeat across documents, with a count-min prefilter."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from reachmart.llm.common import join_by, stored

# Odd multipliers of the rolling hashes; their inverses exist modulo 2 to the 64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SLICES = 256  # parts in which a sketch is merged
_ROWS = 2  # rows of the sketch; a window is repeated only if all rows say so
_FEWEST, _MOST = 20, 30  # cells of a row as powers of two; the flags of a row take 1/8 byte a cell


class _Powers:
    """Powers of the multipliers and of their inverses, as long as the longest text so far."""

    def __init__(self) -> None:
        self.size, self.up, self.down = 0, [], []

    def reach(self, n: int) -> None:
        if n <= self.size:
            return
        self.size = max(n, 2 * self.size, 1 << 12)
        self.up, self.down = [], []
        for base in _BASES:
            for store, factor in ((self.up, base), (self.down, pow(base, -1, 1 << 64))):
                powers = np.full(self.size, factor, np.uint64)
                powers[0] = 1
                store.append(np.cumprod(powers, dtype=np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    digests = b"".join(map(xxhash.xxh3_128_digest, words))
    return np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2)


def _rolled(hashes: np.ndarray, which: int, width: int, powers: _Powers) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    n = len(hashes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers.down[which][:n], out=sums[1:])
    return (sums[width:] - sums[: n - width + 1]) * powers.up[which][: n - width + 1]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width``."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _anchors(hashes: np.ndarray, window: int, anchor: int, powers: _Powers) -> np.ndarray:
    """For every window the least hash of the shorter runs in it. Equal windows have equal
    anchors, so an anchor is at least as frequent as each window it stands for."""
    return _least(_mixed(_rolled(hashes[:, 0], 0, anchor, powers)), window - anchor + 1)


def _cells(anchors: np.ndarray) -> list[np.ndarray]:
    """Cell of each anchor in every row of the sketch, at the finest width (32 bits)."""
    again = _mixed(anchors + np.uint64(0x9E3779B97F4A7C15))
    return [(x >> np.uint64(32)).astype(np.uint32) for x in (again, again << np.uint64(32))][:_ROWS]


# --- first pass: a sketch of each partition, merged ---------------------------------------


def _first_pass(window: int, anchor: int):
    """Per batch the cells of the documents' anchors, cut into slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for value in batch.column(0):
                words = unpack(value.as_py()).split()
                if len(words) >= window:
                    powers.reach(len(words))
                    found.append(np.unique(_anchors(_word_hashes(words), window, anchor, powers)))
            rows, slices, blobs = [], [], []
            for row, cells in enumerate(_cells(np.concatenate(found))):
                cells.sort()
                edges = np.searchsorted(cells, np.arange(_SLICES + 1, dtype=np.uint64) << np.uint64(24))
                for part in range(_SLICES):
                    if edges[part] < edges[part + 1]:
                        rows.append(row)
                        slices.append(part)
                        blobs.append(cells[edges[part] : edges[part + 1]].tobytes())
            arrays = [pa.array(rows, pa.int32()), pa.array(slices, pa.int32()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "slice", "cells"])

    return run


def _merged(sketches: DataFrame) -> tuple[int, np.ndarray]:
    """The power of two of a row's cells, and for each row the bits of cells hit twice.

    The width follows the number of anchors, 16 cells for each, up to a fixed bound. So
    the flags that go to the driver and to every task never exceed 2 * 128 MB. Beyond the
    bound more windows are taken for repeated and the second pass sorts them out.
    """
    total = sketches.filter("row = 0").agg(F.sum(F.octet_length("cells"))).first()[0] or 0
    power = min(max((4 * total - 1).bit_length(), _FEWEST), _MOST)  # four bytes each
    shift = np.uint32(32 - power)
    size = (1 << power) // _SLICES

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, counts = None, np.zeros(0, np.uint8)
        for batch in batches:
            rows, slices = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, part, blob in zip(rows, slices, batch.column(2)):
                if (row, part) != key:
                    if key:
                        yield _flags(key, counts)
                    key, counts = (row, part), np.zeros(size, np.uint8)
                cells = (np.frombuffer(blob.as_py(), np.uint32) >> shift) - np.uint32(part * size)
                hit, times = np.unique(cells, return_counts=True)
                counts[hit] = np.minimum(counts[hit] + np.minimum(times, 2), 2)
        if key:
            yield _flags(key, counts)

    dealt = sketches.repartition("row", "slice").sortWithinPartitions("row", "slice")
    flags = np.zeros((_ROWS, (1 << power) // 8), np.uint8)
    for row, part, bits in dealt.mapInArrow(merge, "row int, slice int, bits binary").toLocalIterator():
        flags[row, part * size // 8 : (part + 1) * size // 8] = np.frombuffer(bits, np.uint8)
    return power, flags


def _flags(key: tuple[int, int], counts: np.ndarray) -> pa.RecordBatch:
    bits = np.packbits(counts > 1, bitorder="little").tobytes()
    arrays = [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([bits], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["row", "slice", "bits"])


# --- second pass: windows that the sketch takes for repeated ------------------------------

_SECOND = (
    "uid long, doc_id {kind}, n_words long, n_removed long, kept_sha256 string, packed binary, hi long, lo int, at int"
)


def _second_pass(window: int, anchor: int, power: int, flags, kind: pa.DataType):
    """A row per document, final unless it has such windows; then rows for the windows.

    The windows of a partition are grouped there first. Where a smaller id of the same
    partition has the window, the word positions are settled (``hi`` is null); of the rest
    each window goes on once, however many documents of the partition share it.
    """
    fields = [("uid", pa.int64()), ("doc_id", kind), ("n_words", pa.int64()), ("n_removed", pa.int64())]
    fields += [("kept_sha256", pa.string()), ("packed", pa.binary()), ("hi", pa.int64()), ("lo", pa.int32())]
    schema = pa.schema([*fields, ("at", pa.int32())])
    shift = np.uint32(32 - power)

    def repeated(anchors: np.ndarray) -> np.ndarray:
        maybe = np.ones(len(anchors), bool)
        for row, cells in enumerate(_cells(anchors)):
            cells = cells >> shift
            bits = flags.value[row][cells >> np.uint32(3)] >> (cells & np.uint32(7)).astype(np.uint8)
            maybe &= (bits & 1).astype(bool)
        return maybe

    def rows_of(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        arrays = [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema]
        arrays = [a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        unpack = zstandard.ZstdDecompressor().decompress
        ids, uids, keys, places = [], [], [], []  # of the documents with windows
        for batch in batches:
            sizes, gone, kept, packed = [], [], [], []
            for uid, doc_id, copy, raw in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3)):
                raw = raw.as_py()
                words = unpack(raw).split()
                n, hits = len(words), ()
                if n >= window and not copy:
                    powers.reach(n)
                    hashes = _word_hashes(words)
                    hits = np.flatnonzero(repeated(_anchors(hashes, window, anchor, powers)))
                removed = n if copy and n >= window else 0
                sizes.append(n)
                gone.append(removed)
                kept.append(hashlib.sha256(b"" if removed else b" ".join(words)).hexdigest())
                packed.append(raw if len(hits) and doc_id is not None else None)
                if packed[-1] is not None:
                    ids.append(doc_id)
                    uids.append(uid)
                    both = [_rolled(hashes[:, k], k, window, powers)[hits] for k in (0, 1)]
                    keys.append(np.stack([both[0].view(np.int64), (both[1] >> np.uint64(32)).astype(np.int64)], axis=1))
                    places.append(hits.astype(np.int32))
            columns = {"uid": batch.column(0), "doc_id": batch.column(1), "n_words": sizes, "n_removed": gone}
            yield rows_of(**columns, kept_sha256=kept, packed=packed)
        if not ids:
            return
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        rank = np.zeros(len(ids), np.int64)
        rank[order] = np.cumsum([0] + [ids[a] != ids[b] for a, b in zip(order, order[1:])])
        owner = np.repeat(np.arange(len(ids)), [len(p) for p in places])
        key, at = np.concatenate(keys), np.concatenate(places)
        by = np.lexsort((rank[owner], key[:, 1], key[:, 0]))
        owner, key, at = owner[by], key[by], at[by]
        new = np.r_[True, (key[1:] != key[:-1]).any(axis=1)]
        least = rank[owner][new][np.cumsum(new) - 1]
        later = rank[owner] > least
        uids, ids = np.array(uids, np.int64), pa.array(ids, kind)
        sent = np.flatnonzero(later)
        for start in range(0, len(sent), 1 << 18):
            some = sent[start : start + (1 << 18)]
            yield rows_of(uid=uids[owner[some]], at=at[some])
        # A window that only repeats within one document of this partition goes on once for
        # each place, as any of them may be covered.
        sent = np.flatnonzero(~later)
        for start in range(0, len(sent), 1 << 18):
            some = sent[start : start + (1 << 18)]
            low = (key[some, 1] - (1 << 31)).astype(np.int32)
            columns = {"uid": uids[owner[some]], "doc_id": ids.take(pa.array(owner[some])), "hi": key[some, 0]}
            yield rows_of(**columns, lo=low, at=at[some])

    return run


def _later_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by window and id, those behind the window's first id.

    Rows stream through; of a window only its key and first id are held.
    """
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        hi, lo = (batch.column(k).to_numpy() for k in (0, 1))
        ids = batch.column(2)
        same = np.r_[False, (hi[1:] == hi[:-1]) & (lo[1:] == lo[:-1])]
        heads = np.flatnonzero(~same)
        first = ids.take(pa.array(heads[np.cumsum(~same) - 1]))
        later = pc.not_equal(ids, first).to_numpy(zero_copy_only=False)
        if last is not None and (hi[0], lo[0]) == last[:2]:
            end = int(heads[1]) if len(heads) > 1 else len(hi)
            later[:end] = pc.not_equal(ids.slice(0, end), pa.scalar(last[2], ids.type)).to_numpy(zero_copy_only=False)
            head = last[2] if end == len(hi) else ids[int(heads[-1])].as_py()
        else:
            head = ids[int(heads[-1])].as_py()
        last = hi[-1], lo[-1], head
        yield batch.filter(pa.array(later)).select(["uid", "at"])


def _covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _last_pass(window: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            counts, gone, kept, texts = [], [], [], []
            for packed, starts in zip(batch.column(1), batch.column(2)):
                words = unpack(packed.as_py()).split()
                starts = np.array(starts.as_py() or [], np.int64)
                covered = _covered(len(words), starts, window)
                rest = b" ".join([w for w, c in zip(words, covered.tolist()) if not c])
                counts.append(len(words))
                gone.append(int(covered.sum()))
                kept.append(hashlib.sha256(rest).hexdigest())
                texts.append(rest if len(starts) else None)
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.binary())], names=names)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, for the shuffle and the stored copy."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        packed = pa.array([pack(t.as_py()) for t in batch.column(2)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["doc_id", "key", "packed"])


def _without_copies(docs: DataFrame, kind: str, text: str, doc_id: str) -> DataFrame:
    """``uid``, ``doc_id``, ``copy`` (a smaller id has the same text) and the packed text."""
    bytes_of = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(bytes_of, 256)).alias("key"), bytes_of.alias("text"))
    digests = rows.filter("doc_id is not null").select("doc_id", "key")
    texts = digests.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    texts = stored(texts.filter("first < last").select("key", "first"), "texts")
    copies = join_by(digests, texts, "key").filter("doc_id > first").select("doc_id", "key").distinct()
    # The copies grow with the documents, so the texts are dealt by id at every size.
    copies = stored(copies, "copies").withColumn("copy", F.lit(True)).hint("merge")
    packed = rows.mapInArrow(_pack, f"doc_id {kind}, key binary, packed binary")
    joined = packed.join(copies, ["doc_id", "key"], "left")
    uid = F.monotonically_increasing_id()
    return stored(joined.select(uid.alias("uid"), "doc_id", F.coalesce("copy", F.lit(False)).alias("copy"), "packed"), "documents")


def remove_repeats(
    docs: DataFrame, window: int = 50, anchor: int = 24, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text`` of every row.

    A word goes if it lies in a window of ``window`` words that also starts in a document
    with a smaller id. Whole copies of a text with a smaller id are settled first, by their
    digest. The first pass then counts in a count-min sketch, once per document, the anchor
    of each window: the least hash of the ``anchor``-word runs in it. The second pass
    groups the windows whose anchor may have been seen twice by a 96-bit hash, within each
    partition and then across, so that a passage in very many documents moves once for each
    partition. ``kept_text`` is null where it can be read off the input: nothing or
    everything was removed.

    * A null or empty text has no words. A null id is smaller than none and none is
      smaller than it: such a row neither loses words nor takes any.
    * Rows that share an id keep one result each and do not take words from each other.
    * An empty table gives an empty result. Only the two named columns are read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    arrow = to_arrow_type(docs.schema[doc_id].dataType)
    texts = _without_copies(docs, kind, text, doc_id)
    sketches = texts.filter("not copy").select("packed")
    sketches = stored(sketches.mapInArrow(_first_pass(window, anchor), "row int, slice int, cells binary"), "sketches")
    power, flags = _merged(sketches)

    sent = docs.sparkSession.sparkContext.broadcast(flags)
    run = _second_pass(window, anchor, power, sent, arrow)
    second = stored(texts.mapInArrow(run, _SECOND.format(kind=kind)), "windows")

    windows = second.filter("hi is not null").select("hi", "lo", "doc_id", "uid", "at")
    windows = windows.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "doc_id")
    places = windows.mapInArrow(_later_places, "uid long, at int")
    places = places.union(second.filter("hi is null and at is not null").select("uid", "at"))
    starts = places.groupBy("uid").agg(F.collect_list("at").alias("starts"))
    rows = second.filter("at is null")
    last = rows.filter("packed is not null").select("uid", "doc_id", "packed").join(starts, "uid", "left")
    settled = last.select("doc_id", "packed", "starts").mapInArrow(
        _last_pass(window, arrow),
        f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept binary",
    )
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    settled = settled.select(*columns, F.col("kept").cast("string").alias("kept_text"))
    final = rows.filter("packed is null").select(*columns, F.lit(None).cast("string").alias("kept_text"))
    return final.union(settled)
