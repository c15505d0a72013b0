"""Benchmark passages in documents, also reworded: a latent cosine search, then checks in place."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reachmart.llm.common import numbered, received, renamed, shared, stored

# Upper case to lower case and ASCII punctuation to blanks; other bytes stay.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_ROWS = 1024  # rows that are given back at a time


@dataclass(frozen=True)
class Settings:
    """Words are runs of letters and digits. Items are searched by passages of ``long`` words,
    those of under ``long`` / 2 words by passages of ``short`` words; passages overlap by half.
    An item of over ``part`` words is searched by overlapping parts of that size.

    A passage whose vector has a cosine of at least ``cosine`` with an item's is a candidate.
    Near it, in a stretch of text not much longer than the item, a match needs a share of
    ``whole`` of the item's words in order, or of ``partly`` of them with a share of ``answer``
    of its last ``answer_words`` words in order where the item ends; and the words in order
    must carry a share of ``weight`` of the item's term weights, and ``least`` in all, which is
    the logarithm of how rarely they come together, or be a share of ``nearly`` of it. With ``passages`` a part of a
    longer item that passes is a match, too.

    The latent space has as many dimensions, up to ``rank``, as keep a share of ``energy`` of
    each item. A benchmark of more than ``items`` items is searched in several passes."""

    long: int = 32
    short: int = 8
    part: int = 64
    cosine: float = 0.55
    rank: int = 256
    energy: float = 0.5
    extra: int = 16  # further columns of the random projection
    rounds: int = 2  # power iterations
    whole: float = 0.6
    partly: float = 0.45
    weight: float = 0.5
    least: float = 12.0
    nearly: float = 0.9
    answer: float = 0.75
    answer_words: int = 8
    items: int = 50_000
    passages: bool = False


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_PLAIN).split()


# --- statistics and space -----------------------------------------------------------------


def _frequencies(docs: DataFrame, terms: list[bytes]) -> tuple[int, np.ndarray]:
    """Number of documents, and for each term of the benchmark how many have it."""
    sent = shared(docs.sparkSession, {t: i for i, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = received(sent)
        own = known.keys()
        counts, n = np.zeros(len(known), np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                hits = own & set(words_of(text.as_py()))
                counts[[known[t] for t in hits]] += 1
            n += batch.num_rows
        found = np.flatnonzero(counts)
        terms_of, values = np.append(found, -1), np.append(counts[found], n)
        yield pa.RecordBatch.from_arrays([pa.array(terms_of), pa.array(values)], names=["term", "n"])

    counted = docs.select(F.col("text").cast("binary")).mapInArrow(run, "term long, n long")
    frequency, total = np.zeros(len(terms), np.int64), 0
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        if row["term"] < 0:
            total = row["n"]
        else:
            frequency[row["term"]] = row["n"]
    return total, frequency


def _product(passages: DataFrame, size: int, right: np.ndarray) -> np.ndarray:
    """A' A times ``right``, where the rows of A are the passages: sums over partitions."""
    sent = shared(passages.sparkSession, right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = received(sent)
        total = np.zeros((size, factor.shape[1]))
        for batch in batches:
            for terms, weights in zip(batch.column(0), batch.column(1)):
                terms, weights = np.array(terms.as_py(), np.int64), np.array(weights.as_py())
                total[terms] += weights[:, None] * (weights @ factor[terms])[None, :]
        rows = np.flatnonzero(total.any(axis=1))
        arrays = [pa.array(rows), pa.array(list(total[rows]), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["term", "row"])

    result = np.zeros((size, right.shape[1]))
    for row in passages.mapInArrow(run, "term long, row array<double>").toLocalIterator():
        result[row["term"]] += row["row"]
    return result


def latent_space(passages: DataFrame, size: int, settings: Settings) -> np.ndarray:
    """Right singular vectors (term, dimension) by randomised SVD; ``passages`` has the
    arrays ``terms`` and ``weights``. The driver holds matrices of one row per term and
    ``rank`` columns, which the bound on the benchmark bounds."""
    width = min(settings.rank + settings.extra, size)
    basis = np.random.default_rng(0).standard_normal((size, width))
    for _ in range(settings.rounds + 1):
        basis, _ = np.linalg.qr(_product(passages, size, basis))
    small = basis.T @ _product(passages, size, basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)[: settings.rank]
    order = order[values[order] > 1e-9 * max(values.max(), 1e-30)]
    return basis @ vectors[:, order]


def dimensions(kept: np.ndarray, energy: float) -> int:
    """How many dimensions keep a share of ``energy`` of every row of unit length; ``kept`` has
    the rows' places in the space. All of them where that is not to be had."""
    least = np.cumsum(kept * kept, axis=1).min(axis=0, initial=1.0)
    enough = np.flatnonzero(least >= energy)
    return int(enough[0]) + 1 if len(enough) else kept.shape[1]


# --- exact checks -------------------------------------------------------------------------


def common_subsequence(item: list[bytes], text: list[bytes]) -> int:
    """Length of the longest common subsequence, one bit of an integer per item word."""
    places: dict[bytes, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for place in filter(None, map(places.get, text)):
        hit = row & place
        row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def in_order(item: list[bytes], text: list[bytes]) -> list[int]:
    """Places in ``item`` of the words of one longest common subsequence, found backwards."""
    table = [[0] * (len(text) + 1)]
    for x in item:
        above, row = table[-1], [0]
        for j, y in enumerate(text):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
        table.append(row)
    places, i, j = [], len(item), len(text)
    while i and j:
        if item[i - 1] == text[j - 1]:
            i, j = i - 1, j - 1
            places.append(i)
        elif table[i - 1][j] >= table[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return places[::-1]


@dataclass
class Unit:
    """An item, or a part of a longer one, that passages are compared with."""

    item: int
    words: list[bytes]
    numbers: np.ndarray
    last: list[bytes]  # the item's answer; none for a part that does not end it
    matches: bool  # whether finding it is a match


class Search:
    """The benchmark's items as vectors of the space, and the checks of candidates."""

    ROWS = 1024  # passages that are compared at a time

    def __init__(self, items, terms, idf, settings: Settings):
        self.items, self.settings = items, settings
        self.number = {t: i for i, t in enumerate(terms)}
        self.idf = np.append(idf, 0.0)
        self.own = np.zeros(len(idf) + 1, bool)  # the terms of the unit that is being checked
        self.units: list[Unit] = []
        for place, (_, words) in enumerate(items):
            last = words[-settings.answer_words :]
            parts = self._parts(words)
            if len(parts) > 1:
                # Passages inside a long item resemble its parts, not all of it.
                self.units += [self._unit(place, part, part[-len(last) :], settings.passages) for part in parts]
            else:
                self.units.append(self._unit(place, words, last, True))
        self.whole = {u: self._unit(u, items[u][1], items[u][1][-settings.answer_words :], True) for u in self._long()}

    def _long(self) -> list[int]:
        return [place for place, (_, words) in enumerate(self.items) if len(words) > self.settings.part]

    def _unit(self, place: int, words: list[bytes], last: list[bytes], matches: bool) -> Unit:
        return Unit(place, words, np.array([self.number[w] for w in words], np.int64), last, matches)

    def _parts(self, words: list[bytes]) -> list[list[bytes]]:
        size = self.settings.part
        if len(words) <= size:
            return [words]
        starts = [*range(0, len(words) - size, size // 2), len(words) - size]
        return [words[i : i + size] for i in starts]

    def weights(self, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
        """Terms of a unit and their TF-IDF weights, of unit length."""
        numbers, counts = np.unique(unit.numbers, return_counts=True)
        weights = counts * self.idf[numbers]
        return numbers, weights / np.linalg.norm(weights)

    def project(self, space: np.ndarray) -> None:
        """Cuts the space to the dimensions that are needed and places the units in it."""
        rows = [self.weights(u) for u in self.units]
        kept = np.array([w @ space[n] for n, w in rows]).reshape(len(rows), space.shape[1])
        rank = dimensions(kept, self.settings.energy)
        # Words that are in no item have no direction: the last row.
        self.space = np.vstack([space[:, :rank] * self.idf[:-1, None], np.zeros((1, rank))]).astype(np.float32)
        vectors = kept[:, :rank].astype(np.float32)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)[:, None]
        short = np.array([2 * len(u.words) < self.settings.long for u in self.units], bool)
        self.scales = [
            (size, np.flatnonzero(which), vectors[which])
            for size, which in ((self.settings.long, ~short), (self.settings.short, short))
            if which.any()
        ]

    def passages(self, numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """A text's passages of each size, at most some ``ROWS`` of the long ones at a time: the
        size, their first words and their unit vectors, none of which is zero.

        Words are added up once, to blocks of half a short passage.
        """
        half, fine = self.settings.long // 2, self.settings.short // 2
        if half % fine:
            raise ValueError("a long passage must be a multiple of a short one")
        blocks = -(-len(numbers) // half)
        padded = np.full(blocks * half, len(self.number), np.int64)
        padded[: len(numbers)] = numbers
        padded = padded.reshape(-1, fine)
        ratio = half // fine
        for start in range(0, max(blocks - 1, 1), self.ROWS):
            sums = self.space[padded[start * ratio : (start + self.ROWS + 1) * ratio]].sum(axis=1)
            for size, _, _ in self.scales:
                own = sums if size == self.settings.short else sums.reshape(-1, ratio, sums.shape[1]).sum(axis=1)
                vectors = own[:-1] + own[1:] if len(own) > 1 else own
                norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
                some = np.flatnonzero(norms > 1e-6)
                yield size, start * half + some * (size // 2), vectors[some] / norms[some, None]

    def candidates(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """Unit, stretch of words and highest cosine of passages that follow each other."""
        units = {size: (which, vectors) for size, which, vectors in self.scales}
        for size, firsts, own in self.passages(numbers):
            which, vectors = units[size]
            cosines = own @ vectors.T
            rows, columns = np.nonzero(cosines >= self.settings.cosine)
            if not len(rows):
                continue
            order = np.lexsort((rows, columns))
            rows, columns = rows[order], columns[order]
            first = firsts[rows]
            new = np.r_[True, (columns[1:] != columns[:-1]) | (first[1:] - first[:-1] > size)]
            heads = np.flatnonzero(new)
            best = np.maximum.reduceat(cosines[rows, columns], heads)
            ends = np.r_[heads[1:], len(rows)] - 1
            yield from zip(which[columns[heads]].tolist(), first[heads].tolist(), (first[ends] + size).tolist(), best.tolist())

    def _stretches(self, numbers: np.ndarray, unit: Unit, low: int, high: int, least: int) -> Iterator[tuple[int, int]]:
        """Where the most words of a unit lie within little more than its length, if enough do."""
        n = len(unit.words)
        low, high = max(0, low - n), min(len(numbers), high + n)
        size = n + max(4, n // 4)
        self.own[unit.numbers] = True
        hits = np.concatenate([[0], np.cumsum(self.own[numbers[low:high]])])
        self.own[unit.numbers] = False
        if hits[-1] < least:
            return
        counts = hits[size:] - hits[:-size] if len(hits) > size else hits[-1:]
        most = counts.max()
        if most < least:
            return
        at = np.flatnonzero(counts == most)
        for start in dict.fromkeys((int(at[len(at) // 2]), int(at[0]), int(at[-1]))):
            yield low + start, min(low + start + size, high)

    def check(self, words: list[bytes], numbers: np.ndarray, unit: Unit, low: int, high: int) -> tuple[float, float] | None:
        """Shares in order of a unit and of its answer in the stretches, if they make a match."""
        s, n = self.settings, len(unit.words)
        least = max(1, math.ceil(min(s.whole, s.partly) * n - 1e-9))
        found = None
        for start, end in self._stretches(numbers, unit, low, high, least):
            text = words[start:end]
            common = common_subsequence(unit.words, text)
            if common < least:
                continue
            behind = text[-(len(unit.last) + max(4, n // 4) + n - common) :]
            answer = common_subsequence(unit.last, behind) / len(unit.last)
            share = common / n
            if share < s.whole and answer < s.answer:
                continue
            weights = self.idf[unit.numbers]
            carried = weights.sum() if common == n else weights[in_order(unit.words, text)].sum()
            if carried >= s.weight * weights.sum() and (carried >= s.least or share >= s.nearly):
                found = max(found or (0.0, 0.0), (share, answer))
        return found

    def matches(self, text: bytes | None) -> list[tuple[int, float, float, float]]:
        """Item place, cosine, share in order and share of the answer, for each item found."""
        words = words_of(text)
        if not words or not self.units:
            return []
        numbers = np.fromiter(map(self.number.get, words, repeat(len(self.number))), np.int64, len(words))
        best: dict[int, tuple[float, float, float]] = {}
        for place, low, high, cosine in self.candidates(numbers):
            unit = self.units[place]
            tried = [unit] if unit.matches else []
            if unit.item in self.whole:
                tried.append(self.whole[unit.item])
            for one in tried:
                found = self.check(words, numbers, one, low, high)
                if found:
                    best[one.item] = max(best.get(one.item, (0.0, 0.0, 0.0)), (found[0], cosine, found[1]))
        return [(i, cosine, share, answer) for i, (share, cosine, answer) in sorted(best.items())]


def prepare(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> list[Search]:
    """The searches over all items, with term weights from all documents. Each holds at most
    ``settings.items`` items or so; which one an item falls to is a matter of its hash."""
    total = benchmark.count()
    passes = max(1, -(-total // settings.items))
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    return [_search(docs, benchmark.filter(own == i) if passes > 1 else benchmark, settings) for i in range(passes)]


def _search(docs: DataFrame, benchmark: DataFrame, settings: Settings) -> Search:
    spark = docs.sparkSession
    rows = benchmark.select("item_id", F.col("text").cast("binary").alias("text")).collect()
    items = [(r["item_id"], words_of(r["text"])) for r in rows if r["text"] is not None]
    items = sorted((i for i in items if i[1]), key=lambda i: (i[0] is None, i[0] if i[0] is not None else 0, i[1]))
    terms = sorted({w for _, words in items for w in words})
    total, frequency = _frequencies(docs, terms)
    idf = np.log((total + 1) / (frequency + 0.5)).clip(1e-3)
    search = Search(items, terms, idf, settings)
    space = np.zeros((len(terms), 0))
    if items:
        vectors = [(n.tolist(), w.tolist()) for n, w in map(search.weights, search.units)]
        passages = spark.createDataFrame(vectors, "terms array<long>, weights array<double>")
        space = latent_space(stored(passages, "passages"), len(terms), settings)
    search.project(space)
    return search


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A row for each row of ``docs`` and item found in it: ``doc_id``, ``item_id``,
    ``cosine``, ``lcs_share`` and ``answer_share``.

    Passages and items are placed in the latent space of the benchmark's TF-IDF vectors, with
    frequencies from all documents, and compared at unit length: so a passage that holds an
    item is near it however little of the item the space keeps. Candidates must then hold a
    long subsequence of the item's words within a stretch of about its length, or a shorter
    one with its last words, its answer, at its end; common words alone do not
    suffice, unless they are nearly all of the item. Where a part of an item decides
    (``Settings.passages``), the shares are the part's.

    The search may miss a candidate; tests measure its recall. Every passage of every text is
    compared with every item, by matrix products of bounded size in the tasks.

    * Null or empty texts and items match nothing. A null id is passed on.
    * Texts of any length are searched whole, in blocks of passages.
    * Repeated rows give repeated matches, repeated items a match each. Empty tables: no rows.
    * Only ``doc_id`` and ``text``, ``item_id`` and ``text`` are read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, cosine double, lcs_share double, answer_share double"
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def matcher(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = received(sent)
            for batch in batches:
                rows, found = [], []
                for i, text in enumerate(batch.column(1)):
                    for match in own.matches(text.as_py()):
                        rows.append(i)
                        found.append(match)
                if not found:
                    continue
                ids = pa.array([own.items[m[0]][0] for m in found])
                arrays = [batch.column(0).take(pa.array(rows, pa.int64())), ids]
                arrays += [pa.array([m[k] for m in found], pa.float64()) for k in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "cosine", "lcs_share", "answer_share"])

        return run

    parts = [texts.mapInArrow(matcher(shared(docs.sparkSession, s)), schema) for s in prepare(docs, benchmark, settings)]
    return reduce(DataFrame.union, parts)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with the same columns.

    Rows with null or empty texts stay, repeated rows stay or go together, and columns of any
    name pass through. An empty benchmark drops nothing.
    """
    rows, place = numbered(docs)
    at = rows.columns.index(place["text"])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    def cleaner(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = received(sent)
            for batch in batches:
                for start in range(0, batch.num_rows, _ROWS):
                    part = batch.slice(start, _ROWS)
                    clean = [not own.matches(t.as_py()) for t in part.column(at).cast(pa.binary())]
                    yield part.filter(pa.array(clean, pa.bool_()))

        return run

    for search in prepare(docs, benchmark, settings):
        rows = rows.mapInArrow(cleaner(shared(docs.sparkSession, search)), fields)
    return renamed(rows, place)
