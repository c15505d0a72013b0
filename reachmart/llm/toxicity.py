"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reachmart.llm.common import held_out, learnable, numbered, received, renamed, shared, stored

_LETTERS = re.compile(r"[^\W\d_]+")
STEM = 5  # letters of a word's stem term
_TOGETHER = 128  # texts that are searched for at a time


@dataclass(frozen=True)
class Settings:
    """The bound of what is learned from, and the size of the vote.

    ``examples`` bounds the labelled rows: where there are more, a share of them is drawn by
    a hash of the id. ``floor`` is the part of a term's weight that its label has no say in.
    """

    examples: int = 4_000
    floor: float = 0.02
    neighbours: int = 15
    prior_weight: float = 0.5
    block: int = 1024


# --- terms -----------------------------------------------------------------------------


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def _terms(words: list[str]) -> set[str]:
    """Words, and the stems of longer words (marked by a hyphen)."""
    distinct = set(words)
    return distinct.union(w[:STEM] + "-" for w in distinct if len(w) > STEM)


class _Words(dict):
    """For each word met so far the numbers of its own term and of its stem's, counted from 1
    and packed into one integer; 0 stands for none. Words without a known term are not kept."""

    REMEMBERED = 200_000
    STEM_BITS = 32

    def __init__(self, number: dict[str, int]):
        super().__init__()
        self.number = number

    def __missing__(self, word: str) -> int:
        own = self.number.get(word, -1) + 1
        stem = self.number.get(word[:STEM] + "-", -1) + 1 if len(word) > STEM else 0
        packed = own << self.STEM_BITS | stem
        if packed:
            if len(self) >= self.REMEMBERED:
                self.clear()
            self[word] = packed
        return packed


class Vocabulary:
    WORDS = 1 << 17  # words, or those of one text, whose terms are added up at a time

    def __init__(self, terms: list[str], weights: list[float]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.weights = np.array(weights, float)
        self.known = _Words(self.number)

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return self.vectors([text])[0]

    def vectors(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the numbers and normalised TF-IDF weights of its known terms."""
        made, held, n = [], [], 0
        for text in texts:
            words = words_of(text)
            held.append(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
            n += len(words)
            if n >= self.WORDS:
                made += self._weighted(held)
                held, n = [], 0
        return made + self._weighted(held)

    def _weighted(self, texts: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        packed = np.concatenate([np.zeros(0, np.int64), *texts])
        firsts = np.arange(len(texts) + 1) * len(self.number)
        first = np.repeat(firsts[:-1] - 1, [len(t) for t in texts])
        own, stem = packed >> _Words.STEM_BITS, packed & ((1 << _Words.STEM_BITS) - 1)
        found, counts = np.unique(np.concatenate([(first + own)[own > 0], (first + stem)[stem > 0]]), return_counts=True)
        cuts = np.searchsorted(found, firsts)
        numbers = found - np.repeat(firsts[:-1], np.diff(cuts))
        weights = (1 + np.log(counts.astype(float))) * self.weights[numbers]
        return [
            (numbers[a:b], weights[a:b] / np.linalg.norm(weights[a:b]) if a < b else weights[a:b])
            for a, b in zip(cuts.tolist(), cuts[1:].tolist())
        ]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and term: toxic and other examples that have it."""
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic].update(_terms(words_of(text)))
        terms = sorted(counts[0].keys() | counts[1].keys())
        arrays = [pa.array(terms, pa.string())]
        arrays += [pa.array([counts[y][t] for t in terms], pa.int64()) for y in (1, 0)]
        yield pa.RecordBatch.from_arrays(arrays, names=["term", "toxic", "other"])


def _vocabulary(examples: DataFrame, settings: Settings) -> Vocabulary | None:
    """All terms that at least two examples share, of whatever class.

    A term's weight is its IDF times how it goes with the label: the correlation of the two
    over the examples, in either direction, which does not grow with their number, and the
    floor. The terms of the bounded examples come to the driver.
    """
    n, positive = examples.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not positive or positive == n:
        return None
    counted = examples.select("text", "toxic").mapInArrow(_term_counts, "term string, toxic long, other long")
    kept = counted.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b")).filter(F.col("a") + F.col("b") >= 2)
    kept = kept.toArrow().sort_by("term")
    a, b = (kept.column(name).to_numpy().astype(float) for name in ("a", "b"))
    c, d = positive - a, n - positive - b
    apart = np.sqrt((a + b) * (c + d) * positive * (n - positive))
    correlation = np.abs(a * d - b * c) / np.where(apart > 0, apart, 1)
    return Vocabulary(kept.column("term").to_pylist(), np.log(1 + n / (a + b)) * (correlation + settings.floor))


# --- index -----------------------------------------------------------------------------


class BlockMaxIndex:
    """Inverted lists cut into blocks of examples, with the largest weight in each block.

    Lists that hold a large part of all examples are kept as full rows instead, which are
    added up without looking up places.
    """

    FULL = 16  # a list with more than one of so many examples is a full row
    LISTS = 16  # vectors whose lists are added up together

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int):
        self.block, self.n = block, len(vectors)
        n_blocks = -(-self.n // block) or 1
        terms = np.concatenate([v[0] for v in vectors] or [np.zeros(0)]).astype(np.int64)
        rows = np.repeat(np.arange(self.n), [len(v[0]) for v in vectors])
        weights = np.concatenate([v[1] for v in vectors] or [np.zeros(0)])
        self.most = np.zeros((n_terms, n_blocks))
        np.maximum.at(self.most.reshape(-1), terms * n_blocks + rows // block, weights)
        often = np.bincount(terms, minlength=n_terms) * self.FULL > self.n
        self.place = np.where(often, np.cumsum(often) - 1, -1)
        self.full = np.zeros((n_blocks, int(often.sum()), block))
        listed = often[terms]
        self.full[rows[listed] // block, self.place[terms[listed]], rows[listed] % block] = weights[listed]
        terms, rows, weights = terms[~listed], rows[~listed], weights[~listed]
        order = np.lexsort((rows, terms))
        rows, self.weights = rows[order], weights[order]
        self.inside = (rows % block).astype(np.int32)
        cell = terms[order] * n_blocks + rows // block
        self.starts = np.searchsorted(cell, np.arange(n_terms * n_blocks + 1))
        self.n_blocks = n_blocks

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        return self.nearest_of_each([(terms, weights)], k, [leave])[0]

    def nearest_of_each(
        self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, leave: list[int] | None = None
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the ``k`` examples of largest cosine above zero, ties by position;
        ``leave`` names an example for each vector that does not count.

        Each vector takes the blocks in the order of their bounds, until no other block can
        reach its k-th best cosine. Vectors that take the same block in the same turn have
        their full rows added up as one matrix product. Cosines have twelve digits, so they
        do not depend on which vectors come together.
        """
        n = len(vectors)
        leave = leave or [-1] * n
        bounds = np.zeros((n, self.n_blocks))
        common = np.zeros((n, self.full.shape[1]))
        lists = []
        for i, (terms, weights) in enumerate(vectors):
            bounds[i] = weights @ self.most[terms]
            place = self.place[terms]
            often = place >= 0
            common[i, place[often]] = weights[often]
            lists.append((terms[~often] * self.n_blocks, weights[~often]))
        order = np.argsort(-bounds, axis=1, kind="stable")
        best = [(np.zeros(0, np.int64), np.zeros(0))] * n
        alive = np.arange(n)
        for turn in range(self.n_blocks):
            at = order[alive, turn]
            bound = bounds[alive, at]
            least = np.array([best[i][1][-1] - 1e-11 if len(best[i][1]) == k else 0.0 for i in alive.tolist()])
            going = (bound > 0) & (bound >= least)
            alive, at, least = alive[going], at[going], least[going]
            for b in np.unique(at).tolist():
                mine = np.flatnonzero(at == b)
                products = common[alive[mine]] @ self.full[b]
                for start in range(0, len(mine), self.LISTS):
                    some = mine[start : start + self.LISTS]
                    which = alive[some].tolist()
                    scored = products[start : start + self.LISTS] + self._listed(b, [lists[i] for i in which])
                    for scores, of, i in zip(scored, least[some].tolist(), which):
                        if leave[i] >= 0 and leave[i] // self.block == b:
                            scores[leave[i] % self.block] = 0
                        best[i] = self._better(best[i], scores, b, k, of)
        return best

    def _better(self, best: tuple[np.ndarray, np.ndarray], scores: np.ndarray, b: int, k: int, least: float):
        hit = np.flatnonzero((scores > 1e-12) & (scores >= least))
        if len(hit) > 4 * k:
            hit = hit[scores[hit] >= np.partition(scores[hit], -k)[-k] - 1e-11]
        rows = np.concatenate([best[0], b * self.block + hit])
        near = np.concatenate([best[1], np.round(scores[hit], 12)])
        top = np.lexsort((rows, -near))[:k]
        return rows[top], near[top]

    def _listed(self, b: int, lists: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The part of a block's scores that comes from the inverted lists, a row for each vector."""
        cells = np.concatenate([cells for cells, _ in lists]) + b
        weights = np.concatenate([weights for _, weights in lists])
        row = np.repeat(np.arange(len(lists)) * self.block, [len(cells) for cells, _ in lists])
        starts = self.starts[cells]
        lengths = self.starts[cells + 1] - starts
        some = np.flatnonzero(lengths)
        starts, lengths, weights, row = starts[some], lengths[some], weights[some], row[some]
        ends = np.cumsum(lengths)
        at = np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        into = np.repeat(row, lengths) + self.inside[at]
        added = np.repeat(weights, lengths) * self.weights[at]
        return np.bincount(into, added, len(lists) * self.block).reshape(len(lists), self.block)


class Model:
    """Vocabulary, index, labels of the indexed examples and the calibration."""

    def __init__(self, vocabulary: Vocabulary | None, vectors, labels, ids, share: float, settings: Settings):
        self.vocabulary, self.share, self.settings = vocabulary, share, settings
        # Like examples side by side make the blocks' bounds tight.
        order = sorted(range(len(vectors)), key=lambda i: (int(vectors[i][0][vectors[i][1].argmax()]), labels[i], i))
        vectors = [vectors[i] for i in order]
        self.labels = np.array([labels[i] for i in order], float)
        self.ids = [ids[i] for i in order]
        self.place = {p: i for i, p in enumerate(order)}
        n_terms = len(vocabulary.number) if vocabulary else 0
        self.index = BlockMaxIndex(vectors, n_terms, settings.block)
        self.nothing, self.slope, self.shift = share, 1.0, 0.0

    def votes(self, vectors, leave: list[int] | None = None) -> list[tuple[float | None, list]]:
        """For each vector the log odds of the distance-weighted vote, and the neighbours' ids;
        None without any."""
        found = []
        for rows, near in self.index.nearest_of_each(vectors, self.settings.neighbours, leave):
            if not len(rows):
                found.append((None, []))
                continue
            labels = self.labels[rows]
            prior = self.settings.prior_weight
            yes = float(near @ labels) + prior * self.share
            no = float(near @ (1 - labels)) + prior * (1 - self.share)
            found.append((math.log(yes / no), [self.ids[r] for r in rows]))
        return found

    def scores(self, texts: list[str | None]) -> list[tuple[float, list]]:
        if self.vocabulary is None:
            return [(self.share, [])] * len(texts)
        return [
            (self.nothing if odds is None else 1 / (1 + math.exp(-(self.shift + self.slope * odds))), evidence)
            for odds, evidence in self.votes(self.vocabulary.vectors(texts))
        ]


def _calibrate(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the vote's log odds, by Newton steps."""
    shift, slope = 0.0, 1.0
    targets = np.where(labels > 0, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    x = np.stack([np.ones_like(odds), odds], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(shift + slope * odds, -30, 30)))
        # A weak pull to the uncalibrated vote keeps the step defined on separable votes.
        gradient = x.T @ (targets - p) - 1e-2 * np.array([shift, slope - 1])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        shift, slope = shift + step[0], slope + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return (shift, slope) if slope > 0 else (0.0, 1.0)


# --- training and scoring -----------------------------------------------------------------


def _examples(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """Distinct texts of a bounded share of the labelled rows of the learning folds."""
    labelled = labels.filter("toxic is not null").filter(learnable(F.col("doc_id")))
    labelled = labelled.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    labelled = labelled.filter("toxic in (0, 1)")
    share = settings.examples / max(labelled.count(), 1)
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit("examples"), "doc_id"), 11) / float(1 << 53) < share
    chosen = stored(labelled.filter(drawn), "labels")
    if chosen.count() > 2 * settings.examples:
        raise ValueError("the drawn labels exceed their bound")
    texts = docs.select("doc_id", "text").filter("text is not null")
    found = texts.join(F.broadcast(chosen), "doc_id").withColumn("_text", F.sha2("text", 256))
    one = found.groupBy("_text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    return stored(one.select("doc_id", "toxic", "text"), "examples")


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from ``labels`` (``doc_id``, ``toxic``) outside the held-out fold.

    What comes to the driver are the terms of the examples, whose number ``settings`` bounds.
    The vote is calibrated on the examples themselves, each without its own vote.
    """
    spark = docs.sparkSession
    examples = _examples(docs, labels, settings)
    vocabulary = _vocabulary(examples, settings)
    n, positive = examples.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = positive / n if n else 0.0
    if vocabulary is None or not vocabulary.number:
        return Model(None, [], [], [], share, settings)
    terms_sent = shared(spark, vocabulary)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(terms_sent)
        for batch in batches:
            found = [own.vector(t) for t in batch.column(2).to_pylist()]
            terms = pa.array([v[0] for v in found], pa.list_(pa.int32()))
            weights = pa.array([v[1] for v in found], pa.list_(pa.float64()))
            arrays = [batch.column(0), batch.column(1), terms, weights]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "toxic", "terms", "weights"])

    kind = examples.schema["doc_id"].dataType.simpleString()
    made = examples.mapInArrow(vectors, f"doc_id {kind}, toxic int, terms array<int>, weights array<double>").toArrow()
    terms_sent.destroy()
    ids, toxic = made.column("doc_id").to_pylist(), made.column("toxic").to_pylist()
    terms, weights = (made.column(name).combine_chunks() for name in ("terms", "weights"))
    cuts = terms.offsets.to_numpy()
    terms, weights = terms.values.to_numpy(), weights.values.to_numpy()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], toxic[i], int(cuts[i + 1] - cuts[i])))
    silent = [toxic[i] for i in order if cuts[i] == cuts[i + 1]]
    order = [i for i in order if cuts[i] < cuts[i + 1]]
    made_vectors = [(terms[cuts[i] : cuts[i + 1]], weights[cuts[i] : cuts[i + 1]]) for i in order]
    labels_of = [toxic[i] for i in order]
    model = Model(vocabulary, made_vectors, labels_of, [ids[i] for i in order], share, settings)

    sent = shared(spark, (model, made_vectors))

    def leave_one_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_vectors = received(sent)
        for batch in batches:
            for start in range(0, batch.num_rows, _TOGETHER):
                part = batch.slice(start, _TOGETHER).column(0)
                at = part.to_pylist()
                odds = [o for o, _ in own.votes([own_vectors[i] for i in at], [own.place[i] for i in at])]
                yield pa.RecordBatch.from_arrays([part, pa.array(odds, pa.float64())], names=["id", "odds"])

    tasks = max(1, min(len(order) // 500, spark.sparkContext.defaultParallelism))
    voted = spark.range(0, len(order), 1, tasks).mapInArrow(leave_one_out, "id long, odds double").collect()
    sent.destroy()
    with_odds = [(r["odds"], labels_of[r["id"]]) for r in voted if r["odds"] is not None]
    silent += [labels_of[r["id"]] for r in voted if r["odds"] is None]
    model.nothing = (sum(silent) + share) / (len(silent) + 1)
    if with_odds:
        model.shift, model.slope = _calibrate(np.array([o for o, _ in with_odds]), np.array([y for _, y in with_odds], float))
    return model


def score(docs: DataFrame, model: Model, *carried: str, text: str = "text") -> DataFrame:
    """``doc_id``, ``carried``, ``score``, ``predicted`` and ``evidence`` of every row. A ``text``
    that is carried goes to the tasks once."""
    sent = shared(docs.sparkSession, model)
    kept = ["doc_id", *carried]
    read = kept if text in kept else [*kept, text]
    at = read.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(sent)
        for batch in batches:
            for start in range(0, batch.num_rows, _TOGETHER):
                part = batch.slice(start, _TOGETHER)
                found = own.scores(part.column(at).to_pylist())
                scores = pa.array([s for s, _ in found], pa.float64())
                predicted = pa.array([int(s >= 0.5) for s, _ in found], pa.int32())
                evidence = pa.array([[str(i) for i in e[:5]] for _, e in found], pa.list_(pa.string()))
                arrays = [*part.columns[: len(kept)], scores, predicted, evidence]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "score", "predicted", "evidence"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema]
    schema = ", ".join([*fields, "score double", "predicted int", "evidence array<string>"])
    return docs.select(*read).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``evidence`` of every row of ``docs``.

    The score is the calibrated vote of the ``neighbours`` nearest labelled examples of both
    classes, by the exact cosine over all their terms, each weighted by its cosine; ``evidence`` names the nearest of them. A text without any term
    of the index gets the rate of toxic examples among such texts.

    * A null text counts as empty. Labels that are null, not 0 or 1, or of a null id teach
      nothing; if an id has several, the largest counts.
    * Without toxic or without other examples every score is the rate of toxic ones (0
      without examples). Repeated rows get the same score each; an empty table, no rows.
    * A text of any length is one vector of all its terms.
    * Only ``doc_id`` and ``text`` of ``docs`` are read, so other columns cannot clash.
    """
    scored = score(docs, train(docs, labels, settings))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` whose score is below one half, with the same columns.

    Null and empty texts have the score of texts without terms; repeated rows stay or go
    together; columns of any name pass through; an empty table stays empty.
    """
    rows, place = numbered(docs)
    rows = rows.withColumn("doc_id", F.col(place["doc_id"]))
    kept = score(rows, train(docs, labels, settings), *place.values(), text=place["text"]).filter("predicted = 0")
    return renamed(kept, place)
