"""Hard negatives by angular triangle filtering before exact integer scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from reachmart.llm.common import received, shared, stored

_NONE = np.iinfo(np.int64).min  # below every score
_EXACT = 2.0**52  # sums of products below this are exact in doubles
_ANGLE_ERROR = 1e-7  # an arc cosine near 0 or pi is that far off at most
_CHUNK = 512  # anchors that are compared with a block of rows at a time


@dataclass(frozen=True)
class Settings:
    """``positives`` per anchor, ``negatives`` for each of them, whose score is ``low`` to
    ``high`` percent of the positive's; components are multiplied by ``scale`` and cut to
    integers. The rest moves work only: ``references`` directions, chosen from ``sample``
    rows; ``block`` anchors sent to the tasks at a time; ``rows`` vectors to a block of the
    index."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256
    references: int = 8
    sample: int = 2048
    block: int = 4096
    rows: int = 1024


# --- bounds -------------------------------------------------------------------------------


def _padded(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1]))) if matrix.shape[1] < width else matrix


def integers(vectors: list, scale: int) -> np.ndarray:
    """The components times ``scale``, cut to integers; shorter vectors end in zeros."""
    width = max((len(v) for v in vectors), default=0)
    matrix = np.zeros((len(vectors), width))
    for row, vector in zip(matrix, vectors):
        row[: len(vector)] = vector
    return np.floor(matrix * scale)


def angles(matrix: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norm of each row and its angles to the reference directions; a zero row: right angles."""
    width = max(matrix.shape[1], references.shape[1])
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    cosines = _padded(matrix, width) @ _padded(references, width).T / np.where(norms > 0, norms, 1)[:, None]
    return norms, np.arccos(np.clip(cosines, -1, 1))


def spread(sample: np.ndarray, number: int) -> np.ndarray:
    """Unit vectors from a sample, each the one farthest in angle from those before it."""
    norms = np.sqrt((sample * sample).sum(axis=1))
    units = sample[norms > 0] / norms[norms > 0][:, None]
    if not len(units):
        return np.zeros((0, sample.shape[1]))
    chosen, nearest = [0], units @ units[0]
    while len(chosen) < min(number, len(units)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def score_bounds(
    own: np.ndarray, theta: np.ndarray, norms: tuple[np.ndarray, np.ndarray], least: np.ndarray, most: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score of anchors (norms ``own``, angles ``theta``) with groups of
    vectors whose angles lie between ``least`` and ``most`` and whose norms lie between the
    two ``norms``; one row per anchor, one column per group.

    For each direction the angle between two vectors is at least the difference of their
    angles to it, and at most their sum, or what the sum leaves of a full turn.
    """
    near = np.zeros((len(own), len(least)))
    far = np.full(near.shape, np.pi)
    for j in range(theta.shape[1]):
        a = theta[:, j][:, None]
        np.maximum(near, np.maximum(a - most[:, j], least[:, j] - a), out=near)
        np.minimum(far, np.minimum(a + most[:, j], 2 * np.pi - a - least[:, j]), out=far)
    high = np.cos(np.maximum(near - 2 * _ANGLE_ERROR, 0))
    low = np.cos(np.minimum(far + 2 * _ANGLE_ERROR, np.pi))
    short, long = (own[:, None] * n for n in norms)
    upper = high * np.where(high > 0, long, short)
    lower = low * np.where(low > 0, short, long)
    margin = 1 + 1e-12 * long
    return lower - margin, upper + margin


def exact_scores(left: np.ndarray, right: np.ndarray, largest: float) -> np.ndarray:
    """Inner products of integers; ``largest`` is the product of the largest norms, which
    bounds every partial sum. Fails if a score does not fit 64 bits."""
    width = max(left.shape[1], right.shape[1])
    left, right = _padded(left, width), _padded(right, width)
    if largest < _EXACT:
        return (left @ right.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    products = whole(left) @ whole(right).T if width else np.zeros((len(left), len(right)), object)
    if products.size and max(products.max(), -products.min()) >= 2**63:
        raise ValueError("a score does not fit 64 bits")
    return products.astype(np.int64)


# --- the search of one task ---------------------------------------------------------------


@dataclass
class Anchors:
    """Some anchors with their angles; each asks for the best rows of ``slots`` score windows
    from ``low`` to ``high`` (one row per anchor, one column per window)."""

    uid: np.ndarray
    label: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    theta: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def part(self, start: int) -> Anchors:
        return Anchors(*[getattr(self, name)[start : start + _CHUNK] for name in self.__dataclass_fields__])


@dataclass
class Block:
    """Some rows of the index."""

    uid: np.ndarray
    vec_id: np.ndarray
    no_id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    theta: np.ndarray


class Best:
    """The best ``k`` rows of each window of some anchors, over the blocks given so far."""

    def __init__(self, anchors: Anchors, k: int, same_label: bool):
        self.anchors, self.k, self.same_label = anchors, k, same_label
        self.least = np.full(anchors.low.shape, _NONE)  # score of the k-th row so far
        self.rows = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]  # group, score, id, no id
        self.compared = self.scored = 0

    def add(self, block: Block) -> None:
        a = self.anchors
        wanted = np.maximum(a.low, self.least)
        low, high = wanted.min(axis=1), a.high.max(axis=1)
        ends = [f(block.norms)[None] for f in (np.min, np.max)]
        edges = [f(block.theta, axis=0)[None] for f in (np.min, np.max)]
        lower, upper = score_bounds(a.norms, a.theta, ends, *edges)
        self.compared += len(a.uid) * len(block.uid)
        some = np.flatnonzero((upper[:, 0] >= low) & (lower[:, 0] <= high))
        if not len(some):
            return
        norms = block.norms[None]
        lower, upper = score_bounds(a.norms[some], a.theta[some], (norms, norms), block.theta, block.theta)
        open_ = (upper >= low[some, None]) & (lower <= high[some, None])
        open_ &= (a.label[some, None] == block.label[None]) == self.same_label
        open_ &= a.uid[some, None] != block.uid[None]
        rows, columns = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
        if not len(rows):
            return
        some, open_ = some[rows], open_[np.ix_(rows, columns)]
        self.scored += int(open_.sum())
        scores = exact_scores(a.vectors[some], block.vectors[columns], a.norms.max() * block.norms.max())
        found = []
        for slot in range(a.low.shape[1]):
            inside = open_ & (scores >= wanted[some, slot, None]) & (scores <= a.high[some, slot, None])
            if inside.sum() > 8 * self.k * len(some) and inside.shape[1] > self.k:
                kth = np.partition(np.where(inside, scores, _NONE), -self.k, axis=1)[:, -self.k]
                inside &= scores >= kth[:, None]
            i, j = np.nonzero(inside)
            found.append((some[i] * a.low.shape[1] + slot, scores[i, j], block.vec_id[columns[j]], block.no_id[columns[j]]))
        self._merge(found)

    def _merge(self, found: list[tuple]) -> None:
        group, score, vec_id, no_id = (np.concatenate(parts) for parts in zip(self.rows, *found))
        if len(group) == len(self.rows[0]):
            return
        order = np.lexsort((vec_id, no_id, -score, group))
        group = group[order]
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
        kept = order[rank < self.k]
        self.rows = [group[rank < self.k], score[kept], vec_id[kept], no_id[kept]]
        last = order[rank == self.k - 1]
        self.least.reshape(-1)[group[rank == self.k - 1]] = score[last]


# --- Spark jobs ---------------------------------------------------------------------------

_INDEX = (
    "uid binary, vec_id binary, no_id binary, label binary, anchor binary, width int, kind string, "
    "vectors binary, norms binary, theta binary"
)
_KINDS = ("int16", "int32", "float64")


def _index(rows: DataFrame, references: np.ndarray, settings: Settings) -> DataFrame:
    """Blocks of vectors that point in similar directions, with norms and angles."""
    sent = shared(rows.sparkSession, references)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = received(sent)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            matrix = integers([v.values.to_numpy() for v in batch.column("vector")], settings.scale)
            norms, theta = angles(matrix, directions)
            nearest = theta.argmin(axis=1) if len(directions) else np.zeros(len(matrix), int)
            order = np.lexsort((theta.min(axis=1, initial=np.pi), nearest))
            ids = batch.column("vec_id")
            columns = [
                ids.fill_null(0).to_numpy(),
                ids.is_null().to_numpy(zero_copy_only=False),
                batch.column("label").to_numpy(),
                batch.column("anchor").to_numpy(zero_copy_only=False),
            ]
            for start in range(0, len(order), settings.rows):
                at = order[start : start + settings.rows]
                part = matrix[at]
                kind = next(k for k in _KINDS if k == "float64" or np.abs(part).max(initial=0) <= np.iinfo(k).max)
                numbers = np.arange(uid, uid + len(at))
                uid += len(at)
                buffers = [numbers, *[c[at] for c in columns], part.shape[1], kind, part.astype(kind), norms[at], theta[at]]
                arrays = [pa.array([b.tobytes() if isinstance(b, np.ndarray) else b]) for b in buffers]
                arrays[5] = arrays[5].cast(pa.int32())
                yield pa.RecordBatch.from_arrays(arrays, names=[field.split()[0] for field in _INDEX.split(", ")])

    return rows.mapInArrow(run, _INDEX)


def _block(row: dict) -> tuple[Block, np.ndarray]:
    uid = np.frombuffer(row["uid"], np.int64)
    of = lambda name, kind: np.frombuffer(row[name], kind)
    vectors = of("vectors", row["kind"]).reshape(len(uid), row["width"]).astype(float)
    theta = of("theta", float).reshape(len(uid), -1)
    return Block(uid, of("vec_id", np.int64), of("no_id", bool), of("label", np.int64), vectors, of("norms", float), theta), of("anchor", bool)


def _anchors_of(index: DataFrame, parts: int) -> DataFrame:
    """A row per anchor; ``part`` deals them evenly, since ``uid`` differs from row to row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["uid", "vec_id", "label", "vector"]
        for batch in batches:
            for row in batch.to_pylist():
                block, asks = _block(row)
                at = np.flatnonzero(asks)
                vectors = pa.array(list(block.vectors[at]), pa.list_(pa.float64()))
                values = [block.uid[at], pa.array(block.vec_id[at], mask=block.no_id[at]), block.label[at], vectors]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=names)

    found = index.mapInArrow(run, "uid long, vec_id long, label long, vector array<double>")
    return found.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int"))


def _best(index: DataFrame, anchors: Anchors, k: int, same_label: bool) -> DataFrame:
    """The best rows of each window within each task: ``anchor``, ``slot``, ``score``, ``vec_id``."""
    sent = shared(index.sparkSession, anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = received(sent)
        parts = [Best(whole.part(start), k, same_label) for start in range(0, len(whole.uid), _CHUNK)]
        for batch in batches:
            for i in range(batch.num_rows):
                block, _ = _block(batch.slice(i, 1).to_pylist()[0])
                for part in parts:
                    part.add(block)
        for part in parts:
            group, score, vec_id, no_id = part.rows
            anchor, slot = np.divmod(group, part.anchors.low.shape[1])
            values = [part.anchors.uid[anchor], slot.astype(np.int32), score, pa.array(vec_id, mask=no_id)]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["anchor", "slot", "score", "vec_id"])

    found = index.mapInArrow(run, "anchor long, slot int, score long, vec_id long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    settings: Settings = Settings(),
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
) -> DataFrame:
    """For each row that ``anchor`` picks and each of its positives, the best negatives.

    The score of two rows is the inner product of their integer components. An anchor's
    positives are the ``positives`` other rows of its label with the highest scores. The
    negatives of a positive are the ``negatives`` rows of other labels with the highest
    scores from ``low`` to ``high`` percent of the positive's. Ties go to the smaller id.
    Columns: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``; ``positive`` is the positive's place.

    The rows are written once as blocks with norms and angles to some reference directions.
    Anchors are sent to the blocks in parts of a fixed size, first for the positives, then
    for the negatives. A block, and then a row, is left out for an anchor if the angles
    bound its scores outside all windows, or below the rows found so far; only what is left
    is scored. So nothing is cut, and only the work depends on the reference directions.

    * Rows with a null label, a null vector, or a component that is null, infinite or not a
      number take no part. A null id stays, sorts last and is no anchor unless picked.
    * Repeated rows are rows of their own: a copy of an anchor can be its positive.
    * Of vectors of different lengths the shorter count as ending in zeros; a zero vector
      scores 0. A positive with a score below 0 has no negatives; with 0, those that score 0.
    * An empty table, or one without anchors, gives no rows. Scores that do not fit 64 bits
      fail. Only the three named columns are read, so others cannot clash.
    """
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).filter(F.col("label").isNotNull() & x.isNotNull() & finite)
    sample = rows.select("vector").orderBy(F.xxhash64("vector")).limit(settings.sample).collect()
    references = spread(integers([r["vector"] for r in sample], settings.scale), settings.references)
    index = stored(_index(rows, references, settings), "vectors")
    asking = rows.filter("anchor").count()
    parts = max(1, -(-asking // settings.block))
    anchors = stored(_anchors_of(index, parts), "anchors")
    found = [_of_part(index, anchors.filter(F.col("part") == i), references, settings) for i in range(parts)]
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result


def _of_part(index: DataFrame, part: DataFrame, references: np.ndarray, settings: Settings) -> DataFrame:
    """The negatives of some anchors. The driver holds these anchors and their positives."""
    rows = part.orderBy("uid").collect()
    matrix = integers([r["vector"] for r in rows], 1)
    norms, theta = angles(matrix, references)
    uid, label = (np.array([r[name] for r in rows], np.int64) for name in ("uid", "label"))
    whole = np.full((len(rows), 1), _NONE)
    asked = Anchors(uid, label, matrix, norms, theta, whole, ~whole)
    positives = _best(index, asked, settings.positives, True).orderBy("anchor", "rank").collect()
    place = {r["uid"]: i for i, r in enumerate(rows)}
    low, high = np.full((len(rows), settings.positives), -_NONE - 1), np.full((len(rows), settings.positives), _NONE)
    chosen = []
    for p in positives:
        at, slot, score = place[p["anchor"]], p["rank"] - 1, p["score"]
        low[at, slot], high[at, slot] = -(-settings.low * score // 100), settings.high * score // 100
        chosen.append((p["anchor"], slot, rows[at]["vec_id"], p["vec_id"], score))
    asked = Anchors(uid, label, matrix, norms, theta, low, high)
    negatives = stored(_best(index, asked, settings.negatives, False), "negatives")
    spark = index.sparkSession
    known = spark.createDataFrame(chosen, "anchor long, slot int, anchor_id long, positive_id long, positive_score long")
    joined = negatives.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(known, ["anchor", "slot"])
    return joined.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", (F.col("slot") + 1).alias("positive")
    )
