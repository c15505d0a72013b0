"""Language by unigram pieces whose segmentations are summed over."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reachmart.llm.common import held_out, learnable, received, shared, stored

UNKNOWN_LANGUAGE = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_START = "▁"  # marks the first piece of a word in the vocabulary
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_RESCALE = 16  # letters after which the sums are scaled, so that long words do not underflow


@dataclass(frozen=True)
class Settings:
    """What is learned from, and the model's size.

    ``documents`` bounds the learning rows of each language: where there are more, a share
    is drawn by a hash of the id. ``longest`` is the length of the longest piece used.
    """

    documents: int = 2_000
    longest: int = 8
    steps: int = 4
    smoothing: float = 0.05
    cache: int = 200_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(path: str, longest: int) -> list[str]:
    """Pieces of letters from a sentence piece file, in lower case, single letters included."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = set()
    for number in range(model.get_piece_size()):
        if model.is_control(number) or model.is_unknown(number) or model.is_byte(number):
            continue
        piece = model.id_to_piece(number).lower()
        letters = piece.removeprefix(_START)
        if len(piece) <= longest and (not letters or _LETTERS.fullmatch(letters)):
            pieces.add(piece)
    return sorted(pieces | {_START})


class Pieces:
    """Finds the pieces that end at each letter of many words at once.

    Piece 0 stands for any single letter that the vocabulary lacks. Substrings are looked
    up by a 64-bit polynomial hash. Keys are dealt to buckets, and each bucket has a factor
    that puts its keys into free slots of the table, so a look-up reads one slot.
    """

    def __init__(self, pieces: list[str], longest: int):
        self.longest, self.size = longest, len(pieces) + 1
        self.powers = np.array([pow(int(_MULTIPLIER), i, 1 << 64) for i in range(longest + 1)], np.uint64)
        keys = np.array([self._key(p) for p in pieces], np.uint64)
        self.bits = len(pieces).bit_length() + 1
        self.buckets = max(self.bits - 3, 1)
        self.held = np.zeros(1 << self.bits, np.uint64)
        self.number = np.zeros(1 << self.bits, np.int32)
        self.factors = np.ones(1 << self.buckets, np.uint64)
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
        free = np.ones(1 << self.bits, bool)
        random = np.random.default_rng(0)
        for group in sorted(groups, key=len, reverse=True):
            for _ in range(10_000):
                factor = random.integers(1, 1 << 63, dtype=np.uint64) | np.uint64(1)
                slots = self._slots(keys[group], factor)
                if free[slots].all() and len(np.unique(slots)) == len(slots):
                    break
            else:
                raise ValueError("the vocabulary does not fit the table")
            free[slots] = False
            self.factors[bucket[group[0]]] = factor
            self.held[slots], self.number[slots] = keys[group], group + 1

    def _key(self, piece: str) -> int:
        key = 0
        for letter in piece:
            key = (key * int(_MULTIPLIER) + ord(letter) + 1) % (1 << 64)
        return key

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(31))) * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(64 - self.buckets)

    def _slots(self, keys: np.ndarray, factors) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * factors) >> np.uint64(64 - self.bits)

    def _numbers(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys, self.factors[self._bucket(keys)])
        return self.number[slots] * (self.held[slots] == keys)

    def ends(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of words of one batch with their start mark, and the piece numbers by
        (word, end, length): 0 for none, or for a single unknown letter."""
        lengths = np.array([len(w) + 1 for w in words])
        width = int(lengths.max())
        codes = np.zeros((len(words), width), np.uint64)
        text = np.frombuffer("".join(w.ljust(width - 1, "\0") for w in words).encode("utf-32-le"), np.uint32)
        codes[:, 0] = ord(_START)
        codes[:, 1:] = text.reshape(len(words), width - 1)
        prefix = np.zeros((len(words), width + 1), np.uint64)
        for i in range(width):
            prefix[:, i + 1] = prefix[:, i] * _MULTIPLIER + codes[:, i] + np.uint64(1)
        numbers = np.zeros((len(words), width + 1, self.longest + 1), np.int32)
        for length in range(1, min(self.longest, width) + 1):
            keys = prefix[:, length:] - prefix[:, : width + 1 - length] * self.powers[length]
            numbers[:, length:, length] = self._numbers(keys)
        return lengths, numbers


def forward(lengths: np.ndarray, numbers: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Log of the sum over all segmentations of each word, by (word, language).

    ``chance`` has a row per piece; row 0 is a letter that the vocabulary lacks and counts
    for single letters only.
    """
    n, width, longest = numbers.shape
    sums = np.zeros((width, n, chance.shape[1]))
    sums[0] = 1.0
    result = np.zeros((n, chance.shape[1]))
    taken = np.zeros((n, chance.shape[1]))  # logs of the scales so far
    for end in range(1, width):
        total = sums[end - 1] * chance[numbers[:, end, 1]]
        for length in range(2, min(longest - 1, end) + 1):
            piece = numbers[:, end, length]
            hit = np.flatnonzero(piece)
            if len(hit):
                total[hit] += sums[end - length][hit] * chance[piece[hit]]
        sums[end] = total
        done = np.flatnonzero(lengths == end)
        if len(done):
            result[done] = np.log(total[done]) + taken[done]
        if end % _RESCALE == 0:
            scale = np.where(total > 0, total, 1.0)
            sums[max(0, end - longest + 1) : end + 1] /= scale
            taken += np.log(scale)
    return result


def log_likelihoods(words: list[str], pieces: Pieces, chance: np.ndarray) -> np.ndarray:
    """Log probability of every word in every language: (word, language)."""
    result = np.zeros((len(words), chance.shape[1]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    start = 0
    while start < len(order):
        # Words of like length together, and no more letters at a time than fit in memory.
        size = max(1, 400_000 // (len(words[order[start]]) + 8) // (pieces.longest + 1))
        part = order[start : start + size]
        while len(part) > 1 and len(part) * len(words[part[-1]]) > 400_000:
            part = part[: len(part) // 2]
        lengths, numbers = pieces.ends([words[i] for i in part])
        result[part] = forward(lengths, numbers, chance)
        start += len(part)
    return result


def expected_counts(
    words: list[str], times: np.ndarray, language: np.ndarray, pieces: Pieces, chance: np.ndarray
) -> np.ndarray:
    """Expected uses of each piece in the words of each language: (piece, language).

    Words longer than 32 letters teach nothing; they are too rare to matter and would need
    scaled sums in both directions.
    """
    counts = np.zeros(chance.shape)
    order = [i for i in sorted(range(len(words)), key=lambda i: len(words[i])) if len(words[i]) <= 32]
    for start in range(0, len(order), 2_000):
        part = np.array(order[start : start + 2_000])
        lengths, numbers = pieces.ends([words[i] for i in part])
        own = language[part]
        n, width, longest = numbers.shape
        at = np.arange(n)

        def of(end: int, length: int) -> np.ndarray:
            value = chance[numbers[:, end, length], own]
            return np.where(numbers[:, end, length] > 0, value, 0.0) if length > 1 else value

        ahead = np.zeros((n, width))
        ahead[:, 0] = 1.0
        for end in range(1, width):
            for length in range(1, min(longest - 1, end) + 1):
                ahead[:, end] += ahead[:, end - length] * of(end, length)
        back = np.zeros((n, width))
        back[at, lengths] = 1.0
        for end in range(width - 1, 0, -1):
            for length in range(1, min(longest - 1, end) + 1):
                back[:, end - length] += back[:, end] * of(end, length)
        total = ahead[at, lengths]
        weight = np.where(total > 0, times[part] / np.where(total > 0, total, 1.0), 0.0)
        for end in range(1, width):
            for length in range(1, min(longest - 1, end) + 1):
                share = weight * ahead[:, end - length] * of(end, length) * back[:, end]
                np.add.at(counts, (numbers[:, end, length], own), share)
    return counts


class Model:
    def __init__(self, languages: list[str], pieces: Pieces, chance: np.ndarray, prior: np.ndarray, settings: Settings):
        self.languages, self.pieces, self.chance = languages, pieces, chance
        self.prior, self.settings = prior, settings
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(languages)))

    def _look_up(self, words: set[str]) -> None:
        """Scores new words; the memory of words is emptied when it is full."""
        if len(self.known) > self.settings.cache:
            self.known, self.scores = {}, self.scores[:0]
        new = sorted(w for w in words if w not in self.known)
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.scores = np.concatenate([self.scores, log_likelihoods(new, self.pieces, self.chance)])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNKNOWN_LANGUAGE, 0.0)] * len(texts)
        results: list[tuple[str, float]] = []
        part: list[list[str]] = []
        size = 0
        for i, value in enumerate(texts):
            # A few texts at a time are split into words, which take many times their size.
            part.append(_LETTERS.findall((value or "").lower()))
            size += len(part[-1])
            if size > 100_000 or i == len(texts) - 1:
                results += self._predict(part)
                part, size = [], 0
        return results

    def _predict(self, split: list[list[str]]) -> list[tuple[str, float]]:
        self._look_up(set().union(*split))
        place = self.known.__getitem__
        results = []
        for words in split:
            if not words:
                results.append((UNKNOWN_LANGUAGE, 0.0))
                continue
            numbers = np.fromiter(map(place, words), np.int64, len(words))
            total = self.prior + self.scores[numbers].sum(axis=0)
            best = int(total.argmax())
            results.append((self.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return results


def train(docs: DataFrame, vocabulary: str | None = None, settings: Settings = Settings()) -> Model:
    """Learns each language's piece probabilities by expectation maximisation.

    Words are counted and the steps run as Spark jobs; the driver gets one number per piece
    and language in each step, which the vocabulary bounds.
    """
    spark = docs.sparkSession
    pieces = Pieces(read_pieces(vocabulary or default_vocabulary(), settings.longest), settings.longest)
    usable = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    usable = usable.filter("lang is not null and text is not null").filter(learnable(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], pieces, np.zeros((pieces.size, 0)), np.zeros(0), settings)
    share = spark.createDataFrame(
        [(i, lang, min(1.0, settings.documents / sizes[lang])) for i, lang in enumerate(languages)],
        "language int, lang string, share double",
    )
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit("language"), "doc_id"), 11) / float(1 << 53) < F.col("share")
    sample = usable.join(F.broadcast(share), "lang").filter(drawn)
    words = sample.select("language", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"))).alias("word"))
    words = stored(words.groupBy("language", "word").agg(F.count(F.lit(1)).alias("times")), "words")

    chance = np.full((pieces.size, len(languages)), 1.0 / pieces.size)
    for _ in range(settings.steps):
        sent = shared(spark, (pieces, chance))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, now = received(sent)
            total = np.zeros(now.shape)
            for batch in batches:
                language, word, times = (batch.column(i) for i in range(3))
                total += expected_counts(word.to_pylist(), times.to_numpy(), language.to_numpy(), own, now)
            piece, language = np.nonzero(total)
            arrays = [pa.array(piece.astype(np.int32)), pa.array(language.astype(np.int32)), pa.array(total[piece, language])]
            yield pa.RecordBatch.from_arrays(arrays, names=["piece", "language", "uses"])

        uses = words.mapInArrow(count, "piece int, language int, uses double")
        counts = np.zeros(chance.shape)
        for row in uses.groupBy("piece", "language").agg(F.sum("uses").alias("uses")).collect():
            counts[row["piece"], row["language"]] = row["uses"]
        sent.destroy()
        # What no language uses keeps a share, so every text has a probability in all of them.
        general = counts.sum(axis=1) + 1e-3
        mixed = counts / np.maximum(counts.sum(axis=0), 1e-9) + settings.smoothing * (general / general.sum())[:, None]
        chance = mixed / mixed.sum(axis=0)
    total = sum(sizes.values())
    prior = np.array([math.log(sizes[lang] / total) for lang in languages])
    return Model(languages, pieces, chance, prior, settings)


def identify(docs: DataFrame, vocabulary: str | None = None, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row of ``docs``.

    The score is the probability of the predicted language given the whole text. It uses
    runs of letters in lower case; where languages tie, the first by name is taken.

    * A null text or one without a letter is ``und`` with score 0; so is every text when
      there is nothing to learn from. Rows with a null language or id teach nothing.
    * Repeated rows get the same result each; an empty table gives no rows. Only
      ``doc_id``, ``text`` and ``lang`` are read, so other columns cannot clash.
    """
    sent = shared(docs.sparkSession, train(docs, vocabulary, settings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(sent)
        for batch in batches:
            found = model.predict(batch.column(2).to_pylist())
            lang = pa.array([lang for lang, _ in found], pa.string())
            score = pa.array([score for _, score in found], pa.float64())
            arrays = [batch.column(0), batch.column(1), lang, score]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
