"""Token boundaries that two tokenizers share, found by galloping intersection."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from reachmart.llm.common import join_by, stored

_BATCH = 1 << 20  # characters that are encoded at a time
BROADCAST_ROWS = 1_000_000  # rows of the table of id pairs that are sent to every task
_IDS = 1 << 32
# Characters whose class (letter, number, blank, other) every version of Unicode agrees on.
_SETTLED = regex.compile(r"[\t\n\r -~¡-¬®-ʯͰ-ͷͺ-ͿΑ-ΡΣ-ϿЀ-ҁҊ-ԧ‐-‧‰-⁞₠-₿℀-⅏←-⇿─-▟]*+")
_RUN = regex.compile(r"\S{200}|\s{200}")
# Where byte-level tokenizers cut a text before they merge bytes; fixed.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file by its name."""
    import public_tokenizers

    return public_tokenizers.path(name)


# --- tokenizers ---------------------------------------------------------------------------


def byte_of_letter() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for
    themselves, the others follow from 256 in ascending order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    others = (b for b in range(256) if b not in printable)
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class ByteLevel:
    """A byte-level tokenizer's file; texts are encoded behind a space.

    Where its merges are numbered in the order of the vocabulary, as in the public files, a
    merge by rank gives the same tokens in a fraction of the time. Texts with characters that
    libraries might classify differently, or with very long words, are left to the tokenizer.
    """

    path: str

    def __post_init__(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_of_letter()
        entries = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.bytes[number] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()

        step = self.tokenizer.pre_tokenizer
        usual = type(step).__name__ == "ByteLevel" and step.use_regex and not step.add_prefix_space
        merges = json.loads(self.tokenizer.to_str())["model"]["merges"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        in_order = all(entries.get("".join(pair)) == 256 + i for i, pair in enumerate(pairs))
        self.ranks = None
        if usual and in_order and self.tokenizer.normalizer is None:
            ranks = {b: i for i, b in enumerate(self.bytes) if i < 256 + len(merges)}
            self.ranks = tiktoken.Encoding("file", pat_str=_WORDS.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        texts = [" " + t for t in texts]
        plain = [self.ranks is not None and _SETTLED.fullmatch(t) is not None and not _RUN.search(t) for t in texts]
        rest = [t for t, p in zip(texts, plain) if not p]
        others = iter(self.tokenizer.encode_batch(rest, add_special_tokens=False))
        return [self.ranks.encode_ordinary(t) if p else next(others).ids for t, p in zip(texts, plain)]


@dataclass
class Pieces:
    """A sentence-piece model, which puts a space before a text itself."""

    path: str

    def __post_init__(self):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=self.path)
        self.bytes = [self._bytes(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())]

    @staticmethod
    def _bytes(piece: str) -> bytes:
        if re.fullmatch(r"<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=4)
def _loaded(path: str):
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


# --- galloping intersection ---------------------------------------------------------------


def gallop(driver: np.ndarray, longer: np.ndarray, first: np.ndarray, end: np.ndarray, hint: np.ndarray) -> np.ndarray:
    """For each value of ``driver`` the place of the first value of ``longer`` not below it,
    between its ``first`` and ``end``.

    Steps of doubling length from ``hint`` go up or down until the value is passed; then
    the last step is halved until one place is left. All values go at once, but each only
    as far as its own place is from its hint.
    """
    low, high = hint.copy(), hint.copy()  # the place is above low - 1 and at most high
    step = np.ones(len(driver), np.int64)
    below = (hint < end) & (longer[np.minimum(hint, len(longer) - 1)] < driver) if len(longer) else np.zeros(len(driver), bool)
    up, down = np.flatnonzero(below), np.flatnonzero(~below)
    while len(up):
        low[up] = high[up] + 1
        high[up] = np.minimum(high[up] + step[up], end[up])
        step[up] *= 2
        going = high[up] < end[up]
        going[going] = longer[high[up[going]]] < driver[up[going]]
        up = up[going]
    while len(down):
        at = np.maximum(low[down] - step[down], first[down])
        step[down] *= 2
        going = at < low[down]
        passed = going.copy()
        passed[going] = longer[at[going]] < driver[down[going]]
        high[down[going & ~passed]] = at[going & ~passed]
        low[down[passed]] = at[passed] + 1
        low[down[~passed]] = at[~passed]
        down = down[going & ~passed]
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        smaller = longer[middle] < driver[open_]
        low[open_[smaller]] = middle[smaller] + 1
        high[open_[~smaller]] = middle[~smaller]
        open_ = open_[low[open_] < high[open_]]
    return low


@dataclass
class Ends:
    """Where the tokens of some texts end, in one row of bytes for all; ``start`` has the
    number of tokens before each text."""

    ids: np.ndarray
    ends: np.ndarray
    start: np.ndarray
    text: np.ndarray = field(init=False)

    def __post_init__(self):
        self.text = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))

    @classmethod
    def of(cls, ids: list[list[int]], sizes: np.ndarray) -> Ends:
        start = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)
        flat = np.fromiter((n for i in ids for n in i), np.int64, start[-1])
        return cls(flat, np.cumsum(sizes[flat]), start)


def common_ends(a: Ends, b: Ends) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the tokens that end at the same byte of the same text.

    In each text the tokenizer with fewer tokens drives the search in the other's ends.
    """
    found = []
    a_drives = np.diff(a.start) <= np.diff(b.start)
    for driver, other, drives in ((a, b, a_drives), (b, a, ~a_drives)):
        at = np.flatnonzero(drives[driver.text])
        text = driver.text[at]
        first, end = other.start[text], other.start[text + 1]
        # The place at the same share of the text's tokens, from where the search gallops.
        share = (at - driver.start[text]) * (end - first) // np.maximum(np.diff(driver.start)[text], 1)
        place = gallop(driver.ends[at], other.ends, first, end, first + share)
        same = place < end
        same[same] = other.ends[place[same]] == driver.ends[at[same]]
        found.append((at[same], place[same]))
    (a1, b1), (b2, a2) = found
    in_a = np.concatenate([a1, a2])
    order = np.argsort(in_a, kind="stable")
    return in_a[order], np.concatenate([b1, b2])[order]


class Writer:
    """Writes the groups of a text as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, a_size: int, b_size: int):
        numbers = [str(i) for i in range(max(a_size, b_size))]
        self.tails = (0, a_size, 2 * a_size, 2 * a_size + b_size)
        self.parts = [n + tail for size, tails in ((a_size, ",|"), (b_size, ",;")) for tail in tails for n in numbers[:size]]

    def codes(self, a: Ends, b: Ends, last_a: np.ndarray, last_b: np.ndarray) -> np.ndarray:
        """Places in ``parts`` for all tokens, group after group."""
        closes_a, closes_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
        closes_a[last_a], closes_b[last_b] = True, True
        group_a, group_b = (np.cumsum(c) - c for c in (closes_a, closes_b))
        before = np.concatenate([[0], last_b + 1])
        codes = np.empty(len(a.ids) + len(b.ids), np.int64)
        codes[np.arange(len(a.ids)) + before[group_a]] = a.ids + np.where(closes_a, self.tails[1], self.tails[0])
        codes[np.arange(len(b.ids)) + last_a[group_b] + 1] = b.ids + np.where(closes_b, self.tails[3], self.tails[2])
        return codes

    def digests(self, a: Ends, b: Ends, last_a: np.ndarray, last_b: np.ndarray) -> list[str]:
        codes = self.codes(a, b, last_a, last_b).tolist()
        of_text = (a.start + b.start).tolist()
        part = self.parts.__getitem__
        texts = ("".join(map(part, codes[s:e]))[:-1] for s, e in zip(of_text, of_text[1:]))
        return [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]


def _decoded(text: bytes | None) -> str:
    """The text; the empty one if it is null or no valid UTF-8, which no tokens spell."""
    try:
        return (text or b"").decode()
    except UnicodeDecodeError:
        return ""


def encode_both(first, second, texts: list[str]) -> tuple[Ends, Ends]:
    """The tokens of both; none for texts that either does not spell out."""
    ids = []
    for tokenizer in (first, second):
        made = tokenizer.encode(texts)
        spelled = tokenizer.bytes.__getitem__
        ids.append([i if t and b"".join(map(spelled, i)) == b" " + t.encode() else [] for i, t in zip(made, texts)])
    whole = [bool(x and y) for x, y in zip(*ids)]
    sizes = [np.array([len(b) for b in t.bytes], np.int64) for t in (first, second)]
    a, b = ([i if w else [] for i, w in zip(side, whole)] for side in ids)
    return Ends.of(a, sizes[0]), Ends.of(b, sizes[1])


# --- Spark jobs ---------------------------------------------------------------------------

_COLUMNS = "n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, counts array<int>"


def _batches(texts: list[str]) -> Iterator[list[str]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > _BATCH:
            yield texts[start:i]
            start, size = i, 0
        size += len(t)
    yield texts[start:]


def aligned(rows: DataFrame, first: str, second: str) -> DataFrame:
    """``doc_id`` of each row with its token counts, the digest of its groups, and its pairs of
    linked ids (``a`` times 2 ** 32 plus ``b``) with how often each occurs."""
    names = ["doc_id", *[c.split()[0] for c in _COLUMNS.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = _loaded(first), _loaded(second)
        writer = Writer(len(a_side.bytes), len(b_side.bytes))
        for batch in batches:
            texts, done = [_decoded(t.as_py()) for t in batch.column(1)], 0
            for some in _batches(texts):
                if not some:
                    continue
                a, b = encode_both(a_side, b_side, some)
                last_a, last_b = common_ends(a, b)
                groups = np.bincount(a.text[last_a], minlength=len(some))
                a_size, b_size = len(a_side.bytes), len(b_side.bytes)
                links = (a.text[last_a] * a_size + a.ids[last_a]) * b_size + b.ids[last_b]
                links, counts = np.unique(links, return_counts=True)
                of_text, pairs = np.divmod(links, a_size * b_size)
                pairs = pairs // b_size * _IDS + pairs % b_size
                ends = np.concatenate([[0], np.cumsum(np.bincount(of_text, minlength=len(some)))]).astype(np.int32)
                values = [
                    batch.column(0).slice(done, len(some)),
                    pa.array(np.diff(a.start)),
                    pa.array(np.diff(b.start)),
                    pa.array(groups.astype(np.int64)),
                    pa.array(writer.digests(a, b, last_a, last_b), pa.string()),
                    pa.ListArray.from_arrays(ends, pa.array(pairs, pa.int64())),
                    pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(values, names=names)
                done += len(some)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_COLUMNS}")


def align(
    docs: DataFrame, first: str | None = None, second: str | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """How two tokenizers' tokens of each text line up.

    ``first`` is the file of a byte-level tokenizer, which encodes a space and the text;
    ``second`` a sentence-piece model, which adds that space. Bytes at which tokens of both
    end cut the tokens into groups, and two tokens that end there together are linked.
    Columns: ``doc_id``, ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best`` (links
    of an id pair that is linked in the corpus as often as any pair with its second id),
    ``count_sum`` (each link's corpus-wide count, added up), ``groups_sha256``.

    Texts are encoded once. A text's links are added up before they are counted over the
    corpus; the counted pairs are sent to every task up to a fixed number of them, and
    joined by a shuffle that splits frequent pairs beyond it.

    * Texts that are null, empty, no valid UTF-8, or not spelled out by the tokens of both
      have no tokens: zeros and an empty digest. Special tokens' names are ordinary text.
    * Every row keeps a row of its own, whatever its id or text; a null id stays null.
    * A text is encoded whole, however long, in some 400 times its size of memory. No rows give no rows. Only the two named
      columns are read, so others cannot clash.
    """
    first, second = first or vocabulary("byte_bpe_50k.json"), second or vocabulary("piece_bpe_32k.model")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    made = stored(aligned(rows, first, second).withColumn("uid", F.monotonically_increasing_id()), "aligned")
    links = made.select("uid", F.explode(F.arrays_zip("pairs", "counts")).alias("l"))
    links = links.select("uid", F.col("l.pairs").alias("pair"), F.col("l.counts").cast("long").alias("n"))
    counted = stored(links.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    second_id = F.col("pair").bitwiseAND(F.lit(_IDS - 1))
    highest = counted.groupBy(second_id.alias("b")).agg(F.max("count").alias("most"))
    joined = counted.withColumn("b", second_id).join(highest, "b")
    pairs = stored(joined.select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "counted")
    if pairs.count() <= BROADCAST_ROWS:
        found = links.join(F.broadcast(pairs), "pair")
    else:
        found = join_by(links, pairs, "pair")
    summed = found.groupBy("uid").agg(
        F.sum("n").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    return (
        made.drop("pairs", "counts")
        .join(summed, "uid", "left")
        .na.fill(0, ["n_links", "n_best", "count_sum"])
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    )
