import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from reachmart.llm import alignment
from tests.llm.conftest import text

FIRST, SECOND = alignment.vocabulary("byte_bpe_50k.json"), alignment.vocabulary("piece_bpe_32k.model")
STRANGE = [
    "<|endoftext|> and </s> <s> <unk> <0x41>", "▁ under ▁▁", "日本語のテキスト、とても長い。", "naïve Ünïcödé é ﬁ Ⅷ ½", "😀👩‍👩‍👧 ​﻿",
    " leading", "trailing ", "  two  spaces\t\ttabs\n\n\nlines\r\n", "\x00\x01\x7f", "a", " ", "\n", "Ġ Ċ Ā", "1234567890 3.14 don't", "x" * 3000,
]


def spelled_first():
    tokenizer = Tokenizer.from_file(FIRST)
    tokenizer.encode_special_tokens = True
    decoder = {}
    for b in range(256):  # what the library itself writes for a byte
        if b < 128:
            decoder[pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(b))[0][0]] = bytes([b])
    return tokenizer, alignment.byte_of_letter(), decoder


def plain(rows):
    """Ends as sets of bytes, groups by walking over both lists, counts in one table."""
    first, letters, _ = spelled_first()
    second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    made, total = [], Counter()
    for i, t in rows:
        t = t or ""
        a = first.encode(" " + t, add_special_tokens=False).ids
        b = second.encode(t)
        a_bytes = [bytes(letters[c] for c in first.id_to_token(x)) if x != 50256 else b"<|endoftext|>" for x in a]
        pieces = [second.id_to_piece(x) for x in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces]
        if not t or any(b"".join(s) != (" " + t).encode() for s in (a_bytes, b_bytes)):
            a, b, a_bytes, b_bytes = [], [], [], []
        ends = [np.cumsum([len(x) for x in s]).astype(int).tolist() for s in (a_bytes, b_bytes)]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, before = [], 0
        for end in common:
            sides = [[x for x, e in zip(ids, es) if before < e <= end] for ids, es in ((a, ends[0]), (b, ends[1]))]
            groups.append("|".join(",".join(map(str, s)) for s in sides))
            before = end
        links = [(x, y) for x, e in zip(a, ends[0]) if e in set(common) for y, f in zip(b, ends[1]) if f == e]
        total.update(links)
        made.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = defaultdict(int)
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    return sorted(
        [
            (i, na, nb, g, len(links), sum(total[p] == most[p[1]] for p in links), sum(total[p] for p in links), sha)
            for i, na, nb, g, links, sha in made
        ],
        key=repr,
    )


def ours(docs):
    return sorted((tuple(r) for r in alignment.align(docs).collect()), key=repr)


def short(t):
    return t if t is None or len(t) < 2000 else t[:2000]


def test_brute_force(make_docs, odd_rows):
    rows = [(i, short(t)) for i, t, *_ in odd_rows] + list(enumerate(STRANGE, 100)) + [(7, "Anna a lancé le projet à Köln, größer!")] * 3
    rows = [(i, t if t != "x" * 3000 else "x" * 300) for i, t in rows]
    got = ours(make_docs(rows, clashing=True))
    assert got == plain(rows)
    assert sum(r[1] == 0 for r in got) < 10


def test_pairs_joined_by_a_shuffle(make_docs, monkeypatch):
    rows = list(enumerate(STRANGE[:10])) * 2
    monkeypatch.setattr(alignment, "BROADCAST_ROWS", -1)
    assert ours(make_docs(rows)) == plain([(i, short(t)) for i, t in rows])


def test_long_texts_and_batches(make_docs, odd_rows, monkeypatch):
    rows = [(i, t) for i, t, *_ in odd_rows] + list(enumerate(STRANGE))
    docs = make_docs(rows)
    whole = ours(docs)
    assert len(whole) == len(rows) and max(r[1] for r in whole) > 80_000
    monkeypatch.setattr(alignment, "_BATCH", 10)
    assert ours(docs.coalesce(1)) == whole


def test_empty_and_invalid(spark, make_docs):
    assert ours(make_docs([])) == []
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.lit(b"\xff\xfe a").cast("binary").alias("text"))
    assert ours(docs) == [(0, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("seed", range(40))
def test_gallop(seed):
    rng = random.Random(seed)
    lists = [sorted(rng.sample(range(300), rng.randrange(0, 60))) for _ in range(rng.randrange(1, 6))]
    longer = np.array([x for part in lists for x in part], np.int64)
    edges = np.cumsum([0, *map(len, lists)])
    driver, first, end, hint, wanted = [], [], [], [], []
    for part, a, b in zip(lists, edges, edges[1:]):
        for value in rng.sample(range(-5, 310), 20):
            driver.append(value)
            first.append(a)
            end.append(b)
            hint.append(rng.randint(a, b))
            wanted.append(a + int(np.searchsorted(part, value)))
    arrays = [np.array(x, np.int64) for x in (first, end, hint)]
    assert alignment.gallop(np.array(driver, np.int64), longer, *arrays).tolist() == wanted


def test_letters_of_bytes():
    _, letters, decoder = spelled_first()
    assert len(letters) == 256 and sorted(letters.values()) == list(range(256))
    assert all(letters[c] == b[0] for c, b in decoder.items() if len(c) == 1)


def test_words_are_those_of_the_tokenizer():
    """Every settled character, next to letters, numbers, blanks and marks."""
    side = alignment.ByteLevel(FIRST)
    letter = {b: c for c, b in alignment.byte_of_letter().items()}
    cut = side.tokenizer.pre_tokenizer.pre_tokenize_str
    settled = [chr(i) for i in range(0x3000) if alignment._SETTLED.fullmatch(chr(i))]
    assert len(settled) > 1400 and not alignment._SETTLED.fullmatch("a\u00a0") and not alignment._SETTLED.fullmatch("日")
    for c in settled:
        t = f" a{c}a1{c}1 {c} {c}.{c}\n{c}'s'{c}  {c}{c}"
        own = ["".join(letter[b] for b in w.encode()) for w in alignment._WORDS.findall(t)]
        assert own == [w for w, _ in cut(t)], c


def test_merges_by_rank():
    side = alignment.ByteLevel(FIRST)
    rng = random.Random(3)
    signs = "aab  \n\t.,'!?’é1\u00a0" + "".join(STRANGE)[:300]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(80))) for _ in range(400)] + [" don't we'll", "''s  ", "x" * 500, " " * 500]
    texts += [text(i, 40) + " Größe déjà señor lärm’s" for i in range(50)]
    wanted = [side.tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert side.encode(texts) == wanted
    assert side.ranks is not None and any(alignment._SETTLED.fullmatch(t) for t in texts)
    side.ranks = None
    assert side.encode(texts) == wanted
