import hashlib
import math
import random
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from reachmart.llm import fingerprints
from tests.llm.conftest import text


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def term(word):
    return signed(xxhash.xxh64_intdigest(word.encode(), 42))


def counts(t):
    return Counter(term(w) for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w)


def weights(texts):
    df = Counter(h for t in texts for h in counts(t))
    return {h: max(math.log2(len(texts) / n), 0.25) if n * 1024 >= len(texts) else 10.0 for h, n in df.items()}


def plain_fingerprint(t, known):
    votes, total = [0] * 128, 0
    for h, n in counts(t).items():
        weight = min(255, math.floor(known.get(h, 10.0) * 4 * (1 + math.log2(n)) + 0.5))
        other = xxhash.xxh64_intdigest(struct.pack("<i", 43), xxhash.xxh64_intdigest(struct.pack("<q", h), 42))
        total += weight
        for half, bits in enumerate((h, other)):
            for i in range(64):
                votes[half * 64 + i] += weight * (bits >> i & 1)
    return sum(1 << i for i, v in enumerate(votes) if 2 * v > total)


def plain(rows):
    """Every document after the other, the next one by its place in the sorted list."""
    texts = [(i, t or "") for i, t, *_ in rows]
    known = weights([t for _, t in texts])
    texts.sort(key=lambda r: (r[0] is None, r[0] or 0, term(r[1])))
    prints = [plain_fingerprint(t, known) for _, t in texts]
    found = []
    for at, (i, t) in enumerate(texts):
        after = (at + 1) % len(texts)
        cut = len(t) // 4
        edited = t[: len(t) - cut] + texts[after][1][:cut]
        e = plain_fingerprint(edited, known)
        alike = [1 - (prints[at] ^ x).bit_count() / 128 for x in (e, prints[after])]
        near = sum((prints[at] ^ p).bit_count() <= 4 for p in prints) - 1
        near = near if i is not None and i % 100 == 0 else None
        found.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{prints[at]:032x}", f"{e:032x}", *alike, near))
    return sorted(found, key=repr)


def ours(docs):
    return sorted((tuple(r) for r in fingerprints.edited_likeness(docs).collect()), key=repr)


def near_copies(n):
    """Texts of which some differ in one word of many."""
    rng = random.Random(5)
    base = [text(900 + k, 120).split() for k in range(3)]
    rows = []
    for i in range(n):
        words = list(base[i % 3])
        if i % 4:
            words[rng.randrange(120)] = f"new{rng.randrange(9)}"
        rows.append((i * 25, " ".join(words)))
    return rows


def test_brute_force(make_docs):
    rows = near_copies(60) + [(7 * i + 1, text(i, 5 + 3 * i)) for i in range(60)]
    got = ours(make_docs(rows, clashing=True))
    assert got == plain(rows)
    assert sum(r[-1] or 0 for r in got) > 20


def test_odd_rows(make_docs, odd_rows):
    odd = [(i, t if t is None or len(t) < 10_000 else t[:9_999]) for i, t, *_ in odd_rows]
    odd += [(100, "a"), (100, "a"), (100, "b c"), (200, None), (200, ""), (300, "ö" * 41 + " 日本 語")]
    assert ours(make_docs(odd)) == plain(odd)


def test_very_long_text(make_docs, odd_rows):
    assert ours(make_docs(odd_rows)) == plain(odd_rows)


@pytest.mark.parametrize("rows", [[], [(5, "one two three four")], [(5, "a b c d")] * 3])
def test_few_rows(make_docs, rows):
    assert ours(make_docs(rows)) == plain(rows)


def test_frequent_terms_beside_rare_ones(spark, make_docs, monkeypatch):
    """Sent to every task or joined by a shuffle, the weights are the same."""
    rows = [(i, text(i, 30)) for i in range(50)]
    monkeypatch.setattr(fingerprints, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(fingerprints, "RARE", 4)
    listed = fingerprints.frequent_terms(make_docs(rows)).collect()
    df = Counter(h for _, t in rows for h in counts(t))
    assert {r["term"]: r["bits"] for r in listed} == pytest.approx({h: math.log2(50 / n) for h, n in df.items() if n * 16 >= 50})
    got = fingerprints.fingerprints(make_docs(rows), ["doc_id"]).count()
    assert got == 50


@pytest.mark.parametrize("radius, kept", [(0, 1), (3, 1), (4, 2), (7, 3)])
def test_tables_find_all(spark, radius, kept):
    rng = random.Random(radius)
    prints = [rng.getrandbits(128) for _ in range(40)]
    for p in list(prints):
        for bits in range(radius + 3):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(128), bits)))
    prints = sorted(set(prints))
    halves = [(signed(p >> 64), signed(p & (1 << 64) - 1)) for p in prints]
    fps = spark.createDataFrame(halves, "high long, low long")
    asked = fps.select(F.col("high").alias("q_high"), F.col("low").alias("q_low")).filter("q_low % 3 <> 0")
    got = [(r.q_high, r.q_low, r.high, r.low, r.distance) for r in fingerprints.within(asked, fps, radius, kept).collect()]
    wanted = [
        (*halves[a], *halves[b], (x ^ y).bit_count())
        for a, x in enumerate(prints)
        for b, y in enumerate(prints)
        if (x ^ y).bit_count() <= radius and halves[a][1] % 3 != 0
    ]
    assert sorted(got) == sorted(wanted)


def test_no_python_worker(make_docs):
    plan = fingerprints.edited_likeness(make_docs([(1, "a b"), (2, "b c")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
