import tracemalloc
from itertools import combinations

import numpy as np
import pytest
import xxhash

from reachmart.llm import simhash
from reachmart.llm.components import connected_components
from tests.llm.conftest import text


def plain_fingerprint(value, k=4):
    words = (value or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius=4):
    """(id, fingerprint, least reachable id) per row, by comparing all pairs."""
    fps = [plain_fingerprint(row[1]) for row in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for row, g in zip(rows, group):
        if row[0] is not None:
            least[g] = min(least.get(g, row[0]), row[0])
    return sorted(((r[0], f"{f:016x}", least.get(g)) for r, f, g in zip(rows, fps, group)), key=str)


def found(frame):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in frame.collect()), key=str)


@pytest.mark.parametrize("n,radius", [(300, 4), (70, 3), (64, 0), (130, 8), (1, 4)])
def test_bit_planes(n, radius):
    rng = np.random.default_rng(n)
    fps = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for i in range(1, n, 2):
        for bit in rng.integers(0, 64, rng.integers(0, 9)):
            fps[i] = fps[i - 1] ^ np.uint64(1 << int(bit))
    distance = np.bitwise_count(fps[: n // 2 + 1, None] ^ fps[None, :])
    assert (simhash.near(fps[: n // 2 + 1], fps, radius) == (distance <= radius)).all()


def test_groups_of_odd_rows(make_docs, odd_rows):
    rows = [r for r in odd_rows if len(r[1] or "") < 10_000]
    assert found(simhash.simhash_groups(make_docs(rows, clashing=True))) == plain_groups(rows)


def test_long_text():
    long = " ".join(f"a{i}" for i in range(50_000))
    words = long.encode().split()
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(len(words) - 3)], np.uint64)
    wanted = sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes))
    assert simhash.fingerprint(long.encode()) == wanted


def test_empty(make_docs):
    assert found(simhash.simhash_groups(make_docs([]))) == []


@pytest.mark.parametrize("group", [8, 2048])
def test_large_groups_are_split(spark, group):
    """Chains and a dense ball, with parts far below their size, against all pairs."""
    rng = np.random.default_rng(3)
    center = int(rng.integers(0, 1 << 62))
    fps = {center}
    for _ in range(150):
        fps.add(center ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 7)), replace=False)))
    at = int(rng.integers(0, 1 << 62))
    for _ in range(40):
        at ^= sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        fps.add(at)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = connected_components(simhash._links(frame, 4, group))
    got = {r.node: r.root for r in roots.collect()}
    own = sorted(fps)
    parent = {f: f for f in own}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(own):
        for b in own[:i]:
            if (a ^ b).bit_count() <= 4 and find(a) != find(b):
                parent[find(a)] = find(b)
    pairs = [(got.get(s, s), find(f)) for f, s in zip(fps, signed)]
    assert len(set(pairs)) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components(spark):
    links = [(5, 4), (4, 3), (9, 9), (None, 1), (8, 7), (3, 1), (7, 20), (1, 2)]
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == {(2, 1), (3, 1), (4, 1), (5, 1), (8, 7), (20, 7)}


def test_one_stays(make_docs, odd_rows):
    docs = make_docs(odd_rows, clashing=True)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 2, 3, 6, 7, 8, 9, 11]
    assert sum(r.doc_id is None for r in rows) == 2
    assert [r.text for r in rows if r.doc_id == 2] == [min(text(1, 80), text(2, 70))]


def test_groups_headed_by_a_repeated_id(spark, make_docs):
    a, b, c = text(21, 90), text(22, 90), text(23, 90)
    rows = [(1, a), (2, a), (2, b), (3, b), (4, c), (4, a), (5, c), (4, c), (6, None), (6, "")]
    kept = simhash.one_per_group(make_docs(rows, clashing=True)).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(1, a), (2, b), (4, c), (6, "")]
    # Two groups with the same least id keep a row each.
    kept = simhash.one_per_group(make_docs([(1, a), (1, b), (2, a), (3, b)])).collect()
    assert sorted(r.text for r in kept) == sorted([a, b])
    assert {r.doc_id for r in kept} == {1}


def test_memory_of_a_group_of_near_copies():
    """All linked to each other, and a path over several others."""
    fps = np.array([sum(1 << b for b in pair) for pair in combinations(range(64), 2)], np.uint64)
    fps = np.r_[fps, [np.uint64((1 << 4 * i) - 1) for i in range(1, 15)]]
    tracemalloc.start()
    root = simhash._roots(fps, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert root[:2016].tolist() == [0] * 2016 and root[2016:].tolist() == [0] * 14
    assert peak < 64e6
