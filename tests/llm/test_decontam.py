import random

import numpy as np
import pytest

from reachmart.llm import decontam
from tests.llm.conftest import text

ITEMS = "item_id long, text string"


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence():
    rng = random.Random(0)
    for _ in range(200):
        a, b = ([rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randrange(1, 40))] for _ in "ab")
        assert decontam.common_subsequence(a, b) == plain_lcs(a, b)


def test_in_order():
    rng = random.Random(1)
    for _ in range(100):
        a, b = ([rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(0, 30))] for _ in "ab")
        places = decontam.in_order(a, b)
        assert len(places) == plain_lcs(a, b) == plain_lcs([a[i] for i in places], b)


def test_dimensions():
    kept = np.array([[0.9, 0.3, 0.2], [0.1, 0.9, 0.3]])
    assert [decontam.dimensions(kept, e) for e in (0.005, 0.5, 0.85, 0.99)] == [1, 2, 3, 3]
    assert decontam.dimensions(np.zeros((2, 0)), 0.5) == 0


def test_space_has_the_singular_vectors(spark):
    rng = np.random.default_rng(0)
    matrix = rng.random((40, 25)) * (rng.random((40, 25)) < 0.3)
    rows = [(np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for r in matrix]
    frame = spark.createDataFrame(rows, "terms array<long>, weights array<double>")
    space = decontam.latent_space(frame, 25, decontam.Settings(rank=5, extra=20, rounds=4))
    _, _, right = np.linalg.svd(matrix)
    assert np.abs(space @ space.T - right[:5].T @ right[:5]).max() < 1e-6


@pytest.fixture(scope="module")
def corpus():
    """Items hidden in other text: whole, reworded, cut short, and not at all."""
    rng = random.Random(1)
    items = [(i, text(1000 + i, 16 + 5 * (i % 9), 3_000)) for i in range(40)] + [(40, text(77, 200, 3_000)), (41, "")]
    rows, planted = [], {}
    for i in range(300):
        words = text(i, rng.randrange(5, 200), 3_000).split()
        kind = i % 4
        if kind:
            item = rng.randrange(41)
            own = items[item][1].rstrip(".").split()
            if kind == 2:
                own = [w if rng.random() > 0.2 else f"other{rng.randrange(99)}" for w in own]
            if kind == 3:
                own = own[: len(own) // 4]
            at = rng.randrange(len(words))
            words[at:at] = own
            planted[i] = (kind, item)
        rows.append((i, " ".join(words).upper() if i % 5 == 0 else " ".join(words) + ","))
    return items, rows, planted


def test_against_all_pairs(spark, make_docs, corpus):
    """What is found holds the item in order; nearly all planted items are found, and only they."""
    items, rows, planted = corpus
    benchmark = spark.createDataFrame(items + [(50, None)], ITEMS)
    docs = make_docs(rows, clashing=True)
    found = decontam.find_leaks(docs, benchmark)
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    texts, own = dict(rows), dict(items)
    for (i, j), r in got.items():
        item = decontam.words_of(own[j].encode())
        assert r.lcs_share <= plain_lcs(item, decontam.words_of(texts[i].encode())) / len(item) + 1e-9
        assert r.lcs_share >= 0.6 or (r.lcs_share >= 0.45 and r.answer_share >= 0.75)
    kinds = {kind: {(i, j) for i, (k, j) in planted.items() if k == kind} for kind in (1, 2, 3)}
    assert kinds[1] <= set(got)
    assert len(kinds[2] & set(got)) >= 0.9 * len(kinds[2])
    assert set(got) <= kinds[1] | kinds[2]
    # In several passes over the documents, with a space each, the same items are found.
    again = decontam.find_leaks(docs, benchmark, decontam.Settings(items=15)).collect()
    assert kinds[1] <= {(r.doc_id, r.item_id) for r in again} <= kinds[1] | kinds[2]
    kept = decontam.drop_leaks(docs, benchmark, decontam.Settings(items=15)).collect()
    assert {r.doc_id for r in kept} == {i for i, _ in rows} - {r.doc_id for r in again}


def test_common_words_are_no_match(spark, make_docs):
    story = (
        "the harbour was quiet in the morning and the name of the boat was painted in red on the side of it what the men "
        "of the city said is that the north wind is the worst of the year and that it was the end of the season in the town"
    )
    rows = [(i, " ".join(random.Random(i).sample(story.split(), 40) + story.split() * 3)) for i in range(30)]
    rows += [(i, text(i, 60, 3_000) + story) for i in range(30, 400)]
    rows += [(500, text(7, 50) + " What is the name of the city in the north? Oslo. " + text(8, 50))]
    items = [
        (1, "what is the name of the city in the north oslo"),
        (2, "The heatou ononat to to the anor shheed eronnten onnt thin ndonsh, of. Is the was that of."),
        (3, "is it that the name of the end was in the year of the"),
    ]
    got = decontam.find_leaks(make_docs(rows), spark.createDataFrame(items, ITEMS)).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(500, 1)]


def test_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, clashing=True)
    benchmark = spark.createDataFrame([(1, odd_rows[0][1]), (2, "one two"), (None, "Ö é 日本"), (3, "")], ITEMS)
    got = sorted(((r.doc_id, r.item_id) for r in decontam.find_leaks(docs, benchmark).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (2, 1), (None, 1), (7, 1), (9, 2), (8, None)], key=str)
    kept = decontam.drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i in (2, 3, 4, 5, None, 6, 10, 11))


def test_empty(spark, make_docs):
    none = spark.createDataFrame([], ITEMS)
    assert decontam.find_leaks(make_docs([(1, "a")]), none).collect() == []
    assert decontam.find_leaks(make_docs([]), spark.createDataFrame([(1, "a b")], ITEMS)).collect() == []


def zipf(rng, n, size=20_000):
    return [f"z{int(size ** rng.random())}" for _ in range(n)]


@pytest.mark.parametrize("n", [40, 3_000, 50_000])
def test_recall_does_not_fall_with_the_benchmark(spark, make_docs, n):
    """Thousands of items need more dimensions than the latent space has."""
    rng = random.Random(5)
    items = [(i, " ".join(zipf(rng, rng.randrange(16, 60)))) for i in range(n)]
    rows, whole, reworded, clean = [], set(), set(), set()
    for i in range(300):
        item, words = 7 * i % n, zipf(rng, rng.randrange(20, 200))
        if i % 3:
            own = items[item][1].split()
            if i % 3 == 1:
                own = [w if rng.random() > 0.2 else f"other{rng.randrange(99)}" for w in own]
            at = rng.randrange(len(words))
            words[at:at] = own
            if plain_lcs(items[item][1].split(), own) >= 0.6 * len(own):
                (reworded if i % 3 == 1 else whole).add((i, item))
        else:
            clean.add(i)
        rows.append((i, " ".join(words)))
    found = decontam.find_leaks(make_docs(rows), spark.createDataFrame(items, ITEMS)).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(whole) == 100 and len(reworded) >= 90
    assert len(whole & got) >= 0.95 * len(whole)
    assert len(reworded & got) >= 0.9 * len(reworded)
    assert len({i for i, _ in got} & clean) <= 2


def test_passages_of_long_items(spark, tmp_path):
    from reachmart.llm import queries

    rng = random.Random(9)
    item = zipf(rng, 200)
    rows = [(i, " ".join(zipf(rng, 90) + item[at : at + 64] + zipf(rng, 90))) for i, at in enumerate((0, 17, 80, 136))]
    rows.append((9, " ".join(zipf(rng, 200))))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(r.doc_id for r in queries.op10(spark, str(tmp_path)).collect()) == [0, 1, 2, 3]
