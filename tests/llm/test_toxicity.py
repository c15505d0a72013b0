import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from reachmart.llm import toxicity
from tests.llm.conftest import text


def plain_nearest(vectors, query, k, leave):
    scores = []
    for i, (terms, weights) in enumerate(vectors):
        own = dict(zip(terms.tolist(), weights.tolist()))
        cosine = sum(w * own.get(t, 0.0) for t, w in zip(query[0].tolist(), query[1].tolist()))
        if cosine > 1e-12 and i != leave:
            scores.append((-round(cosine, 12), i))
    return [(i, -c) for c, i in sorted(scores)[:k]]


@pytest.mark.parametrize("block", [1, 4, 64])
def test_index_is_exact(block):
    rng = np.random.default_rng(block)

    def vector():
        terms = np.unique(rng.integers(0, 30, rng.integers(1, 8)))
        weights = rng.integers(1, 4, len(terms)).astype(float)
        return terms, weights / np.linalg.norm(weights)

    vectors = [vector() for _ in range(150)] + [(np.zeros(0, np.int64), np.zeros(0))]
    index = toxicity.BlockMaxIndex(vectors, 30, block)
    for i in range(100):
        query = vector() if i % 2 else vectors[i]
        rows, near = index.nearest(*query, 5, i if i % 3 else -1)
        wanted = plain_nearest(vectors, query, 5, i if i % 3 else -1)
        assert rows.tolist() == [r for r, _ in wanted]
        assert near.tolist() == pytest.approx([c for _, c in wanted])


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        words = text(i, 60).split()
        if toxic:
            for _ in range(4):
                words[rng.randrange(60)] = rng.choice(["vilest", "rotten", "scummy", "wretch"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out(spark, make_docs, corpus, odd_rows):
    rows, labels = corpus
    extra = [(1000 + k, t) for k, (_, t, *_) in enumerate(odd_rows)] + [(None, "rotten vilest scummy")]
    odd_labels = [(1, None), (None, 1), (3, 7), (5000, 1), (0, 1), (0, 0)]
    frame = spark.createDataFrame(labels + odd_labels, "doc_id long, toxic int")
    docs = make_docs(rows + extra, clashing=True)
    got = toxicity.toxicity(docs, frame).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(labels)
    for r in got:
        fold = None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 5
        assert r.held_out == (fold == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id in truth:
            assert r.predicted == truth[r.doc_id]
    scores = {r.doc_id: r.score for r in got}
    assert scores[1002] < 0.1 and scores[None] > 0.5
    kept = toxicity.drop_toxic(docs, frame)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if not r.predicted)


def test_labels_of_the_held_out_fold_teach_nothing(spark, make_docs, corpus):
    rows, labels = corpus
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    docs = make_docs(rows)
    a = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    b = toxicity.toxicity(docs, spark.createDataFrame(turned, "doc_id long, toxic int")).collect()
    assert {(r.doc_id, r.score) for r in a} == {(r.doc_id, r.score) for r in b}


def test_nothing_to_learn(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.toxicity(make_docs([(1, "a")]), none).collect()] == [(0.0, 0)]
    assert toxicity.toxicity(make_docs([]), none).collect() == []


def plain_scores(docs, examples, settings):
    """Cosines with every example in turn, over all terms of both."""
    counts = {i: Counter(toxicity.words_of(t)) for i, (t, _) in examples.items()}

    def terms_of(words):
        found = Counter(words)
        for w, n in words.items():
            if len(w) > 5:
                found[w[:5] + "-"] += n
        return found

    counts = {i: terms_of(c) for i, c in counts.items()}
    n, positive = len(examples), sum(y for _, y in examples.values())
    a, b = (Counter(t for i, (_, y) in examples.items() if y == k for t in counts[i]) for k in (1, 0))
    weight = {}
    for t in a | b:
        if a[t] + b[t] >= 2:
            c, d = positive - a[t], n - positive - b[t]
            apart = math.sqrt((a[t] + b[t]) * (c + d) * positive * (n - positive))
            weight[t] = math.log(1 + n / (a[t] + b[t])) * ((abs(a[t] * d - b[t] * c) / apart if apart else 0) + settings.floor)

    def vector(c):
        v = {t: (1 + math.log(k)) * weight[t] for t, k in c.items() if t in weight}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    own = {i: vector(c) for i, c in counts.items()}
    found = {}
    for i, t in docs:
        q = vector(terms_of(Counter(toxicity.words_of(t))))
        near = sorted(((sum(x * v.get(k, 0) for k, x in q.items()), j) for j, v in own.items()), reverse=True)
        near = [(c, examples[j][1]) for c, j in near[: settings.neighbours] if c > 1e-12]
        share = positive / n
        yes, no = (sum(c for c, y in near if y == k) + settings.prior_weight * s for k, s in ((1, share), (0, 1 - share)))
        found[i] = math.log(yes / no) if near else None
    return found


def test_whole_query_against_plain_cosines(spark, make_docs, corpus):
    rows, labels = corpus
    settings = toxicity.Settings(block=16)
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(make_docs(rows), frame, settings)
    truth, texts = dict(labels), dict(rows)
    learned = {i: (texts[i], y) for i, y in truth.items() if zlib.crc32(str(i).encode()) % 5}
    assert sorted(model.ids) == sorted(learned) and set(model.labels) == {0.0, 1.0}
    wanted = plain_scores(rows, learned, settings)
    for r in toxicity.score(make_docs(rows), model).collect():
        odds = wanted[r.doc_id]
        assert r.score == pytest.approx(1 / (1 + math.exp(-(model.shift + model.slope * odds))), rel=1e-6)


@pytest.mark.parametrize("size, least", [("sf0.001", 0.9), ("sf0.01", 0.5), ("sf0.1", 0.9)])
def test_recall_on_the_given_labels(spark, size, least):
    """Every size learns from all its examples; the middle one has 6 held-out toxic documents."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{size}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    assert set(model.labels) == {0.0, 1.0} and 0.05 < model.labels.mean() < 0.3
    held = labels.filter("toxic is not null").select("doc_id", "toxic")
    rows = toxicity.score(docs.join(held, "doc_id"), model, "toxic").collect()
    rows = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    toxic, clean = ([r.predicted for r in rows if r.toxic == y] for y in (1, 0))
    assert np.mean(toxic) >= least and np.mean(clean) <= 0.02


def test_vectors_of_many_texts(corpus, monkeypatch):
    texts = [t for _, t in corpus[0][:50]] + [None, "", "unknown wordsunknown", "rotten " * 40, "ROTTEN Rottenness rottener"]
    terms = sorted({w for t in texts[:50] for w in toxicity.words_of(t)} | {"rotte-", "vilest", "scumm-"})
    weights = [1 + i % 7 / 7 for i in range(len(terms))]
    whole = toxicity.Vocabulary(terms, weights).vectors(texts)
    monkeypatch.setattr(toxicity.Vocabulary, "WORDS", 100)
    monkeypatch.setattr(toxicity._Words, "REMEMBERED", 9)
    parts = toxicity.Vocabulary(terms, weights).vectors(texts)
    for text_of, (numbers, values), part in zip(texts, whole, parts):
        counts = Counter(toxicity.words_of(text_of))
        for w, n in list(counts.items()):
            if len(w) > 5:
                counts[w[:5] + "-"] += n
        plain = {t: (1 + math.log(counts[t])) * w for t, w in zip(terms, weights) if counts[t]}
        norm = math.sqrt(sum(x * x for x in plain.values()))
        assert [terms[i] for i in numbers] == sorted(plain)
        assert values.tolist() == pytest.approx([plain[t] / norm for t in sorted(plain)])
        assert numbers.tolist() == part[0].tolist() and values.tolist() == part[1].tolist()


def test_lists_of_many_vectors_are_added_up_together(monkeypatch):
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(200):
        weights = rng.random(6) + 0.1
        vectors.append((np.sort(rng.choice(500, 6, replace=False)), weights / np.linalg.norm(weights)))
    index, calls = toxicity.BlockMaxIndex(vectors, 500, 256), []
    listed = toxicity.BlockMaxIndex._listed
    monkeypatch.setattr(toxicity.BlockMaxIndex, "_listed", lambda *args: calls.append(1) or listed(*args))
    got = index.nearest_of_each(vectors[:64], 5, list(range(64)))
    assert len(calls) <= 64 / 8
    for i, (rows, near) in enumerate(got):
        wanted = plain_nearest(vectors, vectors[i], 5, i)
        assert rows.tolist() == [r for r, _ in wanted] and near.tolist() == pytest.approx([c for _, c in wanted])
