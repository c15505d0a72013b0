import hashlib
import random

from reachmart.llm import windows
from tests.llm.conftest import text


def plain(rows, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    for i, words in split:
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    result = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        result.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=str)


def found(frame):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect()), key=str)


def test_odd_rows(make_docs, odd_rows):
    rows = [r for r in odd_rows if len(r[1] or "") < 10_000] + [(12, " ".join(["la"] * 300)), (13, " ".join(["la"] * 70))]
    assert found(windows.remove_repeats(make_docs(rows, clashing=True))) == plain(rows, 50)


def test_long_and_empty(make_docs, odd_rows):
    rows = [r for r in odd_rows if len(r[1] or "") > 10_000]
    assert found(windows.remove_repeats(make_docs(rows))) == plain(rows, 50)
    assert found(windows.remove_repeats(make_docs([]))) == []


def test_random_passages(make_docs):
    rng = random.Random(5)
    passages = [text(100 + i, rng.randrange(5, 40)).split() for i in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(1, 6)):
            words += rng.choice(passages) if rng.random() < 0.6 else text(rng.random(), rng.randrange(1, 30), 5).split()
        rows.append((rng.randrange(40), " ".join(words)))
    for window, anchor in ((10, 4), (7, 7)):
        assert found(windows.remove_repeats(make_docs(rows), window, anchor)) == plain(rows, window)


def test_kept_text(make_docs):
    shared = text(1, 60)
    rows = [(1, shared), (2, "before " + shared + " after")]
    kept = {r.doc_id: r.kept_text for r in windows.remove_repeats(make_docs(rows)).collect()}
    assert kept[2] == "before after"
