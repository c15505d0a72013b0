import math
import random

import numpy as np
import pytest

from reachmart.llm import language


@pytest.fixture(scope="module")
def pieces():
    return language.read_pieces(language.default_vocabulary(), 8)


def segmentations(word, known, chance):
    """Sum over all ways to cut a word, written out."""
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, min(8, len(word)) + 1):
        number = known.get(word[:n], 0)
        if number or n == 1:
            total += chance[number] * segmentations(word[n:], known, chance)
    return total


def test_forward_sums_all_segmentations(pieces):
    finder = language.Pieces(pieces, 8)
    rng = np.random.default_rng(0)
    chance = rng.random((finder.size, 3))
    chance /= chance.sum(axis=0)
    known = {p: i + 1 for i, p in enumerate(pieces)}
    words = ["the", "straße", "日本語", "éa", "x", "internation", "ñandú"]
    got = language.log_likelihoods(words, finder, chance)
    for i, word in enumerate(words):
        for g in range(3):
            assert got[i, g] == pytest.approx(math.log(segmentations("▁" + word, known, chance[:, g])))
    long = language.log_likelihoods(["ab" * 5_000], finder, chance)
    assert np.isfinite(long).all()


def test_expected_counts_cover_the_letters(pieces):
    finder = language.Pieces(pieces, 8)
    words = ["the", "thing", "straße", "日本語"]
    times, lang = np.array([3.0, 1, 2, 5]), np.array([0, 1, 0, 1])
    chance = np.full((finder.size, 2), 1 / finder.size)
    counts = language.expected_counts(words, times, lang, finder, chance)
    lengths = np.array([1] + [len(p) for p in pieces])
    wanted = [sum(t * (len(w) + 1) for w, t, g in zip(words, times, lang) if g == h) for h in (0, 1)]
    assert (counts * lengths[:, None]).sum(axis=0) == pytest.approx(wanted)


SYLLABLES = {"aa": "ka lo mi ne".split(), "bb": "stra ung ich ber".split(), "cc": "eau oux éte que".split()}


def prose(lang, seed, n=30):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def test_held_out_accuracy(make_docs, odd_rows):
    rows = [(i, prose(lang, i), lang) for i, lang in enumerate(list(SYLLABLES) * 40)]
    odd = [(1000 + k, t, None) for k, (_, t, *_) in enumerate(odd_rows)] + [(2000, "12 34 !"), (None, prose("aa", 5), "bb")]
    got = {r.doc_id: r for r in language.identify(make_docs(rows + odd, clashing=True)).collect()}
    assert len(got) == len(rows + odd)
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert any(got[i].held_out for i, *_ in rows)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {got[i].lang_pred for i in (1004, 1005, 1006, 1008, 2000)} == {"und"}
    assert got[None].lang_pred == "aa" and not got[None].held_out


def test_nothing_to_learn(make_docs):
    assert [r.lang_pred for r in language.identify(make_docs([(1, "word", None)])).collect()] == ["und"]
    assert language.identify(make_docs([])).collect() == []
