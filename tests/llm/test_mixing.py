import random
from collections import defaultdict

import pytest

from reachmart.llm import common, mixing


def plain_rake(cells, power, sweeps):
    total = sum(cells.values())
    share = {k: n / total for k, n in cells.items()}
    dims = len(next(iter(cells)))
    targets = []
    for d in range(dims):
        sums = defaultdict(float)
        for k, n in cells.items():
            sums[k[d]] += n
        whole = sum((n / total) ** power for n in sums.values())
        targets.append({v: (n / total) ** power / whole for v, n in sums.items()})
    for _ in range(sweeps):
        for d in range(dims):
            sums = defaultdict(float)
            for k, s in share.items():
                sums[k[d]] += s
            share = {k: s * targets[d][k[d]] / sums[k[d]] for k, s in share.items()}
    return share, targets


def test_rake_meets_the_margins(spark):
    rng = random.Random(1)
    cells = {(f"s{a}", f"l{b}", f"t{c}"): rng.randrange(1, 1000) for a in range(6) for b in range(3) for c in range(2) if a + b != 4}
    frame = spark.createDataFrame([(*k, n) for k, n in cells.items()], "a string, b string, c string, tokens long")
    got = {(r.a, r.b, r.c): r.share for r in mixing.rake(frame, ["a", "b", "c"], 0.5, 12).collect()}
    wanted, targets = plain_rake(cells, 0.5, 12)
    assert got == {k: pytest.approx(s) for k, s in wanted.items()}
    for d in range(3):
        for value, target in targets[d].items():
            assert sum(s for k, s in got.items() if k[d] == value) == pytest.approx(target, abs=1e-3)


@pytest.mark.parametrize("budget", [0.1, 0.6, 1.0])
def test_budget_with_full_cells(spark, budget):
    rows = [("a", 1000, 0.5), ("b", 100, 0.4), ("c", 50, 0.1), ("d", 0, 0.0)]
    frame = spark.createDataFrame(rows, "k string, tokens long, share double")
    got = mixing.probabilities(frame, budget).collect()
    assert all(0 <= r.probability <= 1 for r in got)
    assert sum(r.probability * r.tokens for r in got) == pytest.approx(budget * 1150)


def test_full_cells_are_held_while_the_others_are_raked(spark):
    rng = random.Random(5)
    cells = {(f"s{a}", f"l{b}", f"t{c}"): rng.randrange(50, 400) * 5**a for a in range(5) for b in range(3) for c in range(3)}
    cells["s0", "l0", "t0"] = 3
    frame = spark.createDataFrame([(*k, n) for k, n in cells.items()], "a string, b string, c string, tokens long")
    dims = ["a", "b", "c"]
    for budget, power in ((0.3, 0.8), (0.6, 0.9)):
        chances = mixing.probabilities(mixing.rake(frame, dims, power, 30, budget), budget)
        got = chances.collect()
        total = sum(cells.values())
        assert sum(r.probability * r.tokens for r in got) == pytest.approx(budget * total)
        assert any(r.probability > 0.999 for r in got) and all(0 <= r.probability <= 1 for r in got)
        share, targets = plain_rake(cells, power, 30)
        assert {(r.a, r.b, r.c): r.weight * r.tokens for r in got} == {k: pytest.approx(budget * total * s) for k, s in share.items()}
        told = {(r.dim, r.category): r for r in mixing.margins(chances, dims, budget, power).collect()}
        for d, name in enumerate(dims):
            for value, target in targets[d].items():
                told_now = told[name, value]
                of = [r for r in got if r[name] == value]
                reached = sum(r.probability * r.tokens for r in of) / (budget * total)
                assert (told_now.target, told_now.reached) == (pytest.approx(target), pytest.approx(reached))
                assert told_now.scarce == (sum(r.tokens for r in of) < target * budget * total)
                if not any(t.scarce for t in told.values()):
                    assert reached == pytest.approx(target, rel=0.01), (budget, value)


def test_few_cells_are_raked_without_shuffle_and_broadcast(spark, monkeypatch):
    cells = {(f"s{a}", f"l{b}"): 10 * a + b + 1 for a in range(5) for b in range(4)}
    frame = spark.createDataFrame([(*k, n) for k, n in cells.items()], "a string, b string, tokens long")
    plans = []

    def spied(rows, purpose):
        plans.append((purpose, rows._jdf.queryExecution().executedPlan().toString()))
        return common.stored(rows, purpose)

    monkeypatch.setattr(mixing, "stored", spied)
    for most, shuffled in ((len(cells), False), (7, True)):
        monkeypatch.setattr(mixing, "_CELLS", most)
        plans.clear()
        raked = mixing.rake(frame, ["a", "b"], 0.5, 2, 0.9)
        steps = [plan for purpose, plan in plans if purpose == "factors"]
        assert len(steps) == 6 and all(("Exchange" in plan) == shuffled for plan in steps)
        wanted, _ = plain_rake(cells, 0.5, 2)
        assert {(r.a, r.b): r.share for r in raked.collect()} == {k: pytest.approx(s) for k, s in wanted.items()}


def test_mix(make_docs, odd_rows):
    rng = random.Random(3)
    rows = list(odd_rows) + [(None, "a b c")]
    for i in range(2_000):
        words = "x " * rng.randrange(1, 30) + rng.choice(["", "@", "a | b", "Copyright"])
        rows.append((100 + i, words, rng.choice(["en", "en", "en", "de", None]), rng.choice(["big"] * 8 + ["s", "t", ""])))
    docs = make_docs(rows, clashing=True)
    got = mixing.mix(docs, budget=0.4, power=0.8).collect()
    assert len(got) == len(rows)
    tokens = sum(r.n_tokens for r in got)
    assert tokens == sum(len((t or "").split()) for _, t, *_ in rows)
    assert sum(r.probability * r.n_tokens for r in got) == pytest.approx(0.4 * tokens)
    assert all(not r.sampled and r.probability == 0 for r in got if not r.n_tokens)
    wanted = sum(r.probability * r.n_tokens for r in got if r.doc_id and r.doc_id >= 100)
    assert sum(r.n_tokens for r in got if r.sampled and r.doc_id and r.doc_id >= 100) == pytest.approx(wanted, rel=0.1)
    cells = defaultdict(int)
    for r in got:
        cells[r.source, r.lang, r.topic] += r.n_tokens
    share, _ = plain_rake({k: n for k, n in cells.items() if n}, 0.8, 10)
    for r in got:
        if r.n_tokens:
            key = r.source, r.lang, r.topic
            assert r.weight == pytest.approx(0.4 * tokens * share[key] / cells[key])
    kept = mixing.sample(docs, budget=0.4, power=0.8)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.sampled)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")]])
def test_nothing_to_weigh(make_docs, rows):
    assert [r.sampled for r in mixing.mix(make_docs(rows)).collect()] == [False] * len(rows)
