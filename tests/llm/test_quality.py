import random
import re
from collections import Counter

from reachmart.llm import quality
from tests.llm.conftest import text

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def plain(value):
    value = value or ""
    words = re.findall("[^\x20\x09-\x0d]+", value)
    lines = [line for line in value.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    symbols = sum(value.count(c) for c in "#*$%&|<>")
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_counts(make_docs, odd_rows):
    rng = random.Random(2)
    rows = list(odd_rows)
    for i in range(40):
        line = text(rng.random(), rng.randrange(1, 12), 4)
        rows.append((100 + i, "\n".join(rng.choice([line, text(i, 9), "a | b | c", "", " ", "x#*"]) for _ in range(rng.randrange(9)))))
    frame = quality.clean_lines(make_docs(rows, clashing=True))
    got = sorted(((r.doc_id, *[r[c] for c in COLUMNS]) for r in frame.collect()), key=str)
    assert got == sorted(((i, *plain(t)) for i, t, *_ in rows), key=str)


def test_lines(make_docs):
    prose = "A line of some words that ends here. " * 1
    good = " ".join(f"word{i}" for i in range(30)) + "."
    rows = [
        (1, good),
        (2, good + "\nHome | About | Contact"),
        (3, good + "\n" + " ".join(f"no{i}" for i in range(60))),
        (4, good + "\n\nAll Rights Reserved by nobody."),
        (5, good + "\n" + " ".join(f"w{i}%%%" for i in range(40)) + "."),
        (6, prose),
        (7, good + "  \t"),
    ]
    got = {r.doc_id: (r.kept, r.clean_text) for r in quality.clean_lines(make_docs(rows)).collect()}
    assert got[1] == (True, good)
    assert got[2] == (True, good)
    assert got[3] == (False, good)
    assert got[4] == (True, good + "\n")
    assert got[5] == (False, good)
    assert got[6] == (False, prose)
    assert got[7] == (True, good + "  \t")


def test_empty(make_docs):
    assert quality.clean_lines(make_docs([])).collect() == []
