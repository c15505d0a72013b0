import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns named like results or like the operators' own columns.
CLASHING = [
    "score", "predicted", "evidence", "shard", "slot", "fp", "key", "component_id", "hi", "lo", "kept", "topic",
    "weight", "probability", "sampled", "n_words", "clean_text", "terms", "item_id", "cosine", "n_email", "_0", "_text", "_hash",
]
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000)) + "."


def text(seed: int, n: int, words: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n)) + "."


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clashing=False):
        full = [(i, t, *(rest + ("en", "a"))[: 2], len(t or "")) for i, t, *rest in rows for rest in [tuple(rest)]]
        frame = spark.createDataFrame(full, DOCS)
        if clashing:
            from pyspark.sql import functions as F

            frame = frame.select("*", *[F.lit("x").alias(c) for c in CLASHING])
        return frame

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty values, a very long text, repeated rows, ties in id, several copies."""
    same = text(1, 80)
    return [
        (1, same), (2, same), (2, same), (2, text(2, 70)), (3, None, None, None), (4, ""), (5, " \n\t "),
        (None, same), (None, None), (6, LONG), (7, text(3, 55) + " " + same), (8, "Ö é 日本"), (9, "one two"),
        (10, LONG + " more"), (11, text(4, 60), "", ""),
    ]
