"""Quality rules that clean line by line first and judge the document afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reachmart.llm.common import BREAKS, numbered, renamed

SYMBOLS = "[#*$%&|<>]"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "base_failed", "clean_text", "kept"
)

# A line of prose ends in one of these.
ENDINGS = [".", "!", "?", "…", ":", ";", ",", '"', "'", "”", "’", "»", ")", "。", "！", "？", "।", "؟"]
# Symbols, and marks between the entries of a menu or the cells of a table.
MARKS = "[#*$%&|<>»·]"
# Phrases of page furniture; also found with capital first letters or in capitals.
BOILERPLATE = [
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "accept cookies",
    "enable javascript",
    "javascript is disabled",
    "click here",
    "sign up for our newsletter",
    "share on facebook",
    "skip to content",
    "lorem ipsum",
]


_WORD = r"[^\x20\x09-\x0D]"


def _has_word(line: Column) -> Column:
    return F.rlike(line, F.lit(_WORD))


def with_base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``.

    Words of repeated windows are found within the row: hashes of 8 words are made from
    hashes of 1, 2 and 4 by pairing neighbours, and only documents with a hash that occurs
    twice sort them to count the covered words.
    """
    column = F.coalesce(F.col(text), F.lit(""))
    frame = docs.withColumns(
        {
            "_words": F.array_remove(F.split(column, f"{BREAKS}+", -1), ""),
            "_lines": F.split(column, "\n", -1),
            "_filled": F.filter(F.split(column, "\n", -1), _has_word),
            "n_symbols": F.regexp_count(column, F.lit(SYMBOLS)).cast("long"),
        }
    )
    frame = frame.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_dup_lines": (F.size("_filled") - F.size(F.array_distinct("_filled"))).cast("long"),
            "_hash": F.transform("_words", lambda word: F.xxhash64(word)),
        }
    ).drop("_words", "_filled")
    for step in (1, 2, 4):
        n = F.size("_hash") - step
        pairs = F.zip_with(F.slice("_hash", 1, n), F.slice("_hash", step + 1, n), lambda a, b: F.xxhash64(a, b))
        frame = frame.withColumn("_hash", F.when(n > 0, pairs).otherwise(F.array().cast("array<bigint>")))
    repeats = F.size(F.array_distinct("_hash")) < F.size("_hash")
    none = F.array().cast("array<struct<h:bigint,at:int>>")
    placed = F.transform("_hash", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    frame = frame.withColumn("_placed", F.when(repeats, F.sort_array(placed)).otherwise(none)).drop("_hash")

    def twice(entry: Column, i: Column) -> Column:
        after = F.get("_placed", i + 1)["h"].eqNullSafe(entry["h"])
        return after | ((i > 0) & F.get("_placed", F.greatest(i - 1, F.lit(0)))["h"].eqNullSafe(entry["h"]))

    at = F.sort_array(F.transform(F.filter("_placed", twice), lambda entry: entry["at"]))
    frame = frame.withColumn("_at", F.when(F.size("_placed") > 0, at).otherwise(F.array().cast("array<int>")))
    frame = frame.drop("_placed")
    n = F.size("_at")
    gaps = F.zip_with(
        F.slice("_at", 2, F.greatest(n - 1, F.lit(0))),
        F.slice("_at", 1, F.greatest(n - 1, F.lit(0))),
        lambda b, a: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)
    return frame.withColumn("n_repeat_words", F.when(n > 0, covered).otherwise(0).cast("long")).drop("_at")


def line_passes(line: Column) -> Column:
    """Whether a line is text: it ends like a sentence and is no menu, table or furniture."""
    ends = F.substring(F.rtrim(line, F.lit(BLANKS)), -1, 1).isin(ENDINGS)
    marked = F.regexp_count(line, F.lit(MARKS)) * 25 > F.char_length(line)
    furniture = F.lit(False)
    for phrase in BOILERPLATE:
        for form in dict.fromkeys((phrase, phrase.capitalize(), phrase.title(), phrase.upper())):
            furniture = furniture | F.contains(line, F.lit(form))
    return ends & ~marked & ~furniture


def clean_lines(docs: DataFrame, text: str = "text", most_lost: float = 0.5) -> DataFrame:
    """Adds the base counts, ``clean_text``, ``lost_chars``, ``base_failed`` and ``kept``.

    Lines that fail ``line_passes`` are removed; lines without a word stay as they are. A
    document fails the base rules if it has under 20 words or more than 30 % of them lie
    in repeated windows of 8 words. It also goes if the removed lines held more than
    ``most_lost`` of its characters.

    * A null text counts as empty: no words, base rules failed, an empty ``clean_text``.
    * Repeated rows get the same result each. Columns named like a result are replaced,
      and others pass through.
    """
    rows, place = numbered(docs, RESULTS)
    text = place[text]
    frame = with_base_counts(rows, text)
    frame = frame.withColumn("_good", F.transform("_lines", lambda line: ~_has_word(line) | line_passes(line)))
    lost = F.zip_with("_lines", "_good", lambda line, good: F.when(good, 0).otherwise(F.char_length(line)))
    kept_lines = F.filter("_lines", lambda line, i: F.get("_good", i))
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    frame = frame.withColumns(
        {
            "lost_chars": F.aggregate(lost, F.lit(0).cast("long"), lambda total, n: total + n),
            "base_failed": failed,
            "clean_text": F.array_join(kept_lines, "\n"),
        }
    )
    size = F.coalesce(F.char_length(F.col(text)), F.lit(0))
    kept = ~F.col("base_failed") & (F.col("lost_chars") <= size * most_lost)
    return renamed(frame.withColumn("kept", kept), place, *RESULTS)
