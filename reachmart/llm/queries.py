"""The queries of this subpackage by name; each takes the session and the folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reachmart.llm import (
    alignment,
    decontam,
    fingerprints,
    language,
    mixing,
    negatives,
    pii,
    quality,
    sharding,
    simhash,
    toxicity,
    warc,
    windows,
)
from reachmart.llm.common import table
from reachmart.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


@query("op1_simhash")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents: 4-word shingles, at most 4 bits apart."""
    return simhash.simhash_groups(table(spark, folder, "documents"), shingle=4, radius=4)


@query("op2_language")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of all documents, learned outside the held-out fold."""
    return language.identify(table(spark, folder, "documents"))


@query("op3_toxicity")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of all documents, with the nearest labelled examples."""
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_repeated_windows")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Words left in all documents after removing passages of 50 words seen in earlier ones."""
    cleaned = windows.remove_repeats(table(spark, folder, "documents"), window=50)
    return cleaned.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op5_surrogates")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with surrogates for personal data, and how many of each kind."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, key=b"surrogates of the query")


@query("op6_interleave")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 8 shards of the corpus' mixture of sources."""
    return shard_digest(table(spark, folder, "documents"))


def shard_digest(docs: DataFrame, shards: int = 8) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = sharding.interleave(rows, shards, order=("doc_id", "text_crc32", "size"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_warc_segments")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to archives in segments, and what reading them back gives."""
    pages = table(spark, folder, "pages")
    path = scratch_dir(spark, "archives")
    warc.write_archives(pages, path)
    found = warc.read_archives(spark, path)
    kind = pages.schema["page_id"].dataType
    return found.select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "problem",
    )


@query("op8_mixture")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Calibrated sampling of all documents, three tenths of the tokens, raked to flattened margins."""
    mixed = mixing.mix(table(spark, folder, "documents"), budget=0.3, power=0.8, sweeps=8)
    return mixed.select(
        "doc_id", "source", "lang", "topic", "n_tokens",
        F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "sampled",
    )


@query("op9_line_quality")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and verdict of the line-first rules for all documents."""
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.clean_lines(table(spark, folder, "documents").select("doc_id", "text")).select(*columns, "lost_chars")


@query("op10_benchmark_leaks")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the benchmark items found in them, copied or reworded."""
    return decontam.find_leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), decontam.Settings(passages=True)
    )


@query("op11_hard_negatives")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector against all vectors."""
    vectors = table(spark, folder, "embeddings")
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label=shifted)


@query("op12_fingerprints")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of texts whose last quarter is the next document's start."""
    return fingerprints.edited_likeness(table(spark, folder, "documents"))


@query("op13_token_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of a byte-level and of a sentence-piece vocabulary line up in all documents."""
    return alignment.align(table(spark, folder, "documents"))
