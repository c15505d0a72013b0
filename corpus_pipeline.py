"""From raw documents to shards: five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reachmart.llm import decontam, mixing, sharding, simhash, toxicity
from reachmart.llm.common import stored, table

BUDGET = 0.6  # part of the tokens that the mixture keeps
POWER = 0.8  # flattening of the mixture's margins
SHARDS = 8


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the vote of the nearest labelled examples does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash fingerprints."""
    return simhash.one_per_group(docs, shingle=4, radius=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark and no passage of a longer one."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"), decontam.Settings(passages=True))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of documents whose tokens meet flattened margins of source, language and topic."""
    return mixing.sample(docs, budget=BUDGET, power=POWER)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard and slot; every shard holds the same mixture."""
    return sharding.interleave(docs, SHARDS)


STAGES = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("mixture", mixture),
    ("shards", shards),
]

# The votes, the latent search and the hashes have no SQL form; tests/llm/test_pipeline.py
# compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
