"""The compacted keys of the ledger against the ledger itself."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from reachmart.operators import sent_keys
from reachmart.sources import key_index
from reachmart.sources.ledger import Ledger

KEYS = "customer_id string, email string"


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def draws(seed):
    draw = random.Random(seed)

    def key(prefix):
        return draw.choice([None, f"{prefix}0", f"{prefix}0", f"{prefix}{draw.randrange(60)}"])

    return lambda n: [(key("i"), key("e")) for _ in range(n)]


@pytest.mark.parametrize("few", [0, 1000])
def test_same_as_the_ledger(spark, tmp_path, monkeypatch, few):
    """Runs before and after compactions, a run recorded again, a run that is being repeated."""
    monkeypatch.setattr(key_index, "FEW", few)
    ledger, some = Ledger(spark, f"{tmp_path}/ledger"), draws(1)
    entries = spark.createDataFrame(some(200), KEYS)

    def same():
        for run in (None, "a/1"):
            for columns in (("customer_id",), ("customer_id", "email")):
                wanted = sent_keys.unsent(entries, ledger.rows(except_run=run), *columns)
                assert rows_of(ledger.unsent(entries, *columns, except_run=run)) == rows_of(wanted)

    same()
    ledger.compact()
    ledger.record(spark.createDataFrame(some(15), KEYS), "a/1")
    same()
    ledger.compact()
    ledger.record(spark.createDataFrame(some(15), KEYS), "b")
    same()
    ledger.compact()
    ledger.record(spark.createDataFrame(some(3), KEYS), "a/1")  # other keys than before
    ledger.record(spark.createDataFrame([], KEYS), "c")
    same()
    ledger.compact()
    ledger.compact()
    same()
    state = ledger.index.state()
    assert (state.generation, state.stale) == (3, set()) and {"a/1", "b"} <= state.runs


def test_a_batch_reads_its_buckets_only(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    ledger.record(spark.range(5000).select(F.concat(F.lit("i"), "id").alias("customer_id"), F.lit(None).alias("email")), "all")
    ledger.compact()
    entries = spark.createDataFrame([("i77", "x@x"), ("new", None)], KEYS)
    hits = ledger.index.hits(entries, ledger.rows(), ["customer_id", "email"])
    assert rows_of(hits) == [("id", "i77")]
    plan = plan_of(hits)
    assert "In(key, [" in plan
    buckets = re.search(r"PartitionFilters: \[.*?bucket#\d+ IN \(([\d,]+)\)", plan)
    assert 1 <= len(buckets[1].split(",")) <= 3  # one for each key of the batch, of 16
    assert re.search(r"PartitionFilters: \[[^]]*NOT \(?run_id#\d+ (IN|=) ", plan)  # and nothing of the run's folder
    assert rows_of(ledger.unsent(entries, "customer_id", "email")) == [("new", None)]


def test_a_compaction_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    ledger.record(spark.createDataFrame([("a", None)], KEYS), "one")
    ledger.compact()
    ledger.record(spark.createDataFrame([("b", None)], KEYS), "two")

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(key_index.KeyIndex, "_commit", die)
        with pytest.raises(RuntimeError):
            ledger.compact()
    entries = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], KEYS)
    assert ledger.index.state().runs == {"one"}
    assert rows_of(ledger.unsent(entries, "customer_id")) == [("c", "3")]
    ledger.compact()
    assert ledger.index.state().runs == {"one", "two"}
    assert rows_of(ledger.unsent(entries, "customer_id")) == [("c", "3")]
