from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from reachmart.llm import common, decontam, mixing, toxicity
from tests.llm.test_simhash import plain_groups

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows that go into each stage, and the last one's rows."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
        rows.append(docs.collect())
    return rows


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_each_stage_on_its_input(spark, steps):
    start, clean, single, apart, mixed, placed = steps
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    frame = spark.createDataFrame(start, schema)
    scores = {r.doc_id: r.score for r in toxicity.toxicity(frame, labels).collect()}
    assert ids(clean) == sorted(i for i, s in scores.items() if s < 0.5)

    groups = plain_groups([(r.doc_id, r.text) for r in clean])
    assert ids(single) == sorted(i for i, _, least in groups if i == least)

    items = [decontam.words_of(r.text.encode()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    spaced = [b" " + b" ".join(item) + b" " for item in items]
    words = {r.doc_id: b" " + b" ".join(decontam.words_of((r.text or "").encode())) + b" " for r in single}
    leaked = {i for i, text in words.items() if any(item in text for item in spaced)}
    assert leaked <= set(ids(single)) - set(ids(apart))
    assert len(apart) >= 0.9 * (len(single) - len(leaked))

    wanted = mixing.mix(spark.createDataFrame(apart, schema), budget=corpus_pipeline.BUDGET, power=corpus_pipeline.POWER)
    assert ids(mixed) == sorted(r.doc_id for r in wanted.collect() if r.sampled)
    assert ids(placed) == ids(mixed)
    sizes = Counter(r.shard for r in placed)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_run(spark, steps):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    assert sorted((r.doc_id, r.shard, r.slot) for r in got.collect()) == sorted((r.doc_id, r.shard, r.slot) for r in steps[-1])


def test_stages_on_odd_and_empty_tables(spark, make_docs, odd_rows):
    for rows in (odd_rows, []):
        docs = make_docs(rows, clashing=True)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, FOLDER)
            assert kept.columns == docs.columns, name
            assert kept.count() <= len(rows)
        assert corpus_pipeline.shards(spark, docs, FOLDER).count() == len(rows)


@pytest.mark.parametrize("name", ["toxicity", "benchmark"])
def test_texts_go_to_the_tasks_once(spark, make_docs, name):
    docs = make_docs([(i, "some words here") for i in range(3)])
    plan = dict(corpus_pipeline.STAGES)[name](spark, docs, FOLDER)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "MapInArrow":
        plan = plan.children().head()
    read = plan.children().head().output().mkString(",").split(",")
    assert sum(column.startswith(("_1#", "text#", "_text#")) for column in read) == 1


def test_a_worker_holds_a_shared_value_once(spark):
    sent = common.shared(spark, toxicity.Vocabulary(["a"], [1.0]))

    def run(batches):
        for batch in batches:
            own = common.received(sent)
            yield pa.RecordBatch.from_arrays([pa.array([own is common.received(sent) and own.number["a"] == 0])], names=["same"])

    assert [r.same for r in spark.range(1).mapInArrow(run, "same boolean").collect()] == [True]
