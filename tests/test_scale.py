"""Plans: what is read, what is shuffled, how a hot key is treated."""

import re
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import plan_of
from reachmart import catalog
from reachmart.operators import activity, lookups, quality, sent_keys
from reachmart.operators.histogram import histogram
from reachmart.plans import activation, marts, reports, warehouse
from reachmart.session import scratch_dir
from reachmart.sources.tables import SalesTables, WarehouseTables

FOLDER, AS_OF = "/root/testdata/sf0.001", "2024-01-31"
WRITING = {"materialize_marts", "payload_roundtrip", "stream_sync"}


@pytest.fixture(scope="module")
def tables(spark):
    return SalesTables(spark, FOLDER)


def scans(plan):
    return re.findall(r"FileScan parquet .*?(?:orders|events|customer|nation|lineitem)\.parquet.*", plan)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - WRITING))
def test_no_query_pairs_everything(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time functions


def test_scores_read_only_the_windows(tables):
    plan = plan_of(marts.segment_scores(tables, AS_OF))
    assert "GreaterThanOrEqual(o_orderdate,2001-05-04T00:00)" in plan
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in plan
    assert "props" not in plan and "o_orderpriority" not in plan


def test_profile_reads_each_fact_once(tables):
    found = scans(plan_of(marts.customer_360(tables, AS_OF)))
    assert sum("orders.parquet" in scan for scan in found) == 1
    assert sum("events.parquet" in scan for scan in found) == 1


def test_cohorts_shuffle_orders_once(tables):
    plan = plan_of(marts.cohort_retention(tables))
    assert len(scans(plan)) == 1 and "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 2  # the second one moves week pairs only


def test_stored_facts_are_pruned_by_week(spark, tmp_path):
    read = warehouse.build(SalesTables(spark, FOLDER), AS_OF, warehouse.Folders(spark, str(tmp_path)))
    plan = marts.segment_scores(WarehouseTables(read), AS_OF)._jdf.queryExecution().toString()
    assert "order_week" in plan.split("PartitionFilters: [", 1)[1]
    recent = WarehouseTables(read).orders(datetime(2023, 11, 2))
    whole = WarehouseTables(read).orders()
    assert 0 < len(recent.inputFiles()) and recent.count() < whole.count()


def test_top_lists_need_no_full_sort(spark):
    for name in ("top_active", "first_n_segment"):
        assert "TakeOrderedAndProject" in plan_of(catalog.QUERIES[name](spark, FOLDER))


def test_top_lists_add_up_the_winners_only(spark, tables):
    """Orders meet the ids before they are shuffled; stored and lazy profiles agree."""
    for name in ("top_active", "first_n_segment"):
        plan = plan_of(catalog.QUERIES[name](spark, FOLDER))
        assert re.search(r"LeftSemi, BuildRight.*(\n.*){1,8}orders.parquet", plan)
    profile = marts.customer_360(tables, AS_OF)
    assert reports.top_active(profile).collect() == reports.top_active_of(tables, AS_OF).collect()
    records = marts.segment_records(profile, "churn_rescue_nps")
    best = marts.best_records(tables, AS_OF, "churn_rescue_nps", 3).collect()
    assert activation.first_of_segment(records, 3).collect() == best


def test_hot_customer_is_combined_before_the_shuffle(spark):
    """A third of the rows on one key: one row per task reaches the shuffle."""
    rows = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50_000).alias("customer_id"),
        F.lit("paid").alias("status"),
        F.lit(1.0).alias("amount"),
        F.timestamp_add("DAY", (F.col("id") % 700).cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("order_ts"),
    )
    stats = activity.order_stats(rows, AS_OF)
    assert "partial_sum" in plan_of(stats) and "partial_count" in plan_of(stats)
    assert stats.filter("customer_id = 7").collect()[0]["orders_cnt"] == rows.filter("customer_id = 7").count()
    assert "partial_collect_set" in plan_of(activity.weekly_cohorts(rows))


def test_hot_entry_key_is_split(spark):
    """Adaptive execution splits the long run of one id in both kinds of join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        entries = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("customer_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("email"),
        )
        ledger = spark.range(0, 30_000, 7).select(
            F.col("id").cast("string").alias("customer_id"), F.lit(None).cast("string").alias("email")
        )
        frames = [
            sent_keys.unsent(entries, ledger, "customer_id"),
            sent_keys.unsent(entries, ledger, "customer_id", "email"),
            sent_keys.mark_sent(entries, ledger),
            lookups.find_all(entries, entries.select(F.col("customer_id").alias("lookup"))),
        ]
        for frame in frames:
            rows = frame.collect()
            assert "SortMergeJoin(skew=true)" in plan_of(frame)
            assert sum(row["customer_id"] == "hot" for row in rows) == 20_000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_histogram(spark):
    frame = spark.createDataFrame([(x,) for x in (0.0, 0.5, 1.0, 9.99, 10.0, None)], "x double")
    rows = {r["bin"]: (r["bin_start"], r["customers"]) for r in histogram(frame, "x", 10).collect()}
    assert rows == {0: (0.0, 2), 1: (1.0, 1), 9: (9.0, 2)}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [tuple(r) for r in histogram(flat, "x", 10).collect()] == [(0, 3.0, 2)]
    assert histogram(frame.filter("x is null"), "x", 10).collect() == []


def test_data_tests_count_failures(spark):
    frame = spark.createDataFrame([(1, "paid"), (1, "void"), (2, "void"), (None, None), (None, "lost")], "k int, s string")
    report = quality.report(
        [
            quality.not_null(frame, "m", "k"),
            quality.unique(frame, "m", "k"),
            quality.accepted_values(frame, "m", "s", ["paid"]),
        ]
    )
    rows = {r["test"]: (r["failures"], r["passed"]) for r in report.collect()}
    assert rows == {"not_null": (2, False), "unique": (1, False), "accepted_values": (2, False)}
    both = quality.report([quality.not_null(frame, "m", "k"), quality.unique(frame, "m", "k")]).collect()
    assert sorted(quality.model_tests(frame, "m", [("not_null", "k", None), ("unique", "k", None)]).collect()) == sorted(both)
    assert [r["failures"] for r in quality.model_tests(frame.limit(0), "m", [("not_null", "k", None), ("unique", "k", None)]).collect()] == [0, 0]


def test_leads_read_only_the_windows(tables):
    for name in ("lead_rows", "task_rows", "activation_summary"):
        assert "GreaterThanOrEqual(o_orderdate,2001-05-04T00:00)" in plan_of(catalog.QUERIES[name](tables.spark, FOLDER))


def test_scratch_follows_the_cluster_setting():
    def session(master, folder):
        conf = SimpleNamespace(get=lambda key, default=None: folder)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))

    assert scratch_dir(session("yarn", "hdfs:///shared/"), "marts").startswith("hdfs:///shared/marts-")
    assert scratch_dir(session("local[8]", None), "marts").count("/marts-") == 1
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("spark://host:7077", None), "marts")
