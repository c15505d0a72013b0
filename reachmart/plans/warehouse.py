"""Models stored as Parquet folders or catalog tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reachmart.functions.temporal import Instant
from reachmart.plans import marts, staging
from reachmart.sources.schemas import DIM_COLUMNS
from reachmart.sources.tables import WarehouseTables

MODELS = [
    "stg_customers", "stg_ad_spend", "fct_orders", "fct_events", "customer_360", "dim_customer",
    "segment_scores", "cohort_retention",
]
PARTITIONS = {"fct_orders": "order_week", "fct_events": "event_week"}


class Folders:
    """One Parquet folder per model below a root. Facts that already arrive in order of time
    need no ``rebalance``, which shuffles them."""

    def __init__(self, spark: SparkSession, root: str, rebalance: bool = True):
        self.spark, self.root, self.rebalance = spark, root.rstrip("/"), rebalance
        self._frames: dict[str, DataFrame] = {}

    def write(self, name: str, rows: DataFrame) -> None:
        self._frames.pop(name, None)
        rows = _spread(name, rows) if self.rebalance else rows
        writer = rows.write.mode("overwrite")
        if name in PARTITIONS:
            writer = writer.partitionBy(PARTITIONS[name])
        writer.parquet(f"{self.root}/{name}")

    def read(self, name: str) -> DataFrame:
        """Listing the weeks of a fact is a job of its own, so a model is opened once."""
        if name not in self._frames:
            self._frames[name] = _typed(name, self.spark.read.parquet(f"{self.root}/{name}"))
        return self._frames[name]


class Schema:
    """One catalog table per model in a database; customer tables can be bucketed, so that
    joins between them need no shuffle. Facts are not bucketed: a hot customer would make
    one bucket, and one task, of a third of the rows."""

    def __init__(self, spark: SparkSession, database: str, buckets: int | None = None, rebalance: bool = True):
        self.spark, self.database, self.buckets, self.rebalance = spark, database, buckets, rebalance
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def write(self, name: str, rows: DataFrame) -> None:
        bucketed = self.buckets and name not in PARTITIONS and "customer_id" in rows.columns
        # One task per bucket, so that each bucket is one sorted file.
        if bucketed:
            rows = rows.repartition(self.buckets, "customer_id")
        elif self.rebalance:
            rows = _spread(name, rows)
        writer = rows.write.mode("overwrite").format("parquet")
        if name in PARTITIONS:
            writer = writer.partitionBy(PARTITIONS[name])
        elif bucketed:
            writer = writer.bucketBy(self.buckets, "customer_id").sortBy("customer_id")
        writer.saveAsTable(f"{self.database}.{name}")

    def read(self, name: str) -> DataFrame:
        return _typed(name, self.spark.table(f"{self.database}.{name}"))


def _spread(name: str, rows: DataFrame) -> DataFrame:
    """One writer per week, and several for a week that is large: few files per folder."""
    return rows.hint("rebalance", PARTITIONS[name]) if name in PARTITIONS else rows


def _typed(name: str, rows: DataFrame) -> DataFrame:
    """Partition values come back as text or zoned time; the model's week has no zone."""
    if name not in PARTITIONS:
        return rows
    return rows.withColumn(PARTITIONS[name], F.col(PARTITIONS[name]).cast("timestamp_ntz"))


def build(tables, as_of: Instant, store: Folders | Schema) -> Callable[[str], DataFrame]:
    """Writes all models; each reads the stored models before it, not the sources again."""
    store.write("stg_customers", staging.customers(tables))
    store.write("stg_ad_spend", staging.ad_spend(tables))
    store.write("fct_orders", staging.fct_orders(tables))
    store.write("fct_events", staging.fct_events(tables))
    stored = WarehouseTables(store.read)
    store.write("customer_360", marts.customer_360(stored, as_of))
    profile = store.read("customer_360")
    store.write("dim_customer", profile.select(*DIM_COLUMNS))
    store.write("segment_scores", marts.scores_of(profile))
    store.write("cohort_retention", marts.cohort_retention(stored))
    return store.read


def row_counts(read: Callable[[str], DataFrame]) -> DataFrame:
    counts = [read(name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("model"), "rows") for name in MODELS]
    whole = counts[0]
    for count in counts[1:]:
        whole = whole.unionByName(count)
    return whole
