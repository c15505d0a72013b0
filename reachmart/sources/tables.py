"""The four input tables: from seed files, from the benchmark's Parquet tables, or from
facts that were materialized earlier.

Each class offers ``customers(columns)``, ``orders(since)``, ``web_events(since)`` and
``ad_spend()``. ``columns`` are those the caller uses; a class may leave out others. ``since``
is a lower bound of the fact's own time that the class hands down to its scan, so that a
look-back job does not read the whole history.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reachmart.functions.temporal import instant, week_start
from reachmart.sources.schemas import CUSTOMER_COLUMNS, SALES_SCHEMAS, SEED_SCHEMAS


class SeedTables:
    """One CSV file, or folder of part files, per table, with a header line."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        # A header that differs from the schema or a bad value stops the job.
        reader = self.spark.read.schema(SEED_SCHEMAS[name]).options(header=True, enforceSchema=False, mode="FAILFAST")
        return reader.csv(f"{self.folder}/{name}.csv")

    def customers(self, columns: list[str] = CUSTOMER_COLUMNS) -> DataFrame:
        return self._read("customers")

    def orders(self, since: datetime | None = None) -> DataFrame:
        return _from(self._read("orders"), F.col("order_ts"), since)

    def web_events(self, since: datetime | None = None) -> DataFrame:
        return _from(self._read("web_events"), F.col("event_ts"), since)

    def ad_spend(self) -> DataFrame:
        return self._read("ad_spend")


class SalesTables:
    """The order, customer, nation, lineitem and events tables in the roles of the model."""

    # Orders end in 2001 and events in January 2024; the shift lets both end on the same day.
    ORDER_SHIFT_DAYS = 8217

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SALES_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def customers(self, columns: list[str] = CUSTOMER_COLUMNS) -> DataFrame:
        """Only a caller who uses the country pays for the join that names it."""
        key = F.col("c_custkey")
        rows = self._read("customer")
        if "country" in columns:
            rows = rows.join(self._read("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        mapped = {
            "customer_id": key,
            "email": F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@example.com")),
            "first_name": F.concat(F.lit("C"), key),
            "last_name": F.col("c_mktsegment"),
            "created_at": F.date_add(F.lit("2017-01-01").cast("date"), (key % 2000).cast("int")),
            "country": F.col("n_name"),
            "marketing_opt_in": F.when(F.col("c_acctbal") > 0, 1),
            "nps_score": F.when(key % 13 != 0, (key % 11).cast("double")),
        }
        return rows.select(*[mapped[name].alias(name) for name in columns])

    def orders(self, since: datetime | None = None) -> DataFrame:
        shift = timedelta(days=self.ORDER_SHIFT_DAYS)
        raw = _from(self._read("orders"), F.col("o_orderdate"), since - shift if since else None)
        return raw.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("o_orderdate") + F.lit(shift)).alias("order_ts"),
            F.when(F.col("o_orderstatus") == "P", "refunded").otherwise("paid").alias("status"),
            (F.floor(F.col("o_totalprice") / 10) / 100.0).alias("amount"),
        )

    def web_events(self, since: datetime | None = None) -> DataFrame:
        user, ts = F.col("user_id"), F.col("ts")
        return _from(self._read("events"), ts, since).select(
            "event_id",
            user.alias("customer_id"),
            "event_type",
            ts.alias("event_ts"),
            F.concat(F.lit("s"), user, F.lit("-"), ts.cast("date")).alias("session_id"),
        )

    def ad_spend(self) -> DataFrame:
        flag = F.col("l_returnflag")
        spend = F.floor(F.col("l_extendedprice") * F.col("l_discount") * 100) / 100.0
        return self._read("lineitem").select(
            F.col("l_shipdate").cast("date").alias("date"),
            F.when(flag == "A", "search").when(flag == "R", "social").otherwise("email").alias("channel"),
            F.concat(F.lit("c"), F.col("l_suppkey") % 20).alias("campaign"),
            spend.alias("spend"),
        )


class WarehouseTables:
    """Facts written by ``plans.warehouse.build``: partitioned by week, so that ``since``
    prunes whole partitions."""

    def __init__(self, read_model):
        self._model = read_model

    def customers(self, columns: list[str] = CUSTOMER_COLUMNS) -> DataFrame:
        return self._model("stg_customers")

    def orders(self, since: datetime | None = None) -> DataFrame:
        facts = _from(self._model("fct_orders"), F.col("order_ts"), since, F.col("order_week"))
        return facts.drop("order_week")

    def web_events(self, since: datetime | None = None) -> DataFrame:
        facts = _from(self._model("fct_events"), F.col("event_ts"), since, F.col("event_week"))
        return facts.drop("event_week").withColumn("session_id", F.lit(None).cast("string"))

    def ad_spend(self) -> DataFrame:
        return self._model("stg_ad_spend")


def _from(facts: DataFrame, ts: Column, since: datetime | None, week: Column | None = None) -> DataFrame:
    if since is None:
        return facts
    facts = facts.filter(ts >= instant(since))
    return facts if week is None else facts.filter(week >= week_start(instant(since)))
