"""The ledger of sent records: Parquet, one folder per run.

A run replaces its own folder and nothing else. Repeating a run, after a lost executor or a
restarted stream, therefore leaves one copy of its rows.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reachmart.sources.files import exists
from reachmart.sources.key_index import KeyIndex
from reachmart.sources.outbox import json_columns

LEDGER_SCHEMA = (
    "customer_id string, email string, segment string, score double, first_name string, "
    "nba_action string, source string, run_id string"
)
_COLUMNS = ["customer_id", "email", "segment", "score", "first_name", "nba_action"]


class Ledger:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.index = KeyIndex(spark, f"{self.folder}-keys")

    def record(self, sent: DataFrame, run_id: str, source: Column | None = None) -> None:
        """Writes the rows of a run; called after their delivery. ``source`` names the payload
        of each row where that is not the run's."""
        rows = json_columns(sent)
        columns = [_ledger_column(rows, name) for name in _COLUMNS]
        rows = rows.select(*columns, (F.lit(f"{run_id}_payload") if source is None else source).alias("source"))
        self.index.forget(run_id)
        rows.write.mode("overwrite").parquet(f"{self.folder}/run_id={quote(run_id, safe='')}")

    def rows(self, except_run: str | None = None) -> DataFrame:
        """All sent rows; ``except_run`` leaves out a run that is being repeated."""
        if not exists(self.spark, self.folder):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        rows = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.folder)
        return rows.filter(F.col("run_id") != except_run) if except_run else rows

    def compact(self) -> None:
        """Brings the keys of all runs into the index; to be called now and then."""
        self.index.compact(self.rows())

    def unsent(self, entries: DataFrame, *columns: str, except_run: str | None = None) -> DataFrame:
        """Entries none of whose ``columns`` (``customer_id``, ``email``) was sent."""
        return self.index.unsent(entries, self.rows(), list(columns), except_run)


def _ledger_column(rows: DataFrame, name: str):
    """Scores are numbers, all other columns text; a score that is none becomes null."""
    column = (F.col(name) if name in rows.columns else F.lit(None)).cast("string")
    return (column.try_cast("double") if name == "score" else column).alias(name)
