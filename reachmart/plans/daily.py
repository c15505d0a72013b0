"""The daily run: marts, data tests, activation, validation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reachmart.functions.decisions import LAPSE_RISK
from reachmart.functions.temporal import Instant, as_datetime
from reachmart.plans import activation, marts, quality_suite, reports, warehouse
from reachmart.sources import outbox
from reachmart.sources.ledger import Ledger


class DataTestsFailed(RuntimeError):
    """Names the failed tests; nothing was activated."""


def run(
    spark: SparkSession,
    tables,
    as_of: Instant,
    store: warehouse.Folders | warehouse.Schema,
    outbox_dir: str,
    ledger: Ledger,
    discount_cap: float = 10.0,
    dry_run: bool = True,
    send: Callable[[DataFrame], DataFrame | None] | None = None,
    **scorers,
) -> DataFrame:
    """Builds the marts and, if their tests pass, activates all segments and then the
    high-value one by itself, with risk and message if there are ``scorers`` (as for
    ``activation.payload``). Returns the validation of the whole payload."""
    read = warehouse.build(tables, as_of, store)
    check(quality_suite.suite({name: read(name) for name in quality_suite.MODELS}))
    for name, segment in (("all", "all"), (LAPSE_RISK, LAPSE_RISK)):
        records = marts.segment_records_from_marts(read("segment_scores"), read("customer_360"), segment)
        payload = activation.payload(records, discount_cap, **scorers)
        run_id = f"{name}-{as_datetime(as_of):%Y%m%d}"
        activation.deliver(payload, outbox_dir, name, ledger, dry_run, send, run_id)
    return validate(spark, outbox_dir)


def check(report: DataFrame) -> None:
    failed = report.filter("NOT passed").collect()  # at most one row per test
    if failed:
        lines = [f"{row['test']} {row['model']}.{row['column_name']}: {row['failures']}" for row in failed]
        raise DataTestsFailed("; ".join(lines))


def validate(spark: SparkSession, outbox_dir: str, name: str = "all") -> DataFrame:
    """Rows and mean risk of a payload file; zero rows where there is no file."""
    return reports.validate_run(outbox.read_results(spark, outbox_dir, name))
