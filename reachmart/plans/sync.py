"""Repair, send what was not sent, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from reachmart.functions.text import float_text
from reachmart.operators import sent_keys
from reachmart.plans import activation, manual_entries
from reachmart.sources import outbox
from reachmart.sources.ledger import Ledger
from reachmart.sources.payload_files import PayloadFiles


def pending(entries: DataFrame, ledger_rows: DataFrame, by: Sequence[str] = ("customer_id", "email")) -> DataFrame:
    """Repaired entries none of whose ``by`` columns was sent."""
    return sent_keys.unsent(manual_entries.repaired(entries), ledger_rows, *by)


def sync(
    entries: DataFrame, ledger: Ledger, outbox_dir: str, run_id: str, send=None, discount_cap: float = 10.0, **scorers
) -> str:
    """Sends the entries whose id and e-mail are unsent, as ``activation.manual_payload``: with
    the action of their segment and, given scorers, risk and message. Payload files of other
    tools in the outbox enter the ledger first, so what they sent counts as sent.

    Payload first, then delivery, then the ledger. Repeating a run that failed halfway sends
    its entries again and replaces its payload and its ledger rows.
    """
    PayloadFiles(ledger, outbox_dir).enter()
    rows = ledger.unsent(manual_entries.repaired(entries), "customer_id", "email", except_run=run_id)
    rows = activation.manual_payload(rows, None, discount_cap, **scorers)
    return activation.deliver(rows, outbox_dir, run_id, ledger, dry_run=False, send=send)


def sync_by_id(entries: DataFrame, ledger: Ledger, outbox_dir: str, run_id: str, send=None) -> str:
    """Sends the entries whose id is unsent, each with the action it came with; payload files of
    other tools count as for ``sync``."""
    PayloadFiles(ledger, outbox_dir).enter()
    rows = ledger.unsent(manual_entries.repaired(entries), "customer_id", except_run=run_id)
    return activation.deliver(rows, outbox_dir, run_id, ledger, dry_run=False, send=send)


def send_one(
    entries: DataFrame,
    key: str,
    ledger: Ledger,
    outbox_dir: str,
    run_id: str,
    send=None,
    dry_run: bool = False,
    discount_cap: float = 10.0,
    **scorers,
) -> bool:
    """Sends the entries that one id or e-mail finds, whether sent before or not; false if
    there are none."""
    found = activation.manual_payload(entries, key, discount_cap, **scorers)
    if found.isEmpty():
        return False
    activation.deliver(found, outbox_dir, run_id, ledger, dry_run=dry_run, send=send)
    return True


def send_file(
    spark: SparkSession,
    path: str,
    ledger: Ledger,
    outbox_dir: str,
    key: str | None = None,
    dry_run: bool = True,
    send=None,
    discount_cap: float = 10.0,
    **scorers,
) -> str | None:
    """Exports the entries of a file, all or those one key finds, as ``manual`` or
    ``manual_<key>``; the path of the payload, or none without a row."""
    rows = activation.manual_payload(outbox.read_manual(spark, path), key, discount_cap, **scorers)
    if rows.isEmpty():
        return None
    name = "manual" if key is None else f"manual_{key}"
    return activation.deliver(rows, outbox_dir, name, ledger, dry_run=dry_run, send=send)


def sync_report(entries: DataFrame, ledger_rows: DataFrame) -> DataFrame:
    """Total, sent and not sent, counted from the marks of the entries: ids that only occur
    in the ledger do not count as sent entries."""
    marked = sent_keys.mark_sent(entries, ledger_rows)
    is_sent = F.col("salesforce_status") == sent_keys.SENT
    return marked.agg(
        F.count("*").alias("total_records"),
        F.count_if(is_sent).alias("sent_records"),
        F.count_if(~is_sent).alias("unsent_records"),
    )


def ledger_union(entries: DataFrame, ledger_rows: DataFrame) -> DataFrame:
    """Entries and sent rows under each other by column name, as text; duplicates stay."""
    ours = entries.withColumn("source", F.lit("manual_entries.csv"))
    theirs = ledger_rows.withColumns(
        {"score": float_text(F.col("score")), "salesforce_status": F.lit(sent_keys.SENT)}
    )
    return ours.unionByName(theirs, allowMissingColumns=True)
