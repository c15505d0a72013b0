"""Which entries were sent already: anti joins and marks against the ledger's keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reachmart.operators.key_join import join_keys, key_set

# Fixed values.
SENT = "Sent to Salesforce"
NOT_SENT = "Not sent"


def sent_keys(ledger: DataFrame) -> DataFrame:
    """The set of sent ids and the set of sent e-mails, from one read of the ledger."""
    pairs = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("key"))
            for kind, column in (("id", "customer_id"), ("email", "email"))
        ]
    )
    keys = with_key(with_key(ledger, "customer_id"), "email").select(F.inline(pairs))
    return keys.filter(F.col("key").isNotNull()).distinct()


def with_key(ledger: DataFrame, column: str) -> DataFrame:
    """A payload without a key column sent nothing under that key."""
    return ledger if column in ledger.columns else ledger.withColumn(column, F.lit(None).cast("string"))


def unsent(entries: DataFrame, ledger: DataFrame, *columns: str) -> DataFrame:
    """Entries none of whose key columns occurs in the ledger.

    One equality join per key column; a single join on "id or e-mail" would compare every
    pair. A missing key matches nothing and keeps its entry.
    """
    for column in columns:
        ledger = with_key(ledger, column)
        entries = join_keys(entries, F.col(column), key_set(ledger, F.col(column)), "left_anti")
    return entries


def mark_sent(entries: DataFrame, ledger: DataFrame, column: str = "customer_id") -> DataFrame:
    """Each entry with its status; the number of rows stays."""
    keys = key_set(with_key(ledger, column), F.col(column))
    marked = join_keys(entries, F.col(column), keys, "left")
    return marked.withColumn("salesforce_status", status_text(F.col("key").isNotNull())).drop("key")


def status_text(is_sent: Column) -> Column:
    return F.when(is_sent, SENT).otherwise(NOT_SENT)
