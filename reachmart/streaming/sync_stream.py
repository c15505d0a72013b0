"""New hand-entered files, repaired and sent as they arrive.

The stream keeps no state of its own: the checkpoint remembers which files were read, the
ledger which records were sent. A micro-batch that is repeated after a failure writes the
same run folder again and does not see its own rows, so each batch counts once.

The stream itself carries paths; a batch's files are read by column name. A file that cannot
be read goes into the table of rejected files, and the stream goes on.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from reachmart.plans import activation, manual_entries
from reachmart.sources import outbox
from reachmart.sources.files import exists
from reachmart.sources.ledger import Ledger
from reachmart.sources.schemas import MANUAL_COLUMNS

_FILE = "path string, modificationTime timestamp, length bigint, content binary"
_REJECTED = "path string, reason string"


def sync_batch(
    batch: DataFrame,
    ledger: Ledger,
    run_id: str,
    outbox_dir: str,
    send: Callable[[DataFrame], DataFrame | None] | None = None,
) -> None:
    """Repairs one batch and sends what the ledger does not know, by ``activation.deliver``:
    the payload is written once, and sending and the ledger start from there."""
    rows = ledger.unsent(manual_entries.repaired(batch), "customer_id", "email", except_run=run_id)
    activation.deliver(rows, outbox_dir, run_id, ledger, dry_run=False, send=send)


def entries_of(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """The entries of some files, and path and reason of the files that hold none that can be
    read: a damaged one, or one whose header has neither an id nor an e-mail. Columns that no
    entry has by that name are left out. An empty file holds no entries."""
    rejected = [(row["path"], row["reason"]) for row in outbox.undecodable(spark, list(map(outbox.literal, paths))).toLocalIterator()]
    good = [outbox.literal(path) for path in paths if path not in dict(rejected)]
    files = []
    for row in outbox.inspected(spark, good).collect() if good else []:
        if {"customer_id", "email"} & set(outbox.column_names(row["header"])):
            files.append(row)
        else:
            rejected.append((unquote(row["path"]), "neither customer_id nor email in the header"))
    return outbox.manual_columns(outbox.read_inspected(spark, files)).select(*MANUAL_COLUMNS), rejected


def rejected_table(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``path`` and ``reason`` of the files that a stream with this checkpoint passed over."""
    folder = _rejected_folder(checkpoint)
    if not exists(spark, folder):
        return spark.createDataFrame([], _REJECTED)
    return spark.read.schema(_REJECTED).parquet(folder)


def _rejected_folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-rejected"


def start(
    spark: SparkSession,
    inbox: str,
    ledger: Ledger,
    checkpoint: str,
    name: str = "manual_sync",
    files_per_batch: int = 1000,
    send: Callable[[DataFrame], DataFrame | None] | None = None,
    outbox_dir: str | None = None,
) -> StreamingQuery:
    """Works off all files that are there and ends; run it again for later ones.

    The driver sees the paths of one batch, ``files_per_batch`` at most. Only a file in which
    a value holds a line end is read in one piece. Payloads go to ``outbox_dir``, or beside
    the checkpoint.
    """
    payloads = outbox_dir or f"{checkpoint.rstrip('/')}-outbox"

    def work(batch: DataFrame, number: int) -> None:
        paths = [row["path"] for row in batch.collect()]
        entries, rejected = entries_of(spark, paths)
        table = spark.createDataFrame(rejected, _REJECTED).coalesce(1)
        table.write.mode("overwrite").parquet(f"{_rejected_folder(checkpoint)}/batch={number}")
        sync_batch(entries, ledger, f"{name}-{number}", payloads, send)

    # Without the content no file is opened here.
    files = spark.readStream.format("binaryFile").schema(_FILE).option("maxFilesPerTrigger", files_per_batch)
    return (
        files.load(inbox)
        .select("path")
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(work)
        .start()
    )
