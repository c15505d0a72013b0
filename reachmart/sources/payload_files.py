"""Payload files that are there already, brought into the ledger once each.

What other tools sent is known from the payload files they left. A manifest beside the ledger
remembers every file that was seen, by path, length and time of change; only new and changed
files are read. They are worked off in batches, so that the driver never holds more than
``files_per_batch`` paths beside the reader's own listing.

A batch writes its ledger run first and its part of the manifest after that. One that dies in
between is found again, gets the same number and replaces its run.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reachmart.sources import outbox
from reachmart.sources.files import exists
from reachmart.sources.ledger import Ledger

MANIFEST_SCHEMA = (
    "path string, length bigint, modified timestamp, header string, lines bigint, digest string, "
    "state string, reason string, batch int"
)
ENTERED, KNOWN, EMPTY, NO_KEY, UNREADABLE = "entered", "known", "empty", "no key", "unreadable"
_IDENTITY = ["path", "length", "modified"]
_KEYS = {"customer_id", "email"}


class PayloadFiles:
    """The payload files of an outbox, ``<name>_payload.csv`` with any ending after that: files, or
    folders of part files. Payloads with ``<name>_records.parquet`` beside them are the
    library's own, whose runs enter the ledger when they are delivered; they are left alone,
    so a dry run still counts as not sent. Files without a byte are not listed."""

    def __init__(self, ledger: Ledger, outbox_dir: str, files_per_batch: int = 5000):
        self.spark, self.ledger, self.files_per_batch = ledger.spark, ledger, files_per_batch
        self.outbox_dir = outbox_dir.rstrip("/")
        self.folder = f"{ledger.folder}-files"

    def manifest(self) -> DataFrame:
        """A row for each version of a file that was seen. ``state``: its rows were ``entered``;
        it has the lines of one that was, so its rows are ``known``; its first line is ``empty``; it has
        ``no key`` column; it is ``unreadable`` for the ``reason`` given."""
        if not exists(self.spark, self.folder):
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(self.folder)

    def rejected(self) -> DataFrame:
        """The files none of whose rows counts, and why."""
        return self.manifest().filter(F.col("state").isin(NO_KEY, UNREADABLE)).select("path", "reason")

    def new(self) -> DataFrame:
        """Path, length and time of the files that the manifest does not have as they are now."""
        reader = self.spark.read.format("binaryFile").options(recursiveFileLookup="true")
        listed = reader.load(self.outbox_dir).select("path", "length", F.col("modificationTime").alias("modified"))
        own = listed.select(_name(r"/([^/]*)_records\.parquet/").alias("name")).filter("name <> ''").distinct()
        theirs = listed.withColumn("name", _name(r"/([^/]*)_payload\.csv[^/]*(?:/[^/]*)?$")).filter("name <> ''")
        return theirs.join(own, "name", "left_anti").drop("name").join(self.manifest(), _IDENTITY, "left_anti")

    def enter(self) -> int:
        """Reads what is new, enters its rows into the ledger, and returns the number of files
        that were looked at."""
        seen = 0
        if not exists(self.spark, self.outbox_dir):
            return seen
        number = (self.manifest().agg(F.max("batch")).first()[0] or 0) + 1
        while files := self.new().orderBy("modified", "path").limit(self.files_per_batch).collect():
            self._enter(files, number)
            number, seen = number + 1, seen + len(files)
        return seen

    def _enter(self, files: list, number: int) -> None:
        frame = self.spark.createDataFrame(files, "path string, length bigint, modified timestamp")
        paths = [file["path"] for file in files]
        literal = [outbox.literal(path) for path in paths]
        bad = {row["path"]: row["reason"] for row in outbox.undecodable(self.spark, literal).toLocalIterator()}
        good = [outbox.literal(path) for path in paths if path not in bad]
        found = {_plain(unquote(row["path"])): row for row in outbox.inspected(self.spark, good).collect()} if good else {}
        before = self.manifest().filter(F.col("state") == ENTERED).select("digest")
        digests = self.spark.createDataFrame([(row["digest"],) for row in found.values()], "digest string")
        known = {row["digest"] for row in digests.join(before, "digest", "left_semi").collect()}
        facts, taken = [], []
        for path in paths:
            row, reason = found.get(_plain(path)), bad.get(path)
            if reason is not None:
                state = UNREADABLE
            elif row is None:
                state = EMPTY
            elif not _KEYS & set(outbox.column_names(row["header"])):
                state, reason = NO_KEY, "neither customer_id nor email in the header"
            elif row["digest"] in known:
                state = KNOWN
            else:
                state = ENTERED
                known.add(row["digest"])
                taken.append(row)
            facts.append((path, *((row["header"], row["lines"], row["digest"]) if row else (None, None, None)), state, reason))
        if taken:
            rows = outbox.read_inspected(self.spark, taken)
            self.ledger.record(rows, f"files-{number:06d}", _name(r"([^/]*_payload\.csv[^/]*)(?:/[^/]*)?$", "_file"))
        columns = "path string, header string, lines bigint, digest string, state string, reason string"
        part = frame.join(self.spark.createDataFrame(facts, columns), "path")
        part.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/batch={number}")


def _name(pattern: str, column: str = "path") -> Column:
    return F.regexp_extract(column, pattern, 1)


def _plain(path: str) -> str:
    """The path without the scheme, of which listings write the root in two ways."""
    return path[path.index(":/") + 2 :].lstrip("/") if ":/" in path else path
