"""CSV edges: payload files, hand-entered files, backups.

CSV holds no structs, so the action becomes JSON text on the way out. Quotes are escaped by
doubling them, as spreadsheet tools and Python's csv module do.
"""

from __future__ import annotations

import bz2
import csv
import gzip
import io
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T

from reachmart.functions.text import spaced_json
from reachmart.sources.files import copy, exists
from reachmart.sources.schemas import MANUAL_COLUMNS, MANUAL_SCHEMA

# Blanks around a value belong to it.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Stands for a quoted empty value while it is read: that is an empty text, no value is null.
_EMPTY = "\u0001"
# Files with line ends in values are read in one piece, so none may grow large.
_ROWS_PER_FILE = 1_000_000
# A quoted value that ends in its own line.
_CLOSED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|\r?$)'


def json_columns(rows: DataFrame) -> DataFrame:
    """Struct columns as JSON text."""
    structs = [field.name for field in rows.schema.fields if isinstance(field.dataType, T.StructType)]
    return rows.withColumns({name: spaced_json(F.to_json(name)) for name in structs})


def write_csv(rows: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """One folder per file of the model; header = column names; the action as JSON."""
    json_columns(rows).write.mode(mode).options(**_CSV, maxRecordsPerFile=_ROWS_PER_FILE).csv(folder)


def hand_off(payload: DataFrame, outbox: str, name: str) -> DataFrame:
    """The payload as Parquet, read back: what is sent and recorded. ``_record`` numbers the
    records, as ids and e-mails may repeat or be missing."""
    folder = f"{outbox.rstrip('/')}/{name}_records.parquet"
    rows = json_columns(payload).withColumn("_record", F.monotonically_increasing_id())
    rows.write.mode("overwrite").parquet(folder)
    return payload.sparkSession.read.schema(rows.schema).parquet(folder)


def write_payload(payload: DataFrame, outbox: str, name: str) -> str:
    folder = f"{outbox.rstrip('/')}/{name}_payload.csv"
    write_csv(payload, folder)
    return folder


def read_results(spark: SparkSession, outbox: str, name: str) -> DataFrame:
    """A payload for the reports, with its numbers typed; empty where there is no file."""
    folder = f"{outbox.rstrip('/')}/{name}_payload.csv"
    if not exists(spark, folder):
        return spark.createDataFrame([], "customer_id string, email string, segment string, score double")
    rows = read_payloads(spark, folder)
    numbers = [name for name in ("score", "llm_risk_score") if name in rows.columns]
    return rows.withColumns({name: F.col(name).try_cast("double") for name in numbers})


def append_manual(entries: DataFrame, folder: str) -> None:
    """Adds entries; every part file carries the header, so order does not matter."""
    write_csv(entries, folder, mode="append")


def read_manual(spark: SparkSession, path: str) -> DataFrame:
    """Hand-entered records, all as text, by column name: a repaired file has its columns in
    another order than a new one. Columns that a file lacks are null."""
    return manual_columns(read_by_name(spark, path))


def manual_columns(rows: DataFrame) -> DataFrame:
    """The columns of an entry first, those that are missing as nulls; then all others."""
    missing = [name for name in MANUAL_COLUMNS if name not in rows.columns]
    rows = rows.withColumns({name: F.lit(None).cast("string") for name in missing})
    return rows.select(*MANUAL_COLUMNS, *[name for name in rows.columns if name not in [*MANUAL_COLUMNS, "_file"]])


def read_payload(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A payload this package wrote: the header must be the schema's, or the read fails."""
    reader = spark.read.schema(schema).options(**_CSV, emptyValue=_EMPTY, multiLine="true", enforceSchema="false")
    return _with_empty(reader.csv(path))


def _with_empty(rows: DataFrame) -> DataFrame:
    texts = [name for name, kind in rows.dtypes if kind == "string"]
    empty = {name: F.when(F.col(f"`{name}`") == _EMPTY, "").otherwise(F.col(f"`{name}`")) for name in texts}
    return rows.select(*[empty[name].alias(name) if name in empty else F.col(f"`{name}`") for name in rows.columns])


def read_payloads(spark: SparkSession, glob: str) -> DataFrame:
    """All payload files that match, as text; ``source`` holds the name of the payload."""
    source = F.regexp_extract("_file", r"([^/]*_payload\.csv)", 1)
    return read_by_name(spark, glob).withColumn("source", source).drop("_file")


def read_by_name(spark: SparkSession, glob: str) -> DataFrame:
    """CSV files as text, matched by column name, with the path of the file in ``_file``.

    The reader matches columns by position and would mix up files whose headers differ. So
    one distributed pass over the lines finds each file's header, and each distinct header
    is read once. The same pass finds the files in which a value holds a line end. Only
    those have to be read as one piece; all others can be split among tasks. Empty files
    hold no rows. A file that cannot be decoded is left out whole; ``undecodable`` lists
    such files. A failing read fails the job.
    """
    bad = {row["path"] for row in undecodable(spark, glob).toLocalIterator()}
    good = glob if not bad else _other_paths(spark, glob, bad)
    if not good:
        return spark.createDataFrame([], f"{MANUAL_SCHEMA}, _file string")
    # One row per file, as in the reader's own file listing.
    return read_inspected(spark, inspected(spark, good).toLocalIterator())


def inspected(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A row for each file that is not empty: ``path`` (percent-encoded), ``header``, ``whole``
    (a value holds a line end), number of ``lines``, and ``digest``, which is the same for
    files of the same lines."""
    lines = (
        spark.read.options(recursiveFileLookup="true")
        .text(paths)
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    )
    sums = [F.sum(F.xxhash64("value", F.lit(seed)).cast("decimal(38,0)")).cast("string") for seed in (0, 1)]
    # Within a task the row number grows with the position in the file.
    return (
        lines.withColumn("line_no", F.monotonically_increasing_id())
        .groupBy("path")
        .agg(
            F.min_by("value", F.struct("at", "line_no")).alias("header"),
            F.max(_opens(F.col("value"))).alias("whole"),
            F.count("*").alias("lines"),
            F.concat_ws(" ", *sums).alias("digest"),
        )
        .filter(F.length("header") > 0)
    )


def _opens(line: Column) -> Column:
    """Whether a quoted value begins in the line and does not end there. A quote inside an
    unquoted value, as in ``O"Neil``, opens nothing."""
    return F.contains(line, F.lit('"')) & F.regexp_replace(line, _CLOSED, "$1").rlike('(^|,)"')


def read_inspected(spark: SparkSession, files: Iterable[Row]) -> DataFrame:
    """The rows of files that ``inspected`` lists, by column name, with the path in ``_file``."""
    groups: dict[tuple[str, bool], list[str]] = {}
    for row in files:
        groups.setdefault((row["header"], row["whole"]), []).append(literal(unquote(row["path"])))
    parts = [_read_group(spark, header, whole, sorted(paths)) for (header, whole), paths in sorted(groups.items())]
    if not parts:
        return spark.createDataFrame([], f"{MANUAL_SCHEMA}, _file string")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def undecodable(spark: SparkSession, glob: str | list[str]) -> DataFrame:
    """``path`` and ``reason`` of the compressed files that end early or are damaged.

    Such a file cannot be split anyway; each is decompressed piece by piece in one task. An
    error of the store is none of the file and fails the job.
    """

    def damage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        openers = {".gz": gzip.open, ".bz2": bz2.open}
        for batch in batches:
            found = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with openers[os.path.splitext(path)[1]](io.BytesIO(content)) as stream:
                        while stream.read(1 << 20):
                            pass
                except (EOFError, OSError, zlib.error) as error:
                    found.append((path, str(error)))
            yield pd.DataFrame(found, columns=["path", "reason"])

    reader = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.{gz,bz2}")
    return reader.load(glob).select("path", "content").mapInPandas(damage, "path string, reason string")


def literal(path: str) -> str:
    """A path as the readers take it, whatever signs its name holds."""
    return re.sub(r"([][{}*?\\])", r"\\\1", path)


def _other_paths(spark: SparkSession, glob: str, bad: set[str]) -> list[str]:
    """The files that match, without the bad ones; listed as the reader lists them."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true").load(glob).select("path")
    return [literal(row["path"]) for row in files.toLocalIterator() if row["path"] not in bad]


def _read_group(spark: SparkSession, header: str, whole: bool, paths: list[str]) -> DataFrame:
    names = column_names(header)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    reader = spark.read.schema(schema).options(**_CSV, emptyValue=_EMPTY, multiLine=str(whole).lower())
    # The path comes percent-encoded, but with "+" as it is.
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return _with_empty(reader.csv(paths).select(*[f"`{name}`" for name in names], path.alias("_file")))


def column_names(header: str) -> list[str]:
    """The names in a header line; a repeated or missing one gets a number."""
    names: list[str] = []
    for number, name in enumerate(next(csv.reader([header.lstrip("\ufeff")]))):
        name = name.strip().replace("`", "") or f"Unnamed: {number}"
        repeats = sum(known.split(".")[0] == name for known in names)
        names.append(f"{name}.{repeats}" if repeats else name)
    return names


def back_up_once(spark: SparkSession, source: str, folder: str) -> bool:
    """Keeps a copy of the unrepaired file or folder, byte for byte, unless one exists."""
    if exists(spark, folder):
        return False
    copy(spark, source, folder)
    return True
