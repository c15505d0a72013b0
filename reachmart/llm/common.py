"""Helpers of the operators in this subpackage."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reachmart.session import scratch_dir

# Characters that separate words, as a regular expression class of Java, Python and RE2.
BREAKS = r"[\x20\x09-\x0D]"

FOLDS = 5


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Writes a table to the shared scratch folder and reads it back, which cuts its lineage."""
    path = scratch_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Whether a row is in the fold that nothing is learned from; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """Whether labels of a row may be learned from; never those of a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS != 0, F.lit(False))


def unit(*parts: Column | str) -> Column:
    """A number from 0 (included) to 1 (excluded), fixed by the text of the parts."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(docs: DataFrame, without: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, str]]:
    """The table with its columns under numbers, so that none can clash with a column that
    an operator adds; and the number of each name that is not in ``without``."""
    place = {name: f"_{i}" for i, name in enumerate(docs.columns) if name not in without}
    return docs.select(*[quoted(name).alias(number) for name, number in place.items()]), place


def renamed(frame: DataFrame, place: dict[str, str], *added: str) -> DataFrame:
    """The reverse of ``numbered``, with the added columns behind."""
    return frame.select(*[F.col(number).alias(name) for name, number in place.items()], *added)


def join_by(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Joins a skewed table to one with a row per key.

    The hash beside the key makes both sides come straight from a shuffle, which is what
    adaptive execution needs to split the run of a hot key.
    """
    salted = right.withColumn("_hash", F.xxhash64(key))
    joined = left.withColumn("_hash", F.xxhash64(key)).join(salted, ["_hash", key], how)
    return joined.drop("_hash")


class _WithClass:
    """A value pickled along with its class, which is the value itself once it is read back.
    The driver holds the bytes alone."""

    def __init__(self, value):
        self.pickled = cloudpickle.dumps(value)

    def __reduce__(self):
        return pickle.loads, (self.pickled,)


def shared(spark: SparkSession, value) -> Broadcast:
    """Sends a value of bounded size to the executors, its class along with it."""
    return spark.sparkContext.broadcast(_WithClass(value))


def received(sent: Broadcast):
    """The value as a Python worker holds it, once for all its tasks."""
    return sent.value


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[pa.Table]:
    """Whole groups of a stream that is sorted by ``keys``: tables of some groups each.

    A table is given out once it has ``most`` rows; a group is never cut.
    """
    import numpy as np

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < most:
            continue
        whole = pa.Table.from_batches(held)
        change = np.zeros(rows, bool)
        for key in keys:
            values = whole.column(key).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(change)
        if len(starts):
            cut = int(starts[-1])
            begin = 0
            for at in [*[int(s) for s in starts], cut]:
                if at - begin >= most or at == cut and at > begin:
                    yield whole.slice(begin, at - begin)
                    begin = at
            held = whole.slice(cut).to_batches()
            rows -= cut
    if rows:
        yield pa.Table.from_batches(held)
