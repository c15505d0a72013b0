"""The ledger's keys as an index, so that a batch reads what concerns it and no more.

``compact`` turns the run folders into one table of keys, dealt by a hash of kind and key into
buckets, sorted, with Bloom filters. A batch asks it once for all kinds of keys: its own keys
name the buckets, and a small batch's keys reach the files' statistics and Bloom filters.
Runs recorded since then are read from their folders.

Each compaction writes a generation of its own and then a state that names it; readers use
the last complete state, so one that dies halfway leaves the generation before it in use. A
run that is recorded again after it was compacted is marked in a new state first: from then
on its folder counts, not its keys in the table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reachmart.operators.key_join import join_keys
from reachmart.operators.sent_keys import with_key
from reachmart.session import scratch_dir
from reachmart.sources.files import children, delete, exists

KINDS = {"customer_id": "id", "email": "email"}
FEW = 1_000  # keys of a batch that are sent along with the filter of the scan
BUCKET_ROWS = 1_000_000


@dataclass
class State:
    """The generation in use, its number of buckets, its runs, and those that no longer count."""

    number: int = 0
    generation: int = 0
    buckets: int = 0
    runs: set[str] = field(default_factory=set)
    stale: set[str] = field(default_factory=set)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("kind", "key"), F.lit(buckets)).cast("int")


def keys_of(rows: DataFrame, columns: list[str], *others: str) -> DataFrame:
    """Columns ``kind`` and ``key`` and ``others``: a row for each key that is there."""
    for column in columns:
        rows = with_key(rows, column)
    pairs = [F.struct(F.lit(KINDS[c]).alias("kind"), F.col(c).cast("string").alias("key")) for c in columns]
    keys = rows.select(*others, F.inline(F.array(*pairs)))
    return keys.filter(F.col("key").isNotNull()).distinct()


class KeyIndex:
    def __init__(self, spark: SparkSession, folder: str, buckets: int = 16):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    # --- states -------------------------------------------------------------------------

    def state(self) -> State:
        """The last complete state; the runs it lists come to the driver, one name each."""
        names = children(self.spark, self.folder) if exists(self.spark, self.folder) else []
        for name in sorted((n for n in names if n.startswith("state-")), reverse=True):
            path = f"{self.folder}/{name}"
            if exists(self.spark, f"{path}/_SUCCESS"):
                rows = self.spark.read.parquet(path).collect()
                listed = [r for r in rows if r["run_id"] is not None]
                return State(
                    int(name.removeprefix("state-")),
                    rows[0]["generation"],
                    rows[0]["buckets"],
                    {r["run_id"] for r in listed if not r["stale"]},
                    {r["run_id"] for r in listed if r["stale"]},
                )
        return State()

    def _commit(self, state: State) -> None:
        runs = [(r, r in state.stale) for r in sorted(state.runs | state.stale)] or [(None, False)]
        rows = [(state.generation, state.buckets, run, stale) for run, stale in runs]
        schema = "generation int, buckets int, run_id string, stale boolean"
        frame = self.spark.createDataFrame(rows, schema).coalesce(1)
        # Two writers of the same state do not both win: the folder may not be there yet.
        frame.write.mode("error").parquet(f"{self.folder}/state-{state.number:08d}")

    def forget(self, run_id: str) -> None:
        """Called before a run's folder is replaced."""
        state = self.state()
        if run_id in state.runs:
            runs, stale = state.runs - {run_id}, state.stale | {run_id}
            self._commit(State(state.number + 1, state.generation, state.buckets, runs, stale))

    # --- the table ----------------------------------------------------------------------

    def _path(self, generation: int) -> str:
        return f"{self.folder}/keys-{generation:08d}"

    def _kept(self, state: State, leave: set[str]) -> DataFrame:
        table = self.spark.read.schema("kind string, key string, run_id string, bucket int").parquet(self._path(state.generation))
        leave = sorted(state.stale | leave)
        return table.filter(~F.col("run_id").isin(leave)) if leave else table

    def _tail(self, state: State, rows: DataFrame) -> DataFrame:
        """Rows of runs that the table does not have; other runs' folders are not read."""
        return rows.filter(~F.col("run_id").isin(sorted(state.runs))) if state.runs else rows

    def compact(self, rows: DataFrame) -> None:
        """Takes the keys of all runs of the ledger (``rows``) into a new generation."""
        state = self.state()
        tail = self._tail(state, rows)
        added = {r["run_id"] for r in tail.select("run_id").distinct().collect()}
        if not added and not state.stale:
            return
        keys = keys_of(tail, list(KINDS), "run_id")
        if state.generation:
            keys = keys.unionByName(self._kept(state, set()).drop("bucket"))
        # An unfinished generation may be there under the next number.
        generation = state.generation + 1
        while exists(self.spark, self._path(generation)):
            generation += 1
        work = scratch_dir(self.spark, "keys")
        keys.write.parquet(work)
        keys = self.spark.read.parquet(work)
        buckets = max(self.buckets, -(-keys.count() // BUCKET_ROWS))
        dealt = keys.withColumn("bucket", _bucket(buckets)).repartition(buckets, "bucket")
        (
            dealt.sortWithinPartitions("bucket", "kind", "key")
            .write.partitionBy("bucket")
            .option("parquet.bloom.filter.enabled#key", "true")
            .parquet(self._path(generation))
        )
        self._commit(State(state.number + 1, generation, buckets, state.runs | added, set()))
        # Readers may still be at the generation before; those before it have none.
        for name in children(self.spark, self.folder):
            if name.startswith("keys-") and int(name.removeprefix("keys-")) < state.generation:
                delete(self.spark, f"{self.folder}/{name}")

    def hits(self, entries: DataFrame, rows: DataFrame, columns: list[str], except_run: str | None = None) -> DataFrame:
        """The keys of ``entries`` that were sent, as ``kind`` and ``key``; ``rows`` is the ledger."""
        state = self.state()
        leave = {except_run} if except_run else set()
        wanted = keys_of(entries, columns)
        tail = self._tail(state, rows)
        known = keys_of(tail.filter(F.col("run_id") != except_run) if except_run else tail, columns)
        if state.generation:
            table = self._kept(state, leave).filter(F.col("kind").isin([KINDS[c] for c in columns]))
            few = wanted.withColumn("bucket", _bucket(state.buckets)).limit(FEW + 1).collect()
            if len(few) <= FEW:
                table = table.filter(F.col("bucket").isin(sorted({r["bucket"] for r in few})))
                table = table.filter(F.col("key").isin(sorted({r["key"] for r in few})))
            known = known.unionByName(table.select("kind", "key"))
        return wanted.join(known, ["kind", "key"], "left_semi")

    def unsent(self, entries: DataFrame, rows: DataFrame, columns: list[str], except_run: str | None = None) -> DataFrame:
        """Entries none of whose key columns was sent.

        The sent keys among the batch's own are written once and then joined for each kind,
        so the ledger is read once. A missing key matches nothing and keeps its entry.
        """
        path = scratch_dir(self.spark, "hits")
        self.hits(entries, rows, columns, except_run).write.parquet(path)
        found = self.spark.read.schema("kind string, key string").parquet(path)
        for column in columns:
            keys = found.filter(F.col("kind") == KINDS[column]).select("key")
            entries = join_keys(entries, F.col(column), keys, "left_anti")
        return entries
