"""The master table of readings: append-only batches, last one wins on read.

An upsert writes only the incoming rows, into a folder of its own, and then commits: it adds the next number to the
ledger, a folder with one small file per finished batch. What is not listed is not read, so a failed run leaves
nothing behind. A commit is accepted only if its number is still free, so it always follows from the state it was
computed on; a writer that comes second looks at the new state and tries again with the rows it has already
written. A snapshot replaces all numbers up to its base. The base of a compaction is the state it has read, so
batches that are committed meanwhile stay.
"""

from __future__ import annotations

import json
import secrets
from collections import Counter
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.normalize import keep_last
from barograph.params import SENSORS
from barograph.sources.csvfiles import scan_readings

_COMMITS = "number long, base long, epoch long, batch long, source string, source_batch long, new_rows long, " \
    "total_rows long, write long, days array<date>"
KEYS = ("station", "timestamp")


class CommitConflict(RuntimeError):
    """Other writers have come first as often as a writer tries."""


@dataclass(frozen=True)
class State:
    """The ledger at one moment: its last number, the last snapshot's, and the batches that count, oldest first."""

    number: int = -1
    snapshot: int = -1
    epoch: int = 0
    batch: int = -1
    total: int = 0
    live: tuple = ()

    def shared_days(self) -> list[date]:
        """Days with rows in more than one batch."""
        return sorted(day for day, times in Counter(d for row in self.live for d in row["days"]).items() if times > 1)

    def known_days(self) -> set[date]:
        return {d for row in self.live for d in row["days"]}


@dataclass(frozen=True)
class MasterTable:
    """Readings keyed by (station, timestamp) below ``root``; a writer tries to commit ``attempts`` times."""

    root: str
    sensors: tuple[str, ...] = SENSORS
    attempts: int = 50

    @property
    def _schema(self) -> str:
        sensors = ", ".join(f"`{s}` double" for s in self.sensors)
        return f"station string, timestamp timestamp_ntz, {sensors}, write long, day date"

    def commits(self, spark: SparkSession) -> DataFrame:
        """The ledger: one row per finished batch with new and total rows; snapshots have a base."""
        try:
            return spark.read.schema(_COMMITS).json(f"{self.root}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], _COMMITS)

    def state(self, spark: SparkSession) -> State:
        """The current state; the driver sees the batches since the last snapshot."""
        done = self.commits(spark)
        last = done.agg(F.max("number").alias("number"), F.max(F.when(F.col("base").isNotNull(), F.col("number"))).alias(
            "snapshot"), F.max_by("base", F.when(F.col("base").isNotNull(), F.col("number"))).alias("base")).first()
        if last["number"] is None:
            return State()
        own = -1 if last["snapshot"] is None else last["snapshot"]
        later = (F.col("number") > (-1 if last["base"] is None else last["base"])) & F.col("base").isNull()
        # A commit after the first query is left for the next look at the ledger.
        rows = done.filter((F.col("number") <= last["number"]) & (later | (F.col("number") == own))).collect()
        live = sorted(rows, key=lambda r: (r["base"] is None, r["number"]))
        newest = max(live, key=lambda r: (r["epoch"], r["batch"]))
        total = sum(r["new_rows"] for r in live)
        return State(last["number"], own, newest["epoch"], newest["batch"], total, tuple(live))

    def total(self, spark: SparkSession) -> int:
        """Keys in the table, by the ledger."""
        return self.state(spark).total

    def _scan(self, spark: SparkSession, state: State) -> DataFrame:
        """Rows of the batches that count; ``place`` orders these."""
        if not state.live:
            return spark.createDataFrame([], self._schema).withColumn("place", F.lit(0).cast("long"))
        data = f"{self.root}/data"
        paths = [f"{data}/write={row['write']}" for row in state.live]
        rows = spark.read.schema(self._schema).option("basePath", data).parquet(*paths)
        place = spark.createDataFrame([(r["write"], i) for i, r in enumerate(state.live)], "write long, place long")
        return rows.join(F.broadcast(place), "write")  # one row per batch since the last snapshot

    def read(self, spark: SparkSession, state: State | None = None) -> DataFrame:
        """Current readings, one row per station and time.

        Keys are unique within a batch, so only the days that several batches hold are searched for
        repeated keys; the other days are read as they are, without a shuffle.
        """
        state = state or self.state(spark)
        rows, shared = self._scan(spark, state), state.shared_days()
        columns = [*KEYS, *self.sensors]
        if not shared:
            return rows.select(*columns)
        several = F.col("day").isin(shared)
        last = keep_last(rows.filter(several).select(*columns, "place"), KEYS, ("place",))
        return rows.filter(~several).select(*columns).unionByName(last.select(*columns))

    def _write(self, df: DataFrame) -> tuple[int, DataFrame, dict[date, int]]:
        """Write rows into a new folder: its number, the rows as written, and their count per day."""
        write = secrets.randbits(62)
        path = f"{self.root}/data/write={write}"
        # A hash as order keeps the aggregate on fixed-width columns; frames grouped by the keys are not shuffled again.
        rows = df.select(*KEYS, *self.sensors).dropna(subset=list(KEYS)).withColumn("_hash", F.xxhash64(*self.sensors))
        out = keep_last(rows, KEYS, ("_hash",)).drop("_hash").withColumn("day", F.to_date("timestamp"))
        # Few files per day; adaptive execution splits a day that is heavy.
        out.hint("rebalance", "day").write.partitionBy("day").parquet(path)
        written = df.sparkSession.read.schema(out.schema).parquet(path)
        return write, written, {r["day"]: r["count"] for r in written.groupBy("day").count().collect()}

    def _commit(self, spark: SparkSession, number: int, **row) -> bool:
        """Add a commit under a number; False if another writer has taken it.

        The file is written under another name and renamed, which fails if the name is taken: the file system
        must refuse that, as it must for checkpoints of streams.
        """
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        paths = jvm.org.apache.hadoop.fs
        draft = paths.Path(f"{self.root}/commits/.{secrets.token_hex(8)}")
        name = paths.Path(f"{self.root}/commits/{number:012d}.json")
        files = draft.getFileSystem(conf)
        out = files.create(draft, False)
        out.write(json.dumps({"number": number, **row}, default=str).encode())
        out.close()
        kind = getattr(paths, "Options$Rename")
        how = spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        try:
            paths.FileContext.getFileContext(files.getUri(), conf).rename(files.makeQualified(draft), files.makeQualified(name), how)
            return True
        except Py4JJavaError as error:
            files.delete(draft, False)
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False

    def replace(self, df: DataFrame, source: str = "snapshot") -> int:
        """Make ``df`` the whole table; an empty one changes nothing. Returns its rows.

        Batches committed before it are gone, also those committed while it was written.
        """
        spark = df.sparkSession
        write, _, days = self._write(df)
        rows = sum(days.values())
        if not rows:
            return 0
        for _ in range(self.attempts):
            state = self.state(spark)
            if self._commit(
                spark, state.number + 1, base=state.number, epoch=state.epoch + bool(state.live), batch=0, source=source,
                new_rows=rows, total_rows=rows, write=write, days=sorted(days),
            ):
                return rows
        raise CommitConflict(f"no free number in {self.attempts} attempts")

    def upsert(self, df: DataFrame, source: str = "stream", source_batch: int | None = None) -> int:
        """Add ``df``; incoming rows win. Returns the number of new keys.

        A batch of the same source that is already committed is skipped, so a
        stream may repeat it. Known keys are looked up in the days of the batch only. Rows without station or time are
        dropped; of rows with one key one stays, the same whatever their order.
        """
        spark = df.sparkSession
        if self._holds(spark, source, source_batch):
            return 0
        write, written, days = self._write(df)
        if not days:
            return 0
        for _ in range(self.attempts):
            state = self.state(spark)
            if self._holds(spark, source, source_batch):
                return 0
            new_rows = self._new_keys(spark, state, written, days)
            if self._commit(
                spark, state.number + 1, epoch=state.epoch, batch=state.batch + 1, source=source, source_batch=source_batch,
                new_rows=new_rows, total_rows=state.total + new_rows, write=write, days=sorted(days),
            ):
                return new_rows
        raise CommitConflict(f"no free number in {self.attempts} attempts")

    def _holds(self, spark: SparkSession, source: str, source_batch: int | None) -> bool:
        if source_batch is None:
            return False
        done = (F.col("source") == source) & (F.col("source_batch") == source_batch)
        return not self.commits(spark).filter(done).isEmpty()

    def _new_keys(self, spark: SparkSession, state: State, written: DataFrame, days: dict[date, int]) -> int:
        """Keys of a batch that the table doesn't hold; days that it has no rows of are only counted."""
        both = sorted(state.known_days() & set(days))
        apart = sum(rows for day, rows in days.items() if day not in set(both))
        if not both:
            return apart
        keys = written.filter(F.col("day").isin(both)).select(*KEYS)
        known = self._scan(spark, state).filter(F.col("day").isin(both)).select(*KEYS)
        return apart + keys.join(known, list(KEYS), "left_anti").count()

    def compact(self, spark: SparkSession) -> int:
        """Rewrite the current rows as a single batch; returns their number.

        Batches that are committed meanwhile stay as they are. After a snapshot that came meanwhile it starts again.
        """
        for _ in range(self.attempts):
            read = self.state(spark)
            write, _, days = self._write(self.read(spark, read))
            rows = sum(days.values())
            if not rows:
                return 0
            for _ in range(self.attempts):
                state = self.state(spark)
                if state.snapshot != read.snapshot:
                    break
                later = sum(r["new_rows"] for r in state.live if r["number"] > read.number)
                if self._commit(
                    spark, state.number + 1, base=read.number, epoch=state.epoch + 1, batch=0, source="compact",
                    new_rows=rows, total_rows=rows + later, write=write, days=sorted(days),
                ):
                    return rows
        raise CommitConflict(f"no free number in {self.attempts} attempts")


def ingest(
    spark: SparkSession,
    master: MasterTable,
    stream_path: str,
    snapshot_path: str | None = None,
    replace_master: bool = True,
) -> DataFrame:
    """Load the snapshot if it has rows, else the stream folder, and return the master.

    A snapshot replaces the master (or is merged, by flag); the stream folder is
    always merged. With no input at all the stored master is returned as it is.
    """
    snapshot = scan_readings(spark, snapshot_path, master.sensors, "*") if snapshot_path else None
    if snapshot is not None and not snapshot.isEmpty():
        master.replace(snapshot) if replace_master else master.upsert(snapshot, "snapshot")
    else:
        incoming = scan_readings(spark, stream_path, master.sensors)
        master.upsert(incoming)
    return master.read(spark)


def count_new_keys(incoming: DataFrame, existing: DataFrame, keys) -> DataFrame:
    """One row: how many incoming keys the existing table does not hold, and the total after."""
    keys = list(keys)
    marked = incoming.select(*keys, F.lit(0).alias("_known")).unionByName(
        existing.select(*keys, F.lit(1).alias("_known"))
    )
    seen = marked.groupBy(*keys).agg(F.max("_known").alias("_known"))
    return seen.agg(
        F.count(F.when(F.col("_known") == 0, 1)).alias("new_records"), F.count(F.lit(1)).alias("total_records")
    )
