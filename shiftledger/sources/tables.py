"""Stored tables as Parquet folders, staged before they are published.

A plan never overwrites a path it reads. Entries are partitioned by the UTC day of
their start, so an hourly sync rewrites two days of data and not a month. A publish
writes the days concerned under a new version and then one small manifest, which says for each
day which version holds it, and which parts the index of ids has. Readers follow the newest complete manifest: until it is
there they see the state before, so a publish that is cut short at any point changes nothing. Manifests are numbered from
the state a run has read, so of two runs on one state the second fails instead of undoing the first.

The reference tables are small next to them; each run writes a new snapshot folder and
readers take the newest complete one.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, date, datetime
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger.operators import increments
from shiftledger.operators.windows import PARTITION, with_partition
from shiftledger.session import shared_dir
from shiftledger.sources import day_index, usage_sums
from shiftledger.sources.day_index import STORED_DAY
from shiftledger.sources.parts import Part

SNAPSHOT = "snapshot"
ROWS_PER_FILE = 5_000_000
#: Seconds after which a publish that has not ended counts as dead.
LEASE = 3600
#: Rows without a kind are from before there were kinds: days.
_MANIFEST = "kind STRING, day DATE, version STRING, place INT, rows LONG"
_SCHEMAS = {"users": model.USERS, "clients": model.CLIENTS, "projects": model.PROJECTS}


def stage(spark: SparkSession, df: DataFrame, name: str, run_id: str) -> DataFrame:
    """Write a result once and read it back: cut lineage, exact statistics.

    Later uses scan the staged files instead of repeating the work, survive lost
    executors, and are planned with the true size, which decides broadcasts.
    """
    # Each attempt of each store gets a folder of its own; nothing staged is ever overwritten.
    path = f"{shared_dir(spark)}/staged/{run_id}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(spark: SparkSession, df: DataFrame, name: str, run_id: str, **figures: Column) -> tuple[DataFrame, dict]:
    """Like ``stage``, with figures (aggregates) of the rows taken while they are written: no further job, no further scan."""
    watch = Observation()
    staged = stage(spark, df.observe(watch, *[f.alias(k) for k, f in figures.items()]), name, run_id)
    # A plan without rows may end without figures.
    return staged, {k: 0 for k in figures} | watch.get


class PublishConflict(RuntimeError):
    """Another run has published since the state that a publish builds on."""


class Held(NamedTuple):
    """A state of the entries: the manifest's number, the version that holds each day, the parts of the day index and of the sums."""

    number: int
    days: dict[date, str]
    index: list[Part]
    sums: list[Part]


class Tables:
    """The stored tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # -- reference tables --

    def read(self, name: str) -> DataFrame:
        """Newest snapshot of users, clients or projects; empty before the first."""
        schema = _SCHEMAS[name]
        path = f"{self.root}/{name}"
        newest = self.newest(path)
        if newest is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{path}/{SNAPSHOT}={newest}")

    def publish(self, name: str, df: DataFrame, run_id: str) -> None:
        """Write the next snapshot.

        ``run_id`` must not sort before the newest one. Each attempt gets a
        folder of its own, so ``df`` may read any earlier snapshot, and a
        repeated run never overwrites what it reads.
        """
        columns = [f.name for f in _SCHEMAS[name].fields]
        path = f"{self.root}/{name}"
        taken = self._snapshots(path)
        newest = max(taken, default="")
        if f"{run_id}.999" < newest:
            raise ValueError(f"run {run_id} is older than the stored {name} ({newest})")
        attempt = sum(t.startswith(f"{run_id}.") for t in taken)
        df.select(*columns).write.mode("errorifexists").parquet(f"{path}/{SNAPSHOT}={run_id}.{attempt:03d}")

    def _snapshots(self, path: str) -> list[str]:
        """Ids of all snapshots, complete or not."""
        if not self._exists(path):
            return []
        folder, system = self._folder(path)
        names = [str(status.getPath().getName()) for status in system.listStatus(folder)]
        return [n.removeprefix(f"{SNAPSHOT}=") for n in names if n.startswith(f"{SNAPSHOT}=")]

    def newest(self, path: str) -> str | None:
        """Id of the newest complete snapshot."""
        done = [r for r in self._snapshots(path) if self._exists(f"{path}/{SNAPSHOT}={r}/_SUCCESS")]
        return max(done, default=None)

    # -- entries --

    def held(self) -> Held:
        """What the newest manifest says; a run reads it once and publishes against it."""
        path = f"{self.root}/entries_manifest"
        found = self.newest(path)
        if found is None:
            return Held(-1, {}, [], [])
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{path}/{SNAPSHOT}={found}").collect()

        def parts(kind: str) -> list[Part]:
            found = sorted((r["place"], r["version"], r["rows"]) for r in rows if r["kind"] == kind)
            return [Part(version, n) for _, version, n in found]

        days = {r["day"]: r["version"] for r in rows if r["day"] is not None}
        return Held(int(found), days, parts("index"), parts("sums"))

    def read_entries(self, held: Held | None = None) -> DataFrame:
        """Stored entries with the partition column; empty before the first publish."""
        held = held or self.held()
        if not held.days:
            return with_partition(self.spark.createDataFrame([], model.ENTRIES))
        path = f"{self.root}/entries"
        days = [f"{path}/version={version}/{PARTITION}={day.isoformat()}" for day, version in held.days.items()]
        reader = self.spark.read.schema(f"{ddl(model.ENTRIES)}, {PARTITION} DATE").option("basePath", path)
        return reader.parquet(*days).drop("version")

    def locate(self, ids: DataFrame, held: Held | None = None) -> DataFrame:
        """(source_id, stored_day) of those ids that are stored, from the day index."""
        held = held or self.held()
        if held.index:
            return day_index.lookup(self.spark, f"{self.root}/entries_index", held.index, ids)
        # A store from before the index, or an empty one.
        stored = self.read_entries(held).select("source_id", F.col(PARTITION).alias(STORED_DAY))
        return stored.join(ids.select("source_id"), "source_id", "left_semi")

    def read_sums(self, held: Held | None = None) -> DataFrame:
        """Hours by user, project, month and cycle of all stored entries, from the stored sums."""
        held = held or self.held()
        if held.sums or not held.days:
            return usage_sums.read(self.spark, f"{self.root}/usage_sums", held.sums)
        # A store from before the sums.
        return increments.usage_sums(self.read_entries(held))

    def days_of(self, placed: DataFrame, held: Held, start: datetime | None) -> list[date]:
        """Partitions a merge can touch: days of incoming rows, days where an incoming id is stored now (an edit may
        move an entry), and stored days of the ghost window.

        ``placed`` are incoming rows with ``stored_day``. The result is one row per day.
        """
        incoming = with_partition(placed).select(F.col(PARTITION).alias("day"))
        days = incoming.unionByName(placed.select(F.col(STORED_DAY).alias("day"))).where("day IS NOT NULL")
        touched = {row[0] for row in days.distinct().collect()}
        if start is not None:
            first = start.astimezone(UTC).date()
            touched |= {day for day in held.days if day >= first}
        return sorted(touched)

    def publish_entries(
        self,
        staged: DataFrame,
        days: list[date],
        rows_per_file: int = ROWS_PER_FILE,
        held: Held | None = None,
        moved: DataFrame | None = None,
        changed: DataFrame | None = None,
    ) -> None:
        """Replace ``days`` by the staged rows, which are their complete next state.

        Each day is cut into slices by a hash of the id, one file per slice: no
        tiny files, and a day holding a large part of all rows is many tasks.
        ``held`` is the state the rows were computed from; if another run has published since, ``PublishConflict`` is raised
        and nothing changes. ``moved`` are the ids that are new or have changed their day (source_id, day), ``changed`` the changed
        entries with their state ``before``; without them both are found from the days' stored rows.
        """
        held = held or self.held()
        columns = [f.name for f in model.ENTRIES.fields]
        rows = with_partition(staged.select(*columns))
        sizes = rows.groupBy(PARTITION).agg(F.ceil(F.count("*") / rows_per_file).alias("_slices"))
        filled = {row[0] for row in sizes.select(PARTITION).collect()}
        if None in filled:
            raise ValueError("an entry without a start cannot be stored")
        version = uuid4().hex
        with self.claim("entries_manifest", held.number + 1):
            (
                # One row per day: a bounded side.
                rows.join(F.broadcast(sizes), PARTITION)
                .withColumn("_slice", F.pmod(F.xxhash64("source_id"), F.col("_slices")))
                .repartition(PARTITION, "_slice")
                .select(*columns, PARTITION)
                .write.partitionBy(PARTITION)
                .parquet(f"{self.root}/entries/version={version}")
            )
            index = day_index.add(self.spark, f"{self.root}/entries_index", held.index, self._moved(rows, days, held, moved))
            sums = usage_sums.add(self.spark, f"{self.root}/usage_sums", held.sums, self._changes(rows, days, held, changed, version))
            now = {day: v for day, v in held.days.items() if day not in set(days)} | {day: version for day in filled}
            rows_now = self._manifest_rows(Held(held.number + 1, now, index, sums))
            rows_now.coalesce(1).write.parquet(f"{self.root}/entries_manifest/{SNAPSHOT}={held.number + 1:012d}")

    def _moved(self, rows: DataFrame, days: list[date], held: Held, moved: DataFrame | None) -> DataFrame:
        """What the day index has to learn (source_id, day)."""
        if moved is not None and (held.index or not held.days):
            return moved
        unknown = rows.select("source_id", F.col(PARTITION).alias("day"))
        if held.days and not held.index:
            # A store from before the index: all of it is new to the index.
            rest = self.read_entries(held).where(~F.col(PARTITION).isin(days))
            unknown = unknown.unionByName(rest.select("source_id", F.col(PARTITION).alias("day")))
        return unknown

    def _changes(self, rows: DataFrame, days: list[date], held: Held, changed: DataFrame | None, run: str) -> DataFrame:
        """Signed sums that the stored sums have to take up, staged."""
        if held.days and not held.sums:
            rest = self.read_entries(held).where(~F.col(PARTITION).isin(days)).select(increments.COUNTED)
            sums = increments.usage_sums(rest.unionByName(rows.select(increments.COUNTED)))
        elif changed is not None:
            sums = increments.changed_sums(changed)
        else:
            gone = increments.usage_sums(self.read_entries(held).where(F.col(PARTITION).isin(days)))
            less = gone.select(*increments.KEYS, *[(-F.col(c)).alias(c) for c in ("sum_s", "sum_us", "n")])
            sums = increments.added([increments.usage_sums(rows), less], drop_empty=False)
        return stage(self.spark, sums, "sums", run)

    def _manifest_rows(self, held: Held) -> DataFrame:
        days = [("day", day, version, None, None) for day, version in sorted(held.days.items())]
        kinds = (("index", held.index), ("sums", held.sums))
        parts = [(kind, None, p.version, place, p.rows) for kind, of in kinds for place, p in enumerate(of)]
        return self.spark.createDataFrame([*days, *parts], _MANIFEST)

    @contextmanager
    def claim(self, manifest: str, number: int) -> Iterator[None]:
        """Hold a manifest number while it is written: of two runs that read the same state, one fails.

        A claim is a file that only one writer can create. It goes when the publish fails; one that was left by a dead writer
        can be taken over after ``LEASE`` seconds.
        """
        path = f"{self.root}/{manifest}/claims/{number:012d}"
        file, system = self._folder(path)
        if not system.createNewFile(file):
            age = time.time() - system.getFileStatus(file).getModificationTime() / 1000
            done = self._exists(f"{self.root}/{manifest}/{SNAPSHOT}={number:012d}/_SUCCESS")
            if done or age < LEASE:
                raise PublishConflict(f"another run has published {manifest} {number}, or is about to; run again on the new state")
            system.delete(file, False)
            if not system.createNewFile(file):
                raise PublishConflict(f"another run has taken over {manifest} {number}")
            # What the dead writer left of this manifest was never complete.
            system.delete(self._folder(f"{self.root}/{manifest}/{SNAPSHOT}={number:012d}")[0], True)
        try:
            yield
        except BaseException:
            system.delete(file, False)
            raise

    def _folder(self, path: str):
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        folder, system = self._folder(path)
        return system.exists(folder)


def ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def send_batches(batches: DataFrame, send) -> None:
    """Hand each batch to ``send(records)`` on the executors.

    The sender must be repeatable: a lost task is run again.
    """

    def deliver(rows):
        for row in rows:
            send(row["records"])

    batches.select("records").foreachPartition(deliver)
