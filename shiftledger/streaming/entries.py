"""Time entries as a stream of extract files.

Edits arrive as repeated ids, so the sync merges each micro-batch by key. What
vanished from the tracker cannot be seen in an append-only stream; the sync job
with a long look-back finds it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shiftledger import model
from shiftledger.operators.upsert import unique_rows
from shiftledger.plans.common import RunFailed, merge_entries, run_id
from shiftledger.plans.runs import recorded
from shiftledger.sources.extracts import CORRUPT, QUARANTINE, check_entries
from shiftledger.sources.tables import Tables, stage

ARRIVAL = "arrival"


def read_entry_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Nested entries of JSON-lines files as they appear, with their order of arrival."""
    reader = (
        spark.readStream.schema(f"{model.ENTRY_EXTRACT}, {CORRUPT} STRING")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).withColumn(
        ARRIVAL, F.struct("_metadata.file_modification_time", "_metadata.file_name")
    )


def merge_batch(
    tables: Tables, batch: DataFrame, batch_id: int, clock: Callable[[], datetime], rejected_path: str
) -> int:
    """Merge one micro-batch: last arrival per id wins. Returns how many rows were set aside.

    Repeating a batch changes nothing: the merge is by key, and staged data and
    rejected rows are written under the batch id.
    """
    run_ts = _batch_time(tables.spark, f"{rejected_path}-times/batch={batch_id}", clock)
    run = f"stream-{batch_id:012d}"
    raw = stage(tables.spark, batch, "raw", run)
    json_fine = {"json": F.col(CORRUPT).isNull()}
    checked = check_entries(raw, QUARANTINE, json_fine, keep=(ARRIVAL,))
    watch = Observation()
    rejected = checked.rejected.observe(watch, F.count(F.lit(1)).alias("rows"))
    rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch={batch_id}")
    last = unique_rows(checked.valid, "source_id", F.col(ARRIVAL)).drop(ARRIVAL)
    extract = stage(tables.spark, last, "extract", run)
    if not extract.isEmpty():
        merge_entries(tables, extract, f"{run}-{run_id(run_ts, 'merge')}", run_ts)
    return watch.get.get("rows", 0)


def _batch_time(spark: SparkSession, path: str, clock: Callable[[], datetime]) -> datetime:
    """The time a batch was first tried: a repeated batch stamps its rows as the first attempt did."""
    try:
        found = spark.read.schema("run_ts TIMESTAMP").parquet(path).first()
    except AnalysisException:
        found = None
    if found is None:
        spark.createDataFrame([(clock(),)], "run_ts TIMESTAMP").coalesce(1).write.mode("overwrite").parquet(path)
        found = spark.read.schema("run_ts TIMESTAMP").parquet(path).first()
    return found["run_ts"].astimezone(UTC)


def require_no_rejects(spark: SparkSession, rejected_path: str) -> None:
    """Fail when any batch so far has rejected rows; call it after the stream has taken up what there is."""
    rejects = spark.read.parquet(rejected_path).count()
    if rejects:
        raise RunFailed(f"{rejects} unreadable rows were set aside in {rejected_path}")


def start_entry_sync(
    stream: DataFrame,
    tables: Tables,
    checkpoint: str,
    rejected_path: str,
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
    merged: Callable[[int, int], None] = lambda batch_id, rejected: None,
) -> StreamingQuery:
    """Merge everything that has arrived, then stop; ``run_entry_sync`` also waits and fails after rejects.

    ``merged`` is told of each batch and how many of its rows were set aside.
    """
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: merged(batch_id, merge_batch(tables, batch, batch_id, clock, rejected_path)))
        .start()
    )


def run_entry_sync(
    stream: DataFrame,
    tables: Tables,
    checkpoint: str,
    rejected_path: str,
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
) -> None:
    """Merge everything that has arrived; run it from any scheduler.

    Rows that can be read are merged whatever else is in a batch; the run then ends in ``RunFailed`` if it has set any row
    aside, and leaves a row of its outcome.
    """
    began = clock()
    run = run_id(began, "stream")
    counts = {"batches": 0, "rejected": 0}

    def merged(batch_id: int, rejected: int) -> None:
        counts["batches"] += 1
        counts["rejected"] += rejected

    with recorded(tables, "stream", run, began, counts):
        start_entry_sync(stream, tables, checkpoint, rejected_path, clock, merged).awaitTermination()
        if counts["rejected"]:
            raise RunFailed(f"{counts['rejected']} unreadable rows were set aside in {rejected_path}")


def drop_repeats(stream: DataFrame, delay: str, time_col: str = "start_time") -> DataFrame:
    """First sight of each id, for feeds that only ever repeat rows.

    State is kept for ``delay``. Edits would be lost here; use the sync for those.
    """
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["source_id"])


_SEEN = "at_us LONG, file STRING, digest LONG"


def changed_entries(stream: DataFrame, content: list[str], key: str = "source_id") -> DataFrame:
    """The newest version of each id, emitted only when its content changes; for feeds that repeat, edit and arrive out of order.

    ``stream`` has ``key``, the ``content`` columns and ``ARRIVAL``. State is one small row per id (order and digest of the version
    emitted last) and doesn't expire, so a version older than that is dropped however late it comes, and a repeat emits
    nothing. Within a batch the newest version wins; equal arrivals go by content digest. Rows without a key are left out.
    Update mode; run it under ``rocksdb_state`` so that state lies on disk.
    """
    order = F.struct(F.unix_micros(f"{ARRIVAL}.file_modification_time").alias("at_us"), F.col(f"{ARRIVAL}.file_name").alias("file"))
    rows = stream.where(F.col(key).isNotNull()).select(
        key, *content, order.alias("_order"), F.xxhash64(*content).alias("_digest")
    ).select(key, *content, "_order.at_us", "_order.file", "_digest")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(key, *content).schema)

    def newest(_key, parts, state):
        seen = tuple(state.get) if state.exists else None
        best, row = seen, None
        for part in parts:
            for k, version in enumerate(zip(part["at_us"].tolist(), part["file"].tolist(), part["_digest"].tolist(), strict=True)):
                if best is None or version > best:
                    best, row = version, part.iloc[[k]]
        if row is not None:
            state.update(best)
            if seen is None or best[2] != seen[2]:
                yield row[[key, *content]]

    return rows.groupBy(key).applyInPandasWithState(newest, schema, _SEEN, "update", "NoTimeout")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, on disk and with incremental checkpoints."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
