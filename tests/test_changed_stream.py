"""Edits as a stream: only true changes come out, whatever the order of arrival, also after a restart."""

import json
import os

from shiftledger.streaming.entries import ARRIVAL, changed_entries, rocksdb_state
from pyspark.sql import functions as F


def test_only_true_changes_come_out(spark, tmp_path):
    inbox, out = tmp_path / "inbox", tmp_path / "out"
    inbox.mkdir()
    # (file time, rows): edits, repeats, a late old version, two versions in one file order, null keys.
    files = [
        (10, [("a", 1), ("b", 1), ("c", 1), (None, 9)]),
        (20, [("a", 2), ("b", 1), ("c", None)]),
        (15, [("a", 7), ("b", 8)]),
        (30, [("a", 2), ("c", None), ("d", 4)]),
        (40, [("a", 1), ("b", 1)]),
    ]

    def write(k):
        at, rows = files[k]
        path = inbox / f"f{k}.json"
        path.write_text("\n".join(json.dumps({"source_id": s, "hours": h, "x": "é"}) for s, h in rows))
        os.utime(path, (1_700_000_000 + at, 1_700_000_000 + at))

    def drain():
        stream = spark.readStream.schema("source_id STRING, hours INT, x STRING").json(str(inbox)).withColumn(
            ARRIVAL, F.struct("_metadata.file_modification_time", "_metadata.file_name")
        )

        def keep(batch, number):
            batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(str(out))

        with rocksdb_state(spark):
            query = changed_entries(stream, ["hours", "x"]).writeStream.outputMode("update").foreachBatch(keep)
            query = query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)

    emitted = []
    for k in range(len(files)):
        write(k)
        drain()  # each a restart from the checkpoint
        rows = {(r["source_id"], r["hours"]) for r in spark.read.parquet(str(out)).where(F.col("batch") == k).collect()} if k != 2 else set()
        emitted.append(rows)
    assert emitted == [{("a", 1), ("b", 1), ("c", 1)}, {("a", 2), ("c", None)}, set(), {("d", 4)}, {("a", 1)}]
    # What came out last of each id is the newest version, as in batch.
    found = spark.read.parquet(str(out)).groupBy("source_id").agg(F.max_by("hours", "batch").alias("h"))
    assert {r["source_id"]: r["h"] for r in found.collect()} == {"a": 1, "b": 1, "c": None, "d": 4}
