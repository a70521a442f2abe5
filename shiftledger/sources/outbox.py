"""Rows to be created in the destination, and the ids that it gives them.

What is to be created is written first (the outbox), each row with a request key that is the same whenever the run is repeated.
Tasks then hand requests to ``create`` on the executors, ten at a time, and what comes back is written as
receipts (request, given id). A task that is lost is run again and asks with the same keys, so a destination that honours
them creates nothing twice; a run that was cut short asks only for what has no receipt yet. Requests and receipts
stay tables from end to end: no id passes through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from uuid import uuid4

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.functions.text import stable_id

BATCH = 10
_RECEIPT = "request STRING, given_id STRING"
#: create(records) -> one id per record; a record has ``request`` and the fields of its row. It must not create a request twice.
Create = Callable[[list[dict]], list[str]]


def requests(rows: DataFrame, key: list[str], kind: str, run: str) -> DataFrame:
    """Add ``request``: a name of the row within a run, the same when the run is repeated."""
    return rows.withColumn("request", stable_id(F.lit(kind), F.lit(run), *[F.col(k).cast("string") for k in key]))


def receipts_of(rows: DataFrame, create: Create, batch: int = BATCH) -> DataFrame:
    """(request, given_id) of rows with a ``request``, asked for in batches. Evaluate it once: each evaluation asks again."""
    fields = [c for c in rows.columns if c != "request"]

    def ask(batches):
        for part in batches:
            for first in range(0, part.num_rows, batch):
                some = part.slice(first, batch)
                keys = some.column("request").to_pylist()
                records = [{"request": k, **json.loads(j)} for k, j in zip(keys, some.column("fields").to_pylist(), strict=True)]
                given = create(records)
                if len(given) != len(records):
                    raise ValueError(f"{len(records)} rows were sent and {len(given)} ids came back")
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(given, pa.string())], names=["request", "given_id"])

    packed = rows.select("request", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("fields"))
    return packed.mapInArrow(ask, _RECEIPT)


class Outbox:
    """Requests and receipts under one root folder, by kind and run."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def deliver(self, rows: DataFrame, key: list[str], kind: str, run: str, create: Create) -> DataFrame:
        """``rows`` with ``given_id``, after asking for those of this run that have no receipt yet."""
        path = f"{self.root}/{kind}/{run}"
        wanted = f"{path}/requests-{uuid4().hex}"
        requests(rows, key, kind, run).write.parquet(wanted)
        stored = self.spark.read.parquet(wanted)
        missing = stored.join(self._receipts(path).select("request"), "request", "left_anti")
        receipts_of(missing, create).write.mode("append").parquet(f"{path}/receipts")
        return stored.join(self._receipts(path), "request", "left").drop("request")

    def _receipts(self, path: str) -> DataFrame:
        """One row per request; of an attempt cut short, what it has committed counts."""
        try:
            found = self.spark.read.schema(_RECEIPT).parquet(f"{path}/receipts")
        except AnalysisException:
            return self.spark.createDataFrame([], _RECEIPT)
        return found.groupBy("request").agg(F.min("given_id").alias("given_id"))
