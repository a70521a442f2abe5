"""One row per run: what it was, how it ended, how long it took and what it did."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from shiftledger.sources.tables import Tables

SUCCESS, PARTIAL, FAILED = "SUCCESS", "PARTIAL", "FAILED"
_SCHEMA = "run STRING, job STRING, run_ts TIMESTAMP, outcome STRING, seconds DOUBLE, error STRING, counts STRING"


class RunFailed(RuntimeError):
    """A run wrote what it could, but some users failed."""


def innermost(error: BaseException) -> str:
    """The message of the error at the bottom: no stack trace, and nothing of what was reported on the way up."""
    seen = set()
    while (cause := error.__cause__ or error.__context__) is not None and id(cause) not in seen:
        seen.add(id(error))
        error = cause
    text = str(error)
    # An executor's Python error reaches the driver as a traceback whose last unindented line is the message.
    lines = [line for line in text.splitlines() if line.strip()]
    if "Traceback (most recent call last)" in text:
        start = max(i for i, line in enumerate(lines) if "Traceback (most recent call last)" in line)
        body = [line for line in lines[start + 1 :] if not line.startswith((" ", "\t", "at "))]
        return body[0] if body else lines[-1]
    return lines[0] if lines else type(error).__name__


@contextmanager
def recorded(tables: Tables, job: str, run: str, run_ts: datetime, counts: dict) -> Iterator[None]:
    """Write the run's row when it ends, whatever way it ends; an error goes on after that."""
    began = time.monotonic()
    outcome, error = SUCCESS, None
    try:
        yield
    except BaseException as failure:
        outcome, error = PARTIAL if isinstance(failure, RunFailed) else FAILED, innermost(failure)
        raise
    finally:
        row = (run, job, run_ts, outcome, time.monotonic() - began, error, json.dumps(counts, default=str))
        tables.spark.createDataFrame([row], _SCHEMA).coalesce(1).write.mode("append").parquet(f"{tables.root}/runs")


def run_rows(tables: Tables) -> DataFrame:
    """All runs so far."""
    try:
        return tables.spark.read.schema(_SCHEMA).parquet(f"{tables.root}/runs")
    except AnalysisException:
        return tables.spark.createDataFrame([], _SCHEMA)
