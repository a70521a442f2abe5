"""A backfill in units of one month and one user, with a stored ledger: what was cut short goes on where it was.

All users of a month are merged in one job, so the driver walks over months, not over users. A user whose rows of a month can't
be read is a row of the ledger, not the end of the run.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.functions.calendar import parse_instant
from shiftledger.operators.windows import within
from shiftledger.plans.backfill import parse_start
from shiftledger.plans.common import Extracts, merge_entries, merge_references, run_id
from shiftledger.plans.runs import RunFailed, recorded
from shiftledger.sources.tables import Tables, stage

DONE, BROKEN = "DONE", "BROKEN"
_SCHEMA = "name STRING, user_source_id STRING, month DATE, state STRING, entries LONG, run_ts TIMESTAMP"


def months_between(start: datetime, end: datetime) -> list[tuple[datetime, datetime]]:
    """Half-open UTC months from that of ``start`` to that of ``end``."""
    found, at = [], datetime(start.year, start.month, 1, tzinfo=UTC)
    while at <= end:
        following = datetime(at.year + at.month // 12, at.month % 12 + 1, 1, tzinfo=UTC)
        found.append((at, following))
        at = following
    return found


def ledger_rows(tables: Tables, name: str) -> DataFrame:
    """The newest state of each (user, month) of the named backfill; a user without a name stands for unreadable rows of nobody."""
    try:
        rows = tables.spark.read.schema(_SCHEMA).parquet(f"{tables.root}/ledger").where(F.col("name") == name)
    except AnalysisException:
        return tables.spark.createDataFrame([], _SCHEMA)
    latest = F.max_by(F.struct("state", "entries", "run_ts"), "run_ts").alias("last")
    return rows.groupBy("name", "user_source_id", "month").agg(latest).select("name", "user_source_id", "month", "last.*")


def run_ledger_backfill(tables: Tables, extracts: Extracts, run_ts: datetime, name: str, start: str | None = None) -> dict[str, int]:
    """Merge the extract month by month; months that the ledger of ``name`` has in full are left out.

    A month goes into the ledger after its merge is published, so a run that is cut short repeats at most one month, and
    repeating changes nothing. Ends in ``RunFailed`` if any unit is broken; a later run with mended rows takes those months again.
    """
    since = parse_start(start)
    run = run_id(run_ts, f"0-ledger-{name}")
    counts = {"months": 0, "left_out": 0, "upserted": 0, "skipped": 0, "broken": 0}
    with recorded(tables, "ledger", run, run_ts, counts):
        merge_references(tables, extracts, run, run_ts)
        rejected = extracts.entries.rejected.select(
            F.col("userId").alias("user_source_id"), parse_instant(F.col("timeInterval.start")).alias("start_time")
        )
        rejected = stage(tables.spark, rejected, "rejected", run)
        valid = stage(tables.spark, within(extracts.entries.valid, since), "valid", run)
        full = ledger_rows(tables, name).groupBy("month").agg(F.bool_and(F.col("state") == DONE).alias("done")).where("done")
        done = {r["month"] for r in full.select("month").collect()}
        for first, following in months_between(since, run_ts):
            if first.date() in done:
                counts["left_out"] += 1
                continue
            _month(tables, valid, rejected, first, following, name, run, run_ts, counts)
        # Rows without a readable start belong to no month.
        nowhere = rejected.where("start_time is null").groupBy("user_source_id").agg(F.count("*").alias("entries"))
        counts["broken"] += _note(tables, nowhere.withColumn("state", F.lit(BROKEN)), None, name, run_ts)
        if counts["broken"]:
            raise RunFailed(f"{counts['broken']} units of the backfill {name} are broken; the ledger names them")
    return counts


def _month(
    tables: Tables, valid: DataFrame, rejected: DataFrame, first: datetime, following: datetime, name: str, run: str, run_ts: datetime, counts: dict
) -> None:
    bad = within(rejected, first, following).groupBy("user_source_id").agg(F.count("*").alias("entries"))
    bad = stage(tables.spark, bad.withColumn("state", F.lit(BROKEN)), "broken", run)
    rows = within(valid, first, following).join(bad.select("user_source_id"), "user_source_id", "left_anti")
    rows = stage(tables.spark, rows, "month", run)
    # Each month is a run of its own for what is staged and published.
    merged = merge_entries(tables, rows, f"{run}-{first:%Y%m}", run_ts)
    good = rows.groupBy("user_source_id").agg(F.count("*").alias("entries")).withColumn("state", F.lit(DONE))
    # A month without any row is done as well.
    nobody = tables.spark.createDataFrame([(None, 0, DONE)], "user_source_id STRING, entries LONG, state STRING")
    broken = bad.count()
    _note(tables, good.unionByName(bad).unionByName(nobody), first, name, run_ts)
    counts["months"] += 1
    counts["upserted"] += merged["upserted"]
    counts["skipped"] += merged["skipped"]
    counts["broken"] += broken


def _note(tables: Tables, units: DataFrame, month: datetime | None, name: str, run_ts: datetime) -> int:
    """Append units to the ledger; how many there were."""
    day = F.lit(month.date() if month else None).cast("date")
    rows = units.select(
        F.lit(name).alias("name"), "user_source_id", day.alias("month"), "state", "entries", F.lit(run_ts).cast("timestamp").alias("run_ts")
    )
    rows = stage(tables.spark, rows, "units", "ledger")
    rows.write.mode("append").parquet(f"{tables.root}/ledger")
    return rows.count()
