"""The sync job: tracker extracts into the stored tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger.functions.calendar import lookback_start
from shiftledger.operators import reports, upsert, windows
from shiftledger.operators import window_sync as ws
from shiftledger.operators.windows import PARTITION
from shiftledger.plans.common import Extracts, RunFailed, affected, merge_references, publish_merged, run_id
from shiftledger.sources.day_index import STORED_DAY
from shiftledger.sources.extracts import rejected_ids, split_failed_users
from shiftledger.plans.runs import recorded
from shiftledger.sources.tables import Tables, stage, stage_counted


class SyncResult(NamedTuple):
    """Outcome of a run: mode, report totals, per-user stats, changes by name.

    ``reports`` is None for short look-backs and for runs without changes.
    """

    mode: str
    report: dict
    stats: DataFrame
    changes: DataFrame
    reports: DataFrame | None


def _searchable(tables: Tables, extracts: Extracts, users: DataFrame, failed: DataFrame, rejected: DataFrame) -> DataFrame:
    """Users (user_id) whose missing entries are known to be gone: fetched whole, and without an unreadable row.

    A rejected row that names no user could be anybody's, so then nobody is searched. Whoever owns an id that
    was read in a rejected row is left out too, whatever user that row names; those are sought by the day index, and only if
    there are such ids.
    """
    nobody = failed.where(F.col("user_source_id").isNull()).limit(1).count() == 1
    fetched = extracts.users.valid.select("source_id") if extracts.scanned_users is None else extracts.scanned_users
    whole = users.join(fetched.select("source_id").distinct(), "source_id", "left_semi").join(
        failed.select(F.col("user_source_id").alias("source_id")), "source_id", "left_anti"
    )
    searched = whole.where(F.lit(not nobody)).select(F.col("id").alias("user_id"))
    if not nobody and not rejected.isEmpty():
        held = tables.held()
        located = tables.locate(rejected, held)
        days = [r[0] for r in located.select(STORED_DAY).distinct().collect()]
        stored = tables.read_entries(held).where(F.col(PARTITION).isin(days))
        owners = stored.join(rejected, "source_id", "left_semi").select("user_id").distinct()
        searched = searched.join(owners, "user_id", "left_anti")
    return searched


def run_sync(
    tables: Tables,
    extracts: Extracts,
    run_ts: datetime,
    lookback_days: int | None = None,
    downstream: Callable[[], object] | None = None,
) -> SyncResult:
    """Merge one look-back extract and delete what vanished from it.

    Users with an invalid entry are left as they are (neither merged nor
    searched for ghosts); everybody else is written, and then the run fails, so
    ``downstream`` is not called. It is called only when something was merged. Totals are taken while the merged rows are
    written; per-user figures are computed when ``stats`` is read. Each run leaves a row of its outcome and duration.
    """
    window, mode = model.lookback_window(lookback_days)
    run = run_id(run_ts, "1-sync")
    counts: dict = {"mode": mode}
    with recorded(tables, "sync", run, run_ts, counts):
        return _sync(tables, extracts, run_ts, lookback_start(run_ts, window), mode, run, counts, downstream)


def _sync(
    tables: Tables,
    extracts: Extracts,
    run_ts: datetime,
    start: datetime,
    mode: str,
    run: str,
    counts: dict,
    downstream: Callable[[], object] | None,
) -> SyncResult:
    spark = tables.spark
    changes = merge_references(tables, extracts, run, run_ts)
    users, projects = tables.read("users"), tables.read("projects")

    failed, broken = stage_counted(spark, split_failed_users(extracts.entries), "failed_users", run, people=F.count(F.lit(1)))
    extract = windows.within(extracts.entries.valid, start).join(failed, "user_source_id", "left_anti")
    rejected = stage(spark, rejected_ids(extracts.entries), "rejected_ids", run)
    searched = _searchable(tables, extracts, users, failed, rejected).distinct()
    scanned, looked_at = stage_counted(spark, searched, "scanned", run, users_scanned=F.count("user_id"))

    resolved = stage(
        spark, upsert.resolve_entries(upsert.unique_rows(extract, "source_id"), users, projects), "resolved", run
    )
    found = affected(tables, resolved, start, run)
    sync = ws.merge_window(found.target.drop(PARTITION), found.placed, scanned, start, run_ts)
    merged, written = stage_counted(spark, sync.merged, "entries", run, **ws.sync_totals())
    publish_merged(tables, merged, found)

    report = ws.totals_report(written | looked_at | changes_of(changes))
    counts |= report
    if broken["people"]:
        raise RunFailed(f"{broken['people']} people have unreadable entries and were left as they are")
    if report["synced"] > 0 and downstream is not None:
        downstream()
    # Only the long look-back is an audit worth telling about.
    noteworthy = mode == model.DEEP and report["has_changes"]
    text = reports.sync_report_rows(spark.createDataFrame([report]), changes) if noteworthy else None
    return SyncResult(mode, report, ws.sync_stats(merged), changes, text)


def changes_of(changes: DataFrame) -> dict[str, int]:
    """Numbers of added and renamed references; one row of a small table."""
    return changes.agg(*ws.change_counts()).first().asDict()
