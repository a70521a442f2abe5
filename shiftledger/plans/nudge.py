"""The nudge job: who logged time without a project, and how to reach them."""

from __future__ import annotations

from datetime import UTC, date, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame

from shiftledger import model
from shiftledger.operators import aggregates as ag
from shiftledger.operators import identity, reports
from shiftledger.operators.upsert import set_column
from shiftledger.plans.common import run_id
from shiftledger.sources.tables import Tables, stage


class NudgeResult(NamedTuple):
    """Lines to send, people not found, report rows; ``nudged`` counts people."""

    nudged: int
    nudges: DataFrame | None
    unmatched: DataFrame | None
    reports: DataFrame | None


def run_nudge(
    tables: Tables,
    load_roster,
    run_ts: datetime,
    day: date | None = None,
    tz: str = model.DEFAULT_TZ,
    cycle_day: int = model.DEFAULT_CYCLE_DAY,
) -> NudgeResult:
    """Find unassigned time of the cycle holding ``day`` (default: the UTC day).

    ``load_roster()`` is only called when there is somebody to look for. Chat
    ids found for the first time are stored.
    """
    run = run_id(run_ts, "4-nudge")
    spark = tables.spark
    day = day or run_ts.astimezone(UTC).date()
    users, projects = tables.read("users"), tables.read("projects")
    # One cycle of entries is scanned once; totals and lists read the staged rows.
    rows = stage(spark, ag.unassigned_rows(tables.read_entries(), projects, day, tz, cycle_day), "unassigned", run)
    people = stage(spark, ag.unassigned_hours(rows, users), "people", run)
    if people.isEmpty():
        return NudgeResult(0, None, None, None)

    matched = stage(spark, identity.match_identity(people, load_roster()), "matched", run)
    found = identity.discovered_ids(matched)
    tables.publish("users", set_column(users, found, "id", "chat_id"), run)

    nudges = stage(spark, identity.nudge_rows(matched, rows), "nudges", run)
    unmatched = identity.unmatched_people(matched)
    counts = identity.matched_count(matched).first()
    return NudgeResult(counts["matched"], nudges, unmatched, reports.unmatched_rows(unmatched))
