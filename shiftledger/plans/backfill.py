"""The backfill job: history from a start date, upsert only."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from shiftledger.model import DEFAULT_BACKFILL_START
from shiftledger.operators.windows import within
from shiftledger.plans.common import Extracts, RunFailed, merge_entries, merge_references, run_id
from shiftledger.plans.runs import recorded
from shiftledger.sources.extracts import split_failed_users
from shiftledger.sources.lookups import users_by_source_id
from shiftledger.sources.tables import Tables, stage, stage_counted


def parse_start(start: str | None) -> datetime:
    """Start instant of a backfill; ISO text in UTC."""
    text = DEFAULT_BACKFILL_START if start is None else start
    if not isinstance(text, str) or not text.endswith("Z"):
        raise ValueError("start must be an ISO instant in UTC, such as 2026-01-01T00:00:00Z")
    return datetime.fromisoformat(text)


def run_backfill(
    tables: Tables,
    extracts: Extracts,
    run_ts: datetime,
    start: str | None = None,
    user_source_id: str | None = None,
) -> dict[str, int]:
    """Merge references, then entries from ``start`` for all users or one.

    Safe to repeat. Fails when no stored user matches, or, after writing the
    others, when a user had invalid entries.
    """
    since = parse_start(start)
    if user_source_id is not None and not isinstance(user_source_id, str):
        raise ValueError("user_source_id must be text")
    run = run_id(run_ts, "0-backfill")
    counts: dict = {"start": since, "user": user_source_id}
    with recorded(tables, "backfill", run, run_ts, counts):
        return _backfill(tables, extracts, run_ts, since, user_source_id, run, counts)


def _backfill(
    tables: Tables, extracts: Extracts, run_ts: datetime, since: datetime, user_source_id: str | None, run: str, counts: dict
) -> dict[str, int]:
    merge_references(tables, extracts, run, run_ts)
    wanted = users_by_source_id(tables.read("users"), user_source_id)
    if wanted.isEmpty():
        raise RunFailed(f"no stored user matches {user_source_id or 'the backfill'}")

    failed, broken = stage_counted(
        tables.spark, split_failed_users(extracts.entries), "failed_users", run, people=F.count(F.lit(1))
    )
    rows = within(extracts.entries.valid, since).join(failed, "user_source_id", "left_anti")
    if user_source_id is not None:
        rows = rows.where(F.col("user_source_id") == user_source_id)
    done = merge_entries(tables, stage(tables.spark, rows, "extract_entries", run), run, run_ts)
    counts |= done
    if broken["people"]:
        raise RunFailed(f"{broken['people']} people have unreadable entries and were left as they are")
    return done
