"""Backfills that go on where they were cut, and audits that compare checksums first."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from test_jobs import CLIENTS, FIRST, NOW, PROJECTS, USERS, entry, interpreted, load, state, tables  # noqa: F401

from shiftledger import testbed as tb
from shiftledger.operators import audit, upsert, windows
from shiftledger.operators import window_sync as ws
from shiftledger.plans import ledger
from shiftledger.plans.common import RunFailed
from shiftledger.plans.runs import run_rows

SF = "/root/testdata/sf0.001"


def units(tables):  # noqa: F811
    return {(r["user_source_id"], r["month"] and r["month"].month): r["state"] for r in ledger.ledger_rows(tables, "history").collect()}


def test_a_backfill_cut_short_goes_on(tables, load, monkeypatch):  # noqa: F811
    plain, taken = ledger.merge_entries, []

    def cut(tables, rows, run, run_ts):
        taken.append(run[-6:])
        if run.endswith("202602") and taken.count("202602") == 1:
            raise OSError("cut")
        return plain(tables, rows, run, run_ts)

    monkeypatch.setattr(ledger, "merge_entries", cut)
    with pytest.raises(OSError):
        ledger.run_ledger_backfill(tables, load(FIRST), NOW, "history")
    assert sorted(state(tables)) == ["e6"]
    counts = ledger.run_ledger_backfill(tables, load(FIRST), NOW + timedelta(hours=1), "history")
    assert counts == {"months": 2, "left_out": 1, "upserted": 5, "skipped": 1, "broken": 0}
    assert taken == ["202601", "202602", "202602", "202603"]
    assert sorted(state(tables)) == ["e1", "e2", "e3", "e4", "e5", "e6"]
    assert units(tables)[("u1", 1)] == "DONE" and units(tables)[("u2", 3)] == "DONE"
    assert [r["outcome"] for r in run_rows(tables).orderBy("run_ts").collect()] == ["FAILED", "SUCCESS"]


def test_one_users_broken_month_is_a_row(tables, load):  # noqa: F811
    bad = [*FIRST, {**entry("bad", "2026-03-05T08:00:00Z", 1), "timeInterval": {"start": "2026-03-05T08:00:00Z", "duration": "an hour"}}]
    with pytest.raises(RunFailed, match="1 units"):
        ledger.run_ledger_backfill(tables, load(bad), NOW, "history")
    assert units(tables)[("u1", 3)] == "BROKEN" and units(tables)[("u1", 1)] == "DONE" and units(tables)[("u2", 3)] == "DONE"
    assert sorted(state(tables)) == ["e3", "e4", "e5", "e6"]
    ledger.run_ledger_backfill(tables, load(FIRST), NOW + timedelta(hours=1), "history")
    assert units(tables)[("u1", 3)] == "DONE" and sorted(state(tables)) == ["e1", "e2", "e3", "e4", "e5", "e6"]
    assert ledger.months_between(NOW.replace(year=2025, month=12), NOW)[0][0].date() == date(2025, 12, 1)


def test_an_audit_finds_what_a_sync_changes_in_differing_groups_only(spark):
    stored, resolved = tb.stored_entries(spark, SF), upsert.resolve_entries(
        windows.within(tb.extract_entries(spark, SF), tb.WINDOW_START), tb.users(spark, SF), tb.projects(spark, SF)
    )
    scanned = tb.users(spark, SF).where(F.col("email").isNotNull()).select(F.col("id").alias("user_id"))
    whole = ws.merge_window(stored, resolved, scanned, tb.WINDOW_START, tb.RUN_TS).merged.where("sync_changed")
    rows = lambda df: sorted((str(tuple(r)) for r in df.drop("before").collect()))
    found = audit.audit_window(stored, resolved, scanned, tb.WINDOW_START, tb.RUN_TS)
    assert rows(found) == rows(whole) and found.count() > 0
    # After a sync the stored rows and the extract agree for all scanned users.
    resolved = resolved.where("user_id is not null")
    synced = ws.merge_window(stored, resolved, scanned, tb.WINDOW_START, tb.RUN_TS).entries
    groups = audit.differing_groups(synced, resolved, tb.WINDOW_START)
    unscanned = tb.users(spark, SF).where(F.col("email").isNull()).select(F.col("id").alias("user_id"))
    assert groups.join(unscanned, "user_id", "left_anti").count() == 0
    # One edit: one group differs, and its rows alone are compared.
    edited = resolved.withColumn("duration_us", F.when(F.col("source_id") == found.where("sync_action = 'updated'").first()["source_id"], 1).otherwise(F.col("duration_us")))
    again = audit.differing_groups(synced, edited, tb.WINDOW_START).join(unscanned, "user_id", "left_anti")
    assert again.count() == 1
