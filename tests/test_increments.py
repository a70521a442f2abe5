"""The day index, the stored sums and numbered publishes, against full recomputation."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_jobs import CLIENTS, FIRST, NOW, PROJECTS, USERS, entry, interpreted, load, state, tables  # noqa: F401

from shiftledger.operators import aggregates as ag
from shiftledger.operators import increments as inc
from shiftledger.plans.common import affected
from shiftledger.plans.sync import run_sync
from shiftledger.sources import day_index
from shiftledger.sources.parts import Part, to_merge
from shiftledger.sources.tables import LEASE, PublishConflict, Tables


def sums_of(df):
    return {(r["user_id"], r["project_id"], r["month"], r["cycle"]): (r["sum_s"], r["sum_us"], r["n"]) for r in df.collect()}


def check_store(tables):
    """Index and sums say what the entries say."""
    stored = tables.read_entries()
    held = tables.held()
    assert held.index and sums_of(tables.read_sums()) == sums_of(inc.usage_sums(stored))
    days = {r["source_id"]: r["start_day"] for r in stored.collect()}
    assert {r["source_id"]: r["stored_day"] for r in tables.locate(stored.select("source_id")).collect()} == days


def test_sums_and_index_follow_every_kind_of_change(tables, load):  # noqa: F811
    steps = [
        FIRST,
        [entry("e1", "2026-02-15T08:00:00Z", 7), FIRST[2], entry("e5", "2026-03-09T08:00:00Z", 5, user="u2")],  # edits, a move, deletes
        [entry("e1", "2026-02-15T08:00:00Z", 7, user="u2", project="p2"), *FIRST[1:3]],  # another owner, a revival
        [],
        FIRST[:4],
        FIRST[:4],
    ]
    for hour, entries in enumerate(steps):
        run_sync(tables, load(entries), NOW + timedelta(hours=hour), 30)
        check_store(tables)
    assert len(tables.held().index) < 5
    # Hours from the sums are those from the entries.
    users, projects = tables.read("users"), tables.read("projects")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(ag.monthly_from(tables.read_sums(), users, projects)) == rows(ag.monthly_hours(tables.read_entries(), users, projects))


def test_a_store_from_before_index_and_sums(spark, tables, load, monkeypatch):  # noqa: F811
    run_sync(tables, load(FIRST), NOW, 30)
    plain = Tables._manifest_rows
    with monkeypatch.context() as old:
        # As older versions wrote it: days alone, without a kind.
        old.setattr(Tables, "_manifest_rows", lambda self, held: plain(self, held).where("kind = 'day'").select(F.lit(None).cast("string").alias("kind"), "day", "version", "place", "rows"))
        run_sync(tables, load(FIRST[:4]), NOW + timedelta(hours=1), 30)
    assert not tables.held().index and not tables.held().sums
    assert sums_of(tables.read_sums()) == sums_of(inc.usage_sums(tables.read_entries()))
    run_sync(tables, load([entry("e1", "2026-02-15T08:00:00Z", 7), *FIRST[1:4]]), NOW + timedelta(hours=2), 30)
    check_store(tables)


def test_a_lookup_reads_the_buckets_of_its_ids(spark, tables, load):  # noqa: F811
    run_sync(tables, load(FIRST), NOW, 30)
    ids = spark.createDataFrame([("e1",), ("nobody",), (None,)], "source_id STRING")
    found = tables.locate(ids)
    assert [(r["source_id"], str(r["stored_day"])) for r in found.collect()] == [("e1", "2026-03-05")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    buckets = {r[0] for r in ids.where("source_id is not null").select(day_index.bucket_of(F.col("source_id"))).collect()}
    filters = [line for line in plan.split("\n") if "PartitionFilters" in line and "bucket" in line]
    assert filters and all(str(b) in filters[0] for b in buckets) and len(buckets) == 2


def test_a_merge_reads_the_days_it_touches_and_the_target_once(spark, tables, load):  # noqa: F811
    run_sync(tables, load(FIRST), NOW, 30)
    incoming = tables.read_entries().where("source_id = 'e1'").drop("start_day")
    found = affected(tables, incoming, None, "test")
    assert [str(d) for d in found.days] == ["2026-03-05"]
    assert found.placed.where("stored_day = '2026-03-05'").count() == 1
    from shiftledger.operators import window_sync as ws

    plan = ws.merge_only(found.target.drop("start_day"), found.placed, NOW)._jdf.queryExecution().optimizedPlan().toString()
    # Once for the merge, once for nobody's empty list of scanned users.
    assert plan.count("updated_at#") > 0 and plan.count("Relation [id#") <= 2


def test_of_two_runs_on_one_state_the_second_fails(spark, tables, load):  # noqa: F811
    run_sync(tables, load(FIRST), NOW, 30)
    held = tables.held()
    rows = tables.read_entries(held).where("source_id in ('e1', 'e2')").drop("start_day")
    day = [r[0] for r in tables.read_entries(held).where("source_id = 'e1'").select("start_day").collect()]
    tables.publish_entries(rows.where("source_id = 'e1'"), day, held=held)
    with pytest.raises(PublishConflict):
        tables.publish_entries(rows, day, held=held)
    assert sorted(state(tables)) == ["e1", "e3", "e4", "e5"]
    check_store(tables)


def test_a_dead_writers_claim_is_taken_over(tables, load, monkeypatch):  # noqa: F811
    run_sync(tables, load(FIRST), NOW, 30)
    number = tables.held().number + 1
    file, system = tables._folder(f"{tables.root}/entries_manifest/claims/{number:012d}")
    assert system.createNewFile(file)
    with pytest.raises(PublishConflict):
        run_sync(tables, load(FIRST[:2]), NOW + timedelta(hours=1), 30)
    assert not any(gone for _, gone in state(tables).values())
    system.setTimes(file, file.getFileSystem(tables.spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(file).getModificationTime() - (LEASE + 5) * 1000, -1)
    run_sync(tables, load(FIRST[:2]), NOW + timedelta(hours=2), 30)
    assert state(tables)["e3"][1]
    check_store(tables)


def test_parts_are_merged_when_they_are_of_like_size():
    parts = []
    for k in range(1000):
        kept, merged = to_merge(parts, 1)
        parts = [*kept, Part(str(k), 1 + sum(p.rows for p in merged))]
        assert len(parts) <= 11 and all(a.rows > 2 * b.rows for a, b in zip(parts, parts[1:], strict=False))
    assert sum(p.rows for p in parts) == 1000
