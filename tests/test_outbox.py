"""Ids that the destination gives, runs that leave their row, figures taken while writing."""

import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_jobs import CLIENTS, FIRST, NOW, PROJECTS, USERS, Base, entry, interpreted, load, state, tables  # noqa: F401

from shiftledger.plans.common import RunFailed
from shiftledger.plans.reconcile import run_reconcile
from shiftledger.plans.runs import innermost, run_rows
from shiftledger.plans.sync import run_sync
from shiftledger.sources.outbox import Outbox
from shiftledger.sources.tables import stage_counted
from shiftledger.streaming.entries import read_entry_stream, run_entry_sync


def maker(folder, fail_after=None):
    """A destination that makes its own ids, honours request keys, and may break down once after some requests."""
    folder = str(folder)

    def create(records):
        ids = []
        for r in records:
            path = f"{folder}/{r['request']}"
            if not os.path.exists(path):
                if fail_after is not None and len(os.listdir(folder)) >= fail_after and not os.path.exists(f"{folder}.broken"):
                    open(f"{folder}.broken", "w").close()
                    raise RuntimeError("connection lost")
                with open(path, "x") as f:
                    f.write(json.dumps([f"recGiven{abs(hash(r['request'])) % 10**9:09d}", r]))
            ids.append(json.load(open(path))[0])
        return ids

    return create


def test_nothing_is_created_twice_when_a_task_dies(spark, tmp_path):
    folder = tmp_path / "made"
    folder.mkdir()
    rows = spark.createDataFrame([(f"k{i}", f"name {i}", None if i % 2 else i * 0.5) for i in range(47)], "id STRING, name STRING, zero DOUBLE")
    box, create = Outbox(spark, str(tmp_path / "outbox")), maker(folder, fail_after=23)
    with pytest.raises(Exception, match="connection lost"):
        box.deliver(rows.repartition(3), ["id"], "users", "run1", create)
    assert len(os.listdir(folder)) < 47
    got = box.deliver(rows, ["id"], "users", "run1", create).collect()
    made = {json.load(open(folder / f))[1]["id"]: json.load(open(folder / f))[0] for f in os.listdir(folder)}
    assert len(os.listdir(folder)) == 47 and {r["id"]: r["given_id"] for r in got} == made
    record = json.load(open(folder / os.listdir(folder)[0]))[1]
    assert set(record) == {"request", "id", "name", "zero"}

    def never(records):
        raise AssertionError("has its receipts")

    assert box.deliver(rows, ["id"], "users", "run1", never).count() == 47
    assert box.deliver(rows.limit(0), ["id"], "users", "run2", never).count() == 0
    # Another run asks anew.
    again = box.deliver(rows.where("id = 'k1'"), ["id"], "users", "run2", create).first()
    assert again["given_id"] != made["k1"] and len(os.listdir(folder)) == 48


def test_reconcile_stores_the_ids_it_is_given(spark, tables, load, tmp_path):  # noqa: F811
    folder = tmp_path / "made"
    folder.mkdir()
    run_sync(tables, load(FIRST), NOW, 30)
    base = Base(spark)
    result = run_reconcile(tables, base.destination(), NOW, send=base.send, create=maker(folder))
    links = {r["name"]: r["link_id"] for r in tables.read("users").unionByName(tables.read("projects"), True).collect()}
    assert links["Ann Lee"] == "recAnn00000000000" and links["Cy"] is None
    assert all(links[n].startswith("recGiven") for n in ("Bob", "Alpha", "Beta", "No Project"))
    kinds = [json.load(open(folder / f))[1] for f in os.listdir(folder)]
    assert {k["name"] for k in kinds if "name" in k} == {"Bob", "Alpha", "Beta", "No Project", "Acme"}
    made = {json.load(open(folder / f))[0] for f in os.listdir(folder)}
    pairs = [k for k in kinds if "month_date" in k]
    assert pairs and all(k["commitment_hours"] == 0 for k in pairs)
    used = {r["assignment_id"] for a in result.actions.values() for r in a.collect() if "assignment_id" in a.columns and r["assignment_id"]}
    assert used <= made
    assert not [x for x in base.log if x[1] == "create"]


def test_runs_leave_a_row_however_they_end(spark, tables, load):  # noqa: F811
    run_sync(tables, load(FIRST), NOW, 30)
    with pytest.raises(RunFailed):
        run_sync(tables, load([entry("bad", "soon", 1)]), NOW + timedelta(hours=1), 30)
    with pytest.raises(ValueError):
        run_sync(tables, load(FIRST), NOW - timedelta(hours=1), 30)
    rows = {r["run_ts"].hour - NOW.hour: r for r in run_rows(tables).collect()}
    assert [rows[h]["outcome"] for h in (0, 1, -1)] == ["SUCCESS", "PARTIAL", "FAILED"]
    assert all(r["seconds"] > 0 and r["job"] == "sync" for r in rows.values())
    assert json.loads(rows[0]["counts"])["upserted"] == 5 and "older" in rows[-1]["error"]
    assert rows[0]["error"] is None and "1 people" in rows[1]["error"]


def test_figures_are_taken_while_rows_are_written(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "one write")
    staged, got = stage_counted(spark, spark.range(100), "counted", "r", rows=F.count("id"), odd=F.count_if(F.col("id") % 2 == 1))
    jobs = len(tracker.getJobIdsForGroup("counted"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {"rows": 100, "odd": 50} and jobs == 1 and staged.count() == 100
    assert stage_counted(spark, spark.range(0), "counted", "r", rows=F.count("id"))[1] == {"rows": 0}


def test_the_innermost_message_counts():
    deep = "An error occurred.\n: SparkException: about recWrong000000001\nTraceback (most recent call last):\n  File recWrong000000002\nRuntimeError: 422 ROW_DOES_NOT_EXIST recRight000000003\n\n\tat org.apache"
    assert innermost(RuntimeError(deep)) == "RuntimeError: 422 ROW_DOES_NOT_EXIST recRight000000003"
    try:
        try:
            raise ValueError("inner")
        except ValueError as error:
            raise RuntimeError("outer") from error
    except RuntimeError as error:
        assert innermost(error) == "inner"
    assert innermost(KeyError()) == "KeyError"


def test_a_dead_link_that_nobody_stores_is_no_healing(spark, tables, load):  # noqa: F811
    run_sync(tables, load(FIRST), NOW, 30)
    base = Base(spark)
    base.fail = "422 ROW_DOES_NOT_EXIST: Record recNobody00000000 does not exist"
    with pytest.raises(RuntimeError, match="recNobody"):
        run_reconcile(tables, base.destination(), NOW, send=base.send)


def test_a_stream_fails_by_itself_after_rejects(spark, tables, load, tmp_path):  # noqa: F811
    run_sync(tables, load([]), NOW, 30)
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.json").write_text("\n".join(json.dumps(x) for x in [FIRST[0], {"id": None, "userId": "u1"}]))
    parts = (tables, str(tmp_path / "cp"), str(tmp_path / "bad"), lambda: NOW + timedelta(hours=1))
    with pytest.raises(RunFailed, match="1 unreadable"):
        run_entry_sync(read_entry_stream(spark, str(inbox)), *parts)
    assert state(tables) == {"e1": (1, False)}
    (inbox / "b.json").write_text(json.dumps(FIRST[1]))
    run_entry_sync(read_entry_stream(spark, str(inbox)), *parts)
    assert sorted(state(tables)) == ["e1", "e2"]
    assert sorted(r["outcome"] for r in run_rows(tables).where("job = 'stream'").collect()) == ["PARTIAL", "SUCCESS"]
