import json
from datetime import date, timedelta

import pytest
from conftest import ids, utc
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger.operators import reconcile as rc
from shiftledger.plans.backfill import parse_start, run_backfill
from shiftledger.plans.common import Extracts, RunFailed
from shiftledger.plans.nudge import run_nudge
from shiftledger.plans.reconcile import Destination, run_reconcile
from shiftledger.plans.sync import run_sync
from shiftledger.sources import extracts as ex
from shiftledger.sources.tables import Tables, send_batches
from shiftledger.streaming.entries import drop_repeats, read_entry_stream, start_entry_sync

NOW = utc("2026-03-10T12:00:00")


def entry(id_, start, hours, user="u1", project="p1", **more):
    interval = {"start": start, "duration": None if hours is None else f"PT{hours}H"}
    return {"id": id_, "userId": user, "projectId": project, "timeInterval": interval, **more}


USERS = [
    {"id": "u1", "name": "Ann Lee", "email": "ann@x.org"},
    {"id": "u2", "name": "Bob", "email": "bob@x.org"},
    {"id": "u3", "name": "Cy"},
]
CLIENTS = [{"id": "c1", "name": "Acme"}]
PROJECTS = [{"id": "p1", "name": "Alpha", "clientId": "c1"}, {"id": "p2", "name": "Beta", "clientId": None}]


@pytest.fixture
def load(spark, tmp_path):
    """load(entries, users=...) -> Extracts read from JSON files"""
    counter = iter(range(100))

    def make(entries, users=USERS, clients=CLIENTS, projects=PROJECTS):
        folder = tmp_path / f"extract{next(counter)}"
        folder.mkdir()
        for name, data in (("users", users), ("clients", clients), ("projects", projects), ("entries", entries)):
            (folder / f"{name}.json").write_text("\n".join(json.dumps(x) for x in data))
        return Extracts(
            ex.load_users(spark, str(folder / "users.json"), ex.QUARANTINE),
            ex.load_clients(spark, str(folder / "clients.json"), ex.QUARANTINE),
            ex.load_projects(spark, str(folder / "projects.json"), ex.QUARANTINE),
            ex.load_time_entries(spark, str(folder / "entries.json"), ex.QUARANTINE),
        )

    return make


@pytest.fixture(scope="module", autouse=True)
def interpreted(spark):
    """A job is dozens of small plans; compiling each would take most of the time."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    # Nor is there anything to adapt to in a few rows.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "store"))


def state(tables):
    return {
        r["source_id"]: (r["duration_us"] and r["duration_us"] // 3_600_000_000, r["deleted_at"] is not None)
        for r in tables.read_entries().collect()
    }


FIRST = [
    entry("e1", "2026-03-05T08:00:00Z", 1),
    entry("e2", "2026-03-05T10:00:00Z", 2, project=None),
    entry("e3", "2026-02-25T08:00:00Z", 3, user="u2", project="p2"),
    entry("e4", "2026-03-06T08:00:00Z", 4, user="u2"),
    entry("e5", "2026-03-09T08:00:00Z", None, user="u2"),
    entry("e6", "2026-01-01T08:00:00Z", 9),
    entry("e7", "2026-03-07T08:00:00Z", 1, user="stranger"),
]


def test_sync_from_nothing_then_edit_move_and_delete(tables, load):
    called = []
    first = run_sync(tables, load(FIRST), NOW, 30, lambda: called.append("reconcile"))
    assert first.mode == "DEEP" and called == ["reconcile"]
    assert (first.report["upserted"], first.report["deleted"], first.report["new_users"], first.report["new_projects"]) == (5, 0, 3, 2)
    assert state(tables) == {"e1": (1, False), "e2": (2, False), "e3": (3, False), "e4": (4, False), "e5": (None, False)}
    assert ids(tables.read("projects")) == ["NO-PROJECT", "p1", "p2"]
    assert tables.read("projects").where("source_id = 'p1' AND client_id IS NOT NULL").count() == 1
    lines = {(r["section"], r["text"]) for r in first.reports.collect()}
    assert {("users added", n) for n in ("Ann Lee", "Bob", "Cy")} | {("run", "merged entries: 5")} <= lines

    second = [
        entry("e1", "2026-02-15T08:00:00Z", 7),  # edited and moved to another day
        entry("e3", "2026-03-01T08:00:00Z", 3, user="u2", project="p2"),  # leaves its day empty
        entry("e5", "2026-03-09T08:00:00Z", 5, user="u2"),
    ]
    users = [{**USERS[0], "name": "Ann Smith"}, *USERS[1:]]
    later = run_sync(tables, load(second, users), NOW + timedelta(hours=1), 30)
    assert (later.report["upserted"], later.report["deleted"], later.report["renamed_users"]) == (3, 2, 1)
    assert state(tables) == {"e1": (7, False), "e2": (2, True), "e3": (3, False), "e4": (4, True), "e5": (5, False)}

    again = run_sync(tables, load(second, users), NOW + timedelta(hours=2), 30)
    assert (again.report["changed"], again.report["deleted"], again.report["renamed_users"]) == (0, 0, 0)
    back = run_sync(tables, load([*second, FIRST[1]], users), NOW + timedelta(hours=3), 30)
    assert back.report["changed"] == 1 and state(tables)["e2"] == (2, False)


def test_an_emptied_day_disappears(tables, load):
    run_sync(tables, load([entry("e1", "2026-02-20T08:00:00Z", 1), entry("e2", "2026-03-05T08:00:00Z", 1)]), NOW, 30)
    run_sync(
        tables,
        load([entry("e1", "2026-03-02T08:00:00Z", 1), entry("e2", "2026-03-05T08:00:00Z", 1)]),
        NOW + timedelta(hours=1), 30,
    )
    stored = tables.read_entries()
    assert ids(stored) == ["e1", "e2"]
    assert {r[0] for r in stored.select("start_day").distinct().collect()} == {date(2026, 3, 2), date(2026, 3, 5)}


def test_short_window_leaves_older_entries_alone(tables, load):
    run_sync(tables, load(FIRST), NOW, 30)
    fast = run_sync(tables, load([FIRST[4]]), NOW + timedelta(hours=1), None)
    assert fast.mode == "FAST" and fast.reports is None
    assert fast.report["deleted"] == 0 and sum(1 for _, gone in state(tables).values() if gone) == 0


def test_nothing_synced_calls_nobody(tables, load):
    called = []
    result = run_sync(tables, load([]), NOW, 1, lambda: called.append(1))
    assert result.report["synced"] == 0 and called == []


def test_one_users_bad_rows_do_not_stop_the_others(tables, load):
    run_sync(tables, load(FIRST), NOW, 30)
    bad = [{**entry("e1", "2026-03-05T08:00:00Z", 8)}, entry("bad", "soon", 1), entry("e4", "2026-03-06T08:00:00Z", 6, user="u2")]
    called = []
    with pytest.raises(RunFailed, match="1 people"):
        run_sync(tables, load(bad), NOW + timedelta(hours=1), 30, lambda: called.append(1))
    got = state(tables)
    assert got["e1"] == (1, False) and got["e2"] == (2, False)  # u1 untouched
    assert got["e4"] == (6, False) and got["e3"] == (3, True)  # u2 merged
    assert called == []


def test_bad_reference_row_stops_before_writing(tables, load):
    with pytest.raises(ex.ExtractRejected):
        run_sync(tables, load(FIRST, users=[*USERS, {"name": "no id"}]), NOW, 30)
    assert tables.read("users").isEmpty() and tables.read_entries().isEmpty()


def test_an_older_run_cannot_replace_a_newer_one(tables, load):
    run_sync(tables, load(FIRST), NOW, 30)
    with pytest.raises(ValueError, match="older"):
        run_sync(tables, load(FIRST), NOW - timedelta(hours=1), 30)


def test_backfill(tables, load):
    assert parse_start(None) == utc("2026-01-01T00:00:00")
    for bad in (5, "yesterday", "2026-01-01"):
        with pytest.raises(ValueError):
            parse_start(bad)
    with pytest.raises(ValueError):
        run_backfill(tables, load([]), NOW, user_source_id=7)
    assert run_backfill(tables, load(FIRST), NOW, "2026-02-01T00:00:00Z") == {"upserted": 5, "skipped": 1}
    later = run_backfill(tables, load([FIRST[5], FIRST[3]]), NOW + timedelta(hours=1), None, "u1")
    assert later == {"upserted": 1, "skipped": 0}
    assert sorted(state(tables)) == ["e1", "e2", "e3", "e4", "e5", "e6"]
    with pytest.raises(RunFailed, match="nobody"):
        run_backfill(tables, load([]), NOW + timedelta(hours=2), None, "nobody")


# --- reconcile --------------------------------------------------------------


class Base:
    """A destination base that applies what it is sent."""

    def __init__(self, spark):
        self.spark = spark
        self.references = {"users": {"recAnn00000000000": " ANN LEE"}, "projects": {}, "clients": {}}
        self.records = {job.strategy: {} for job in model.RECONCILE_JOBS}
        self.assignments = {}
        self.log = []
        self.fail = None

    def destination(self):
        def refs(name):
            return self.spark.createDataFrame(list(self.references[name].items()), "id STRING, name STRING")

        def records(found):
            data = [(i, n, json.dumps(f)) for n, (i, f) in enumerate(found.items())]
            df = self.spark.createDataFrame(data, "id STRING, pos INT, j STRING")
            return df.select("id", "pos", F.parse_json("j").alias("fields"))

        return Destination(
            refs("users"), refs("projects"), refs("clients"), records(self.assignments),
            {s: records(r) for s, r in self.records.items()},
        )

    def send(self, table, kind, rows):
        if self.fail:
            raise RuntimeError(self.fail)
        data = [r.asDict() for r in rows.collect()]
        self.log.append((table, kind, len(data)))
        strategies = {job.name: job.strategy for job in model.RECONCILE_JOBS}
        for r in data:
            if table in self.references:
                self.references[table][r["link_id"]] = r["name"]
            elif table == "project_assignments":
                self.assignments[r["assignment_id"]] = {"Project": [r["project_link"]], "Month": r["month_date"]}
            elif kind == "insert":
                found = self.records[strategies[table]]
                cells = {k.replace("_", " ").title(): r[k] for k in r if k not in ("insert_id", "batch")}
                found[f"row{table[0]}{len(found)}"] = cells
            else:
                cells = self.records[strategies[table]][r["record_id"]]
                if r["set_actual"] is not None:
                    cells["Actual Hours"] = r["set_actual"]
                if r["set_assigned"] is not None:
                    cells["Assigned Hours"] = r["set_assigned"]


def test_reconcile_until_nothing_is_left_to_do(spark, tables, load):
    run_sync(tables, load(FIRST), NOW, 30)
    base = Base(spark)
    first = run_reconcile(tables, base.destination(), NOW, send=base.send)
    # Ann's record is found by name and linked, everything else is created.
    users = {r["name"]: r["link_id"] for r in tables.read("users").collect()}
    assert users["Ann Lee"] == "recAnn00000000000" and users["Bob"].startswith("rec") and users["Cy"] is None
    assert sorted(base.references["projects"].values()) == ["Alpha", "Beta", "No Project"]
    assert list(base.references["clients"].values()) == ["Acme"]
    kinds = {r["kind"] for r in first.reports.collect()}
    assert kinds == {"auto_heal"}
    # 4 hours-bearing (user, project, month) groups, likewise by cycle.
    assert first.stats == {"updated": 0, "inserted": 8, "skipped": 0, "missing": 0}
    # The sentinel was unlinked when reports needed it only now.
    second = run_reconcile(tables, base.destination(), NOW + timedelta(hours=1), send=base.send)
    assert second.stats == {"updated": 0, "inserted": 0, "skipped": 8, "missing": 0}

    edited = [entry("e1", "2026-03-05T08:00:00Z", 6), *FIRST[2:]]  # e1 longer, e2 gone
    run_sync(tables, load(edited), NOW + timedelta(hours=2), 30)
    base.log.clear()
    third = run_reconcile(tables, base.destination(), NOW + timedelta(hours=3), send=base.send)
    assert third.stats["updated"] == 4 and third.stats["inserted"] == 0
    assert [x for x in base.log if x[1] != "create"] == [
        ("People Assignments Table", "update", 2), ("Payroll Actuals Table", "update", 2),
    ]
    hours = sorted(f["Actual Hours"] for f in base.records[model.PAYROLL].values())
    assert hours == [0.0, 3.0, 4.0, 6.0]
    fourth = run_reconcile(tables, base.destination(), NOW + timedelta(hours=4), send=base.send)
    assert fourth.stats["updated"] == 0 and fourth.stats["inserted"] == 0


def test_dead_link_is_healed_and_other_errors_surface(spark, tables, load):
    run_sync(tables, load(FIRST), NOW, 30)
    base = Base(spark)
    run_reconcile(tables, base.destination(), NOW, send=base.send)
    base.fail = "422 ROW_DOES_NOT_EXIST: Record recAnn00000000000 does not exist"
    broken = run_reconcile(tables, base.destination(), NOW + timedelta(hours=1), send=base.send)
    assert broken.aborted and [r["kind"] for r in broken.reports.collect()] == ["dead_link"]
    assert tables.read("users").where("source_id = 'u1' AND link_id IS NULL").count() == 1
    base.fail = "INVALID_PERMISSIONS for recAnn00000000000"
    with pytest.raises(RuntimeError, match="INVALID_PERMISSIONS"):
        run_reconcile(tables, base.destination(), NOW + timedelta(hours=2), send=base.send)
    base.fail = None
    run_reconcile(tables, base.destination(), NOW + timedelta(hours=3), send=base.send)
    assert tables.read("users").where("source_id = 'u1' AND link_id = 'recAnn00000000000'").count() == 1


def test_send_batches(rows, tmp_path):
    batched = rc.batch_actions(rows("record_id STRING", *[(f"rec{i}",) for i in range(25)]), "record_id")
    out = str(tmp_path)

    def write(records):
        with open(f"{out}/{min(records)}.txt", "w") as f:
            f.write("\n".join(records))

    send_batches(rc.collect_batches(batched, F.col("record_id")), write)
    sent = [p.read_text().split("\n") for p in tmp_path.iterdir()]
    assert sorted(map(len, sent)) == [5, 10, 10] and len({x for s in sent for x in s}) == 25


# --- nudge ------------------------------------------------------------------


def test_nudge(spark, tables, load):
    more = [*FIRST, entry("n1", "2026-03-08T08:00:00Z", 1, user="u3", project=None, description="think")]
    run_sync(tables, load(more), NOW, 30)
    roster = spark.createDataFrame(
        [("S1", "somebody", "ANN@X.ORG", 0), ("S2", "Bob", None, 1)], "id STRING, name STRING, email STRING, pos INT"
    )
    result = run_nudge(tables, lambda: roster, NOW)
    assert result.nudged == 1
    assert [(r["chat_id"], r["first_name"], r["hours"], r["text"]) for r in result.nudges.collect()] == [
        ("S1", "Ann", "2", f"2026-03-05 2h {model.NO_DESCRIPTION}")
    ]
    assert [r["user_name"] for r in result.unmatched.collect()] == ["Cy"]
    assert result.reports.first()["text"] == "Cy, address unknown"
    assert {r["source_id"]: r["chat_id"] for r in tables.read("users").collect()} == {"u1": "S1", "u2": None, "u3": None}


def test_nobody_to_nudge_needs_no_roster(tables, load):
    run_sync(tables, load(FIRST), NOW, 30)

    def never():
        raise AssertionError("roster must not be loaded")

    assert run_nudge(tables, never, NOW, day=date(2026, 1, 10)).nudged == 0


# --- streaming --------------------------------------------------------------


def test_stream_equals_batch(spark, tables, load, tmp_path):
    run_backfill(tables, load([]), NOW)
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    files = [FIRST[:3], [entry("e1", "2026-02-05T08:00:00Z", 5), {"id": None, "userId": "u1"}], FIRST[3:]]

    def drain():
        query = start_entry_sync(
            read_entry_stream(spark, str(inbox), files_per_batch=1), tables, str(tmp_path / "cp"), str(tmp_path / "bad"),
            clock=lambda: NOW + timedelta(hours=1),
        )
        assert query.awaitTermination(120)

    import os

    for i, content in enumerate(files):
        path = inbox / f"f{i}.json"
        path.write_text("\n".join(json.dumps(x) for x in content))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    drain()
    expected = {"e1": (5, False), "e2": (2, False), "e3": (3, False), "e4": (4, False), "e5": (None, False), "e6": (9, False)}
    assert state(tables) == expected
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
    drain()
    assert state(tables) == expected


def test_last_arrival_in_one_batch_wins(spark, tables, load, tmp_path):
    import os

    run_backfill(tables, load([]), NOW)
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for i, hours in enumerate([1, 3, 2]):
        path = inbox / f"f{i}.json"
        path.write_text(json.dumps(entry("e1", "2026-03-05T08:00:00Z", hours)))
        os.utime(path, (1_700_000_000 + hours, 1_700_000_000 + hours))
    query = start_entry_sync(read_entry_stream(spark, str(inbox)), tables, str(tmp_path / "cp"), str(tmp_path / "bad"),
                             clock=lambda: NOW + timedelta(hours=1))
    assert query.awaitTermination(120)
    assert state(tables) == {"e1": (3, False)}


def test_drop_repeats(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.json").write_text("\n".join(json.dumps({"source_id": s, "start_time": "2026-03-05T08:00:00Z"}) for s in "aab"))
    (inbox / "b.json").write_text(json.dumps({"source_id": "b", "start_time": "2026-03-05T09:00:00Z"}))
    stream = (
        spark.readStream.schema("source_id STRING, start_time TIMESTAMP").option("maxFilesPerTrigger", 1).json(str(inbox))
    )
    query = (
        drop_repeats(stream, "2 hours").writeStream.format("memory").queryName("seen")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    assert ids(spark.table("seen")) == ["a", "b"]


# --- what a run may not lose ------------------------------------------------


@pytest.mark.parametrize("line", ['{"id": "e1", "userId": "u1", "timeInt', '{"id": "e1", "timeInterval": {"start": "2026-03-05T08:00:00Z"}}'])
def test_unreadable_line_of_nobody_deletes_nothing(spark, tables, load, tmp_path, line):
    run_sync(tables, load(FIRST), NOW, 30)
    broken = tmp_path / "broken.json"
    broken.write_text(line)
    extracts = load([])._replace(entries=ex.load_time_entries(spark, str(broken), ex.QUARANTINE))
    with pytest.raises(RunFailed):
        run_sync(tables, extracts, NOW + timedelta(hours=1), 30)
    assert not any(deleted for _, deleted in state(tables).values())


def test_only_scanned_users_lose_entries(spark, tables, load):
    run_sync(tables, load(FIRST), NOW, 30)
    scanned = spark.createDataFrame([("u1",)], "source_id STRING")
    run_sync(tables, load([])._replace(scanned_users=scanned), NOW + timedelta(hours=1), 30)
    got = state(tables)
    assert got["e1"][1] and not got["e3"][1] and not got["e4"][1]


def test_publish_cut_before_its_manifest_changes_nothing(tables, load, monkeypatch):
    run_sync(tables, load(FIRST), NOW, 30)
    before = state(tables)
    moved = [entry("e1", "2026-03-04T08:00:00Z", 5), *FIRST[1:]]
    with monkeypatch.context() as cut:
        cut.setattr(Tables, "_manifest_rows", lambda *_: (_ for _ in ()).throw(OSError("cut")))
        with pytest.raises(OSError):
            run_sync(tables, load(moved), NOW + timedelta(hours=1), 30)
    assert state(tables) == before
    run_sync(tables, load(moved), NOW + timedelta(hours=1), 30)
    rows = [r["source_id"] for r in tables.read_entries().collect()]
    assert len(rows) == len(set(rows)) and state(tables)["e1"][0] == 5
