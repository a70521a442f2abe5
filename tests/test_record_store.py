"""Destination records laid out by key: kept up from changes, met without a shuffle, read by leaves."""

import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_jobs import FIRST, NOW, Base, entry, load, tables  # noqa: F401

from shiftledger import model
from shiftledger.operators import reconcile as rc
from shiftledger.plans.reconcile import run_reconcile
from shiftledger.plans.sync import run_sync
from shiftledger.sources.record_store import RecordStore, store_records
from shiftledger.sources.tables import PublishConflict, Tables

CELLS = {
    model.PAYROLL: "id STRING, pos INT, user_key STRING, project_key STRING, month_key STRING, actual_kind STRING, actual DOUBLE",
    model.ASSIGNMENT: "id STRING, pos INT, user_key STRING, assignment_key STRING, actual_kind STRING, actual DOUBLE, assigned_kind STRING",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def some(rows):
    def make(strategy, *data):
        return rows(CELLS[strategy], *data)

    return make


def record(strategy, dice, number, pos):
    """A few keys only, one of them frequent; assignment keys may be missing."""
    user = "hot" if dice.random() < 0.4 else dice.choice("abcd")
    if strategy == model.PAYROLL:
        return (f"r{number}", pos, user, dice.choice(["p", "q"]), "m", "number", float(pos))
    found = dice.choice(["x", "y", None])
    return (f"r{number}", pos, user, found, "number", float(pos), "absent")


def state(layout):
    return tuple(sorted(map(str, part.select(sorted(part.columns)).collect())) for part in layout)


@pytest.mark.parametrize("strategy", [model.PAYROLL, model.ASSIGNMENT])
def test_refresh_equals_replace(spark, some, tmp_path, strategy):
    dice = random.Random(5)
    held = {n: record(strategy, dice, n, n) for n in range(60)}
    store = RecordStore(Tables(spark, str(tmp_path / "kept")), strategy)
    assert store.read() is None
    store.replace(some(strategy, *held.values()), 4)
    for step in range(3):
        moved = dice.sample(sorted(held), 12)
        gone, changed = moved[:5], moved[5:]
        new = {n: record(strategy, dice, n, dice.randrange(100) + 100 * step) for n in [*changed, *range(100 * step + 100, 100 * step + 106)]}
        for n in gone:
            del held[n]
        held |= new
        missing = spark.createDataFrame([(f"r{n}",) for n in [*gone, 9999]], "id STRING")
        store.refresh(some(strategy, *new.values()), missing)
        fresh = RecordStore(Tables(spark, str(tmp_path / f"fresh{step}")), strategy)
        assert state(store.read()) == state(fresh.replace(some(strategy, *held.values()), 4))
    assert store.read().current.groupBy(*rc.key_columns(strategy)).count().where("count > 1").isEmpty()


def test_an_emptied_and_an_empty_layout(spark, some, tmp_path):
    store = RecordStore(Tables(spark, str(tmp_path)), model.PAYROLL)
    assert state(store.replace(some(model.PAYROLL), 4)) == ([], [])
    one = some(model.PAYROLL, ("a", 1, "u", "p", "m", "number", 1.0))
    assert [len(part) for part in state(store.refresh(one))] == [1, 0]
    assert state(store.refresh(one.limit(0), one.select("id"))) == ([], [])


def test_of_two_writers_on_one_state_one_fails(spark, some, tmp_path, monkeypatch):
    one = some(model.PAYROLL, ("a", 1, "u", "p", "m", "number", 1.0))
    first, second = (RecordStore(Tables(spark, str(tmp_path)), model.PAYROLL) for _ in range(2))
    before = first._held()
    first.replace(one, 4)
    monkeypatch.setattr(second, "_held", lambda: before)
    with pytest.raises(PublishConflict):
        second.replace(one.limit(0), 4)
    assert first.read().current.count() == 1


def test_records_are_not_shuffled(spark, some, rows, tmp_path):
    store = RecordStore(Tables(spark, str(tmp_path)), model.PAYROLL)
    data = [(f"r{n}", n, f"u{n % 40}", "p", "m", "number", float(n)) for n in range(100)]
    store.replace(some(model.PAYROLL, *data), 4)
    # As another session would read it, which knows the folder only.
    for table in spark.catalog.listTables():
        if table.name.startswith("records_"):
            spark.sql(f"DROP TABLE {table.name}")
    source = rows(
        "user_link STRING, user_name STRING, project_link STRING, project_name STRING, month STRING, total_hours STRING",
        *[(f"u{n}", "n", "p", "x", "m", "5") for n in range(20, 50)],
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        diff = rc.diff_of_layout(source, store.read(), model.PAYROLL)
        # One shuffle: that of the report's rows into the layout's buckets.
        text = plan(diff.actions)
        assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text and "SelectedBucketsCount: 4 out of 4" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    want = rc.diff_of_cells(source, some(model.PAYROLL, *data), model.PAYROLL)
    assert sorted(map(str, diff.actions.collect())) == sorted(map(str, want.actions.collect()))


def test_a_reader_of_some_cells_reads_their_leaves(spark, rows, tmp_path):
    fields = {"User": ["u"], "Project": ["p"], "Month": "m", "Actual Hours": 1.5, "Notes": "long text"}
    odd = [{}, {"Actual Hours": None}, {"Actual Hours": "3"}, {"User": [], "Month": 4}, {"Actual Hours": 7}]
    data = [(f"r{n}", n, json.dumps(f)) for n, f in enumerate([fields] * 20 + odd)]
    records = rows("id STRING, pos INT, j STRING", *data).select("id", "pos", F.parse_json("j").alias("fields"))
    held = store_records(records, str(tmp_path / "records"))
    typed = rc.destination_cells(held, model.PAYROLL)
    schema = next(part for part in plan(typed).split("ReadSchema: ")[1:])
    # Leaves are numbered; the whole record would be one variant.
    assert schema.startswith("struct<id:string,pos:int,fields:struct<0:") and "fields:variant" not in schema
    assert sorted(map(str, typed.collect())) == sorted(map(str, rc.destination_cells(records, model.PAYROLL).collect()))


def test_a_reconcile_against_layouts_finds_the_same(spark, tables, load, tmp_path):  # noqa: F811
    run_sync(tables, load(FIRST), NOW, 30)
    base = Base(spark)
    run_reconcile(tables, base.destination(), NOW, send=base.send)
    run_sync(tables, load([entry("e1", "2026-03-05T08:00:00Z", 6), *FIRST[2:]]), NOW + timedelta(hours=2), 30)
    plain = base.destination()
    stores = {s: RecordStore(Tables(spark, str(tmp_path / "destination")), s) for s in plain.records}
    layouts = {s: store.replace(rc.destination_cells(plain.records[s], s), 4) for s, store in stores.items()}
    met = run_reconcile(tables, plain._replace(records=layouts), NOW + timedelta(hours=3))
    assert met.stats["updated"] == 4
    want = run_reconcile(tables, plain, NOW + timedelta(hours=4))
    assert met.stats == want.stats
    for name, actions in want.actions.items():
        assert sorted(map(str, met.actions[name].collect())) == sorted(map(str, actions.collect()))
