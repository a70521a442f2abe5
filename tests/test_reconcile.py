import json

import pytest
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger.operators import reconcile as rc
from shiftledger.operators import references as rf

SOURCE = "user_link STRING, user_name STRING, project_link STRING, project_name STRING, month STRING, total_hours STRING, raw_project_link STRING"
CYCLE = "23 Jan to 22 Feb 2026"
MONTH = "February 2026"


@pytest.fixture
def source(rows):
    """(user link, user, project link, project, month, hours[, raw link])"""
    return lambda *data: rows(SOURCE, *[(*d, d[2]) if len(d) == 6 else d for d in data])


@pytest.fixture
def records(rows):
    def make(*data):
        df = rows("id STRING, pos INT, j STRING", *[(i, n, json.dumps(f)) for n, (i, f) in enumerate(data)])
        return df.select("id", "pos", F.parse_json("j").alias("fields"))

    return make


def payroll(user, project, hours="absent", month=CYCLE):
    fields = {"User": [user] if user else [], "Month": month}
    if project:
        fields["Project"] = [project]
    if hours != "absent":
        fields["Actual Hours"] = hours
    return fields


def outcomes(diff):
    return sorted((r["outcome"], r["record_id"], r["set_actual"]) for r in diff.actions.collect())


def stats(diff):
    return diff.stats.first().asDict()


# --- payroll ----------------------------------------------------------------


def test_payroll_insert(source, records):
    diff = rc.calculate_diff(source(("recU", "Ann", "recP", "Alpha", CYCLE, "15.5")), records(), model.PAYROLL)
    assert [tuple(r) for r in diff.inserts.collect()] == [(["recU"], ["recP"], CYCLE, 15.5)]
    assert stats(diff) == {"updated": 0, "inserted": 1, "skipped": 0, "missing": 0}


def test_payroll_insert_without_project_and_without_user(source, records):
    diff = rc.calculate_diff(
        source((" recU ", "Ann", "  ", "x", CYCLE, "1"), (None, "Bob", "recP", "x", CYCLE, "1"), ("", "Cy", "recP", "x", CYCLE, "1")),
        records(),
        model.PAYROLL,
    )
    assert [tuple(r) for r in diff.inserts.collect()] == [(["recU"], [], CYCLE, 1.0)]
    assert stats(diff)["missing"] == 2


def test_inserts_can_be_forbidden(source, records):
    diff = rc.calculate_diff(
        source(("recU", "Ann", "recP", "x", CYCLE, "1")), records(), model.PAYROLL, allow_inserts=False
    )
    assert stats(diff) == {"updated": 0, "inserted": 0, "skipped": 0, "missing": 1}


@pytest.mark.parametrize(
    "stored, hours, outcome",
    [
        (15.5, "20.0", "update"),
        (20, "20.0", "unchanged"),
        (20.0, "20.01", "update"),  # 0.01 apart, but a little more in binary
        (15.49, "15.5", "unchanged"),
        (None, "0", "unchanged"),
        ("absent", "0", "update"),
        ("text", "0", "unchanged"),
        ("text", "3", "update"),
        (5, "not a number", "update"),
    ],
)
def test_payroll_update_rule(source, records, stored, hours, outcome):
    diff = rc.calculate_diff(
        source(("recU", "Ann", "recP", "x", CYCLE, hours)), records(("r", payroll("recU", "recP", stored))), model.PAYROLL
    )
    assert [r["outcome"] for r in diff.actions.collect()] == [outcome]
    if outcome == "update":
        expected = 0.0 if hours == "not a number" else float(hours)
        assert [r["set_actual"] for r in diff.updates.collect()] == [expected]


def test_missing_user_and_project_still_match(source, records):
    diff = rc.calculate_diff(
        source((None, "Ann", None, "No Project", CYCLE, "2")), records(("r", payroll(None, None, 1))), model.PAYROLL
    )
    assert outcomes(diff) == [("update", "r", 2.0)]


def test_last_record_of_a_key_wins_and_the_other_is_zeroed(source, records):
    diff = rc.calculate_diff(
        source(("recU", "Ann", "recP", "x", CYCLE, "2")),
        records(("first", payroll("recU", "recP", 7)), ("last", payroll("recU", "recP", 2))),
        model.PAYROLL,
    )
    assert outcomes(diff) == [("unchanged", "last", None), ("zeroed", "first", 0.0)]


def test_zero_stale_by_cell_state(source, records):
    diff = rc.calculate_diff(
        source(),
        records(*[(str(i), payroll("u", "p", h)) for i, h in enumerate([5, 0, 0.0, None, "text", "absent"])]),
        model.PAYROLL,
    )
    assert [o[1] for o in outcomes(diff)] == ["0", "3", "4"]
    assert stats(diff) == {"updated": 3, "inserted": 0, "skipped": 0, "missing": 0}


def test_source_rows_sharing_a_key(source, records):
    """Matched: two updates counted, the last by name and raw link kept. Unmatched: two inserts."""
    shared = [
        ("recU", "Ann", "recNP", "No Project", CYCLE, "3", "recNP"),
        ("recU", "Ann", "recNP", "No Project", CYCLE, "5", None),
        ("recU", "Ann", "recNP", "Beta", CYCLE, "9", None),
    ]
    diff = rc.calculate_diff(source(*shared), records(("r", payroll("recU", "recNP", 1))), model.PAYROLL)
    assert stats(diff)["updated"] == 3
    assert [tuple(r) for r in rc.dedupe_updates(diff.updates).select("record_id", "set_actual").collect()] == [("r", 3.0)]
    assert stats(rc.calculate_diff(source(*shared), records(), model.PAYROLL))["inserted"] == 3
    merged = rc.calculate_diff(source(*shared), records(), model.PAYROLL, merge_duplicate_keys=True)
    assert [r["actual_hours"] for r in merged.inserts.collect()] == [17.0]


def test_unknown_strategy(source, records):
    with pytest.raises(ValueError):
        rc.calculate_diff(source(), records(), "OTHER")
    with pytest.raises(ValueError):
        rc.calculate_diff(source(), records(), model.ASSIGNMENT)


# --- assignments ------------------------------------------------------------


@pytest.fixture
def index(rows):
    return rows("project_link STRING, month_date STRING, assignment_id STRING", ("recP", "2026-02-01", "recPA"))


def person(user, assignment, **cells):
    return {"Person": [user], "Project Assignment": [assignment] if assignment else [], **cells}


def test_assignment_outcomes(source, records, index):
    diff = rc.calculate_diff(
        source(
            ("recU", "Ann", "recP", "x", MONTH, "8"),
            ("recV", "Bob", "recP", "x", MONTH, "4"),
            ("recU", "Ann", " ", "x", MONTH, "1"),
            ("recU", "Ann", None, "x", MONTH, "1"),
            ("recU", "Ann", "recQ", "x", MONTH, "1"),
            (None, "Cy", "recP", "x", MONTH, "1"),
        ),
        records(("r", person("recU", "recPA", **{"Actual Hours": 5, "Assigned Hours": 0}))),
        model.ASSIGNMENT,
        index,
    )
    assert stats(diff) == {"updated": 1, "inserted": 1, "skipped": 2, "missing": 2}
    assert [tuple(r) for r in diff.inserts.collect()] == [(["recV"], ["recPA"], 4.0, 0.0)]
    assert [(r["set_actual"], r["set_assigned"]) for r in diff.updates.collect()] == [(8.0, None)]


@pytest.mark.parametrize(
    "cells, expected",
    [
        ({"Actual Hours": 8}, (None, 0.0)),
        ({"Actual Hours": 8, "Assigned Hours": None}, None),
        ({"Actual Hours": 8, "Assigned Hours": 40}, None),
        ({"Actual Hours": 9}, (8.0, 0.0)),
        ({"Actual Hours": 9, "Assigned Hours": 1}, (8.0, None)),
    ],
)
def test_assigned_hours_are_filled_in(source, records, index, cells, expected):
    diff = rc.calculate_diff(
        source(("recU", "Ann", "recP", "x", MONTH, "8")), records(("r", person("recU", "recPA", **cells))), model.ASSIGNMENT, index
    )
    got = [(r["set_actual"], r["set_assigned"]) for r in diff.updates.collect()]
    assert got == ([] if expected is None else [expected])


def test_records_without_person_or_assignment_never_match(source, records, index):
    diff = rc.calculate_diff(
        source((None, "Cy", "recP", "x", MONTH, "1")),
        records(
            ("a", {"Person": [], "Project Assignment": ["recPA"], "Actual Hours": 1, "Assigned Hours": 0}),
            ("b", {"Person": ["recU"], "Actual Hours": 2, "Assigned Hours": 0}),
        ),
        model.ASSIGNMENT,
        index,
    )
    assert outcomes(diff) == [("missing", None, None), ("zeroed", "a", 0.0), ("zeroed", "b", 0.0)]


def test_bad_month_fails(source, records, index):
    with pytest.raises(Exception, match="No such month"):
        rc.calculate_diff(source(("u", "n", "p", "x", CYCLE, "1")), records(), model.ASSIGNMENT, index).actions.collect()


# --- batches, dead links ----------------------------------------------------


def test_batches(rows):
    updates = rows("record_id STRING", *[(f"rec{i}",) for i in range(25)])
    batched = rc.batch_actions(updates, "record_id")
    sizes = sorted(len(r["records"]) for r in rc.collect_batches(batched, F.col("record_id")).collect())
    assert sizes == [5, 10, 10]


def test_batches_are_full_but_the_last(rows):
    updates = rows("record_id STRING", *[(f"rec{i}",) for i in range(1003)])
    for slices in (1, 7, 1024):
        batches = rc.collect_batches(rc.batch_actions(updates, "record_id", 10, slices), F.col("record_id")).collect()
        assert sorted(len(b["records"]) for b in batches) == [3] + [10] * 100
        assert len({x for b in batches for x in b["records"]}) == 1003


@pytest.mark.parametrize(
    "message, link",
    [
        ("422 ROW_DOES_NOT_EXIST: Record ID recABCDEFGHIJKLMN does not exist", "recABCDEFGHIJKLMN"),
        ("INVALID_RECORD_ID rec12345678901234 and recABCDEFGHIJKLMN", "rec12345678901234"),
        ("RECORD_NOT_FOUND recShort", None),
        ("INVALID_PERMISSIONS recABCDEFGHIJKLMN", None),
    ],
)
def test_dead_links(rows, message, link):
    assert rc.extract_dead_links(rows("message STRING", (message,))).first()["link_id"] == link


# --- references -------------------------------------------------------------


def test_heal_create_conflict(rows):
    records = rows("id STRING, name STRING", ("r1", " ALPHA "), ("r2", "Beta"), ("r3", "beta\t"), ("r4", "Other"))
    missing = rows("id STRING, name STRING", ("1", "alpha"), ("2", "BETA"), ("3", "Gamma"), ("4", "gamma "))
    got = rf.resolve_links(missing, records)
    assert {r["id"]: (r["action"], r["link_id"]) for r in got.collect()} == {
        "1": ("heal", "r1"), "2": ("conflict", None), "3": ("create", None), "4": ("create", None),
    }
    created = {r["id"]: r["link_id"] for r in rf.with_created_ids(got, "users").collect()}
    assert created["1"] == "r1" and created["2"] is None and created["3"] != created["4"]
    table = rows("id STRING, link_id STRING", ("1", None), ("2", None), ("3", None), ("9", "old"))
    linked = {r["id"]: r["link_id"] for r in rf.write_back(table, rf.with_created_ids(got, "users")).collect()}
    assert linked == {"1": "r1", "2": None, "3": created["3"], "9": "old"}


def test_missing_rows(rows):
    names = rows("name STRING", ("Alpha",), ("Beta",), ("Gamma",))
    projects = rows(
        "id STRING, name STRING, client_id STRING, link_id STRING",
        ("p1", "Alpha", "c1", "rec1"), ("p2", "Beta", "c2", None), ("p3", "Gamma", None, ""), ("p4", "Delta", "c3", None),
        ("p5", "alpha", "c3", None),
    )
    clients = rows("id STRING, name STRING, link_id STRING", ("c1", "A", None), ("c2", "B", ""), ("c3", "C", None))
    assert sorted(r["id"] for r in rf.missing_projects(projects, names).collect()) == ["p2", "p3"]
    assert sorted(r["id"] for r in rf.missing_by_name(projects, names).collect()) == ["p2"]
    assert [r["id"] for r in rf.missing_clients(projects, clients, names).collect()] == ["c1"]


def test_assignments(rows, source):
    cells = rows(
        "id STRING, pos INT, project_link STRING, month STRING",
        ("a", 1, "recP", "2026-02-01"), ("b", 2, "recP", "2026-02-01"), ("c", 3, None, "2026-02-01"), ("d", 4, "recQ", None),
    )
    index = rf.assignment_index(cells)
    assert [tuple(r) for r in index.collect()] == [("recP", "2026-02-01", "b")]
    rows_ = source(
        ("u", "n", "recP", "x", MONTH, "1"), ("u", "n", " recQ", "x", MONTH, "1"), ("v", "m", "recQ", "x", MONTH, "1"),
        ("u", "n", "", "x", MONTH, "1"), ("u", "n", None, "x", MONTH, "1"), ("u", "n", "recP", "x", "March 2026", "1"),
    )
    missing = rf.missing_assignments(rows_, index)
    assert sorted(map(tuple, missing.collect())) == [("recP", "2026-03-01"), ("recQ", "2026-02-01")]
    new = rf.new_assignment_rows(missing)
    assert set(new.columns) == {
        "assignment_id", "project_link", "month_date", "commitment_hours", "hours_to_be_paid", "original_invoice_amount",
    }
    assert rf.complete_assignments(index, new).count() == 3
    assert rf.missing_assignments(rows_, rf.complete_assignments(index, new)).isEmpty()
