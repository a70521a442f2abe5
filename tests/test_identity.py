from decimal import Decimal

import pytest

from shiftledger.operators import identity, reports


@pytest.fixture
def roster(rows):
    return rows(
        "id STRING, name STRING, email STRING, pos INT",
        ("S1", "Ann Lee", " ANN@x.org", 0),
        ("S2", "Bob", None, 1),
        ("S3", "BOB ", "bob@other.org", 2),
        ("S4", "ann lee", "ann@x.org", 3),
    )


@pytest.fixture
def people(rows):
    return rows(
        "user_id STRING, user_name STRING, user_email STRING, chat_id STRING",
        ("1", "Anyone", "ann@x.org", "C9"),
        ("2", "Anyone", "Ann@X.org ", None),
        ("3", " bob", "bob@x.org", None),
        ("4", "bob", None, ""),
        ("5", "Nobody", "no@x.org", None),
        ("6", "ann lee", " ", None),
    )


def test_match(people, roster):
    got = {r["user_id"]: (r["matched_chat_id"], r["matched_by"]) for r in identity.match_identity(people, roster).collect()}
    assert got == {
        "1": ("C9", "cache"), "2": ("S1", "email"), "3": ("S2", "name"), "4": ("S2", "name"), "5": (None, None), "6": ("S1", "name"),
    }


def test_discovered_unmatched_counts(people, roster):
    matched = identity.match_identity(people, roster)
    assert sorted(map(tuple, identity.discovered_ids(matched).collect())) == [("2", "S1"), ("3", "S2"), ("4", "S2"), ("6", "S1")]
    assert [r["user_id"] for r in identity.unmatched_people(matched).collect()] == ["5"]
    assert tuple(identity.matched_count(matched).first()) == (6, 1, 5)
    text = reports.unmatched_rows(identity.unmatched_people(matched)).collect()
    assert [(r["section"], r["text"]) for r in text] == [("people", "Nobody, no@x.org")]


def test_nudge_text(rows):
    matched = rows(
        "user_id STRING, user_name STRING, matched_chat_id STRING, unassigned_hours DECIMAL(20,2)",
        ("1", "Ann Lee", "S1", Decimal("2.00")),
        ("2", "Bob", None, Decimal("1.00")),
    )
    entries = rows(
        "user_id STRING, source_id STRING, date STRING, description STRING, duration_hours DECIMAL(20,2)",
        ("1", "a", "2026-03-01", "plan", Decimal("1.25")), ("2", "b", "2026-03-02", "mail", Decimal("0.50")),
    )
    got = [tuple(r) for r in identity.nudge_rows(matched, entries).collect()]
    assert got == [("S1", "1", "Ann", "2", "2026-03-01", "a", "2026-03-01 1.25h plan")]


REPORT = "upserted BIGINT, deleted BIGINT, users_scanned BIGINT"
CHANGES = "table STRING, kind STRING, text STRING"


def test_sync_report_has_a_row_per_line(rows):
    changes = rows(CHANGES, *[("users", "added", "same name")] * 5000, ("clients", "added", "Z"))
    got = [(r["section"], r["text"]) for r in reports.sync_report_rows(rows(REPORT, (7, 2, 4)), changes).collect()]
    assert got.count(("users added", "same name")) == 5000 and ("clients added", "Z") in got
    assert sorted(t for s, t in got if s == "run") == [
        "merged entries: 7", "outcome: SUCCESS", "people looked at: 4", "removed entries: 2"
    ]


def test_alert_rows(rows):
    resolved = rows(
        "id STRING, name STRING, action STRING, link_id STRING",
        ("1", "Alpha", "heal", "rec1"), ("2", "Beta", "conflict", None), ("3", "Gamma", "create", "rec3"),
    )
    assert [r["section"] for r in reports.conflict_rows(resolved).collect()] == ["Beta"]
    healed = reports.heal_rows(resolved, "users").collect()
    assert [r["text"] for r in healed] == ["Alpha is linked to rec1"]
    dead = rows("link_id STRING", ("rec1",), ("rec1",), (None,))
    assert reports.dead_link_rows(dead).count() == 1
