import json

import pytest
from conftest import ids, utc
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger.sources import destination as dst
from shiftledger.sources import extracts as ex
from shiftledger.sources import lookups


def write(tmp_path, *lines):
    (tmp_path / "x.json").write_text("\n".join(json.dumps(x) for x in lines))
    return str(tmp_path / "x.json")


def test_users_defaults(spark, tmp_path):
    path = write(
        tmp_path,
        [{"id": "1", "name": "Ann", "email": "ann@x.org", "status": "ACTIVE"}, {"id": "2", "email": "b@x.org"}],
        {"id": "3"},
        {"id": "4", "name": "", "email": None},
    )
    got = {r["source_id"]: r["name"] for r in ex.load_users(spark, path).valid.collect()}
    assert got == {"1": "Ann", "2": "b@x.org", "3": model.UNKNOWN_USER, "4": ""}


def test_clients_and_projects_defaults(spark, tmp_path):
    path = write(tmp_path, {"id": "1"}, {"id": "2", "name": "N", "clientId": "c"})
    clients = ex.load_clients(spark, path).valid
    projects = ex.load_projects(spark, path).valid
    assert sorted(map(tuple, clients.collect())) == [("1", model.UNKNOWN_CLIENT), ("2", "N")]
    assert sorted(map(tuple, projects.collect()), key=str) == [("1", model.UNKNOWN_PROJECT, None), ("2", "N", "c")]


def test_one_bad_row_fails_a_strict_extract(spark, tmp_path):
    path = write(tmp_path, {"id": "1", "name": "ok"}, {"name": "no id"})
    checked = ex.load_users(spark, path)
    with pytest.raises(Exception, match="Invalid extract row: id"):
        checked.valid.collect()
    with pytest.raises(ex.ExtractRejected, match="id: 1"):
        ex.require_clean(checked.rejected, "users")


def test_quarantine_keeps_good_rows_and_names_reasons(spark, tmp_path):
    (tmp_path / "x.json").write_text(
        '{"id": "1", "email": "a.b@x.org"}\n{"id": "2", "email": "nope"}\n{"email": "@"}\n{broken\n'
    )
    checked = ex.load_users(spark, str(tmp_path / "x.json"), ex.QUARANTINE)
    assert ids(checked.valid) == ["1"]
    assert sorted(tuple(r["reasons"]) for r in checked.rejected.collect()) == [
        ("email",), ("id", "email"), ("json", "id"),
    ]


@pytest.mark.parametrize(
    "email, fine",
    [("a@b.co", True), ("a+b_c-d@sub.x-y.org", True), (".a@b.co", False), ("a..b@c.de", False), ("a@b", False), ("a b@c.de", False)],
)
def test_email_format(rows, email, fine):
    assert rows("e STRING", (email,)).select(F.col("e").rlike(model.EMAIL_PATTERN)).first()[0] is fine


ENTRY = {
    "id": "e1", "description": "d", "userId": "u", "projectId": "p", "billable": True,
    "timeInterval": {"start": "2026-01-02T03:04:05Z", "end": "2026-01-02T04:04:05Z", "duration": "PT1H"},
}


def test_time_entries_are_flattened(spark, tmp_path):
    running = {"id": "e2", "userId": "u", "timeInterval": {"start": "2026-01-02T03:04:05Z"}}
    got = {r["source_id"]: r.asDict() for r in ex.load_time_entries(spark, write(tmp_path, [ENTRY], running)).valid.select(
        "*", F.unix_seconds("start_time").alias("s")).collect()}
    assert got["e1"]["duration_us"] == 3_600_000_000 and got["e1"]["user_source_id"] == "u"
    assert got["e1"]["s"] == int(utc("2026-01-02T03:04:05").timestamp())
    assert [got["e2"][c] for c in ("description", "end_time", "duration_us", "project_source_id")] == [None] * 4


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"id": None}, "id"),
        ({"userId": None}, "userId"),
        ({"timeInterval": {"start": "2026-01-02"}}, "start"),
        ({"timeInterval": {"start": "2026-01-02T03:04:05Z", "end": "x"}}, "end"),
        ({"timeInterval": {"start": "2026-01-02T03:04:05Z", "duration": "1h"}}, "duration"),
    ],
)
def test_invalid_time_entries(spark, tmp_path, change, rule):
    path = write(tmp_path, ENTRY, {**ENTRY, **change})
    checked = ex.load_time_entries(spark, path, ex.QUARANTINE)
    assert checked.valid.count() == 1
    assert [r["reasons"] for r in checked.rejected.collect()] == [[rule]]
    with pytest.raises(Exception, match=rule):
        ex.load_time_entries(spark, path).valid.collect()


def test_roster(spark, tmp_path):
    member = {"id": "S1", "name": "ann", "real_name": "Ann Lee", "profile": {"email": "a@x.org"}, "tz": "UTC"}
    path = write(
        tmp_path,
        {"ok": True, "members": [
            member, {"id": "S2", "name": "bob"}, {**member, "id": "S3", "deleted": True},
            {**member, "id": "S4", "is_bot": True}, {**member, "id": model.SYSTEM_MEMBER_IDS[0]},
        ]},
    )
    got = ex.load_roster(spark, path).orderBy("pos").select("id", "name", "email").collect()
    assert [tuple(r) for r in got] == [("S1", "Ann Lee", "a@x.org"), ("S2", "bob", None)]


def test_failed_roster_fails(spark, tmp_path):
    with pytest.raises(Exception, match="invalid_auth"):
        ex.load_roster(spark, write(tmp_path, {"ok": False, "error": "invalid_auth"})).collect()


def test_destination_records(spark, tmp_path):
    path = write(
        tmp_path,
        {"page": 2, "records": [{"id": "r3", "fields": {"Name": 5}}]},
        {"page": 1, "records": [{"id": "r1", "fields": {"Name": "One", "User": ["u"]}}, {"id": "r2", "fields": {}}]},
    )
    records = dst.load_destination(spark, path)
    assert [r["id"] for r in records.orderBy("pos").collect()] == ["r1", "r2", "r3"]
    assert [tuple(r) for r in dst.load_reference_records(spark, path, "Name").collect()] == [("r1", "One")]
    cells = dst.load_strategy_cells(spark, path, model.PAYROLL)
    assert set(cells.columns) == {"id", "pos", "user_key", "project_key", "month_key", "actual_kind", "actual"}
    assert sorted(tuple(r) for r in cells.select("id", "user_key", "project_key", "month_key").collect()) == [
        ("r1", "u", "no_project", ""), ("r2", "no_user", "no_project", ""), ("r3", "no_user", "no_project", ""),
    ]
    with pytest.raises(ValueError):
        dst.load_strategy_cells(spark, path, "OTHER")


def test_inspect(rows):
    df = rows("a INT, b STRING", (1, "x"), (2, "y"), (3, "z"))
    assert dst.inspect_records(df).count() == 3
    assert [tuple(r) for r in dst.inspect_records(df, "a > 1 AND b = 'z'", ["b"]).collect()] == [("z",)]
    assert dst.inspect_records(df, max_rows=1).count() == 1
    for bad in (0, 100_001, "5", True):
        with pytest.raises(ValueError):
            dst.inspect_records(df, max_rows=bad)
    records = df.select(F.col("b").alias("id"), F.parse_json(F.lit('{"X": 1}')).alias("fields"))
    assert dst.inspect_cells(records, ["X"], "id <> 'x'", 5).count() == 2


def test_lookups(rows):
    users = rows(model.USERS, ("1", "s1", "A", None, None, None, None), ("2", "s2", "B", None, None, None, None))
    assert lookups.users_by_source_id(users).count() == 2
    assert ids(lookups.users_by_source_id(users, "s2")) == ["s2"]
    assert ids(lookups.rows_in(users, "name", rows("name STRING", ("A",), ("A",), ("Q",)))) == ["s1"]
