import pytest
from conftest import ids, utc
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger.operators import integrity, upsert
from shiftledger.operators import window_sync as ws

RUN = utc("2026-03-01T00:00:00")
OLD = utc("2025-01-01T00:00:00")
H = 3_600_000_000


@pytest.fixture
def users(rows):
    return rows(
        model.USERS,
        ("u1", "s1", "Ann", "a@x.org", "recA", "C1", OLD),
        ("u2", "s2", "Bob", None, None, None, OLD),
    )


@pytest.fixture
def projects(rows):
    return rows(model.PROJECTS, ("p1", "sp1", "Alpha", None, "recP", OLD))


ENTRY = "source_id STRING, description STRING, start_time TIMESTAMP, end_time TIMESTAMP, duration_us BIGINT, user_source_id STRING, project_source_id STRING"


def stored(rows, *data):
    """(source id, start, duration, user, deleted, project)"""
    return rows(
        model.ENTRIES,
        *[("id" + s, s, "old", utc(t), None, d, u, p, utc(x) if x else None, OLD) for s, t, d, u, x, p in data],
    )


def extract(rows, *data):
    """(source id, start, duration, user source id, project source id)"""
    return rows(ENTRY, *[(s, "new", utc(t), None, d, u, p) for s, t, d, u, p in data])


def by_key(df, *columns):
    return {r["source_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_upsert_touches_only_listed_columns(rows, users):
    got = upsert.upsert(
        users, rows("source_id STRING, name STRING, email STRING", ("s1", "Anna", None), ("s9", "New", "n@x.org")),
        run_ts=RUN,
    )
    assert got.columns == users.columns
    assert by_key(got, "name", "email", "link_id", "chat_id") == {
        "s1": ("Anna", None, "recA", "C1"),
        "s2": ("Bob", None, None, None),
        "s9": ("New", "n@x.org", None, None),
    }
    new = got.where("source_id = 's9'").select("id", F.unix_seconds("created_at")).first()
    assert len(new[0]) == 64 and new[1] == int(RUN.timestamp())


def test_upsert_is_idempotent(rows, users):
    more = rows("source_id STRING, name STRING", ("s1", "Anna"), ("s9", "New"))
    once = upsert.upsert(users, more, run_ts=RUN)
    twice = upsert.upsert(once, more, run_ts=RUN)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_repeated_keys_fail_or_follow_the_order(rows, users):
    more = rows("source_id STRING, name STRING, n INT", ("s1", "first", 1), ("s1", "last", 2))
    with pytest.raises(Exception, match="Repeated source_id"):
        upsert.upsert(users, more, cols=["name"]).collect()
    assert by_key(upsert.upsert(users, more, cols=["name"], order_by=F.col("n")), "name")["s1"] == ("last",)


def test_user_changes(rows, users):
    more = rows("source_id STRING, name STRING, email STRING", ("s1", "Anna", None), ("s2", "Bob", None), ("s3", "Cy", None))
    assert sorted(map(tuple, upsert.upsert_users(users, more, RUN).changes.collect())) == [
        ("added", "Cy"), ("renamed", "Ann ➔ Anna"),
    ]


def test_clients_and_projects(rows, projects):
    clients = rows(model.CLIENTS, ("c1", "sc1", "Acme", "recC", OLD))
    merged = upsert.upsert_clients(clients, rows("source_id STRING, name STRING", ("sc1", "ACME"), ("sc2", "Zed")), RUN)
    assert by_key(merged.table, "name", "link_id") == {"sc1": ("ACME", "recC"), "sc2": ("Zed", None)}
    assert [tuple(r) for r in merged.changes.collect()] == [("added", "Zed")]
    more = rows(
        "source_id STRING, name STRING, client_source_id STRING",
        ("sp1", "Alpha", "sc1"), ("sp2", "Beta", "nobody"), ("sp3", "Gamma", None),
    )
    merged = upsert.upsert_projects(projects, more, clients, RUN)
    assert by_key(merged.table, "client_id", "link_id") == {"sp1": ("c1", "recP"), "sp2": (None, None), "sp3": (None, None)}
    assert sorted(r["text"] for r in merged.changes.collect()) == ["Beta", "Gamma"]


def test_seed(spark, rows, projects):
    once = upsert.seed_if_absent(projects, upsert.sentinel_row(spark))
    twice = upsert.seed_if_absent(once, upsert.sentinel_row(spark))
    assert ids(once) == ids(twice) == ["NO-PROJECT", "sp1"]
    assert by_key(twice, "name")["NO-PROJECT"] == (model.SENTINEL_NAME,)


def test_upsert_entries(rows, users, projects):
    before = stored(
        rows,
        ("e1", "2026-02-01T00:00:00", H, "u1", "2026-02-02T00:00:00", "p1"),
        ("e2", "2026-02-01T00:00:00", H, "u1", None, None),
    )
    more = extract(
        rows,
        ("e1", "2026-01-15T00:00:00", 2 * H, "s1", "sp1"),
        ("e3", "2026-02-01T00:00:00", None, "s2", "unknown"),
        ("e4", "2026-02-01T00:00:00", H, "nobody", None),
    )
    got = upsert.upsert_entries(before, more, users, projects, RUN)
    assert ids(got.skipped) == ["e4"]
    state = by_key(got.entries, "description", "duration_us", "user_id", "project_id", "deleted_at")
    assert state == {
        "e1": ("new", 2 * H, "u1", "p1", None),  # back to life, moved to another month
        "e2": ("old", H, "u1", None, None),
        "e3": ("new", None, "u2", None, None),
    }
    stamps = {r[0]: r[1] for r in got.entries.select("source_id", F.unix_seconds("updated_at")).collect()}
    assert stamps == {k: int((OLD if k == "e2" else RUN).timestamp()) for k in ("e1", "e2", "e3")}


def test_unchanged_rows_are_touched_too(rows, users, projects):
    before = stored(rows, ("e1", "2026-02-01T00:00:00", H, "u1", None, "p1")).withColumn("description", F.lit("new"))
    same = extract(rows, ("e1", "2026-02-01T00:00:00", H, "s1", "sp1"))
    got = upsert.upsert_entries(before, same, users, projects, RUN).entries
    assert got.select(F.unix_seconds("updated_at")).first()[0] == int(RUN.timestamp())


def test_set_column_and_dead_links(rows, users):
    got = upsert.set_column(users, rows("id STRING, value STRING", ("u2", "recB")), "id", "link_id")
    assert by_key(got, "link_id") == {"s1": ("recA",), "s2": ("recB",)}
    cleared = upsert.clear_dead_links(got, rows("link_id STRING", ("recA",), ("recA",), ("recZ",)))
    assert by_key(cleared, "link_id") == {"s1": (None,), "s2": ("recB",)}
    assert cleared.columns == users.columns


START = utc("2026-02-01T00:00:00")


@pytest.fixture
def case(rows):
    before = stored(
        rows,
        ("kept_old", "2026-01-31T23:59:59", H, "u1", None, None),
        ("ghost", "2026-02-01T00:00:00", H, "u1", None, None),
        ("gone_before", "2026-02-05T00:00:00", H, "u1", "2026-02-06T00:00:00", None),
        ("unscanned", "2026-02-05T00:00:00", H, "u2", None, None),
        ("edited", "2026-02-05T00:00:00", H, "u1", None, None),
        ("unresolved", "2026-02-05T00:00:00", H, "u1", None, None),
    )
    more = extract(
        rows,
        ("edited", "2026-02-05T00:00:00", 2 * H, "s1", None),
        ("unresolved", "2026-02-05T00:00:00", 2 * H, "nobody", None),
        ("fresh", "2026-02-07T00:00:00", H, "s1", None),
    )
    return before, more, rows("user_id STRING", ("u1",))


def test_ghosts_and_soft_delete(rows, case):
    before, more, scanned = case
    ghosts = ws.find_ghosts(before, more, scanned, START)
    assert ids(ghosts) == ["ghost"]
    got = ws.soft_delete(before, ghosts, RUN)
    assert got.count() == before.count()
    assert ids(got.where("deleted_at = timestamp'2026-03-01 00:00:00'")) == ["ghost"]
    assert ids(got.where("updated_at = timestamp'2026-03-01 00:00:00'")) == ["ghost"]


def test_sync_window_in_one_plan(rows, users, projects, case):
    before, more, scanned = case
    sync = ws.sync_window(before, more, users, projects, scanned, START, RUN)
    assert by_key(sync.merged, "sync_action", "sync_changed") == {
        "kept_old": ("kept", False),
        "ghost": ("deleted", True),
        "gone_before": ("kept", False),
        "unscanned": ("kept", False),
        "edited": ("updated", True),
        "unresolved": ("kept", False),
        "fresh": ("inserted", True),
    }
    assert [tuple(r) for r in sync.stats.collect()] == [("u1", 2, 1, 3)]
    # The same as the separate operators one after the other.
    merged = upsert.upsert_entries(before, more, users, projects, RUN).entries
    stepwise = ws.soft_delete(merged, ws.find_ghosts(merged, more, scanned, START), RUN)
    assert sorted(map(str, sync.entries.collect())) == sorted(map(str, stepwise.collect()))


def test_repeating_a_sync_changes_nothing(rows, users, projects, case):
    before, more, scanned = case
    once = ws.sync_window(before, more, users, projects, scanned, START, RUN)
    again = ws.sync_window(once.entries, more, users, projects, scanned, START, RUN)
    assert sorted(map(str, once.entries.collect())) == sorted(map(str, again.entries.collect()))
    assert again.stats.select(F.sum("changed"), F.sum("deleted")).first() == (0, 0)


def test_report(rows):
    stats = rows("user_id STRING, upserted BIGINT, deleted BIGINT, changed BIGINT", ("u1", 2, 1, 3), ("u2", 1, 0, 0))
    changes = rows("table STRING, kind STRING, text STRING", ("clients", "added", "A"), ("users", "renamed", "x"))
    scanned = rows("user_id STRING", ("u1",), ("u2",), ("u3",))
    got = ws.sync_report(stats, changes, scanned).first().asDict()
    assert got == {
        "upserted": 3, "deleted": 1, "changed": 3, "new_users": 0, "renamed_users": 1, "new_projects": 0,
        "new_clients": 1, "users_scanned": 3, "synced": 4, "has_changes": True,
    }
    # New clients alone are no change worth reporting.
    quiet = ws.sync_report(stats.limit(0), changes.where("kind = 'added'"), scanned).first()
    assert (quiet["synced"], quiet["has_changes"], quiet["new_clients"]) == (0, False, 1)


def test_backfill_merges_only_from_start_and_deletes_nothing(rows, users, projects, case):
    before, more, _ = case
    more = more.unionByName(extract(rows, ("early", "2025-12-31T00:00:00", H, "s1", None), ("other", "2026-02-09T00:00:00", H, "s2", None)))
    everyone = ws.backfill(before, more, users, projects, START, RUN)
    assert set(ids(everyone.entries)) == set(ids(before)) | {"fresh", "other"}
    assert everyone.entries.where("deleted_at is not null").count() == 1
    one = ws.backfill(before, more, users, projects, START, RUN, user_source_id="s2")
    assert set(ids(one.entries)) == set(ids(before)) | {"other"}


def test_integrity(rows, users, projects):
    clients = rows(model.CLIENTS, ("c1", "sc1", "Acme", None, OLD))
    entries = stored(
        rows,
        ("e1", "2026-02-01T00:00:00", H, "u1", None, "p1"),
        ("e1", "2026-02-01T00:00:00", H, "gone", None, "p9"),
        ("e2", "2026-02-01T00:00:00", H, "gone", None, None),
    )
    bad = projects.withColumn("client_id", F.lit("c9"))
    report = integrity.integrity_report(users, clients, bad, entries)
    assert {(r[0], r[1]): r[2] for r in report.collect() if r[2]} == {
        ("entries", "unique_source_id"): 1,
        ("entries", "known_user_id"): 2,
        ("entries", "known_project_id"): 1,
        ("projects", "known_client_id"): 1,
    }


def test_deleting_parents(rows, users, projects):
    clients = rows(model.CLIENTS, ("c1", "sc1", "Acme", None, OLD), ("c2", "sc2", "Zed", None, OLD))
    entries = stored(rows, ("e1", "2026-02-01T00:00:00", H, "u1", None, "p1"))
    owned = projects.withColumn("client_id", F.lit("c1"))
    left, detached = integrity.delete_clients(clients, owned, rows("id STRING", ("c1",)))
    assert ids(left) == ["sc2"] and by_key(detached, "client_id") == {"sp1": (None,)}
    left, detached = integrity.delete_projects(projects, entries, rows("id STRING", ("p1",)))
    assert left.isEmpty() and by_key(detached, "project_id") == {"e1": (None,)}
    assert ids(integrity.delete_users(users, entries, rows("id STRING", ("u2",)))) == ["s1"]
    with pytest.raises(integrity.IntegrityError):
        integrity.delete_users(users, entries, rows("id STRING", ("u1",)))


def test_small_increment_leaves_the_target_unshuffled(spark, rows, users, projects, case, tmp_path):
    before, more, scanned = case
    for name, df in (("before", before), ("more", more), ("users", users), ("projects", projects)):
        df.write.parquet(str(tmp_path / name))
    stored, extracted, people, work = (
        spark.read.parquet(str(tmp_path / n)) for n in ("before", "more", "users", "projects")
    )
    upsert.resolve_entries(upsert.unique_rows(extracted, "source_id"), people, work).write.parquet(str(tmp_path / "r"))
    resolved, everyone = spark.read.parquet(str(tmp_path / "r")), people.select(F.col("id").alias("user_id"))
    sync = ws.merge_window(stored, resolved, everyone, START, RUN)
    plan = sync.merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    # The only shuffle is the distinct of the scanned users.
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffled) == 1 and "user_id" in shuffled[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        beyond = ws.merge_window(stored, resolved, everyone, START, RUN)
        plan = beyond.merged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert sorted(map(str, beyond.merged.collect())) == sorted(map(str, sync.merged.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
