from datetime import date
from decimal import Decimal

import pytest
from conftest import utc
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger.operators import aggregates as ag
from shiftledger.operators.windows import with_partition

H = 3_600_000_000


@pytest.fixture
def dims(rows):
    users = rows(
        model.USERS,
        ("u1", "su1", "Ann Lee", "ann@x.org", "recU1", None, None),
        ("u2", "su2", "Bob", None, None, "C2", None),
    )
    projects = rows(
        model.PROJECTS,
        ("p0", model.SENTINEL_SOURCE_ID, model.SENTINEL_NAME, None, "recNP", None),
        ("p1", "sp1", "Alpha", None, "recA", None),
        ("p2", "sp2", "Beta", None, None, None),
        ("p3", "sp3", "Gamma", None, None, None),
    )
    return users, projects


def entries(rows, *data):
    """(id, start, duration, user, project, deleted)"""
    return rows(
        model.ENTRIES,
        *[(i, i, None, utc(s), None, d, u, p, utc(x) if x else None, None) for i, s, d, u, p, x in data],
    )


def shown(df):
    return sorted(
        (r["user_name"], r["project_link"], r["project_name"], r["month"], str(r["total_hours"])) for r in df.collect()
    )


def test_months_split_at_local_midnight_and_inactive_rows_are_out(rows, dims):
    e = entries(
        rows,
        ("1", "2026-01-31T21:59:59", H, "u1", "p1", None),
        ("2", "2026-01-31T22:00:00", 2 * H, "u1", "p1", None),
        ("3", "2026-01-31T22:00:00", None, "u1", "p1", None),
        ("4", "2026-01-31T22:00:00", H, "u1", "p1", "2026-02-02T00:00:00"),
    )
    assert shown(ag.monthly_hours(e, *dims)) == [
        ("Ann Lee", "recA", "Alpha", "February 2026", "2.00"),
        ("Ann Lee", "recA", "Alpha", "January 2026", "1.00"),
    ]


def test_cycle_splits_on_the_23rd(rows, dims):
    e = entries(
        rows,
        ("1", "2026-01-22T21:59:59", H, "u1", "p1", None),
        ("2", "2026-01-22T22:00:00", 2 * H, "u1", "p1", None),
    )
    assert shown(ag.payroll_hours(e, *dims)) == [
        ("Ann Lee", "recA", "Alpha", "23 Dec to 22 Jan 2026", "1.00"),
        ("Ann Lee", "recA", "Alpha", "23 Jan to 22 Feb 2026", "2.00"),
    ]


def test_group_before_default(rows, dims):
    """No project, the sentinel and unlinked projects stay separate rows."""
    e = entries(
        rows,
        *[(str(i), "2026-01-10T08:00:00", H, "u1", p, None) for i, p in enumerate([None, "p0", "p2", "p3", "gone"])],
    )
    assert shown(ag.monthly_hours(e, *dims)) == [
        ("Ann Lee", "recNP", "Beta", "January 2026", "1.00"),
        ("Ann Lee", "recNP", "Gamma", "January 2026", "1.00"),
        ("Ann Lee", "recNP", "No Project", "January 2026", "1.00"),
        ("Ann Lee", "recNP", "No Project", "January 2026", "2.00"),
    ]


def test_without_sentinel_the_link_stays_null(rows, dims):
    users, projects = dims
    e = entries(rows, ("1", "2026-01-10T08:00:00", H, "u1", None, None))
    assert shown(ag.monthly_hours(e, users, projects.where("id <> 'p0'"))) == [
        ("Ann Lee", None, "No Project", "January 2026", "1.00")
    ]


def test_same_link_and_name_of_two_users_are_one_row(rows, dims):
    users, projects = dims
    twins = users.unionByName(users.where("id = 'u1'").withColumn("id", F.lit("u9")))
    e = entries(
        rows, ("1", "2026-01-10T08:00:00", H, "u1", "p1", None), ("2", "2026-01-11T08:00:00", H, "u9", "p1", None)
    )
    assert shown(ag.monthly_hours(e, twins, projects)) == [("Ann Lee", "recA", "Alpha", "January 2026", "2.00")]


def test_one_scan_serves_both_reports(rows, dims):
    e = entries(
        rows,
        *[(str(i), f"2026-0{1 + i % 3}-{10 + i}T08:00:00", (i + 1) * H, f"u{1 + i % 2}", "p1", None) for i in range(18)],
    )
    both = ag.usage_buckets(e)
    assert shown(ag.monthly_from(both, *dims)) == shown(ag.monthly_hours(e, *dims))
    assert shown(ag.payroll_from(both, *dims)) == shown(ag.payroll_hours(e, *dims))
    total = sum(Decimal(r[-1]) for r in shown(ag.monthly_hours(e, *dims)))
    assert total == sum(range(1, 19))


def test_active_names_both_ways(rows, dims):
    users, projects = dims
    users = users.withColumn("name", F.when(F.col("id") == "u2", "").otherwise(F.col("name")))
    e = entries(
        rows,
        ("1", "2026-01-10T08:00:00", H, "u1", "p1", None),
        ("2", "2026-01-10T08:00:00", H, "u2", None, None),
        ("3", "2026-01-10T08:00:00", None, "u2", "p3", None),
    )
    from_reports = ag.active_names(ag.monthly_hours(e, users, projects), ag.payroll_hours(e, users, projects))
    direct = ag.active_names_of(e, users, projects)
    expected = {("user", "Ann Lee"), ("project", "Alpha"), ("project", "No Project")}
    assert {tuple(r) for r in from_reports.collect()} == expected
    assert {tuple(r) for r in direct.collect()} == expected
    assert {tuple(r) for r in ag.active_names_of(ag.usage_buckets(e), users, projects).collect()} == expected


def test_unassigned_time(rows, dims):
    e = entries(
        rows,
        ("before", "2026-01-22T21:59:59", H, "u1", None, None),
        ("first", "2026-01-22T22:00:00", H, "u1", None, None),
        ("sentinel", "2026-02-01T08:00:00", H // 2, "u1", "p0", None),
        ("assigned", "2026-02-01T08:00:00", H, "u1", "p1", None),
        ("after", "2026-02-22T22:00:00", H, "u1", None, None),
        ("zero", "2026-02-01T08:00:00", 0, "u2", None, None),
    ).withColumn("description", F.when(F.col("id") == "first", "call"))
    got = ag.unassigned_time(e, *dims, date(2026, 2, 22)).orderBy("user_id", "date").collect()
    assert {(r["user_id"], str(r["unassigned_hours"])) for r in got} == {("u1", "1.50")}
    assert [(x["date"], x["description"], str(x["duration_hours"])) for x in got] == [
        ("2026-01-23", "call", "1.00"),
        ("2026-02-01", model.NO_DESCRIPTION, "0.50"),
    ]


def test_many_entries_of_one_user_are_a_row_each(rows, dims):
    e = entries(rows, *[(f"e{i}", "2026-02-01T08:00:00", H, "u1" if i else "u2", None, None) for i in range(1501)])
    got = ag.unassigned_time(e, *dims, date(2026, 2, 1)).collect()
    hot = [r for r in got if r["user_id"] == "u1"]
    assert len({r["source_id"] for r in hot}) == 1500 and {str(r["unassigned_hours"]) for r in hot} == {"1500.00"}
    assert len(got) == 1501


def test_plan_prunes_and_pre_aggregates(spark, rows, dims, tmp_path):
    e = with_partition(entries(rows, ("1", "2026-01-10T08:00:00", H, "u1", None, None)))
    e.write.partitionBy("start_day").parquet(str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    monthly = plan(ag.monthly_hours(stored, *dims))
    assert "IsNull(deleted_at)" in monthly and "IsNotNull(duration_us)" in monthly
    assert "description" not in monthly
    assert "CartesianProduct" not in monthly and "BroadcastNestedLoopJoin" not in monthly
    unassigned = plan(ag.unassigned_rows(stored, dims[1], date(2026, 2, 1)))
    assert "start_day" in unassigned.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThanOrEqual(start_time" in unassigned


def test_report_rows_are_dealt_into_the_sessions_partitions(spark, rows):
    """Adaptive planning goes by compressed bytes and would merge them, so a task's table of groups grew with the input."""
    entries = rows(
        "start_time TIMESTAMP, duration_us BIGINT, user_id STRING, project_id STRING, deleted_at TIMESTAMP",
        *[(utc("2026-01-05T10:00:00"), 3_600_000_000, f"u{i % 3}", f"p{i % 5}", None) for i in range(30)],
    )
    users = rows("id STRING, link_id STRING, name STRING", *[(f"u{i}", f"recU{i}", f"name {i}") for i in range(3)])
    projects = rows(
        "id STRING, source_id STRING, link_id STRING, name STRING", *[(f"p{i}", f"sp{i}", f"recP{i}", f"name {i}") for i in range(5)]
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        report = ag.monthly_hours(entries, users, projects)
        assert report.rdd.getNumPartitions() == 7
        assert sorted({float(r["total_hours"]) for r in report.collect()}) == [2.0] and report.count() == 15
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
