"""The reconcile job: stored hours against the destination."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger.operators import aggregates as ag
from shiftledger.operators import reconcile as rc
from shiftledger.operators import references as rf
from shiftledger.operators import reports
from shiftledger.operators.upsert import clear_dead_links
from shiftledger.plans.common import run_id
from shiftledger.plans.runs import innermost, recorded
from shiftledger.sources.outbox import Create, Outbox
from shiftledger.sources.tables import Tables, stage

# send(table, kind, rows): deliver one staged set of actions; kind is
# "create", "insert" or "update". Rows of inserts and updates carry
# batch, at most ten rows each.
Sender = Callable[[str, str, DataFrame], None]


class Destination(NamedTuple):
    """What the destination holds: reference records (id, name) and records (id, pos, fields), or their layout by key."""

    users: DataFrame
    projects: DataFrame
    clients: DataFrame
    project_assignments: DataFrame
    records: dict[str, DataFrame | rc.Layout]  # by strategy


class ReconcileResult(NamedTuple):
    """Totals, actions per job, report rows; ``aborted`` after a dead link was healed."""

    stats: dict
    actions: dict[str, DataFrame]
    reports: DataFrame | None
    aborted: bool


def link_references(
    tables: Tables,
    destination: Destination,
    names: DataFrame,
    run: str,
    send: Sender | None = None,
    create: Create | None = None,
) -> DataFrame:
    """Give every active user, then project, then client a link.

    Rows to be created are asked of ``create``, whose ids are stored; without it they get a replayable id and are
    handed to ``send``. Returns report rows.
    """
    spark = tables.spark

    def settle(name: str, missing: DataFrame, records: DataFrame) -> DataFrame:
        found = rf.resolve_links(missing, records)
        if create is not None:
            found = stage(spark, found, f"resolved_{name}", run)
            wanted = found.where(F.col("action") == rf.CREATE).select("id", "name")
            receipts = Outbox(spark, f"{tables.root}/outbox").deliver(wanted, ["id"], name, run, create)
            resolved = stage(spark, rf.with_given_ids(found, receipts), f"links_{name}", run)
        else:
            resolved = stage(spark, rf.with_created_ids(found, name), f"links_{name}", run)
        if create is None and send is not None:
            send(name, "create", resolved.where(F.col("action") == rf.CREATE).select("link_id", "name"))
        tables.publish(name, rf.write_back(tables.read(name), resolved), run)
        return reports.conflict_rows(resolved).unionByName(reports.heal_rows(resolved, name))

    user_names, project_names = ag.names_of(names, "user"), ag.names_of(names, "project")
    texts = []
    if not user_names.isEmpty():
        texts.append(settle("users", rf.missing_by_name(tables.read("users"), user_names), destination.users))
    if not project_names.isEmpty():
        projects = tables.read("projects")
        clients = rf.missing_clients(projects, tables.read("clients"), project_names)
        texts.append(settle("projects", rf.missing_projects(projects, project_names), destination.projects))
        texts.append(settle("clients", clients, destination.clients))
    if not texts:
        return spark.createDataFrame([], reports.SCHEMA)
    found = texts[0]
    for more in texts[1:]:
        found = found.unionByName(more)
    return stage(spark, found, "reference_reports", run)


def run_reconcile(
    tables: Tables,
    destination: Destination,
    run_ts: datetime,
    tz: str = model.DEFAULT_TZ,
    cycle_day: int = model.DEFAULT_CYCLE_DAY,
    send: Sender | None = None,
    tolerance: float = model.TOLERANCE,
    create: Create | None = None,
) -> ReconcileResult:
    """References first, then each job: diff, inserts, updates.

    Hours per user, project, month and cycle come from the stored sums, so no entry is read (with a zone or cycle day of
    one's own the entries are, once); names and both reports come from there. When ``send`` fails
    because a linked record is gone, its link is cleared and the run ends early;
    the next run links anew. Any other error surfaces. With ``create``, rows to be created are asked of it and the ids it gives
    are stored. Each run leaves a row of its outcome and duration.
    """
    run = run_id(run_ts, "2-reconcile")
    total = dict.fromkeys(("updated", "inserted", "skipped", "missing"), 0)
    with recorded(tables, "reconcile", run, run_ts, total):
        return _reconcile(tables, destination, run_ts, tz, cycle_day, send, tolerance, create, run, total)


def _reconcile(
    tables: Tables,
    destination: Destination,
    run_ts: datetime,
    tz: str,
    cycle_day: int,
    send: Sender | None,
    tolerance: float,
    create: Create | None,
    run: str,
    total: dict[str, int],
) -> ReconcileResult:
    spark = tables.spark
    actions: dict[str, DataFrame] = {}
    own = (tz, cycle_day) == (model.DEFAULT_TZ, model.DEFAULT_CYCLE_DAY)
    sums = tables.read_sums() if own else ag.usage_buckets(tables.read_entries(), tz, cycle_day)
    buckets = stage(spark, sums, "buckets", run)
    names = stage(spark, ag.active_names_of(buckets, tables.read("users"), tables.read("projects")), "names", run)
    try:
        texts = link_references(tables, destination, names, run, send, create)
        users, projects = tables.read("users"), tables.read("projects")
        for job in model.RECONCILE_JOBS:
            if job.source == "monthly":
                report = ag.monthly_from(buckets, users, projects)
            else:
                report = ag.payroll_from(buckets, users, projects, cycle_day)
            source = stage(spark, report, f"source_{job.source}", run)
            index = None
            if job.strategy == model.ASSIGNMENT:
                makers = (send, create) if job.allow_inserts else (None, None)
                index = _complete_index(tables, destination, source, run, *makers)
            held = destination.records[job.strategy]
            if isinstance(held, rc.Layout):
                diff = rc.diff_of_layout(source, held, job.strategy, index, job.allow_inserts, tolerance)
            else:
                cells = stage(spark, rc.destination_cells(held, job.strategy), f"cells_{job.source}", run)
                diff = rc.diff_of_cells(source, cells, job.strategy, index, job.allow_inserts, tolerance)
            done = stage(spark, diff.actions, f"actions_{job.source}", run)
            actions[job.name] = done
            if send is not None:
                _deliver(spark, job, done, run, send)
            for key, value in rc.diff_stats(done).first().asDict().items():
                total[key] += value
    except Exception as error:
        healed = heal_dead_links(tables, innermost(error), run_ts)
        if healed is None:
            raise
        return ReconcileResult(total, actions, healed, True)
    return ReconcileResult(total, actions, texts, False)


def _complete_index(
    tables: Tables, destination: Destination, source: DataFrame, run: str, send: Sender | None, create: Create | None
) -> DataFrame:
    cells = rc.destination_cells(destination.project_assignments, model.PROJECT_ASSIGNMENT)
    index = stage(tables.spark, rf.assignment_index(cells), "assignment_index", run)
    wanted = rf.new_assignment_rows(rf.missing_assignments(source, index))
    if create is not None:
        keys = ["project_link", "month_date"]
        asked = Outbox(tables.spark, f"{tables.root}/outbox").deliver(wanted, keys, "project_assignments", run, create)
        return rf.complete_assignments(index, stage(tables.spark, rf.with_given_assignments(asked), "new_assignments", run))
    created = stage(tables.spark, wanted, "new_assignments", run)
    if send is not None:
        send("project_assignments", "create", created)
    return rf.complete_assignments(index, created)


def _deliver(spark, job: model.ReconcileJob, actions: DataFrame, run: str, send: Sender) -> None:
    """Inserts before updates, each numbered into batches."""
    updates = stage(spark, rc.dedupe_updates(rc.updates_of(actions)), f"updates_{job.source}", run)
    # Two inserts may be alike in every cell, so they get a key of their own.
    inserts = stage(
        spark,
        rc.inserts_of(actions, job.strategy).withColumn("insert_id", F.uuid()),
        f"inserts_{job.source}",
        run,
    )
    if not inserts.isEmpty():
        send(job.name, "insert", rc.batch_actions(inserts, "insert_id"))
    if not updates.isEmpty():
        send(job.name, "update", rc.batch_actions(updates, "record_id"))


def heal_dead_links(tables: Tables, message: str, run_ts: datetime) -> DataFrame | None:
    """Clear the link an error message names from all tables.

    Returns the report rows, or None when the message is of another kind or names an id that nobody stores.
    """
    spark = tables.spark
    run = run_id(run_ts, "3-heal")
    dead = rc.extract_dead_links(spark.createDataFrame([(message,)], "message STRING")).where(
        F.col("link_id").isNotNull()
    )
    links = [tables.read(name).select("link_id") for name in ("users", "projects", "clients")]
    stored = links[0].unionByName(links[1]).unionByName(links[2])
    dead = dead.join(stored, "link_id", "left_semi")
    if dead.isEmpty():
        return None
    dead = stage(spark, dead, "dead_links", run)
    for name in ("users", "projects", "clients"):
        tables.publish(name, clear_dead_links(tables.read(name), dead), run)
    return reports.dead_link_rows(dead)
