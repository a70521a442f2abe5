"""Each query runs one operator over whole benchmark tables.

Results are flat and engine-neutral: hours as DOUBLE, instants as ISO text,
lists joined to text.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger import testbed as tb
from shiftledger.functions import calendar as cal
from shiftledger.functions import cells
from shiftledger.functions.text import number_text
from shiftledger.operators import aggregates as ag
from shiftledger.operators import audit, identity, integrity, reconcile, references, reports, upsert, windows
from shiftledger.operators import increments as inc
from shiftledger.operators import window_sync as ws
from shiftledger.session import shared_dir
from shiftledger.sources import destination, extracts, lookups, record_store
from shiftledger.sources.outbox import Outbox
from shiftledger.sources.tables import Tables, stage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

NUDGE_DAY = date(1998, 3, 10)


def query(fn: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[fn.__name__] = fn
    return fn


def _iso(instant: Column) -> Column:
    """UTC wall time as text, whatever the session zone."""
    return F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")


def _real(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# --- aggregates -------------------------------------------------------------


@query
def monthly_hours(spark, sf):
    rows = ag.monthly_hours(tb.entries(spark, sf), tb.users(spark, sf), tb.projects(spark, sf))
    return _real(rows.drop("raw_project_link"), "total_hours")


@query
def payroll_hours(spark, sf):
    rows = ag.payroll_hours(tb.entries(spark, sf), tb.users(spark, sf), tb.projects(spark, sf))
    return _real(rows.drop("raw_project_link"), "total_hours")


@query
def monthly_hours_lines(spark, sf):
    rows = ag.monthly_hours(tb.line_entries(spark, sf), tb.line_users(spark, sf), tb.projects(spark, sf))
    return _real(rows.drop("raw_project_link"), "total_hours")


@query
def payroll_hours_lines(spark, sf):
    rows = ag.payroll_hours(tb.line_entries(spark, sf), tb.line_users(spark, sf), tb.projects(spark, sf))
    return _real(rows.drop("raw_project_link"), "total_hours")


@query
def active_entries(spark, sf):
    return ag.active_entries(tb.entries(spark, sf)).select(
        "source_id", "user_id", "project_id", _iso(F.col("start_time")).alias("start_time"), "duration_us"
    )


@query
def active_names(spark, sf):
    return ag.active_names_of(tb.entries(spark, sf), tb.users(spark, sf), tb.projects(spark, sf))


@query
def cycle_bounds(spark, sf):
    day = F.col("day")
    first = cal.cycle_first_day(day, model.DEFAULT_CYCLE_DAY)
    after = cal.cycle_end_day(day, model.DEFAULT_CYCLE_DAY)
    days = tb.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return days.select(
        cal.iso_day(day).alias("day"),
        _iso(cal.local_midnight(first, model.DEFAULT_TZ)).alias("cycle_start"),
        _iso(cal.local_midnight(after, model.DEFAULT_TZ)).alias("cycle_end"),
    )


def _unassigned_rows(spark, sf):
    return ag.unassigned_rows(tb.entries(spark, sf), tb.projects(spark, sf), NUDGE_DAY)


@query
def unassigned_hours(spark, sf):
    return _real(ag.unassigned_hours(_unassigned_rows(spark, sf), tb.users(spark, sf)), "unassigned_hours")


@query
def unassigned_time(spark, sf):
    rows = ag.unassigned_time(tb.entries(spark, sf), tb.users(spark, sf), tb.projects(spark, sf), NUDGE_DAY)
    return _real(rows, "unassigned_hours", "duration_hours")


@query
def entry_items_json(spark, sf):
    return ag.entry_json(_unassigned_rows(spark, sf)).select("source_id", "user_id", "item")


@query
def unassigned_entries(spark, sf):
    return _real(
        _unassigned_rows(spark, sf).select("source_id", "user_id", "date", "description", "duration_hours"),
        "duration_hours",
    )


# --- sources ----------------------------------------------------------------


@query
def users_default_name(spark, sf):
    return extracts.shape_users(tb.raw_users(spark, sf))


@query
def clients_default_name(spark, sf):
    return extracts.shape_clients(tb.raw_clients(spark, sf))


@query
def projects_default_name(spark, sf):
    return extracts.shape_projects(tb.raw_projects(spark, sf))


@query
def lookback_modes(spark, sf):
    """Entries in the window of a short and of a long look-back from one instant, by mode."""
    found = None
    for days in (None, 1, 30, 400):
        window, mode = model.lookback_window(days)
        start = cal.lookback_start(tb.LOOKBACK_TS, window)
        rows = windows.within(tb.entries(spark, sf), start).agg(F.count("*").alias("entries"))
        rows = rows.select(F.lit(window.days).alias("days"), F.lit(mode).alias("mode"), _iso(cal.instant_literal(start)).alias("start"), "entries")
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def flat_entries(spark, sf):
    flat = extracts.check_entries(tb.raw_entries(spark, sf), extracts.QUARANTINE).valid
    return flat.select(
        "source_id",
        "description",
        _iso(F.col("start_time")).alias("start_time"),
        "duration_us",
        "user_source_id",
        "project_source_id",
    )


@query
def rejected_entries(spark, sf):
    rejected = extracts.check_entries(tb.raw_entries(spark, sf), extracts.QUARANTINE).rejected
    return rejected.select("id", F.array_join("reasons", ",").alias("reasons"))


@query
def user_window(spark, sf):
    linked = tb.users(spark, sf).where(F.col("link_id").isNotNull()).select(F.col("id").alias("user_id"))
    rows = windows.user_window(tb.entries(spark, sf), linked, tb.WINDOW_START)
    return rows.select("source_id", "user_id", _iso(F.col("start_time")).alias("start_time"))


@query
def destination_cells(spark, sf):
    fields = F.col("fields")
    return tb.event_records(spark, sf).select(
        "id", cells.cell_kind(fields, "k").alias("kind"), cells.cell_number(fields, "k").alias("number")
    )


@query
def cell_kinds(spark, sf):
    """All four states of a cell, read from records stored with their cells shredded."""
    fields = F.col("fields")
    held = record_store.store_records(tb.mixed_records(spark, sf), f"{shared_dir(spark)}/records-{uuid4().hex}")
    return held.select(
        "id",
        cells.cell_kind(fields, model.FIELD_ACTUAL_HOURS).alias("kind"),
        cells.cell_number(fields, model.FIELD_ACTUAL_HOURS).alias("number"),
        cells.cell_text(fields, model.FIELD_ACTUAL_HOURS).alias("text"),
    )


@query
def reference_records(spark, sf):
    return destination.reference_records(tb.page_records(spark, sf), model.FIELD_NAME)


@query
def roster_members(spark, sf):
    return extracts.shape_roster(tb.raw_roster(spark, sf)).select("id", "name", "email")


@query
def inspect_records(spark, sf):
    return destination.inspect_records(
        tb.table(spark, sf, "orders"),
        predicate="o_orderstatus = 'F' AND o_totalprice > 100000",
        columns=["o_orderkey", "o_custkey", "o_totalprice"],
    )


@query
def lookup_rows(spark, sf):
    wanted = tb.clients(spark, sf).where(F.col("link_id").isNull()).select(F.col("id").alias("client_id"))
    return lookups.rows_in(tb.projects(spark, sf), "client_id", wanted).select("id", "name", "client_id")


# --- upserts ----------------------------------------------------------------


def _user_extract(spark, sf):
    building = F.col("c_mktsegment") == "BUILDING"
    return tb.table(spark, sf, "customer").select(
        F.concat(F.lit("su"), F.col("c_custkey").cast("string")).alias("source_id"),
        F.when(building, F.upper("c_name")).otherwise(F.col("c_name")).alias("name"),
        F.when(building, F.lit(None).cast("string")).otherwise(F.concat("c_name", F.lit("@new.example"))).alias("email"),
    )


def _stored_users(spark, sf):
    wanted = tb.table(spark, sf, "customer").where(F.col("c_mktsegment") != "FURNITURE").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("id")
    )
    return lookups.rows_in(tb.users(spark, sf), "id", wanted)


@query
def upsert_users(spark, sf):
    merged = upsert.upsert_users(_stored_users(spark, sf), _user_extract(spark, sf), tb.RUN_TS)
    return merged.table.select("source_id", "name", "email", "link_id", "chat_id")


@query
def user_changes(spark, sf):
    return upsert.upsert_users(_stored_users(spark, sf), _user_extract(spark, sf), tb.RUN_TS).changes


@query
def upsert_clients(spark, sf):
    stored = tb.clients(spark, sf).where(F.col("link_id").isNotNull())
    rows = tb.clients(spark, sf).select("source_id", F.lower("name").alias("name"))
    return upsert.upsert_clients(stored, rows, tb.RUN_TS).table.select("source_id", "name", "link_id")


@query
def client_changes(spark, sf):
    stored = tb.clients(spark, sf).where(F.col("link_id").isNotNull())
    rows = tb.clients(spark, sf).select("source_id", F.lower("name").alias("name"))
    return upsert.upsert_clients(stored, rows, tb.RUN_TS).changes


def _upsert_projects(spark, sf):
    stored = tb.projects(spark, sf).where(F.col("link_id").isNotNull())
    key = F.col("p_partkey")
    rows = tb.table(spark, sf, "part").select(
        F.when(key == 0, model.SENTINEL_SOURCE_ID)
        .otherwise(F.concat(F.lit("sp"), key.cast("string")))
        .alias("source_id"),
        F.concat_ws(" ", "p_brand", "p_name").alias("name"),
        F.concat(F.lit("sc"), (key % 30).cast("string")).alias("client_source_id"),
    )
    return upsert.upsert_projects(stored, rows, tb.clients(spark, sf), tb.RUN_TS)


@query
def upsert_projects(spark, sf):
    return _upsert_projects(spark, sf).table.select("source_id", "name", "client_id", "link_id")


@query
def project_changes(spark, sf):
    return _upsert_projects(spark, sf).changes


def _entry_columns(df, *more):
    return df.select(
        "source_id",
        "description",
        _iso(F.col("start_time")).alias("start_time"),
        "duration_us",
        "user_id",
        "project_id",
        _iso(F.col("deleted_at")).alias("deleted_at"),
        _iso(F.col("updated_at")).alias("updated_at"),
        *more,
    )


def _upsert_entries(spark, sf):
    return upsert.upsert_entries(
        tb.stored_entries(spark, sf), tb.extract_entries(spark, sf), tb.users(spark, sf), tb.projects(spark, sf), tb.RUN_TS
    )


@query
def upsert_entries(spark, sf):
    return _entry_columns(_upsert_entries(spark, sf).entries)


@query
def skipped_entries(spark, sf):
    return _upsert_entries(spark, sf).skipped.select("source_id", "user_source_id")


@query
def set_links(spark, sf):
    key = F.col("c_custkey").cast("string")
    updates = tb.table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.concat(F.lit("u"), key).alias("id"), F.concat(F.lit("recNew"), key).alias("value")
    )
    return upsert.set_column(tb.users(spark, sf), updates, "id", "link_id").select("id", "name", "link_id")


@query
def clear_dead_links(spark, sf):
    dead = tb.table(spark, sf, "orders").where(F.col("o_totalprice") > 450000).select(
        F.concat(F.lit("recU"), F.col("o_custkey").cast("string")).alias("link_id")
    )
    return upsert.clear_dead_links(tb.users(spark, sf), dead).select("id", "name", "link_id")


@query
def seed_if_absent(spark, sf):
    stored = tb.projects(spark, sf).where(F.col("link_id").isNotNull()).select("id", "source_id", "name", "link_id")
    rows = tb.projects(spark, sf).select("id", "source_id", F.lit("seed").alias("name"))
    return upsert.seed_if_absent(stored, rows)


@query
def integrity_report(spark, sf):
    clients = tb.clients(spark, sf).where(F.col("link_id").isNotNull())
    users = _stored_users(spark, sf)
    return integrity.integrity_report(users, clients, tb.projects(spark, sf), tb.entries(spark, sf))


@query
def detach_clients(spark, sf):
    gone = tb.clients(spark, sf).where(F.col("link_id").isNull()).select("id")
    return integrity.delete_clients(tb.clients(spark, sf), tb.projects(spark, sf), gone)[1].select("id", "name", "client_id")


# --- window sync ------------------------------------------------------------


def _window(spark, sf):
    return windows.within(tb.extract_entries(spark, sf), tb.WINDOW_START)


def _scanned(spark, sf):
    """Users known by e-mail were scanned; the others must not lose entries."""
    return tb.users(spark, sf).where(F.col("email").isNotNull()).select(F.col("id").alias("user_id"))


def _ghosts(spark, sf):
    return ws.find_ghosts(tb.stored_entries(spark, sf), _window(spark, sf), _scanned(spark, sf), tb.WINDOW_START)


@query
def ghost_entries(spark, sf):
    return _ghosts(spark, sf)


@query
def soft_delete(spark, sf):
    stored = tb.stored_entries(spark, sf)
    return _entry_columns(ws.soft_delete(stored, _ghosts(spark, sf), tb.RUN_TS))


def _sync(spark, sf):
    return ws.sync_window(
        tb.stored_entries(spark, sf),
        _window(spark, sf),
        tb.users(spark, sf),
        tb.projects(spark, sf),
        _scanned(spark, sf),
        tb.WINDOW_START,
        tb.RUN_TS,
    )


@query
def window_sync(spark, sf):
    return _entry_columns(_sync(spark, sf).merged, "sync_action", "sync_changed")


@query
def window_sync_stats(spark, sf):
    return _sync(spark, sf).stats


@query
def audit_changes(spark, sf):
    """What the sync changes, found by checksums of users and days first."""
    resolved = upsert.resolve_entries(_window(spark, sf), tb.users(spark, sf), tb.projects(spark, sf))
    found = audit.audit_window(tb.stored_entries(spark, sf), resolved, _scanned(spark, sf), tb.WINDOW_START, tb.RUN_TS)
    return _entry_columns(found, "sync_action")


@query
def audit_groups(spark, sf):
    """Users and days whose stored rows are not those of the extract."""
    resolved = upsert.resolve_entries(_window(spark, sf), tb.users(spark, sf), tb.projects(spark, sf))
    groups = audit.differing_groups(tb.stored_entries(spark, sf), resolved, tb.WINDOW_START)
    return groups.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


def _kept_up(spark, sf):
    """Sums of the stored entries, brought up to date by what the sync changes."""
    stored = inc.usage_sums(tb.stored_entries(spark, sf))
    return inc.added([stored, inc.changed_sums(_sync(spark, sf).merged.where("sync_changed"))])


@query
def monthly_hours_incremental(spark, sf):
    rows = ag.monthly_from(_kept_up(spark, sf), tb.users(spark, sf), tb.projects(spark, sf))
    return _real(rows.drop("raw_project_link"), "total_hours")


@query
def payroll_hours_incremental(spark, sf):
    rows = ag.payroll_from(_kept_up(spark, sf), tb.users(spark, sf), tb.projects(spark, sf))
    return _real(rows.drop("raw_project_link"), "total_hours")


@query
def changed_hours(spark, sf):
    """What the sync changes in the hours of each user, project, month and cycle."""
    sums = inc.changed_sums(_sync(spark, sf).merged.where("sync_changed"))
    return sums.select(
        "user_id", "project_id", F.date_format("month", "yyyy-MM").alias("month"), F.date_format("cycle", "yyyy-MM").alias("cycle"),
        (F.col("sum_s") + F.expr("sum_us div 1000000")).alias("seconds"), "n",
    )


def _changes(spark, sf):
    return (
        upsert.upsert_users(_stored_users(spark, sf), _user_extract(spark, sf)).changes.withColumn("table", F.lit("users"))
        .unionByName(_upsert_projects(spark, sf).changes.withColumn("table", F.lit("projects")))
        .unionByName(client_changes(spark, sf).withColumn("table", F.lit("clients")))
    )


@query
def sync_report(spark, sf):
    return ws.sync_report(_sync(spark, sf).stats, _changes(spark, sf), _scanned(spark, sf))


@query
def sync_report_text(spark, sf):
    return reports.sync_report_rows(sync_report(spark, sf), _changes(spark, sf))


@query
def backfill(spark, sf):
    merged = ws.backfill(
        tb.stored_entries(spark, sf),
        tb.extract_entries(spark, sf),
        tb.users(spark, sf),
        tb.projects(spark, sf),
        tb.WINDOW_START,
        tb.RUN_TS,
    )
    return _entry_columns(merged.entries)


# --- references -------------------------------------------------------------


@query
def name_state(spark, sf):
    return references.name_state(tb.name_records(spark, sf))


def _names(spark, sf, kind):
    return ag.names_of(active_names(spark, sf), kind)


@query
def missing_users(spark, sf):
    return references.missing_by_name(tb.users(spark, sf), _names(spark, sf, "user"))


@query
def missing_projects(spark, sf):
    return references.missing_projects(tb.projects(spark, sf), _names(spark, sf, "project"))


@query
def missing_clients(spark, sf):
    return references.missing_clients(tb.projects(spark, sf), tb.clients(spark, sf), _names(spark, sf, "project"))


@query
def resolve_links(spark, sf):
    return references.resolve_links(tb.unlinked_rows(spark, sf), tb.name_records(spark, sf))


@query
def assignment_index(spark, sf):
    return references.assignment_index(tb.dated_records(spark, sf))


def _previous_monthly(spark, sf):
    return ag.monthly_hours(tb.stored_entries(spark, sf), tb.users(spark, sf), tb.projects(spark, sf))


def _current_monthly(spark, sf):
    return ag.monthly_hours(tb.current_entries(spark, sf), tb.users(spark, sf), tb.projects(spark, sf))


def _previous_index(spark, sf):
    cells_ = reconcile.destination_cells(
        tb.assignment_records(_previous_monthly(spark, sf)), model.PROJECT_ASSIGNMENT
    )
    return references.assignment_index(cells_)


@query
def missing_assignments(spark, sf):
    return references.missing_assignments(_current_monthly(spark, sf), _previous_index(spark, sf))


@query
def new_assignment_rows(spark, sf):
    missing = references.missing_assignments(_current_monthly(spark, sf), _previous_index(spark, sf))
    return references.new_assignment_rows(missing).drop("assignment_id")


@query
def complete_assignments(spark, sf):
    index = _previous_index(spark, sf)
    created = _created(references.missing_assignments(_current_monthly(spark, sf), index))
    return references.complete_assignments(index, created)


def _created(missing):
    """Assignments with the id the destination would have given them."""
    return missing.withColumn(
        "assignment_id",
        F.concat(F.lit("new"), F.substring(F.md5(F.concat_ws("|", "project_link", "month_date")), 1, 14)),
    )


@query
def write_back(spark, sf):
    table = tb.unlinked_rows(spark, sf).withColumn("link_id", F.lit(None).cast("string"))
    return references.write_back(table, resolve_links(spark, sf))


@query
def created_links(spark, sf):
    """Rows without a link after a destination that makes its own ids was asked for those it lacks."""
    resolved = resolve_links(spark, sf)
    box = Outbox(spark, f"{shared_dir(spark)}/outbox-{uuid4().hex}")
    wanted = resolved.where(F.col("action") == references.CREATE).select("id", "name")
    receipts = box.deliver(wanted, ["id"], "rows", "query", lambda records: [f"rec{r['request'][:14]}" for r in records])
    linked = references.with_given_ids(resolved, receipts)
    return references.write_back(tb.unlinked_rows(spark, sf).withColumn("link_id", F.lit(None).cast("string")), linked)


# --- reconcile --------------------------------------------------------------


def _payroll_reports(spark, sf):
    """(previous, current) payroll rows."""
    users, projects = tb.users(spark, sf), tb.projects(spark, sf)
    previous = ag.payroll_hours(tb.stored_entries(spark, sf), users, projects)
    return previous, ag.payroll_hours(tb.current_entries(spark, sf), users, projects)


def _cells(spark, records, strategy):
    """Typed cells, written once as in the job: the diff reads them twice, and would make and read each VARIANT several times."""
    return stage(spark, reconcile.destination_cells(records, strategy), f"cells_{strategy.lower()}", "query")


def _payroll_diff(spark, sf):
    previous, current = _payroll_reports(spark, sf)
    return reconcile.diff_of_cells(current, _cells(spark, tb.payroll_records(previous), model.PAYROLL), model.PAYROLL)


def _assignment_diff(spark, sf):
    previous = stage(spark, _previous_monthly(spark, sf), "previous_monthly", "query")
    current = stage(spark, _current_monthly(spark, sf), "source_monthly", "query")
    held = reconcile.destination_cells(tb.assignment_records(previous), model.PROJECT_ASSIGNMENT)
    index = stage(spark, references.assignment_index(held), "assignment_index", "query")
    created = stage(spark, _created(references.missing_assignments(current, index)), "new_assignments", "query")
    cells_ = _cells(spark, tb.person_records(previous), model.ASSIGNMENT)
    complete = references.complete_assignments(index, created)
    return reconcile.diff_of_cells(current, cells_, model.ASSIGNMENT, index=complete)


@query
def payroll_actions(spark, sf):
    return _payroll_diff(spark, sf).actions.select(
        "outcome", "record_id", "user_link", "user_name", "project_id", "project_name", "month", "hours", "set_actual"
    )


@query
def laid_out_actions(spark, sf):
    """The same against records laid out by key, of which an earlier delivery was kept up from changes."""
    previous, current = _payroll_reports(spark, sf)
    cells_ = _cells(spark, tb.payroll_records(previous), model.PAYROLL)
    earlier, changed, gone = tb.earlier_cells(cells_)
    store = record_store.RecordStore(Tables(spark, f"{shared_dir(spark)}/store-{uuid4().hex}"), model.PAYROLL)
    store.replace(earlier, 32)
    diff = reconcile.diff_of_layout(current, store.refresh(changed, gone), model.PAYROLL)
    return diff.actions.select(
        "outcome", "record_id", "user_link", "user_name", "project_id", "project_name", "month", "hours", "set_actual"
    )


@query
def payroll_updates(spark, sf):
    return _payroll_diff(spark, sf).updates.select("record_id", "set_actual")


@query
def payroll_inserts(spark, sf):
    rows = _payroll_diff(spark, sf).inserts
    return rows.withColumns({"user": F.array_join("user", ","), "project": F.array_join("project", ",")})


@query
def payroll_zeroed(spark, sf):
    actions = _payroll_diff(spark, sf).actions
    return actions.where(F.col("outcome") == reconcile.ZEROED).select("record_id", "set_actual")


@query
def dedup_updates(spark, sf):
    return reconcile.dedupe_updates(_payroll_diff(spark, sf).updates).select("record_id", "set_actual")


@query
def diff_stats(spark, sf):
    return reconcile.total_stats([_payroll_diff(spark, sf).stats, _assignment_diff(spark, sf).stats])


@query
def assignment_updates(spark, sf):
    return _assignment_diff(spark, sf).updates.select("record_id", "set_actual", "set_assigned")


@query
def assignment_inserts(spark, sf):
    rows = _assignment_diff(spark, sf).inserts
    return rows.withColumns(
        {"person": F.array_join("person", ","), "project_assignment": F.array_join("project_assignment", ",")}
    )


@query
def action_batches(spark, sf):
    updates = stage(spark, reconcile.dedupe_updates(_payroll_diff(spark, sf).updates), "updates_payroll", "query")
    batched = reconcile.batch_actions(updates.select("record_id"), "record_id")
    return batched.groupBy("batch").agg(
        F.count("*").alias("rows"), F.min("record_id").alias("first_id"), F.max("record_id").alias("last_id")
    )


@query
def dead_links(spark, sf):
    found = reconcile.extract_dead_links(tb.destination_errors(spark, sf))
    return found.where(F.col("link_id").isNotNull()).select("error_id", "link_id")


@query
def heal_dead_links(spark, sf):
    dead = reconcile.extract_dead_links(tb.destination_errors(spark, sf))
    numbered = tb.table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("rec"), F.lpad(F.col("c_custkey").cast("string"), 14, "0")).alias("link_id")
    )
    return upsert.clear_dead_links(numbered, dead.where(F.col("link_id").isNotNull()))


# --- identity ---------------------------------------------------------------


def _matched(spark, sf):
    return identity.match_identity(tb.people(spark, sf), tb.roster(spark, sf))


@query
def match_identity(spark, sf):
    return _matched(spark, sf)


@query
def discovered_ids(spark, sf):
    return identity.discovered_ids(_matched(spark, sf))


@query
def unmatched_users(spark, sf):
    return identity.unmatched_people(_matched(spark, sf))


@query
def matched_count(spark, sf):
    return identity.matched_count(_matched(spark, sf))


@query
def nudge_rows(spark, sf):
    rows = _unassigned_rows(spark, sf)
    people = ag.unassigned_hours(rows, tb.users(spark, sf))
    matched = identity.match_identity(people, tb.roster(spark, sf))
    return identity.nudge_rows(matched, rows)


@query
def unmatched_report(spark, sf):
    return reports.unmatched_rows(identity.unmatched_people(_matched(spark, sf)))


@query
def conflict_report(spark, sf):
    return reports.conflict_rows(resolve_links(spark, sf))


@query
def heal_report(spark, sf):
    return reports.heal_rows(resolve_links(spark, sf), "all")
