"""Diff of computed hours against destination records."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.functions import cells as c
from shiftledger.functions.calendar import month_label_to_date
from shiftledger.functions.text import blank_to_null, hash_slot
from shiftledger.model import (
    ASSIGNMENT,
    BATCH_SIZE,
    DEAD_LINK_CODES,
    FIELD_ACTUAL_HOURS,
    FIELD_ASSIGNED_HOURS,
    FIELD_MONTH,
    FIELD_PERSON,
    FIELD_PROJECT,
    FIELD_PROJECT_ASSIGNMENT,
    FIELD_USER,
    NO_PROJECT,
    NO_USER,
    PAYROLL,
    PROJECT_ASSIGNMENT,
    RECORD_ID_PATTERN,
    TOLERANCE,
)

UPDATE = "update"
INSERT = "insert"
UNCHANGED = "unchanged"
SKIPPED = "skipped"
MISSING = "missing"
ZEROED = "zeroed"


class Diff(NamedTuple):
    """``actions`` holds every source row and every zeroed record with its outcome.

    A job stages ``actions`` once; updates, inserts and stats are cheap views of it.
    """

    actions: DataFrame
    updates: DataFrame
    inserts: DataFrame
    stats: DataFrame


class Layout(NamedTuple):
    """Typed cells by key: ``current`` has the last record of each key, ``rest`` all others (``sources.record_store``)."""

    current: DataFrame
    rest: DataFrame


# --- destination cells ------------------------------------------------------


def destination_cells(records: DataFrame, strategy: str) -> DataFrame:
    """The cells a strategy needs, typed; everything else is dropped here.

    ``records`` has (id, pos, fields VARIANT). Keys use the first id of a link
    list, untrimmed, and "no_user"/"no_project"/"" where it is missing.
    """
    fields = F.col("fields")
    if strategy == PROJECT_ASSIGNMENT:
        return records.select(
            "id",
            "pos",
            c.cell_first_link(fields, FIELD_PROJECT).alias("project_link"),
            c.cell_text(fields, FIELD_MONTH).alias("month"),
        )
    hours = [
        c.cell_kind(fields, FIELD_ACTUAL_HOURS).alias("actual_kind"),
        c.cell_number(fields, FIELD_ACTUAL_HOURS).alias("actual"),
    ]
    if strategy == PAYROLL:
        return records.select(
            "id",
            "pos",
            F.coalesce(c.cell_first_link(fields, FIELD_USER), F.lit(NO_USER)).alias("user_key"),
            F.coalesce(c.cell_first_link(fields, FIELD_PROJECT), F.lit(NO_PROJECT)).alias("project_key"),
            F.coalesce(c.cell_text(fields, FIELD_MONTH), F.lit("")).alias("month_key"),
            *hours,
        )
    if strategy == ASSIGNMENT:
        return records.select(
            "id",
            "pos",
            c.cell_first_link(fields, FIELD_PERSON).alias("user_key"),
            c.cell_first_link(fields, FIELD_PROJECT_ASSIGNMENT).alias("assignment_key"),
            *hours,
            c.cell_kind(fields, FIELD_ASSIGNED_HOURS).alias("assigned_kind"),
        )
    raise ValueError(f"Unknown strategy: {strategy}")


def key_columns(strategy: str) -> list[str]:
    """Columns on which source rows and records meet."""
    return ["user_key", "project_key", "month_key"] if strategy == PAYROLL else ["user_key", "assignment_key"]


def matchable(cells: DataFrame, strategy: str) -> DataFrame:
    """Records that a row can meet: assignment records without person or assignment match nothing."""
    if strategy == ASSIGNMENT:
        return cells.where(F.col("user_key").isNotNull() & F.col("assignment_key").isNotNull())
    return cells


def destination_index(cells: DataFrame, strategy: str) -> DataFrame:
    """Last record per key, of those that can be met.

    ``max_by`` aggregates on the map side, so a key shared by a large
    part of all records is reduced before the shuffle.
    """
    keys = key_columns(strategy)
    cells = matchable(cells, strategy)
    values = [x for x in cells.columns if x not in keys and x != "pos"]
    last = F.max_by(F.struct(*values), F.struct("pos", "id")).alias("_last")
    return cells.groupBy(*keys).agg(last).select(
        *keys, *[F.col(f"_last.{v}").alias("record_id" if v == "id" else v) for v in values]
    )


# --- source rows ------------------------------------------------------------


def source_hours(total_hours: Column) -> Column:
    """Hours as DOUBLE; anything unreadable is 0."""
    value = total_hours.try_cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))


def source_rows(source: DataFrame, strategy: str, index: DataFrame | None = None) -> DataFrame:
    """Report rows with their matching key.

    Assignment rows find their assignment by (project, month) in ``index``;
    without one the key is null, which matches nothing.
    """
    # Null casts in the projection keep the optional input columns optional.
    raw_link = F.col("raw_project_link") if "raw_project_link" in source.columns else F.col("project_link")
    rows = source.select(
        "user_link",
        "user_name",
        "project_link",
        "project_name",
        "month",
        source_hours(F.col("total_hours")).alias("hours"),
        raw_link.alias("raw_project_link"),
        blank_to_null(F.col("user_link")).alias("user_id"),
        blank_to_null(F.col("project_link")).alias("project_id"),
    )
    user_key = F.coalesce("user_id", F.lit(NO_USER))
    if strategy == PAYROLL:
        return rows.select(
            "*",
            user_key.alias("user_key"),
            F.coalesce("project_id", F.lit(NO_PROJECT)).alias("project_key"),
            F.col("month").alias("month_key"),
            F.lit(None).cast("string").alias("assignment_id"),
        )
    found = index.select(
        F.col("project_link").alias("project_id"), F.col("month_date"), F.col("assignment_id")
    )
    dated = rows.withColumn(
        "month_date", F.when(F.col("project_id").isNotNull(), month_label_to_date(F.col("month")))
    )
    return dated.join(found, ["project_id", "month_date"], "left").select(
        *rows.columns,
        user_key.alias("user_key"),
        F.col("assignment_id").alias("assignment_key"),
        "assignment_id",
    )


def source_order() -> Column:
    """Order of source rows where the last one wins; nulls come first."""
    return F.struct("user_name", "project_name", "raw_project_link", "user_link", "hours")


# --- diff -------------------------------------------------------------------


def hours_differ(hours: Column, actual_kind: Column, actual: Column, tolerance: float) -> Column:
    """Beyond tolerance (in binary floating point), or a zero whose cell is absent.

    A cell that is not a number counts as 0.
    """
    moved = F.abs(hours - F.coalesce(actual, F.lit(0.0))) > tolerance
    return moved | ((hours == 0) & (actual_kind == c.ABSENT))


def calculate_diff(
    source: DataFrame,
    records: DataFrame,
    strategy: str,
    index: DataFrame | None = None,
    allow_inserts: bool = True,
    tolerance: float = TOLERANCE,
    merge_duplicate_keys: bool = False,
) -> Diff:
    """Least set of updates, inserts and zeroed records.

    ``source`` are report rows, ``records`` destination records (id, pos,
    fields), ``index`` the complete assignments of the assignment strategy.

    Two source rows may share a key. By default each acts on its own (two
    updates of one record, of which :func:`dedupe_updates` keeps the last, or two
    inserts); ``merge_duplicate_keys`` sums them into one row first.
    """
    if strategy not in (PAYROLL, ASSIGNMENT):
        raise ValueError(f"Unknown strategy: {strategy}")
    cells = destination_cells(records, strategy)
    return diff_of_cells(source, cells, strategy, index, allow_inserts, tolerance, merge_duplicate_keys)


def diff_of_cells(
    source: DataFrame,
    cells: DataFrame,
    strategy: str,
    index: DataFrame | None = None,
    allow_inserts: bool = True,
    tolerance: float = TOLERANCE,
    merge_duplicate_keys: bool = False,
) -> Diff:
    """:func:`calculate_diff` on typed cells, which a job stages because they are read twice.

    One full outer join on the key judges the source rows and shows the last records that no row meets.
    Records that are not the last of their key are never met; they are told apart by record id, which has no hot values.
    """
    last = destination_index(cells, strategy)
    others = cells.join(last.select(F.col("record_id").alias("id")), "id", "left_anti")
    return _diff(source, last, others, strategy, index, allow_inserts, tolerance, merge_duplicate_keys)


def diff_of_layout(
    source: DataFrame,
    layout: Layout,
    strategy: str,
    index: DataFrame | None = None,
    allow_inserts: bool = True,
    tolerance: float = TOLERANCE,
    merge_duplicate_keys: bool = False,
) -> Diff:
    """:func:`calculate_diff` on records laid out by key: they are neither grouped nor shuffled."""
    last = layout.current.drop("pos").withColumnRenamed("id", "record_id")
    return _diff(source, last, layout.rest, strategy, index, allow_inserts, tolerance, merge_duplicate_keys)


def _diff(
    source: DataFrame,
    last: DataFrame,
    others: DataFrame,
    strategy: str,
    index: DataFrame | None,
    allow_inserts: bool,
    tolerance: float,
    merge_duplicate_keys: bool,
) -> Diff:
    """``last`` has one record per key (record_id), ``others`` all records besides (id)."""
    if strategy == ASSIGNMENT and index is None:
        raise ValueError("the assignment strategy needs the assignment index")

    rows = source_rows(source, strategy, index)
    if merge_duplicate_keys:
        rows = _merged(rows, strategy)
    matched = rows.withColumn("is_row", F.lit(True)).join(last, key_columns(strategy), "full")

    is_row = F.col("is_row").isNotNull()
    stale = (F.col("actual_kind") != c.ABSENT) & ~F.coalesce(F.col("actual") == 0, F.lit(False))
    differs = hours_differ(F.col("hours"), F.col("actual_kind"), F.col("actual"), tolerance)
    unassigned = F.col("assigned_kind") == c.ABSENT if strategy == ASSIGNMENT else F.lit(False)
    # A skipped row has no project, so no assignment key: it meets no record.
    skipped = F.col("project_id").isNull() if strategy == ASSIGNMENT else F.lit(False)
    insertable = F.lit(allow_inserts) & F.col("user_id").isNotNull()
    if strategy == ASSIGNMENT:
        insertable = insertable & F.col("assignment_id").isNotNull()

    outcome = (
        F.when(~is_row, ZEROED)
        .when(skipped, SKIPPED)
        .when(F.col("record_id").isNotNull(), F.when(differs | unassigned, UPDATE).otherwise(UNCHANGED))
        .when(insertable, INSERT)
        .otherwise(MISSING)
    )
    updated = F.col("outcome") == UPDATE
    judged = matched.where(is_row | stale).withColumn("outcome", outcome).select(
        "outcome",
        "record_id",
        "user_name",
        "project_name",
        "raw_project_link",
        "user_link",
        "user_id",
        "project_id",
        "assignment_id",
        "month",
        "hours",
        F.when(F.col("outcome") == ZEROED, F.lit(0.0)).when(updated & differs, F.col("hours")).alias("set_actual"),
        F.when(updated & unassigned, F.lit(0.0)).alias("set_assigned"),
    )
    superseded = others.where(stale).select(
        F.lit(ZEROED).alias("outcome"), F.col("id").alias("record_id"), F.lit(0.0).alias("set_actual")
    )
    actions = judged.unionByName(superseded, allowMissingColumns=True)
    return Diff(actions, updates_of(actions), inserts_of(actions, strategy), diff_stats(actions))


def _merged(rows: DataFrame, strategy: str) -> DataFrame:
    keys = key_columns(strategy)
    rest = [x for x in rows.columns if x not in keys and x != "hours"]
    # Null keys (assignment rows without assignment) match nothing and stay apart.
    shared = rows.where(F.col("assignment_key").isNotNull()) if strategy == ASSIGNMENT else rows
    summed = shared.groupBy(*keys).agg(
        F.round(F.sum("hours"), 2).alias("hours"), F.max_by(F.struct(*rest), source_order()).alias("_r")
    ).select(*keys, "hours", *[F.col(f"_r.{x}").alias(x) for x in rest])
    if strategy == ASSIGNMENT:
        summed = summed.unionByName(rows.where(F.col("assignment_key").isNull()).select(summed.columns))
    return summed


def updates_of(actions: DataFrame) -> DataFrame:
    """Updates before dedupe: cells to set, null meaning "leave alone"."""
    return actions.where(F.col("outcome").isin(UPDATE, ZEROED)).select(
        "record_id", "set_actual", "set_assigned", "user_name", "project_name", "raw_project_link", "user_link", "hours"
    )


def dedupe_updates(updates: DataFrame) -> DataFrame:
    """One update per record: the last by :func:`source_order`, its cells replacing all earlier ones."""
    last = F.max_by(F.struct("set_actual", "set_assigned"), source_order()).alias("_u")
    return updates.groupBy("record_id").agg(last).select("record_id", "_u.set_actual", "_u.set_assigned")


def inserts_of(actions: DataFrame, strategy: str) -> DataFrame:
    """Rows to create, link cells as lists."""
    rows = actions.where(F.col("outcome") == INSERT)
    if strategy == PAYROLL:
        return rows.select(
            F.array("user_id").alias("user"),
            F.when(F.col("project_id").isNotNull(), F.array("project_id"))
            .otherwise(F.array().cast("array<string>"))
            .alias("project"),
            "month",
            F.col("hours").alias("actual_hours"),
        )
    return rows.select(
        F.array("user_id").alias("person"),
        F.array("assignment_id").alias("project_assignment"),
        F.col("hours").alias("actual_hours"),
        F.lit(0.0).alias("assigned_hours"),
    )


def diff_stats(actions: DataFrame) -> DataFrame:
    """One row: updated (before dedupe), inserted, skipped, missing."""
    outcome = F.col("outcome")
    return actions.agg(
        F.count_if(outcome.isin(UPDATE, ZEROED)).alias("updated"),
        F.count_if(outcome == INSERT).alias("inserted"),
        F.count_if(outcome.isin(SKIPPED, UNCHANGED)).alias("skipped"),
        F.count_if(outcome == MISSING).alias("missing"),
    )


def total_stats(stats: list[DataFrame]) -> DataFrame:
    """Sum of the jobs' stats."""
    stacked = stats[0]
    for more in stats[1:]:
        stacked = stacked.unionByName(more)
    return stacked.agg(*[F.sum(x).alias(x) for x in ("updated", "inserted", "skipped", "missing")])


# --- sending ----------------------------------------------------------------


def batch_actions(actions: DataFrame, id_col: str, size: int = BATCH_SIZE, slices: int = 1024) -> DataFrame:
    """Add ``batch`` (from 0): rows numbered over the whole table, ``size`` to a batch, so only the last may be short.

    Rows are ordered by a hash slice of the unique id, then by the id. Each slice counts on from the rows of the
    slices before it, so no task sorts more than a slice. A group of ``size`` consecutive numbers may span two slices.
    """
    if size < 1 or slices < 1:
        raise ValueError("size and slices must be positive")
    sliced = actions.withColumn("_slice", hash_slot(F.col(id_col), F.lit(slices)))
    counts = sliced.groupBy("_slice").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(id_col)) - 1
    numbered = sliced.withColumn("_place", place).join(F.broadcast(bases), "_slice")
    batch = F.floor((F.col("_base") + F.col("_place")) / size).cast("bigint")
    return numbered.withColumn("batch", batch).drop("_slice", "_place", "_base")


def collect_batches(batched: DataFrame, payload: Column) -> DataFrame:
    """One row per batch with its payloads: never more than the batch size."""
    return batched.groupBy("batch").agg(F.collect_list(payload).alias("records"))


# --- dead links -------------------------------------------------------------


def extract_dead_links(errors: DataFrame) -> DataFrame:
    """First record id of error texts that say a record is gone, else null."""
    message = F.col("message")
    gone = F.lit(False)
    for code in DEAD_LINK_CODES:
        gone = gone | message.contains(code)
    found = F.nullif(F.regexp_extract(message, RECORD_ID_PATTERN, 0), F.lit(""))
    return errors.withColumn("link_id", F.when(gone, found))
