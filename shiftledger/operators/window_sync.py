"""Window sync: merge a look-back extract and find what vanished from it."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.functions.calendar import instant_literal
from shiftledger.functions.text import stable_id
from shiftledger.operators.increments import BEFORE, COUNTED
from shiftledger.operators.upsert import (
    ENTRY_COLUMNS,
    UpsertedEntries,
    resolve_entries,
    unique_rows,
    upsert_entries,
)
from shiftledger.operators.windows import user_window, within
from shiftledger.sources.day_index import STORED_DAY

UPDATED = "updated"
INSERTED = "inserted"
DELETED = "deleted"
KEPT = "kept"
#: Counts that make a run worth telling about; new clients alone do not.
NOTEWORTHY = ("upserted", "deleted", "new_users", "renamed_users", "new_projects")


class WindowSync(NamedTuple):
    """``merged`` is the next state plus ``sync_action``, ``sync_changed`` and ``before``, what changed rows counted as until now.

    A job stages ``merged`` once and takes entries and statistics from there.
    """

    merged: DataFrame
    entries: DataFrame
    stats: DataFrame


def find_ghosts(entries: DataFrame, extract: DataFrame, scanned_users: DataFrame, start: datetime) -> DataFrame:
    """Ids of live stored entries of scanned users in the window, missing from the extract."""
    live = user_window(entries, scanned_users, start).where(F.col("deleted_at").isNull())
    return live.select("source_id", "user_id").join(extract.select("source_id"), "source_id", "left_anti")


def soft_delete(entries: DataFrame, ids: DataFrame, run_ts: datetime) -> DataFrame:
    """Stamp the named entries as deleted; nothing is removed."""
    named = ids.select("source_id").distinct().withColumn("_gone", F.lit(True))
    stamp = instant_literal(run_ts)
    return entries.join(named, "source_id", "left").select(
        *[
            F.when(F.col("_gone"), stamp).otherwise(F.col(c)).alias(c) if c in ("deleted_at", "updated_at") else F.col(c)
            for c in entries.columns
        ]
    )


def sync_window(
    entries: DataFrame,
    extract: DataFrame,
    users: DataFrame,
    projects: DataFrame,
    scanned_users: DataFrame,
    start: datetime,
    run_ts: datetime,
    order_by: Column | None = None,
) -> WindowSync:
    """Merge, ghost search and soft delete in one plan over all users.

    Only users in ``scanned_users`` (column ``user_id``) can lose entries: an
    extract that is incomplete for somebody must not delete their rows.
    """
    resolved = resolve_entries(unique_rows(extract, "source_id", order_by), users, projects)
    return merge_window(entries, resolved, scanned_users, start, run_ts)


def merge_window(
    entries: DataFrame, resolved: DataFrame, scanned_users: DataFrame, start: datetime, run_ts: datetime
) -> WindowSync:
    """The same from resolved rows, one per id.

    A job stages ``resolved`` first: Spark overrates the size of a join's result,
    and only with the true size does it plan to broadcast the increment rather
    than shuffle the stored rows. Those pass one join against the increment, and
    both outcomes (matched: update, unmatched: possible ghost) are decided in one
    projection.
    """
    located = STORED_DAY in resolved.columns
    incoming = resolved.select(
        "source_id", *[F.col(c).alias(f"_new_{c}") for c in ENTRY_COLUMNS], *([STORED_DAY] if located else [])
    ).withColumn("_in", F.lit(True))
    scanned = scanned_users.select("user_id").distinct().withColumn("_scanned", F.lit(True))
    stamp = instant_literal(run_ts)

    known_user = F.col("_new_user_id").isNotNull()
    action = (
        F.when(F.col("_in") & known_user, UPDATED)
        .when(
            F.col("_in").isNull()
            & F.col("deleted_at").isNull()
            & (F.col("start_time") >= instant_literal(start))
            & F.col("_scanned"),
            DELETED,
        )
        .otherwise(KEPT)
    )
    differs = F.lit(False)
    for c in ENTRY_COLUMNS:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    joined = (
        entries.join(incoming, "source_id", "left")
        .join(scanned, "user_id", "left")
        .withColumn("sync_action", action)
        .withColumn(
            "sync_changed",
            F.when(F.col("sync_action") == UPDATED, differs).otherwise(F.col("sync_action") == DELETED),
        )
    )

    before = F.when(F.col("sync_changed"), F.struct(*COUNTED))

    def next_value(c: str) -> Column:
        value = F.col(c)
        if c in ENTRY_COLUMNS:
            value = F.when(F.col("sync_action") == UPDATED, F.col(f"_new_{c}")).otherwise(value)
        if c == "deleted_at":
            value = F.when(F.col("sync_action") == DELETED, stamp).otherwise(value)
        if c == "updated_at":
            value = F.when(F.col("sync_action") != KEPT, stamp).otherwise(value)
        return value.alias(c)

    def first_value(c: str) -> Column:
        if c == "source_id":
            return F.col(c)
        if c in ENTRY_COLUMNS:
            return F.col(f"_new_{c}").alias(c)
        if c == "id":
            return stable_id(F.col("source_id")).alias(c)
        if c == "updated_at":
            return stamp.alias(c)
        return F.lit(None).cast(entries.schema[c].dataType).alias(c)

    stored = joined.select(*[next_value(c) for c in entries.columns], "sync_action", "sync_changed", before.alias(BEFORE))
    if located:
        absent = incoming.where(known_user & F.col(STORED_DAY).isNull())
    else:
        known = entries.select("source_id").join(incoming.select("source_id"), "source_id", "left_semi")
        absent = incoming.where(known_user).join(known, "source_id", "left_anti")
    inserted = absent.select(
        *[first_value(c) for c in entries.columns],
        F.lit(INSERTED).alias("sync_action"),
        F.lit(True).alias("sync_changed"),
        F.lit(None).cast(stored.schema[BEFORE].dataType).alias(BEFORE),
    )
    merged = stored.unionByName(inserted)
    return WindowSync(merged, merged.drop("sync_action", "sync_changed", BEFORE), sync_stats(merged))


def merge_only(entries: DataFrame, resolved: DataFrame, run_ts: datetime) -> DataFrame:
    """Merge resolved rows without a ghost search: the next state with the columns of ``merge_window``."""
    nobody = entries.select("user_id").limit(0)
    return merge_window(entries, resolved, nobody, run_ts, run_ts).merged


def sync_stats(merged: DataFrame) -> DataFrame:
    """Per user: upserted, deleted, and how many rows truly changed.

    "Upserted" counts every merged row, changed or not.
    """
    return (
        merged.where(F.col("sync_action") != KEPT)
        .groupBy("user_id")
        .agg(
            F.count_if(F.col("sync_action").isin(UPDATED, INSERTED)).alias("upserted"),
            F.count_if(F.col("sync_action") == DELETED).alias("deleted"),
            F.count_if("sync_changed").alias("changed"),
        )
    )


def sync_report(stats: DataFrame, changes: DataFrame, scanned_users: DataFrame) -> DataFrame:
    """One row of run totals.

    ``changes`` has (table, kind, text) of all reference merges. ``has_changes``
    leaves new clients out; ``synced`` (upserted + deleted) decides whether the
    reconcile runs.
    """
    totals = stats.agg(
        F.coalesce(F.sum("upserted"), F.lit(0)).alias("upserted"),
        F.coalesce(F.sum("deleted"), F.lit(0)).alias("deleted"),
        F.coalesce(F.sum("changed"), F.lit(0)).alias("changed"),
    )
    counts = changes.agg(*change_counts())
    scanned = scanned_users.agg(F.countDistinct("user_id").alias("users_scanned"))
    # Three one-row tables as one: stacked, then the one value of each column.
    stacked = totals.unionByName(counts, allowMissingColumns=True).unionByName(scanned, allowMissingColumns=True)
    report = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    has_changes = F.lit(False)
    for c in NOTEWORTHY:
        has_changes = has_changes | (F.col(c) > 0)
    return report.withColumn("synced", F.col("upserted") + F.col("deleted")).withColumn("has_changes", has_changes)


def totals_report(counts: dict[str, int]) -> dict:
    """The same report from figures that were taken while the rows were written."""
    return {**counts, "synced": counts["upserted"] + counts["deleted"], "has_changes": any(counts[c] > 0 for c in NOTEWORTHY)}


def sync_totals() -> dict[str, Column]:
    """Totals of merged rows, to be taken while they are written."""
    action = F.col("sync_action")
    return {
        "upserted": F.count_if(action.isin(UPDATED, INSERTED)),
        "deleted": F.count_if(action == DELETED),
        "changed": F.count_if("sync_changed"),
    }


def change_counts() -> list[Column]:
    """Numbers of reference changes by kind."""
    is_kind = [
        ("new_users", "users", "added"),
        ("renamed_users", "users", "renamed"),
        ("new_projects", "projects", "added"),
        ("new_clients", "clients", "added"),
    ]
    return [F.count_if((F.col("table") == t) & (F.col("kind") == k)).alias(n) for n, t, k in is_kind]


def backfill(
    entries: DataFrame,
    extract: DataFrame,
    users: DataFrame,
    projects: DataFrame,
    start: datetime,
    run_ts: datetime,
    user_source_id: str | None = None,
) -> UpsertedEntries:
    """Merge history from ``start`` for all users or one. Nothing is deleted."""
    rows = within(extract, start)
    if user_source_id is not None:
        rows = rows.where(F.col("user_source_id") == user_source_id)
    return upsert_entries(entries, rows, users, projects, run_ts)
