"""Parts shared by the jobs."""

from __future__ import annotations

from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.operators import upsert
from shiftledger.operators import window_sync as ws
from shiftledger.operators.upsert import unique_rows
from shiftledger.operators.windows import PARTITION, with_partition
from shiftledger.plans.runs import RunFailed
from shiftledger.sources.day_index import STORED_DAY
from shiftledger.sources.extracts import Validated, require_clean
from shiftledger.sources.tables import Held, Tables, stage, stage_counted


__all__ = ["Affected", "Extracts", "RunFailed", "affected", "merge_entries", "merge_references", "publish_merged", "run_id"]


class Extracts(NamedTuple):
    """Validated tracker extracts of one run."""

    users: Validated
    clients: Validated
    projects: Validated
    entries: Validated
    #: Source ids (column source_id) of the users whose entries were fetched whole; by default those in ``users``.
    scanned_users: DataFrame | None = None


def run_id(run_ts: datetime, step: str) -> str:
    """Sortable id of a run; ``step`` orders the jobs of one instant."""
    return f"{run_ts.astimezone(UTC):%Y%m%dT%H%M%S%f}-{step}"


def merge_references(tables: Tables, extracts: Extracts, run: str, run_ts: datetime) -> DataFrame:
    """Merge users, then clients, then projects (which refer to clients).

    Reference extracts are all or nothing: one invalid row stops the run before
    anything is written. Returns all changes as (table, kind, text).
    """
    spark = tables.spark
    for name in ("users", "clients", "projects"):
        require_clean(getattr(extracts, name).rejected, name)

    def publish(name: str, merged: upsert.Upserted) -> DataFrame:
        changes = stage(spark, merged.changes.withColumn("table", F.lit(name)), f"changes_{name}", run)
        tables.publish(name, merged.table, run)
        return changes

    def incoming(name: str) -> DataFrame:
        return stage(spark, getattr(extracts, name).valid, f"extract_{name}", run)

    users = publish("users", upsert.upsert_users(tables.read("users"), incoming("users"), run_ts))
    clients = publish("clients", upsert.upsert_clients(tables.read("clients"), incoming("clients"), run_ts))
    seeded = upsert.seed_if_absent(tables.read("projects"), upsert.sentinel_row(spark))
    projects = publish(
        "projects",
        upsert.upsert_projects(seeded, incoming("projects"), tables.read("clients"), run_ts),
    )
    return users.unionByName(clients).unionByName(projects)


class Affected(NamedTuple):
    """What a merge works on: stored entries of the days it can touch, those days, the incoming rows with ``stored_day``
    (staged; null for ids that are not stored), and the state all this was read from."""

    target: DataFrame
    days: list
    placed: DataFrame
    held: Held


def affected(tables: Tables, resolved: DataFrame, start: datetime | None, run: str) -> Affected:
    """Find incoming rows in the day index and open the days concerned. Reads no other stored day."""
    held = tables.held()
    located = tables.locate(resolved, held)
    placed = stage(tables.spark, resolved.join(located, "source_id", "left"), "placed", run)
    days = tables.days_of(placed, held, start)
    return Affected(tables.read_entries(held).where(F.col(PARTITION).isin(days)), days, placed, held)


def publish_merged(tables: Tables, merged: DataFrame, found: Affected) -> None:
    """Publish the staged next state of the affected days, the ids that are new there or have changed their day, and the hours
    that changed entries take away or add."""
    day = with_partition(found.placed.where(F.col("user_id").isNotNull())).where(~F.col(PARTITION).eqNullSafe(F.col(STORED_DAY)))
    moved = day.select("source_id", F.col(PARTITION).alias("day"))
    tables.publish_entries(merged, found.days, held=found.held, moved=moved, changed=merged.where("sync_changed"))


def merge_entries(
    tables: Tables, extract: DataFrame, run: str, run_ts: datetime, order_by: Column | None = None
) -> dict[str, int]:
    """Upsert a staged extract, without a ghost pass; counts of the merge."""
    rows = unique_rows(extract, "source_id", order_by)
    resolved, counts = stage_counted(
        tables.spark,
        upsert.resolve_entries(rows, tables.read("users"), tables.read("projects")),
        "resolved",
        run,
        upserted=F.count_if(F.col("user_id").isNotNull()),
        skipped=F.count_if(F.col("user_id").isNull()),
    )
    found = affected(tables, resolved, None, run)
    merged = ws.merge_only(found.target.drop(PARTITION), found.placed, run_ts)
    publish_merged(tables, stage(tables.spark, merged, "entries", run), found)
    return counts
