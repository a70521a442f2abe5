"""Keyed writes: each returns the table's next state.

Parquet has no MERGE, so an upsert is a projection of target and increment. It
is written as joins whose build side is always the increment. While the
increment is small enough for Spark to broadcast (its own size check, planned or
adaptive), the target is streamed through without a shuffle; beyond that size
the same plan runs as sort-merge joins.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.functions.calendar import instant_literal
from shiftledger.functions.text import stable_id
from shiftledger.model import RENAME_ARROW, SENTINEL_NAME, SENTINEL_SOURCE_ID
from shiftledger.sources.day_index import STORED_DAY


class Upserted(NamedTuple):
    """Next state of the table, and what was new or renamed (kind, text)."""

    table: DataFrame
    changes: DataFrame


class UpsertedEntries(NamedTuple):
    """Next state of the entries, and the extract rows whose user is unknown."""

    entries: DataFrame
    skipped: DataFrame


def unique_rows(rows: DataFrame, key: str, order_by: Column | None = None) -> DataFrame:
    """One row per key: the last by ``order_by``, or an error on repeated keys.

    A pre-aggregating group-by, so a key repeated very often is reduced before
    the shuffle; the merge that follows joins on the same key and needs no other.
    """
    whole = F.struct(*[F.col(c) for c in rows.columns])
    if order_by is not None:
        return rows.groupBy(key).agg(F.max_by(whole, order_by).alias("_row")).select("_row.*")
    counted = rows.groupBy(key).agg(F.any_value(whole).alias("_row"), F.count("*").alias("_n"))
    repeated = F.raise_error(F.concat(F.lit(f"Repeated {key} in one upsert: "), F.col(key).cast("string")))
    return counted.select(F.when(F.col("_n") == 1, F.col("_row")).otherwise(repeated).alias("_row")).select("_row.*")


def upsert(
    target: DataFrame,
    rows: DataFrame,
    key: str = "source_id",
    cols: list[str] | None = None,
    run_ts: datetime | None = None,
    touch: str | None = None,
    order_by: Column | None = None,
    new: dict[str, Column] | None = None,
    located: str | None = None,
) -> DataFrame:
    """Insert or update only ``cols`` of ``rows``; all other columns survive.

    ``touch`` names a column set to ``run_ts`` on every matched row, changed or
    not. ``new`` gives the values of further columns on inserted rows. ``located`` names a column of ``rows`` that is
    null for keys that are not stored: then the target is read once, else its keys are read again to find what is new.
    """
    cols = cols or [c for c in rows.columns if c not in (key, located)]
    incoming = unique_rows(rows, key, order_by).select(
        F.col(key),
        *[F.col(c).alias(f"_new_{c}") for c in cols],
        F.lit(True).alias("_in"),
        *([F.col(located).isNull().alias("_absent")] if located else []),
    )

    def next_value(c: str) -> Column:
        if c in cols:
            return F.when(F.col("_in"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c == touch:
            return F.when(F.col("_in"), instant_literal(run_ts)).otherwise(F.col(c)).alias(c)
        return F.col(c)

    def first_value(c: str) -> Column:
        kind = target.schema[c].dataType
        if c == key:
            return F.col(key)
        if c in cols:
            return F.col(f"_new_{c}").cast(kind).alias(c)
        if new and c in new:
            return new[c].cast(kind).alias(c)
        if c == "id":
            return stable_id(F.col(key)).alias(c)
        if c in ("created_at", touch) and run_ts is not None:
            return instant_literal(run_ts).alias(c)
        return F.lit(None).cast(kind).alias(c)

    updated = target.join(incoming, key, "left").select(*[next_value(c) for c in target.columns])
    if located:
        absent = incoming.where("_absent")
    else:
        known = target.select(key).join(incoming.select(key), key, "left_semi")
        absent = incoming.join(known, key, "left_anti")
    return updated.unionByName(absent.select(*[first_value(c) for c in target.columns]))


# --- reference tables -------------------------------------------------------


def _added(target: DataFrame, rows: DataFrame) -> DataFrame:
    known = target.select("source_id").join(rows.select("source_id"), "source_id", "left_semi")
    return rows.join(known, "source_id", "left_anti").select(F.lit("added").alias("kind"), F.col("name").alias("text"))


def upsert_users(users: DataFrame, rows: DataFrame, run_ts: datetime | None = None) -> Upserted:
    """Merge (source_id, name, email); report added names and "old ➔ new"."""
    # The inner join keeps only stored users named in the extract: no pass of
    # the whole table goes further than this.
    stored = users.select("source_id", F.col("name").alias("_old")).join(
        rows.select("source_id", "name"), "source_id"
    )
    renamed = stored.where(F.col("_old") != F.col("name")).select(
        F.lit("renamed").alias("kind"), F.concat("_old", F.lit(RENAME_ARROW), "name").alias("text")
    )
    return Upserted(
        upsert(users, rows, cols=["name", "email"], run_ts=run_ts),
        _added(users, rows).unionByName(renamed),
    )


def upsert_clients(clients: DataFrame, rows: DataFrame, run_ts: datetime | None = None) -> Upserted:
    """Merge (source_id, name); report added names."""
    return Upserted(upsert(clients, rows, cols=["name"], run_ts=run_ts), _added(clients, rows))


def upsert_projects(
    projects: DataFrame, rows: DataFrame, clients: DataFrame, run_ts: datetime | None = None
) -> Upserted:
    """Merge (source_id, name, client); an unknown client becomes null."""
    keys = clients.select(F.col("source_id").alias("client_source_id"), F.col("id").alias("client_id"))
    resolved = rows.join(keys, "client_source_id", "left").select("source_id", "name", "client_id")
    return Upserted(
        upsert(projects, resolved, cols=["name", "client_id"], run_ts=run_ts), _added(projects, rows)
    )


def seed_if_absent(target: DataFrame, rows: DataFrame, key: str = "source_id") -> DataFrame:
    """Insert rows whose key is absent; existing rows are left alone."""
    known = target.select(key).join(rows.select(key), key, "left_semi")
    return target.unionByName(rows.join(known, key, "left_anti"), allowMissingColumns=True)


def sentinel_row(spark) -> DataFrame:
    """The "no project" project."""
    return spark.createDataFrame(
        [(SENTINEL_SOURCE_ID, SENTINEL_NAME)], "source_id STRING, name STRING"
    ).select(stable_id(F.col("source_id")).alias("id"), "source_id", "name")


# --- entries ----------------------------------------------------------------

ENTRY_COLUMNS = [
    "description", "start_time", "end_time", "duration_us", "user_id", "project_id", "deleted_at",
]


def resolve_entries(extract: DataFrame, users: DataFrame, projects: DataFrame) -> DataFrame:
    """Extract rows with stored user and project ids, null where unknown.

    ``deleted_at`` is null: a returned entry comes back to life.
    """
    user_keys = users.select(F.col("source_id").alias("user_source_id"), F.col("id").alias("user_id"))
    project_keys = projects.select(F.col("source_id").alias("project_source_id"), F.col("id").alias("project_id"))
    return (
        extract.join(user_keys, "user_source_id", "left")
        .join(project_keys, "project_source_id", "left")
        .withColumn("deleted_at", F.lit(None).cast("timestamp"))
    )


def skipped_entries(extract: DataFrame, users: DataFrame) -> DataFrame:
    """Extract rows whose user is unknown."""
    keys = users.select(F.col("source_id").alias("user_source_id"))
    return extract.join(keys, "user_source_id", "left_anti")


def upsert_entries(
    entries: DataFrame,
    extract: DataFrame,
    users: DataFrame,
    projects: DataFrame,
    run_ts: datetime,
    order_by: Column | None = None,
) -> UpsertedEntries:
    """Merge an extract; rows of unknown users are left out and returned."""
    merged = merge_resolved(entries, resolve_entries(extract, users, projects), run_ts, order_by)
    return UpsertedEntries(merged, skipped_entries(extract, users))


def merge_resolved(
    entries: DataFrame, resolved: DataFrame, run_ts: datetime, order_by: Column | None = None
) -> DataFrame:
    """Merge resolved rows. A job stages them first, so that their true size is
    known when Spark decides whether to broadcast them. Rows that carry ``stored_day`` need no second look at the entries."""
    known = resolved.where(F.col("user_id").isNotNull())
    located = STORED_DAY if STORED_DAY in resolved.columns else None
    return upsert(
        entries, known, cols=ENTRY_COLUMNS, run_ts=run_ts, touch="updated_at", order_by=order_by, located=located
    )


# --- single columns ---------------------------------------------------------


def set_column(target: DataFrame, updates: DataFrame, key: str, col: str) -> DataFrame:
    """Set one column on the rows named in ``updates`` (columns ``key`` and ``value``)."""
    return target.join(updates.select(key, F.col("value").alias("_value")), key, "left").select(
        *[F.coalesce("_value", c).alias(c) if c == col else F.col(c) for c in target.columns]
    )


def clear_dead_links(target: DataFrame, dead_ids: DataFrame) -> DataFrame:
    """Null ``link_id`` wherever it equals one of ``dead_ids.link_id``."""
    dead = dead_ids.select("link_id").distinct().withColumn("_dead", F.lit(True))
    return target.join(dead, "link_id", "left").select(
        *[F.when(F.col("_dead"), None).otherwise(F.col(c)).alias(c) if c == "link_id" else F.col(c)
          for c in target.columns]
    )
