"""Constraints of the stored tables, checked and enforced as jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger import model

_TABLES = {
    "users": model.USERS,
    "clients": model.CLIENTS,
    "projects": model.PROJECTS,
    "entries": model.ENTRIES,
}


class IntegrityError(ValueError):
    """A write would break a constraint."""


def duplicate_keys(table: DataFrame, key: str = "source_id") -> DataFrame:
    """Key values held by more than one row."""
    return table.groupBy(key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Non-null references without a parent row."""
    refs = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    # One row per referenced id before the join: hot parents stay cheap.
    return refs.join(parent.select(F.col("id").alias(column)), column, "left_anti")


def _row_checks(name: str, table: DataFrame) -> DataFrame:
    """Null and uniqueness checks of one table from one pass, grouped by its key."""
    required = [f.name for f in _TABLES[name].fields if not f.nullable]
    nulls = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    keys = table.groupBy("source_id").agg(F.count("*").alias("rows"), F.count_if(nulls).alias("nulls"))
    counted = keys.agg(
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("not_null"), F.count_if(F.col("rows") > 1).alias("unique_source_id")
    )
    return _by_check(name, counted)


def _reference_checks(name: str, table: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Rows whose reference has no parent, for all reference columns from one pass.

    Rows are counted per combination of references before any join, so a hot parent is one row there.
    """
    refs = table.groupBy(*parents).agg(F.count("*").alias("rows"))
    broken = []
    for column, parent in parents.items():
        # Parents are made unique, lest one held twice counts rows twice.
        held = parent.select(F.col("id").alias(column)).distinct().withColumn(f"held_{column}", F.lit(True))
        refs = refs.join(held, column, "left")
        lost = F.col(column).isNotNull() & F.col(f"held_{column}").isNull()
        broken.append(F.coalesce(F.sum(F.when(lost, F.col("rows"))), F.lit(0)).alias(f"known_{column}"))
    return _by_check(name, refs.agg(*broken))


def _by_check(name: str, counted: DataFrame) -> DataFrame:
    """One row per column of the one-row ``counted``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("violations")) for c in counted.columns]))
    return counted.select(pairs.alias("p")).select(F.lit(name).alias("table"), "p.check", "p.violations")


def integrity_report(
    users: DataFrame, clients: DataFrame, projects: DataFrame, entries: DataFrame
) -> DataFrame:
    """Violations per (table, check); all zero when the tables are sound. Entries are read twice: by key and by reference."""
    tables = {"users": users, "clients": clients, "projects": projects, "entries": entries}
    parts = [_row_checks(name, df) for name, df in tables.items()]
    parts.append(_reference_checks("projects", projects, {"client_id": clients}))
    parts.append(_reference_checks("entries", entries, {"user_id": users, "project_id": projects}))
    return reduce(DataFrame.unionByName, parts)


def detach(child: DataFrame, removed: DataFrame, column: str) -> DataFrame:
    """Null references to removed parents (``removed.id``)."""
    gone = removed.select(F.col("id").alias(column)).distinct().withColumn("_gone", F.lit(True))
    return child.join(gone, column, "left").select(
        *[F.when(F.col("_gone"), None).otherwise(F.col(c)).alias(c) if c == column else F.col(c)
          for c in child.columns]
    )


def delete_clients(clients: DataFrame, projects: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove clients; their projects lose the client."""
    return clients.join(ids.select("id"), "id", "left_anti"), detach(projects, ids, "client_id")


def delete_projects(projects: DataFrame, entries: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove projects; their entries lose the project."""
    return projects.join(ids.select("id"), "id", "left_anti"), detach(entries, ids, "project_id")


def delete_users(users: DataFrame, entries: DataFrame, ids: DataFrame) -> DataFrame:
    """Remove users; refused while any entry belongs to one of them."""
    held = entries.select("user_id").join(ids.select(F.col("id").alias("user_id")), "user_id", "left_semi")
    if not held.isEmpty():
        raise IntegrityError("entries still belong to a user to be deleted")
    return users.join(ids.select("id"), "id", "left_anti")
