"""Linking stored reference rows to destination records by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.functions.calendar import month_label_to_date
from shiftledger.functions.text import empty_to_null, normalise_name, record_id, trim_all
from shiftledger.model import (
    FIELD_COMMITMENT_HOURS,
    FIELD_HOURS_TO_BE_PAID,
    FIELD_ORIGINAL_INVOICE_AMOUNT,
)
from shiftledger.operators.upsert import set_column

CONFLICT = "conflict"
HEAL = "heal"
CREATE = "create"


def name_state(records: DataFrame) -> DataFrame:
    """Destination records (id, name) by normalised name.

    ``link_id`` is set for names of exactly one record; two or more records
    make the name a conflict.
    """
    return (
        records.groupBy(normalise_name(F.col("name")).alias("norm"))
        .agg(F.count("*").alias("records"), F.min("id").alias("_id"))
        .select(
            "norm",
            "records",
            F.when(F.col("records") == 1, F.col("_id")).alias("link_id"),
            (F.col("records") > 1).alias("conflicted"),
        )
    )


def missing_by_name(table: DataFrame, names: DataFrame) -> DataFrame:
    """Rows without a link (null only) whose exact name is in ``names``."""
    return (
        table.where(F.col("link_id").isNull())
        .select("id", "name")
        .join(names.select("name"), "name", "left_semi")
        .select("id", "name")
    )


def active_projects(projects: DataFrame, names: DataFrame) -> DataFrame:
    """Projects whose exact name is in ``names``."""
    return projects.select("id", "name", "client_id", "link_id").join(names.select("name"), "name", "left_semi")


def missing_projects(projects: DataFrame, names: DataFrame) -> DataFrame:
    """Active projects without a link; an empty link counts as none."""
    unlinked = projects.where(F.coalesce("link_id", F.lit("")) == "")
    return active_projects(unlinked, names).select("id", "name")


def missing_clients(projects: DataFrame, clients: DataFrame, names: DataFrame) -> DataFrame:
    """Unlinked (null) clients of any active project, linked or not."""
    used = active_projects(projects, names).select(F.col("client_id").alias("id"))
    return (
        clients.where(F.col("link_id").isNull()).select("id", "name").join(used, "id", "left_semi")
    )


def resolve_links(missing: DataFrame, records: DataFrame) -> DataFrame:
    """What to do for each missing row: (id, name, action, link_id).

    conflict: several records carry the name, nothing is written. heal: one
    record does, its id is linked. create: none does; ``link_id`` is null until
    the destination (or :func:`with_created_ids`) supplies it. Two missing rows
    of one normalised name both create.
    """
    return missing.withColumn("norm", normalise_name(F.col("name"))).join(
        name_state(records), "norm", "left"
    ).select(
        "id",
        "name",
        F.when(F.col("conflicted"), CONFLICT)
        .when(empty_to_null(F.col("link_id")).isNotNull(), HEAL)
        .otherwise(CREATE)
        .alias("action"),
        empty_to_null(F.col("link_id")).alias("link_id"),
    )


def with_created_ids(resolved: DataFrame, scope: str) -> DataFrame:
    """Give rows to be created a replayable record id, unique per table (``scope``)."""
    return resolved.withColumn(
        "link_id",
        F.when(F.col("action") == CREATE, record_id(F.lit(scope), F.col("id"))).otherwise(F.col("link_id")),
    )


def with_given_ids(resolved: DataFrame, receipts: DataFrame) -> DataFrame:
    """Links of rows to be created are the ids that the destination gave them (``id``, ``given_id``)."""
    given = receipts.select("id", "given_id")
    link = F.when(F.col("action") == CREATE, F.col("given_id")).otherwise(F.col("link_id"))
    return resolved.join(given, "id", "left").withColumn("link_id", link).drop("given_id")


def write_back(table: DataFrame, resolved: DataFrame) -> DataFrame:
    """Store healed and created links."""
    links = resolved.where(F.col("link_id").isNotNull()).select("id", F.col("link_id").alias("value"))
    return set_column(table, links, "id", "link_id")


# --- project assignments ----------------------------------------------------


def assignment_index(cells: DataFrame) -> DataFrame:
    """(project_link, month_date) to the id of its last record.

    ``cells`` has (id, pos, project_link, month). Records without project or
    month are left out. A grouped ``max_by`` pre-aggregates, so many records of
    one key never meet in one task.
    """
    usable = cells.where((F.coalesce("project_link", F.lit("")) != "") & (F.coalesce("month", F.lit("")) != ""))
    return usable.groupBy("project_link", F.col("month").alias("month_date")).agg(
        F.max_by("id", F.struct("pos", "id")).alias("assignment_id")
    )


def source_assignments(source: DataFrame) -> DataFrame:
    """Distinct (project_link, month_date) of monthly rows.

    Only an empty link is left out: blanks are trimmed after that test.
    """
    return (
        source.where(F.coalesce("project_link", F.lit("")) != "")
        .select(trim_all(F.col("project_link")).alias("project_link"), "month")
        .distinct()
        .select("project_link", month_label_to_date(F.col("month")).alias("month_date"))
    )


def missing_assignments(source: DataFrame, index: DataFrame) -> DataFrame:
    """Source pairs the index lacks."""
    keys = ["project_link", "month_date"]
    return source_assignments(source).join(index.select(keys), keys, "left_anti")


def new_assignment_rows(missing: DataFrame) -> DataFrame:
    """Rows to create: the pair, a replayable id and three zero defaults."""
    zero = F.lit(0.0)
    return missing.select(
        record_id(F.lit("assignment"), F.col("project_link"), F.col("month_date")).alias("assignment_id"),
        "project_link",
        "month_date",
        zero.alias(_column(FIELD_COMMITMENT_HOURS)),
        zero.alias(_column(FIELD_HOURS_TO_BE_PAID)),
        zero.alias(_column(FIELD_ORIGINAL_INVOICE_AMOUNT)),
    )


def with_given_assignments(rows: DataFrame) -> DataFrame:
    """New assignment rows with the ids that the destination gave them (``given_id``) for those of one's own."""
    return rows.withColumn("assignment_id", F.col("given_id")).drop("given_id")


def complete_assignments(index: DataFrame, created: DataFrame) -> DataFrame:
    """Index including the newly created assignments."""
    keys = ["project_link", "month_date", "assignment_id"]
    return index.select(keys).unionByName(created.select(keys))


def _column(field: str) -> str:
    return field.lower().replace(" ", "_")


def conflict_alerts(resolved: DataFrame) -> DataFrame:
    """Names somebody has to sort out in the destination."""
    return resolved.where(F.col("action") == CONFLICT).select("id", "name")
