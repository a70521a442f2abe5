"""Tracker and roster extracts: JSON lines, each an object or an array of objects.

Line-delimited files split across tasks; an array on one line (an API page)
becomes one row per element. Schemas are explicit, so nothing is read twice.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger.functions.calendar import parse_instant
from shiftledger.functions.durations import is_iso_duration, parse_valid_duration

FAIL = "fail"
QUARANTINE = "quarantine"

CORRUPT = "_corrupt"


class Validated(NamedTuple):
    """Rows that passed, and rows that did not with their ``reasons``."""

    valid: DataFrame
    rejected: DataFrame


class ExtractRejected(ValueError):
    """A strict extract holds invalid rows."""


def validate(df: DataFrame, rules: dict[str, Column], mode: str = FAIL) -> Validated:
    """Check each row against named rules (true means fine, null counts as broken).

    ``fail``: the first broken row fails the query that reads ``valid``.
    ``quarantine``: broken rows move to ``rejected`` with the names of the rules.
    """
    if mode not in (FAIL, QUARANTINE):
        raise ValueError(f"Unknown validation mode: {mode}")
    reasons = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    )
    judged = df.withColumn("reasons", reasons)
    fine = F.size("reasons") == 0
    rejected = judged.where(~fine)
    if mode == QUARANTINE:
        return Validated(judged.where(fine).drop("reasons"), rejected)
    guard = F.when(fine, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("Invalid extract row: "), F.array_join("reasons", ", "))).cast("boolean")
    )
    return Validated(judged.where(guard).drop("reasons"), rejected)


def require_clean(rejected: DataFrame, what: str) -> None:
    """Fail a strict run before anything is written, naming rules and counts."""
    found = rejected.select(F.explode("reasons").alias("rule")).groupBy("rule").count().collect()
    if found:
        detail = ", ".join(sorted(f"{r['rule']}: {r['count']}" for r in found))
        raise ExtractRejected(f"{what} extract rejected ({detail})")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with an explicit schema; unreadable lines land in ``_corrupt``."""
    return (
        spark.read.schema(f"{schema}, {CORRUPT} STRING")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def _load(spark: SparkSession, path: str, schema: str, rules: dict[str, Column], mode: str) -> Validated:
    rules = {"json": F.col(CORRUPT).isNull(), **rules}
    checked = validate(read_json_lines(spark, path, schema), rules, mode)
    return Validated(checked.valid.drop(CORRUPT), checked.rejected)


def _optional(check: Column, value: Column) -> Column:
    return value.isNull() | check


# --- users, clients, projects ----------------------------------------------


def load_users(spark: SparkSession, path: str, mode: str = FAIL) -> Validated:
    """(source_id, name, email, status); the name falls back to the e-mail."""
    rules = {
        "id": F.col("id").isNotNull(),
        "email": _optional(F.col("email").rlike(model.EMAIL_PATTERN), F.col("email")),
    }
    checked = _load(spark, path, model.USER_EXTRACT, rules, mode)
    return Validated(shape_users(checked.valid), checked.rejected)


def shape_users(raw: DataFrame) -> DataFrame:
    """Defaults replace null only; an empty name is kept."""
    return raw.select(
        F.col("id").alias("source_id"),
        F.coalesce("name", "email", F.lit(model.UNKNOWN_USER)).alias("name"),
        "email",
        "status",
    )


def load_clients(spark: SparkSession, path: str, mode: str = FAIL) -> Validated:
    """(source_id, name)."""
    checked = _load(spark, path, model.CLIENT_EXTRACT, {"id": F.col("id").isNotNull()}, mode)
    return Validated(shape_clients(checked.valid), checked.rejected)


def shape_clients(raw: DataFrame) -> DataFrame:
    """Defaults replace null only."""
    return raw.select(F.col("id").alias("source_id"), F.coalesce("name", F.lit(model.UNKNOWN_CLIENT)).alias("name"))


def load_projects(spark: SparkSession, path: str, mode: str = FAIL) -> Validated:
    """(source_id, name, client_source_id)."""
    checked = _load(spark, path, model.PROJECT_EXTRACT, {"id": F.col("id").isNotNull()}, mode)
    return Validated(shape_projects(checked.valid), checked.rejected)


def shape_projects(raw: DataFrame) -> DataFrame:
    """Defaults replace null only; a project may lack a client."""
    return raw.select(
        F.col("id").alias("source_id"),
        F.coalesce("name", F.lit(model.UNKNOWN_PROJECT)).alias("name"),
        F.col("clientId").alias("client_source_id"),
    )


# --- entries ----------------------------------------------------------------


def entry_rules() -> dict[str, Column]:
    """What a nested time entry must satisfy.

    The rules test the texts by pattern and leave their parsing to the rows kept:
    a filter is planned below the projection, so what both need runs twice.
    """
    start, end, duration = (F.col(f"timeInterval.{x}") for x in ("start", "end", "duration"))
    return {
        "id": F.col("id").isNotNull(),
        "userId": F.col("userId").isNotNull(),
        "start": parse_instant(start).isNotNull(),
        "end": _optional(parse_instant(end).isNotNull(), end),
        "duration": _optional(is_iso_duration(duration), duration),
    }


def check_entries(
    raw: DataFrame, mode: str = FAIL, rules: dict[str, Column] | None = None, keep: tuple[str, ...] = ()
) -> Validated:
    """Nested entries as flat rows, durations in microseconds.

    ``rules`` are checked besides those of entries; ``keep`` names further
    columns to carry along.
    """
    checked = validate(raw, {**(rules or {}), **entry_rules()}, mode)
    interval = F.col("timeInterval")
    flat = checked.valid.select(
        F.col("id").alias("source_id"),
        "description",
        parse_instant(interval["start"]).alias("start_time"),
        parse_instant(interval["end"]).alias("end_time"),
        parse_valid_duration(interval["duration"]).alias("duration_us"),
        F.col("userId").alias("user_source_id"),
        F.col("projectId").alias("project_source_id"),
        *keep,
    )
    return Validated(flat, checked.rejected)


def load_time_entries(spark: SparkSession, path: str, mode: str = FAIL) -> Validated:
    """Time entries of an extract as flat rows."""
    raw = read_json_lines(spark, path, model.ENTRY_EXTRACT)
    return check_entries(raw, mode, {"json": F.col(CORRUPT).isNull()})


def split_failed_users(entries: Validated) -> DataFrame:
    """Users with at least one rejected entry (column ``user_source_id``); rejected rows may also name no user."""
    return entries.rejected.select(F.col("userId").alias("user_source_id")).distinct()


def rejected_ids(entries: Validated) -> DataFrame:
    """Ids that could be read in rejected rows (column ``source_id``): these entries are not gone."""
    return entries.rejected.where(F.col("id").isNotNull()).select(F.col("id").alias("source_id")).distinct()


# --- roster -----------------------------------------------------------------


def load_roster(
    spark: SparkSession, path: str, system_members: tuple[str, ...] = model.SYSTEM_MEMBER_IDS
) -> DataFrame:
    """(id, name, email, pos) of people; fails when the answer says it failed."""
    return shape_roster(read_json_lines(spark, path, model.ROSTER_EXTRACT), system_members)


def shape_roster(raw: DataFrame, system_members: tuple[str, ...] = model.SYSTEM_MEMBER_IDS) -> DataFrame:
    """Members of roster pages, without leavers, bots and system accounts.

    ``pos`` orders members as delivered: by page number where given, then by
    place within the page.
    """
    page = F.col("page") if "page" in raw.columns else F.lit(0)
    accepted = raw.where(
        F.when(F.coalesce("ok", F.lit(False)), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("Roster error: "), F.coalesce("error", F.lit("unreadable")))).cast("boolean")
        )
    )
    members = accepted.select(page.cast("bigint").alias("_page"), F.posexplode("members").alias("_at", "m"))
    unwanted = reduce(
        lambda a, b: a | b,
        [F.coalesce("m.deleted", F.lit(False)), F.coalesce("m.is_bot", F.lit(False)),
         F.col("m.id").isin(*system_members)],
    )
    return members.where(~unwanted).select(
        F.col("m.id").alias("id"),
        F.coalesce("m.real_name", "m.name").alias("name"),
        F.col("m.profile.email").alias("email"),
        F.struct("_page", "_at").alias("pos"),
    )
