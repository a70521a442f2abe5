"""Hours per person and project, by calendar month and by payroll cycle."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.functions import calendar as cal
from shiftledger.functions.durations import (
    entry_hours_2dp,
    hours_2dp,
    is_positive,
    resum_duration,
    sum_duration,
)
from shiftledger.functions.text import is_filled
from shiftledger.model import (
    DEFAULT_CYCLE_DAY,
    DEFAULT_TZ,
    NO_DESCRIPTION,
    SENTINEL_NAME,
    SENTINEL_SOURCE_ID,
)
from shiftledger.operators.windows import within



def is_active() -> Column:
    """Not deleted, and not a timer still running."""
    return F.col("deleted_at").isNull() & F.col("duration_us").isNotNull()


def active_entries(entries: DataFrame) -> DataFrame:
    """Entries that count towards hours."""
    return entries.where(is_active())


def usage_buckets(
    entries: DataFrame,
    tz: str = DEFAULT_TZ,
    cycle_day: int = DEFAULT_CYCLE_DAY,
    buckets: tuple[str, ...] = ("month", "cycle"),
) -> DataFrame:
    """Seconds per user, project and bucket: the one pass over the entries.

    Aggregating on raw keys before any join lets map-side combining absorb hot
    users and the hot "no project" key, and leaves the joins a small input.
    With both buckets one scan feeds the monthly and the payroll report.
    """
    day = cal.local_date(F.col("start_time"), tz)
    columns = {
        "month": cal.month_start(day),
        "cycle": cal.cycle_month(day, cycle_day),
    }
    return (
        active_entries(entries)
        .select("user_id", "project_id", "duration_us", *[columns[b].alias(b) for b in buckets])
        .groupBy("user_id", "project_id", *buckets)
        .agg(*sum_duration(F.col("duration_us")))
    )


def roll_up(buckets: DataFrame, users: DataFrame, projects: DataFrame, bucket: str, label: Column) -> DataFrame:
    """Report rows of one bucket kind.

    Groups by the *raw* link and name and fills in defaults only afterwards: a
    null project, the sentinel and an unlinked project stay separate rows even
    where their shown link is the same. ``raw_project_link`` keeps the undefaulted
    link, which orders such rows.

    The rows are one per user, project and bucket by now, so combining them on the map side would hold most of them in a second
    table beside the first. They are dealt at once into the session's number of partitions, which adaptive planning, that goes by
    compressed bytes, does not merge again.
    """
    named_users = users.select(
        F.col("id").alias("user_id"), F.col("link_id").alias("user_link"), F.col("name").alias("user_name")
    )
    named_projects = projects.select(
        F.col("id").alias("project_id"),
        F.col("link_id").alias("raw_project_link"),
        F.col("name").alias("raw_project_name"),
    )
    # One value, computed once and used as a scalar: no join needed.
    sentinel_link = (
        projects.where(F.col("source_id") == SENTINEL_SOURCE_ID).agg(F.max("link_id")).scalar()
    )
    keys = ["user_link", "user_name", "raw_project_link", "raw_project_name", bucket]
    named = buckets.join(named_users, "user_id").join(named_projects, "project_id", "left")
    partitions = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        named.select(*keys, "sum_s", "sum_us")
        .repartition(partitions, *keys)
        .groupBy(*keys)
        .agg(*resum_duration())
        .select(
            "user_link",
            "user_name",
            F.coalesce("raw_project_link", sentinel_link).alias("project_link"),
            F.coalesce("raw_project_name", F.lit(SENTINEL_NAME)).alias("project_name"),
            label.alias("month"),
            hours_2dp(F.col("sum_s"), F.col("sum_us")).alias("total_hours"),
            "raw_project_link",
        )
    )


def monthly_from(buckets: DataFrame, users: DataFrame, projects: DataFrame) -> DataFrame:
    """Monthly report rows from :func:`usage_buckets`."""
    return roll_up(buckets, users, projects, "month", cal.month_label(F.col("month")))


def payroll_from(
    buckets: DataFrame, users: DataFrame, projects: DataFrame, cycle_day: int = DEFAULT_CYCLE_DAY
) -> DataFrame:
    """Payroll report rows from :func:`usage_buckets`."""
    return roll_up(buckets, users, projects, "cycle", cal.cycle_label(F.col("cycle"), cycle_day))


def monthly_hours(entries: DataFrame, users: DataFrame, projects: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Hours by local calendar month."""
    return monthly_from(usage_buckets(entries, tz, buckets=("month",)), users, projects)


def payroll_hours(
    entries: DataFrame,
    users: DataFrame,
    projects: DataFrame,
    tz: str = DEFAULT_TZ,
    cycle_day: int = DEFAULT_CYCLE_DAY,
) -> DataFrame:
    """Hours by local payroll cycle."""
    return payroll_from(
        usage_buckets(entries, tz, cycle_day, buckets=("cycle",)), users, projects, cycle_day
    )


def active_names(monthly: DataFrame, payroll: DataFrame) -> DataFrame:
    """Distinct non-empty user and project names of both reports: (kind, name)."""
    names = ["user_name", "project_name"]
    # Each report is reduced to distinct name pairs before the two are stacked.
    return _distinct_names(monthly.select(names).distinct().unionByName(payroll.select(names).distinct()))


def active_names_of(pairs: DataFrame, users: DataFrame, projects: DataFrame) -> DataFrame:
    """The same names straight from the entries (or from :func:`usage_buckets`).

    Both reports cover the same active entries, so their names are those of the
    distinct (user, project) pairs; no bucketing and only one pass is needed.
    """
    if "duration_us" in pairs.columns:
        pairs = active_entries(pairs)
    named = (
        pairs.select("user_id", "project_id")
        .distinct()
        .join(users.select(F.col("id").alias("user_id"), F.col("name").alias("user_name")), "user_id")
        .join(
            projects.select(F.col("id").alias("project_id"), F.col("name").alias("project_name")),
            "project_id",
            "left",
        )
    )
    return _distinct_names(
        named.select("user_name", F.coalesce("project_name", F.lit(SENTINEL_NAME)).alias("project_name"))
    )


def _distinct_names(pairs: DataFrame) -> DataFrame:
    stacked = pairs.select(
        F.explode(
            F.array(
                F.struct(F.lit("user").alias("kind"), F.col("user_name").alias("name")),
                F.struct(F.lit("project").alias("kind"), F.col("project_name").alias("name")),
            )
        ).alias("n")
    ).select("n.kind", "n.name")
    return stacked.where(is_filled(F.col("name"))).distinct()


def names_of(names: DataFrame, kind: str) -> DataFrame:
    """One kind of :func:`active_names`, as a single ``name`` column."""
    return names.where(F.col("kind") == kind).select("name")


# --- time without a project -------------------------------------------------


def unassigned_rows(
    entries: DataFrame,
    projects: DataFrame,
    day: date,
    tz: str = DEFAULT_TZ,
    cycle_day: int = DEFAULT_CYCLE_DAY,
) -> DataFrame:
    """Active entries of the cycle holding ``day`` with no project or the sentinel.

    The bounds are literals, so the scan prunes to the cycle.
    """
    first, after = cal.cycle_bounds(day, tz, cycle_day)
    in_cycle = active_entries(within(entries, first, after))
    sentinel_id = projects.where(F.col("source_id") == SENTINEL_SOURCE_ID).agg(F.max("id")).scalar()
    return in_cycle.where(F.col("project_id").isNull() | (F.col("project_id") == sentinel_id)).select(
        "source_id",
        "user_id",
        "duration_us",
        cal.iso_day(cal.local_date(F.col("start_time"), tz)).alias("date"),
        F.coalesce("description", F.lit(NO_DESCRIPTION)).alias("description"),
        entry_hours_2dp(F.col("duration_us")).alias("duration_hours"),
    )


def unassigned_totals(rows: DataFrame) -> DataFrame:
    """Per-user sums and entry counts of :func:`unassigned_rows`, positive sums only."""
    totals = rows.groupBy("user_id").agg(*sum_duration(F.col("duration_us")), F.count("*").alias("entry_count"))
    return totals.where(is_positive(F.col("sum_s"), F.col("sum_us")))


def unassigned_hours(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Who logged how much time without a project."""
    people = users.select(
        F.col("id").alias("user_id"),
        F.col("name").alias("user_name"),
        F.col("email").alias("user_email"),
        "chat_id",
    )
    return (
        unassigned_totals(rows)
        .join(people, "user_id")
        .select(
            "user_id",
            "user_name",
            "user_email",
            "chat_id",
            hours_2dp(F.col("sum_s"), F.col("sum_us")).alias("unassigned_hours"),
            "entry_count",
        )
    )


def unassigned_time(
    entries: DataFrame,
    users: DataFrame,
    projects: DataFrame,
    day: date,
    tz: str = DEFAULT_TZ,
    cycle_day: int = DEFAULT_CYCLE_DAY,
) -> DataFrame:
    """Who logged time without a project in the cycle: one row per entry, with the person's total.

    Put in order by (user_id, date, source_id); nothing is collected, however many entries a person has.
    """
    rows = unassigned_rows(entries, projects, day, tz, cycle_day)
    listed = rows.select("user_id", "source_id", "date", "description", "duration_hours")
    return unassigned_hours(rows, users).join(listed, "user_id")


def entry_json(rows: DataFrame) -> DataFrame:
    """Add ``item``: date, description and hours of an entry as JSON text."""
    return rows.withColumn(
        "item", F.to_json(F.struct("date", "description", F.col("duration_hours").alias("hours")))
    )
