"""Time windows over stored or extracted entries."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.functions.calendar import instant_literal, local_date

PARTITION = "start_day"


def with_partition(entries: DataFrame) -> DataFrame:
    """Add the storage partition: the UTC day of the start."""
    return entries.withColumn(PARTITION, local_date(F.col("start_time"), "UTC"))


def within(entries: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Entries with start in the half-open window [start, end).

    On stored entries the bounds also apply to the partition column, so days
    outside the window are not even listed.
    """
    partitioned = PARTITION in entries.columns
    if start is not None:
        entries = entries.where(F.col("start_time") >= instant_literal(start))
        if partitioned:
            entries = entries.where(F.col(PARTITION) >= F.lit(start.astimezone(UTC).date()))
    if end is not None:
        entries = entries.where(F.col("start_time") < instant_literal(end))
        if partitioned:
            entries = entries.where(F.col(PARTITION) <= F.lit(end.astimezone(UTC).date()))
    return entries


def user_window(
    entries: DataFrame, scanned_users: DataFrame, start: datetime, end: datetime | None = None
) -> DataFrame:
    """Entries of the scanned users (column ``user_id``) within the window."""
    return within(entries, start, end).join(scanned_users.select("user_id").distinct(), "user_id", "left_semi")
