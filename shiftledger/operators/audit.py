"""A long look-back as an audit: compare checksums first, rows only where they differ.

Per user and day, stored live rows of the window and the extract's rows are reduced to a count and order-free sums of row hashes.
In most nights most groups agree, and their rows go no further. The rest is merged as ``merge_window`` does. What changes is
the same; rows that did not change are not stamped, as nobody looked at them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.functions.calendar import local_date
from shiftledger.operators.upsert import ENTRY_COLUMNS
from shiftledger.operators.window_sync import merge_window
from shiftledger.operators.windows import within

GROUP = ["user_id", "day"]
_CONTENT = ["source_id", *[c for c in ENTRY_COLUMNS if c != "deleted_at"]]


def _with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", local_date(F.col("start_time"), "UTC"))


def checksums(rows: DataFrame) -> DataFrame:
    """user_id, day, n, mixed and total: equal for equal sets of rows, whatever their order; summed before the shuffle."""
    hashed = _with_day(rows).select(*GROUP, F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in _CONTENT]).alias("h"))
    # Two sums of different bits: a pair of equal changes can't cancel out in both.
    return hashed.groupBy(*GROUP).agg(
        F.count("*").alias("n"), F.bit_xor("h").alias("mixed"), F.sum(F.shiftrightunsigned("h", 33)).alias("total")
    )


def differing_groups(entries: DataFrame, resolved: DataFrame, start: datetime) -> DataFrame:
    """(user_id, day) whose live stored rows from ``start`` on are not those of the extract."""
    stored = checksums(within(entries, start).where(F.col("deleted_at").isNull()))
    found = checksums(within(resolved, start).where(F.col("user_id").isNotNull()))
    theirs = found.select(*GROUP, *[F.col(c).alias(f"_{c}") for c in ("n", "mixed", "total")])
    joined = stored.join(theirs, GROUP, "full")
    same = F.col("n").eqNullSafe(F.col("_n")) & F.col("mixed").eqNullSafe(F.col("_mixed")) & F.col("total").eqNullSafe(F.col("_total"))
    return joined.where(~same).select(*GROUP)


def audit_window(
    entries: DataFrame, resolved: DataFrame, scanned_users: DataFrame, start: datetime, run_ts: datetime, groups: DataFrame | None = None
) -> DataFrame:
    """The changed rows of a window sync with the columns of ``merge_window``; only rows of differing groups are compared.

    ``resolved`` has one row per id. ``groups`` are the differing groups if they are known (a job stages them).
    """
    groups = differing_groups(entries, resolved, start) if groups is None else groups
    extract = within(resolved, start)
    met = _with_day(extract).join(groups, GROUP, "left_semi").drop("day")
    # Rows of unknown users change nothing, but what they name isn't gone.
    incoming = met.unionByName(extract.where(F.col("user_id").isNull()))
    # Stored rows of these groups, and rows stored elsewhere whose ids come in there: entries that have moved.
    within_groups = _with_day(entries).join(groups.withColumn("_met", F.lit(True)), GROUP, "left").drop("day")
    named = within_groups.join(incoming.select("source_id", F.lit(True).alias("_named")), "source_id", "left")
    target = named.where("_met or _named").select(*entries.columns)
    return merge_window(target, incoming, scanned_users, start, run_ts).merged.where("sync_changed")
