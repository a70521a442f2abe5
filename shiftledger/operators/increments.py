"""Hours kept up from changes: signed sums of what a merge takes away and what it puts there.

A report over all entries is a sum per user, project, month and cycle (``usage_buckets``), so it changes by the
difference of the changed entries alone. Inserts, edits, moves between users, projects and days, deletes and revivals are all
the same here: the row before counts negative, the row after positive, and rows that do not count towards hours are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.functions import calendar as cal
from shiftledger.functions.durations import sum_duration
from shiftledger.model import DEFAULT_CYCLE_DAY, DEFAULT_TZ
from shiftledger.operators.aggregates import active_entries

KEYS = ["user_id", "project_id", "month", "cycle"]
#: What of an entry its hours depend on.
COUNTED = ["user_id", "project_id", "start_time", "duration_us", "deleted_at"]
BEFORE = "before"


def _sums(signed: DataFrame, tz: str, cycle_day: int) -> DataFrame:
    """Sums of entries with a ``sign``, reduced before the shuffle."""
    day = cal.local_date(F.col("start_time"), tz)
    placed = active_entries(signed).select(
        "user_id",
        "project_id",
        (F.col("duration_us") * F.col("sign")).alias("duration_us"),
        "sign",
        cal.month_start(day).alias("month"),
        cal.cycle_month(day, cycle_day).alias("cycle"),
    )
    return placed.groupBy(*KEYS).agg(*sum_duration(F.col("duration_us")), F.sum("sign").cast("long").alias("n"))


def usage_sums(entries: DataFrame, tz: str = DEFAULT_TZ, cycle_day: int = DEFAULT_CYCLE_DAY) -> DataFrame:
    """user_id, project_id, month, cycle, sum_s, sum_us and n (entries) from all entries."""
    return _sums(entries.select(*COUNTED, F.lit(1).alias("sign")), tz, cycle_day)


def changed_sums(changed: DataFrame, tz: str = DEFAULT_TZ, cycle_day: int = DEFAULT_CYCLE_DAY) -> DataFrame:
    """Signed sums of changed entries, whose state before is in the struct ``before`` (null: new)."""
    after = F.struct(*COUNTED, F.lit(1).alias("sign"))
    before = F.struct(*[F.col(f"{BEFORE}.{c}").alias(c) for c in COUNTED], F.lit(-1).alias("sign"))
    both = F.array_compact(F.array(after, F.when(F.col(BEFORE).isNotNull(), before)))
    return _sums(changed.select(F.inline(both)), tz, cycle_day).where("sum_s <> 0 or sum_us <> 0 or n <> 0")


def added(sums: list[DataFrame], drop_empty: bool = True) -> DataFrame:
    """Sums and signed sums added up; what no entry is left of goes, unless older sums are still to be added."""
    stacked = reduce(DataFrame.unionByName, sums)
    total = stacked.groupBy(*KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in ("sum_s", "sum_us", "n")])
    return total.where("n <> 0" if drop_empty else "sum_s <> 0 or sum_us <> 0 or n <> 0")
