"""Wall-clock time, months and payroll cycles.

A payroll cycle starts on ``cycle_day`` and ends the day before it in the next
month. Shifting a local date back by ``cycle_day - 1`` days turns cycles into
calendar months, so one ``trunc`` finds the cycle.
"""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftledger.model import INSTANT_PATTERN, MONTH_NAMES


def check_cycle_day(cycle_day: int) -> int:
    """Cycle days beyond 28 do not exist in every month."""
    if not 1 <= cycle_day <= 28:
        raise ValueError("cycle_day must be between 1 and 28")
    return cycle_day


def local_time(instant: Column, tz: str) -> Column:
    """Wall time in ``tz``, shown as such whatever the session zone is."""
    return F.to_utc_timestamp(F.from_utc_timestamp(instant, tz), F.current_timezone())


def local_date(instant: Column, tz: str) -> Column:
    """Calendar day in ``tz``."""
    return local_time(instant, tz).cast("date")


def month_start(day: Column) -> Column:
    """First day of the month."""
    return F.trunc(day, "MM")


def cycle_month(day: Column, cycle_day: int) -> Column:
    """First of the month in which the day's payroll cycle starts."""
    return F.trunc(F.date_sub(day, check_cycle_day(cycle_day) - 1), "MM")


def cycle_first_day(day: Column, cycle_day: int) -> Column:
    """First day of the payroll cycle holding the day."""
    return F.date_add(cycle_month(day, cycle_day), cycle_day - 1)


def cycle_end_day(day: Column, cycle_day: int) -> Column:
    """First day after the payroll cycle holding the day."""
    return F.date_add(F.add_months(cycle_month(day, cycle_day), 1), cycle_day - 1)


def local_midnight(day: Column, tz: str) -> Column:
    """Instant at which a calendar day starts in ``tz``."""
    wall = F.from_utc_timestamp(day.cast("timestamp"), F.current_timezone())
    return F.to_utc_timestamp(wall, tz)


def month_label(month: Column) -> Column:
    """'February 2026'."""
    return F.date_format(month, "MMMM yyyy")


def cycle_label(month: Column, cycle_day: int) -> Column:
    """'23 Jan to 22 Feb 2026' for the cycle that starts in ``month``."""
    first = F.date_add(month, cycle_day - 1)
    last = F.date_sub(F.add_months(month, 1), 2 - cycle_day)
    return F.concat(F.date_format(first, "d MMM"), F.lit(" to "), F.date_format(last, "d MMM yyyy"))


def month_label_to_date(label: Column) -> Column:
    """'February 2026' to '2026-02-01'; an unknown month name fails the query."""
    parts = F.split(label, " ")
    name = parts[0]
    number = F.array_position(F.array(*[F.lit(m) for m in MONTH_NAMES]), name)
    return F.when(
        number > 0,
        F.concat(F.try_element_at(parts, F.lit(2)), F.lit("-"), F.lpad(number.cast("string"), 2, "0"), F.lit("-01")),
    ).when(label.isNotNull(), F.raise_error(F.concat(F.lit("No such month: "), name)).cast("string"))


def iso_day(day: Column) -> Column:
    """'2026-02-01'."""
    return F.date_format(day, "yyyy-MM-dd")


# --- driver-side bounds -----------------------------------------------------
# Window bounds are worked out once per run and handed to the plan as literals,
# so they reach partition pruning and the Parquet filters.


def instant_literal(moment: datetime) -> Column:
    """Timestamp literal for an aware datetime, free of the session zone."""
    if moment.tzinfo is None:
        raise ValueError("instants must carry a time zone")
    micros = (moment - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def cycle_bounds(day: date, tz: str, cycle_day: int) -> tuple[datetime, datetime]:
    """Half-open [start, end) instants of the payroll cycle holding ``day``."""
    shifted = day - timedelta(days=check_cycle_day(cycle_day) - 1)
    first = date(shifted.year, shifted.month, cycle_day)
    after = date(first.year + first.month // 12, first.month % 12 + 1, cycle_day)
    zone = ZoneInfo(tz)

    def midnight(d: date) -> datetime:
        return datetime(d.year, d.month, d.day, tzinfo=zone).astimezone(UTC)

    return midnight(first), midnight(after)


def lookback_start(run_ts: datetime, window: timedelta) -> datetime:
    """Instant arithmetic: 24 hours per day, whatever clocks did meanwhile."""
    return run_ts.astimezone(UTC) - window


def parse_instant(text: Column) -> Column:
    """UTC instant from ISO text; null when it is not one (see INSTANT_PATTERN)."""
    # Seconds may be left out, which Spark's cast does not accept.
    with_seconds = F.when(F.length(text) == 17, F.concat(F.substring(text, 1, 16), F.lit(":00Z"))).otherwise(text)
    return F.when(text.rlike(INSTANT_PATTERN), with_seconds.try_cast("timestamp"))
