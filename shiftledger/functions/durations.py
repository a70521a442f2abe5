"""Durations as whole microseconds, and hours rounded to two places.

Sums are kept as two long columns, whole seconds and left-over microseconds:
plain long additions in the hash aggregate, and no overflow until a single
group holds some 10^15 rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Signs are allowed on every part, a fraction on the seconds.
_DURATION = (
    r"^P(?!$)(-?\d+W)?(-?\d+D)?"
    r"(T(?=[-\d])(-?\d+H)?(-?\d+M)?(-?\d+(\.\d+)?S)?)?$"
)
# Numbers too long for the quick path, which reads the time part as an interval.
_LONG = r"\d{10,}|\.\d{7,}|\d{7,}[WD]"
# A number and its unit. Of a fraction seven digits matter: the seventh decides how the sixth is rounded.
_PARTS = r"(-?\d+(?:\.\d{1,7})?)\d*([WDHMS])"
_UNIT_SECONDS = (("W", 604_800), ("D", 86_400), ("H", 3600), ("M", 60), ("S", 1))
US_PER_SECOND = 1_000_000
US_PER_HOUR = 3_600_000_000
_US_PER_DAY = 86_400_000_000


def is_iso_duration(text: Column) -> Column:
    """True for ISO-8601 durations of fixed length whose microseconds fit a BIGINT.

    Years and months are refused: they have no fixed number of seconds.
    """
    return text.rlike(_DURATION) & (~text.rlike(_LONG) | _exact_us(text).isNotNull())


def _exact_us(text: Column) -> Column:
    """Microseconds by decimal arithmetic, rounded once, halves away from zero; null beyond a BIGINT.

    One expression over the parts, whatever units there are: rare texts need it, and written out per unit it would bloat the
    code that every row runs through.
    """

    def seconds(number: Column, unit: Column) -> Column:
        each = F.lit(None).cast("int")
        for letter, length in _UNIT_SECONDS:
            each = F.when(unit == letter, length).otherwise(each)
        return F.try_multiply(number.try_cast("decimal(28,7)"), each.cast("decimal(6,0)")).cast("decimal(38,7)")

    parts = F.zip_with(
        F.regexp_extract_all(text, F.lit(_PARTS), F.lit(1)), F.regexp_extract_all(text, F.lit(_PARTS), F.lit(2)), seconds
    )
    total = F.aggregate(parts, F.lit(0).cast("decimal(38,7)"), lambda sum_, part: F.try_add(sum_, part).cast("decimal(38,7)"))
    return F.try_multiply(F.round(total, 6), F.lit(US_PER_SECOND)).try_cast("bigint")


def parse_iso_duration(text: Column) -> Column:
    """Microseconds of an ISO-8601 duration; null for null or malformed text."""
    return F.when(is_iso_duration(text), parse_valid_duration(text))


def parse_valid_duration(text: Column) -> Column:
    """Microseconds of text that :func:`is_iso_duration` accepts, without asking again.

    The time part is read by Spark's own interval cast, which wants words for the unit letters; adding it to the epoch gives
    its microseconds. Weeks and days are rare and looked for only where present.
    """
    words = F.substring_index(text, "T", -1)
    for letter, word in (("H", " hours "), ("M", " minutes "), ("S", " seconds ")):
        words = F.replace(words, F.lit(letter), F.lit(word))
    time_us = F.unix_micros(F.timestamp_micros(F.lit(0)) + words.try_cast("interval"))

    def count(unit: str) -> Column:
        found = F.nullif(F.regexp_extract(text, rf"(-?\d+){unit}", 1), F.lit(""))
        return F.coalesce(found.cast("bigint"), F.lit(0))

    days_us = (count("W") * 7 + count("D")) * _US_PER_DAY
    quick = F.when(text.contains("T"), time_us).otherwise(0) + F.when(text.contains("D") | text.contains("W"), days_us).otherwise(0)
    return F.when(text.rlike(_LONG), _exact_us(text)).when(text.isNotNull(), quick)


def iso_duration_us(text: Column) -> Column:
    """Like :func:`parse_iso_duration`, but malformed text fails the query."""
    return F.when(
        text.isNull() | is_iso_duration(text), parse_iso_duration(text)
    ).otherwise(F.raise_error(F.concat(F.lit("Malformed duration: "), text)).cast("bigint"))


def sum_duration(duration_us: Column) -> list[Column]:
    """Aggregates ``sum_s`` and ``sum_us`` of a microsecond column."""
    whole = _div(duration_us, US_PER_SECOND)
    return [
        F.sum(whole).alias("sum_s"),
        F.sum(duration_us - whole * F.lit(US_PER_SECOND)).alias("sum_us"),
    ]


def resum_duration() -> list[Column]:
    """Combine already summed ``sum_s`` / ``sum_us`` pairs."""
    return [F.sum("sum_s").alias("sum_s"), F.sum("sum_us").alias("sum_us")]


def is_positive(sum_s: Column, sum_us: Column) -> Column:
    """Whether a summed pair is more than nothing."""
    seconds, rest = _normalised(sum_s, sum_us)
    return (seconds > 0) | ((seconds == 0) & (rest > 0))


def hours_2dp(sum_s: Column, sum_us: Column) -> Column:
    """Hours of a summed pair as DECIMAL(20,2), halves rounded away from zero.

    Whole-number steps on longs: no intermediate scale that could round a second
    time, and no wide decimals.
    """
    seconds, rest = _normalised(sum_s, sum_us)
    # A hundredth of an hour is 36 seconds.
    left = F.pmod(seconds, F.lit(36))
    tie = F.lit(18 * US_PER_SECOND) - F.when(seconds < 0, 1).otherwise(0)
    rounded = _div(left * US_PER_SECOND + rest + tie, 36 * US_PER_SECOND)
    cents = _div(seconds - left, 36) + rounded
    return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(20,2)")


def entry_hours_2dp(duration_us: Column) -> Column:
    """Hours of a single duration."""
    return hours_2dp(F.lit(0).cast("bigint"), duration_us)


def _normalised(sum_s: Column, sum_us: Column) -> tuple[Column, Column]:
    """The same amount with 0 to 999999 left-over microseconds."""
    rest = F.pmod(sum_us, F.lit(US_PER_SECOND))
    return sum_s + _div(sum_us - rest, US_PER_SECOND), rest


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by))
