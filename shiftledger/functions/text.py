"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftledger.model import WHITESPACE


def trim_all(text: Column) -> Column:
    """Trim every Unicode blank, not only spaces."""
    return F.btrim(text, F.lit(WHITESPACE))


def normalise_name(text: Column) -> Column:
    """Name as compared across systems: trimmed and lower-cased."""
    return F.lower(trim_all(text))


def blank_to_null(text: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(trim_all(text), F.lit(""))


def empty_to_null(text: Column) -> Column:
    """Null only for the empty string; blanks are kept."""
    return F.nullif(text, F.lit(""))


def is_filled(text: Column) -> Column:
    """True for non-null, non-empty text."""
    return F.coalesce(text != "", F.lit(False))


def number_text(value: Column) -> Column:
    """Shortest decimal text of a 2-place number: 2, 1.5, 0.25."""
    fixed = value.cast("decimal(22,2)").cast("string")
    return F.rtrim(F.rtrim(fixed, F.lit("0")), F.lit("."))


def first_word(text: Column) -> Column:
    """Text up to the first space."""
    return F.split(text, " ", 2)[0]


def stable_id(*parts: Column) -> Column:
    """Replayable surrogate key: the same natural key always gives the same id."""
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def record_id(*parts: Column) -> Column:
    """Replayable id in the destination's format: ``rec`` and 14 alphanumerics."""
    digest = stable_id(*parts)
    head = F.lpad(F.lower(F.conv(F.substring(digest, 1, 16), 16, 36)), 13, "0")
    return F.concat(F.lit("rec"), head, F.substring(digest, 17, 1))


def hash_slot(text: Column, slots: Column) -> Column:
    """Slot 0..slots-1 of a text, evenly spread and the same on every run and engine."""
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, slots.cast("bigint")).cast("int")
