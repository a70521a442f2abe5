"""Matching people to the chat roster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.functions.text import (
    blank_to_null,
    empty_to_null,
    first_word,
    normalise_name,
    number_text,
)


def match_identity(people: DataFrame, roster: DataFrame) -> DataFrame:
    """Adds ``matched_chat_id`` and ``matched_by`` to people (name, email, chat_id).

    A cached chat id wins, then the exact e-mail, then the exact name, both
    trimmed and lower-cased; of several members the first by ``pos`` wins. The
    roster is reduced to one member per e-mail and per name, so a join never
    multiplies rows.
    """
    first = F.min_by("id", F.struct("pos", "id"))
    by_email = (
        roster.where(F.col("email").isNotNull())
        .groupBy(normalise_name(F.col("email")).alias("_email"))
        .agg(first.alias("_by_email"))
    )
    by_name = roster.groupBy(normalise_name(F.col("name")).alias("_name")).agg(first.alias("_by_name"))
    cached = empty_to_null(F.col("chat_id"))
    return (
        people.withColumn("_email", F.lower(blank_to_null(F.col("user_email"))))
        .withColumn("_name", normalise_name(F.col("user_name")))
        .join(by_email, "_email", "left")
        .join(by_name, "_name", "left")
        .select(
            *people.columns,
            F.coalesce(cached, F.col("_by_email"), F.col("_by_name")).alias("matched_chat_id"),
            F.when(cached.isNotNull(), "cache")
            .when(F.col("_by_email").isNotNull(), "email")
            .when(F.col("_by_name").isNotNull(), "name")
            .alias("matched_by"),
        )
    )


def discovered_ids(matched: DataFrame) -> DataFrame:
    """(id, value) of matches that were not cached yet, for ``set_column``."""
    return matched.where(
        empty_to_null(F.col("chat_id")).isNull() & F.col("matched_chat_id").isNotNull()
    ).select(F.col("user_id").alias("id"), F.col("matched_chat_id").alias("value")).distinct()


def unmatched_people(matched: DataFrame) -> DataFrame:
    """People without any chat id."""
    return matched.where(F.col("matched_chat_id").isNull()).select("user_id", "user_name", "user_email")


def matched_count(matched: DataFrame) -> DataFrame:
    """One row: total, unmatched and matched people."""
    return matched.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("matched_chat_id").isNull()).alias("unmatched"),
        F.count_if(F.col("matched_chat_id").isNotNull()).alias("matched"),
    )


def nudge_rows(matched: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per matched person and entry; rows of a ``chat_id`` in order of (date, source_id) make a message.

    ``matched`` has one row per person with ``unassigned_hours``; ``entries`` has user_id, source_id, date, description and
    duration_hours.
    """
    text = F.concat_ws(" ", "date", F.concat(number_text(F.col("duration_hours")), F.lit("h")), "description")
    return (
        matched.where(F.col("matched_chat_id").isNotNull())
        .join(entries, "user_id")
        .select(
            F.col("matched_chat_id").alias("chat_id"),
            "user_id",
            first_word(F.col("user_name")).alias("first_name"),
            number_text(F.col("unassigned_hours")).alias("hours"),
            "date",
            "source_id",
            text.alias("text"),
        )
    )
