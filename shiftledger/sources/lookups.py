"""Point and list lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def users_by_source_id(users: DataFrame, source_id: str | None = None) -> DataFrame:
    """All users, or the one with the source id."""
    picked = users.select("id", "source_id", "name", "email", "chat_id")
    return picked if source_id is None else picked.where(F.col("source_id") == source_id)


def rows_in(table: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``column`` occurs in ``wanted.<column>``; any list length."""
    return table.join(wanted.select(column), column, "left_semi")
