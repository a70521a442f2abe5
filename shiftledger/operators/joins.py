"""Joins whose keys may be held by any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are joined apart. Each key beyond them holds at most one in ``HOT_KEYS`` of the rows.
HOT_KEYS = 1000


def lookup(rows: DataFrame, table: DataFrame, key: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row per ``key``), without meeting a frequent or a null key in one task.

    The ``hot_keys`` most frequent keys are found from counts; their rows of the table, ``hot_keys`` at most, are broadcast, so
    rows with these keys are not shuffled. Rows without a key go around the join. The rest is joined as Spark
    sees fit. ``rows`` is read four times: hand a stored table, or one that is cheap to compute.

    A key that ``table`` does not have gives nulls; a null key in ``table`` is never met; both may be empty.
    """
    known = rows.where(F.col(key).isNotNull())
    counts = known.groupBy(key).agg(F.count("*").alias("_times"))
    hot = F.broadcast(counts.orderBy(F.desc("_times"), key).limit(hot_keys).select(key))
    hot_table = F.broadcast(table.join(hot, key, "left_semi"))
    columns = [*rows.columns, *(c for c in table.columns if c != key)]
    often = known.join(hot, key, "left_semi").join(hot_table, key, "left")
    rest = known.join(hot, key, "left_anti").join(table, key, "left")
    missing = [F.lit(None).cast(table.schema[c].dataType).alias(c) for c in table.columns if c != key]
    without = rows.where(F.col(key).isNull()).select(*rows.columns, *missing)
    return often.select(*columns).unionByName(rest.select(*columns)).unionByName(without)
