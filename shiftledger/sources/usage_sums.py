"""Stored hours by user, project, month and cycle, kept up by what each publish changes.

A publish adds one part of signed sums; the sums of all parts are those of the entries. Reports read these few rows and no entry.
Sums are kept for the library's own zone and cycle day.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from shiftledger.operators import increments
from shiftledger.sources.parts import Part, to_merge

_SCHEMA = "user_id STRING, project_id STRING, month DATE, cycle DATE, sum_s LONG, sum_us LONG, n LONG"


def _stacked(spark: SparkSession, root: str, parts: list[Part]) -> list[DataFrame]:
    reader = spark.read.schema(_SCHEMA)
    return [reader.parquet(f"{root}/part={p.version}") for p in parts]


def read(spark: SparkSession, root: str, parts: list[Part]) -> DataFrame:
    """The sums as of these parts."""
    return increments.added(_stacked(spark, root, parts)) if parts else spark.createDataFrame([], _SCHEMA)


def add(spark: SparkSession, root: str, parts: list[Part], changes: DataFrame) -> list[Part]:
    """Write signed sums (staged) as a part; the parts from then on."""
    rows = changes.count()
    if not rows:
        return parts
    kept, merged = to_merge(parts, rows)
    # Sums that have come to nothing can go only where no older part is left.
    latest = increments.added([*_stacked(spark, root, merged), changes], drop_empty=not kept) if merged else changes
    version = uuid4().hex
    path = f"{root}/part={version}"
    latest.write.parquet(path)
    return [*kept, Part(version, spark.read.schema(_SCHEMA).parquet(path).count())]
