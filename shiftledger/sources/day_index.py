"""Which day holds an entry id: a small stored table beside the entries.

A merge has to find the stored row of each incoming id, wherever it lies. Entries are stored by day, so without this table
every merge would scan the ids of all days. The index is cut into buckets by a hash of the id, and a lookup reads
the buckets of its ids only: a few rejected ids or a micro-batch read a fraction of two narrow columns.

Each publish adds one part with the ids that are new or have moved; of several parts the newest that has an id counts.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.sources.parts import Part, to_merge

BUCKET = "bucket"
BUCKETS = 256
ROWS_PER_FILE = 5_000_000
STORED_DAY = "stored_day"
_SCHEMA = f"source_id STRING, day DATE, {BUCKET} INT"


def bucket_of(source_id: Column) -> Column:
    return F.pmod(F.xxhash64(source_id), F.lit(BUCKETS)).cast("int")


def _pairs(spark: SparkSession, root: str, parts: list[Part]) -> DataFrame:
    """source_id, day, bucket and place (later parts are greater) of all parts."""
    reader = spark.read.schema(_SCHEMA)
    each = [reader.parquet(f"{root}/part={p.version}").withColumn("place", F.lit(n)) for n, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, each)


def newest(pairs: DataFrame) -> DataFrame:
    """One row per id: its day in the latest part."""
    return pairs.groupBy("source_id").agg(F.max_by("day", "place").alias("day"))


def lookup(spark: SparkSession, root: str, parts: list[Part], ids: DataFrame) -> DataFrame:
    """(source_id, stored_day) of those ``ids`` that are stored; null ids are nowhere.

    The buckets in use, ``BUCKETS`` at most, go to the driver and reach the scan as a partition filter.
    """
    wanted = ids.select("source_id").where(F.col("source_id").isNotNull()).distinct()
    buckets = [r[0] for r in wanted.select(bucket_of(F.col("source_id"))).distinct().collect()]
    held = _pairs(spark, root, parts).where(F.col(BUCKET).isin(buckets)).join(wanted, "source_id", "left_semi")
    return newest(held).withColumnRenamed("day", STORED_DAY)


def add(spark: SparkSession, root: str, parts: list[Part], moved: DataFrame) -> list[Part]:
    """Write the ids that are new or moved (source_id, day; staged) as a part; the parts from then on."""
    rows = moved.count()
    if not rows:
        return parts
    kept, merged = to_merge(parts, rows)
    latest = moved.select("source_id", "day")
    if merged:
        older = _pairs(spark, root, merged).select("source_id", "day", "place")
        latest = newest(older.unionByName(latest.withColumn("place", F.lit(len(merged)))))
    total = rows + sum(p.rows for p in merged)
    files = max(1, -(-total // (BUCKETS * ROWS_PER_FILE)))
    part = Part(uuid4().hex, total)
    (
        latest.select("source_id", "day", bucket_of(F.col("source_id")).alias(BUCKET))
        .withColumn("_file", F.pmod(F.hash("source_id"), F.lit(files)))
        .repartition(BUCKET, "_file")
        .drop("_file")
        .write.partitionBy(BUCKET)
        .parquet(f"{root}/part={part.version}")
    )
    return [*kept, part]
