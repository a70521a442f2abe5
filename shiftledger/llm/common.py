"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftledger.session import shared_dir

#: White space by which texts are compared and words counted.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place; never used twice, so a repeated attempt meets no old files."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batch_bytes(spark: SparkSession, most: str) -> Iterator[None]:
    """Spark hands batches of about ``most`` bytes to the Arrow tasks of what is run inside, then the session is as before.

    By number alone a batch of long texts takes many times the memory of one of short texts, in Spark and in Python.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def in_fold(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as the empty text."""
    crc = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return (crc % modulus) == remainder


def rank_within(df: DataFrame, keys: list[str], seed: Column, order: list[Column], name: str, buckets: int = 1024) -> DataFrame:
    """Add ``name``: the row's place (from 0) within its group, gapless, in the order of a hash.

    A group may hold any share of the rows: each is spread over ``buckets`` slices of the hash
    ``seed``, rows are numbered within a slice, and the slices' counts give each slice its first number.
    ``keys`` must not be null. Equal ``seed`` and ``order`` values may be numbered either way.
    """
    sliced = df.withColumn("_slice", F.pmod(seed, F.lit(buckets)).cast("int"))
    counts = sliced.groupBy(*keys, "_slice").agg(F.count("*").alias("_in_slice"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*keys, "_slice", F.coalesce(F.sum("_in_slice").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(seed, *order)
    numbered = sliced.withColumn("_place", F.row_number().over(inside) - 1)
    return (
        numbered.join(bases, [*keys, "_slice"])
        .withColumn(name, (F.col("_base") + F.col("_place")).cast("long"))
        .drop("_slice", "_place", "_base")
    )
