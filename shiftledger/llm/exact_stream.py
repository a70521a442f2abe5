"""Exact duplicates by stateful streaming.

Digests of normalised texts run through a streaming aggregation without watermark, so its keyed state never
expires; the state lives in RocksDB on the executors' disks and is kept in the shared folder. Per digest it retains
the smallest document id, a content locator (the row of the digest table that has it) and the number of rows.
Partial aggregation reduces a batch before its shuffle, so a text that fills a third of the rows is one state row.

Every micro-batch writes the digests it changed; a repeated batch writes the same files again. Then the full bytes of
all rows that share a digest are compared. Should they differ, those rows are grouped by their text instead, so even
a digest that collides loses nothing.

Defined results: a null text is an empty one, and empty texts are equal; of rows with equal text and equal id exactly one
is kept; a null id comes after all others; an empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.llm.common import SPACE, scratch, stage

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Files take the room that they fill; by default each store sets aside some megabytes.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Bytes of digest files taken into one micro-batch.
BATCH_BYTES = 1 << 30
#: Digests that may be broadcast (8 bytes each) to pick the texts to compare; beyond it they are joined by a shuffle.
BROADCAST_DIGESTS = 2_000_000


def normalised(text: str = "text") -> Column:
    """The text with each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def stream_digests(
    spark: SparkSession, source: str, schema: T.StructType, state: str, log: str, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Run the stateful deduplication over files of (digest, locator) rows; returns digest, first, n for all so far.

    With the same ``state`` and ``log`` folders a later call takes up only new files and goes on from the kept state.
    """
    own = spark.newSession()
    # A new session starts from defaults; the number of state partitions is the caller's.
    partitions = {"spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions")}
    for key, value in {**STATE_STORE, **partitions}.items():
        own.conf.set(key, value)
    rows = own.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(source)
    seen = rows.groupBy("digest").agg(F.min("locator").alias("first"), F.count("*").alias("n"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").option("compression", "zstd").parquet(f"{log}/batch={batch}")

    stream = seen.writeStream.outputMode("update").option("checkpointLocation", state).foreachBatch(write)
    stream.trigger(availableNow=True).start().awaitTermination()
    changes = spark.read.schema(T.StructType([*seen.schema, T.StructField("batch", T.IntegerType())])).parquet(log)
    # The last change of a digest holds its state: locators only fall and counts only rise.
    return changes.groupBy("digest").agg(F.min("first").alias("first"), F.max("n").alias("n"))


def _differing(docs: DataFrame, digest: Callable[[Column], Column], repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts of rows whose digest occurs more than once, digests whose texts are not all the same bytes)."""
    keys = repeated.select(F.xxhash64("digest").alias("_key")).distinct()
    if repeated.count() <= BROADCAST_DIGESTS:
        keys = F.broadcast(keys)
    texts = docs.select("doc_id", "row", normalised().alias("text"))
    hits = texts.withColumn("digest", digest(F.col("text"))).withColumn("_key", F.xxhash64("digest"))
    hits = hits.join(keys, "_key", "left_semi").drop("_key")
    # Least and greatest bytes are found before the shuffle, so a text that fills the table is sent once per task.
    bounds = hits.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("most"))
    return hits, stage(bounds.where("least <> most").select("digest"), "collisions")


def exact_groups(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, batch_bytes: int = BATCH_BYTES, number: str | None = None
) -> DataFrame:
    """One row per document: doc_id, digest (of the normalised text), keep_id, group_size, kept, row (its number).

    ``number`` names a column of written row numbers; by default rows are numbered here.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", (F.col(number) if number else F.monotonically_increasing_id()).alias("row"))
    locator = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    # The row number is fixed by writing it; everything below reads it from there.
    rows = docs.select("doc_id", "row", digest(normalised()).alias("digest")).select("digest", locator.alias("locator"))
    source = scratch(spark, "digests")
    rows.write.option("compression", "zstd").parquet(source)
    stored = spark.read.schema(rows.schema).parquet(source)
    groups = stream_digests(spark, source, rows.schema, scratch(spark, "state"), scratch(spark, "changes"), batch_bytes)
    groups = stage(groups, "groups")

    hits, differing = _differing(docs, digest, groups.where("n > 1").select("digest"))
    sound = stored.join(groups, "digest").select(
        F.col("locator.doc_id").alias("doc_id"),
        "digest",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("locator.row") == F.col("first.row")).alias("kept"),
        F.col("locator.row").alias("row"),
    )
    if differing.isEmpty():
        return sound
    same = Window.partitionBy("digest", "text")
    in_order = same.orderBy(F.col("doc_id").asc_nulls_last(), "row")
    apart = hits.join(differing, "digest", "left_semi").select(
        "doc_id",
        "digest",
        F.first("doc_id").over(in_order).alias("keep_id"),
        F.count("*").over(same).alias("group_size"),
        (F.row_number().over(in_order) == 1).alias("kept"),
        "row",
    )
    return sound.join(differing, "digest", "left_anti").unionByName(apart)


def dedup_report(docs: DataFrame) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns whatever their names; one row of each text.

    Rows are told apart by a written number, so those that go are found without looking at texts again.
    """
    rows = stage(docs.select(F.struct("*").alias("document"), F.monotonically_increasing_id().alias("number")), "numbered")
    groups = exact_groups(rows.select("document.doc_id", "document.text", "number"), number="number")
    gone = stage(groups.where("not kept").select(F.col("row").alias("number")), "repeats")
    return rows.join(gone, "number", "left_anti").select("document.*")
