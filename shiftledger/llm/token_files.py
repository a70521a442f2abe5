"""Token ids as ORC files that can be read stripe by stripe.

Documents are range-partitioned by id, so each file holds an id range in ascending order. Within a file, ids are
integer columns (run-length encoded by the format), small stripes let many tasks read one file, and row indexes
and Bloom filters on ``doc_id`` let a reader skip what a lookup cannot need. A document's start in the whole
stream is its start within the file, which is stored, plus what the earlier files hold, which is one row per file.

Defined results: a null text is an empty one and has the end id only; rows with equal ids lie together, in the
order of their texts; null ids come first; an empty table gives an empty one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftledger.llm.common import scratch
from shiftledger.llm.tokens import encoder, slices

ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(8 << 20),
    "orc.encoding.strategy": "SPEED",
}
SCHEMA = "part int, doc_id long, local_start long, n_tokens long, ids array<int>"
#: Text bytes per file, as a guide to their number.
FILE_BYTES = 32 << 20
#: Text bytes encoded at a time.
SLICE = 2 << 20


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode every text and write part, doc_id, local_start, n_tokens and ids in ascending doc_id order."""

    def encode_part(batches):
        encode, done = encoder(tokenizer).encode, 0
        for whole in batches:
            for batch in slices(whole, "_text", SLICE):
                ids, counts = encode(batch.column("_text"))
                ids = np.insert(ids, np.cumsum(counts), end_id).astype(np.int32)
                counts = counts + 1
                ends = np.cumsum(counts)
                starts = done + ends - counts
                done += int(ends[-1])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids))
                columns = [batch.column("part"), batch.column("doc_id"), pa.array(starts), pa.array(counts), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "local_start", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    ordered = rows.repartitionByRange(max(1, size // FILE_BYTES + 1), "doc_id").sortWithinPartitions("doc_id", "_text")
    ids = ordered.withColumn("part", F.spark_partition_id()).mapInArrow(encode_part, SCHEMA)
    ids.write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """part, doc_id, local_start, n_tokens, ids; filters on doc_id reach the stripes' statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path)


def part_bases(tokens: DataFrame) -> DataFrame:
    """Ids in all earlier files, one row per file; reads no ids."""
    sizes = tokens.groupBy("part").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Read files back: doc_id, start, n_tokens, ids_crc32. No shuffle of documents, whatever the number of files."""
    tokens = read_tokens(spark, path)

    def digest(batches):
        for batch in batches:
            lists = batch.column("ids")
            edges = lists.offsets.to_numpy()
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4"))
            view = memoryview(values.view(np.uint8)).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
            kept = [batch.column(c) for c in ("part", "doc_id", "local_start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(crc, pa.int64())], names=["part", "doc_id", "local_start", "n_tokens", "ids_crc32"]
            )

    rows = tokens.mapInArrow(digest, "part int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    bases = part_bases(tokens)
    return rows.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_to_orc(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write all documents' ids to new files in the shared folder and return what is read back from them."""
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return token_digests(spark, path)
