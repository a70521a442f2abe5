"""Sharding by extendible hashing, with DataFrame functions only.

The leading bits of a hash of the key address a directory. A bucket whose documents exceed the byte limit
splits on the next bit, and only it; the others keep their shorter prefix. Splitting works on byte sums per
prefix, which partial aggregation makes before the shuffle.

Defined results: a null text has 0 bytes; rows with equal keys have equal hashes and no bit parts them, so a
bucket that no bit splits is cut by a running number of its rows into shards of the limit; a document larger than
the limit is a shard of its own if the bits part it from the others, and is marked ``oversized``. An empty table
gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm.common import stage

#: Bits of the hash; md5 so that other engines can follow the directory.
BITS = 60
#: Bits looked at in one round over the documents.
STEP = 12
LIMIT = 1 << 20


def key_hash(key: str) -> Column:
    """60 bits of the md5 of the key as text, as a long."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def _prefix(hashed: Column, depth: Column) -> Column:
    return F.call_function("shiftright", hashed, (F.lit(BITS) - depth).cast("int"))


def directory(sizes: DataFrame, limit: int) -> DataFrame:
    """The directory's buckets (depth, prefix, shard_bytes, shard_docs) for rows (hashed, bytes).

    Each round sums the bytes of all prefixes of the next ``STEP`` bits below the buckets that are still too
    large. A bucket is a leaf when it fits and its parent does not.
    """
    leaves, base, rows = None, 0, sizes
    while True:
        last = min(BITS, base + STEP)
        cells = rows.groupBy(_prefix(F.col("hashed"), F.lit(last)).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("docs")
        )
        depths = F.explode(F.sequence(F.lit(base), F.lit(last))).alias("depth")
        nodes = (
            cells.select("cell", "bytes", "docs", depths)
            .withColumn("prefix", F.call_function("shiftright", "cell", (F.lit(last) - F.col("depth")).cast("int")))
            .groupBy("depth", "prefix")
            .agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
        )
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.col("depth") == BITS)
        nodes = stage(nodes.withColumn("leaf", fits), "directory")
        # A node is in the tree while no node above it is a leaf; its parent tells, as fitting passes down.
        parents = nodes.where("leaf").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        tree = nodes.withColumn("parent", F.call_function("shiftright", "prefix", F.lit(1))).join(
            parents, ["depth", "parent"], "left_anti"
        )
        found = tree.where("leaf").drop("leaf", "parent")
        leaves = found if leaves is None else leaves.unionByName(found)
        large = nodes.where((F.col("depth") == last) & ~F.col("leaf")).select(F.col("prefix").alias("cell"))
        if last == BITS or large.isEmpty():
            return leaves
        rows = rows.withColumn("cell", _prefix(F.col("hashed"), F.lit(last))).join(large, "cell", "left_semi").drop("cell")
        base = last


def assign_shards(docs: DataFrame, key: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """One row per document: key, bytes, depth, shard (prefix bits as text), part, shard_bytes, shard_docs, oversized.

    ``part`` is 0 but in buckets that no bit splits; shard and part together name a shard.
    """
    sizes = docs.select(
        F.col(key), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"), key_hash(key).alias("hashed")
    )
    leaves = directory(sizes.select("hashed", "bytes"), limit)
    # The directory in full: a leaf of depth d is met through its first bits, one lookup per depth in use.
    used = [r["depth"] for r in leaves.select("depth").distinct().collect()]
    depths = F.explode(F.array(*[F.lit(d) for d in sorted(used)] or [F.lit(0)])).alias("depth")
    placed = sizes.select("*", depths).withColumn("prefix", _prefix(F.col("hashed"), F.col("depth"))).join(
        leaves, ["depth", "prefix"]
    )
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")))
    named = placed.withColumn("shard", bits)
    stuck = (F.col("depth") == BITS) & (F.col("shard_bytes") > limit) & (F.col("shard_docs") > 1)
    whole = named.where(~stuck).withColumn("part", F.lit(0).cast("long"))
    return _cut(named.where(stuck), limit).unionByName(whole).select(
        key, "bytes", "depth", "shard", "part", "shard_bytes", "shard_docs", (F.col("shard_bytes") > limit).alias("oversized")
    )


def _cut(rows: DataFrame, limit: int) -> DataFrame:
    """Deal rows of one hash into parts: as many of the largest row's size as the limit holds go into each."""
    by_hash = Window.partitionBy("hashed")
    numbered = rows.withColumns(
        {"_most": F.max("bytes").over(by_hash), "_n": F.row_number().over(by_hash.orderBy("bytes")) - 1}
    )
    each = F.greatest(F.lit(1), F.expr(f"{limit} div greatest(_most, 1)"))
    dealt = numbered.withColumn("part", F.floor(F.col("_n") / each).cast("long"))
    per_part = Window.partitionBy("hashed", "part")
    return dealt.withColumns(
        {"shard_bytes": F.sum("bytes").over(per_part), "shard_docs": F.count("*").over(per_part)}
    ).drop("_most", "_n")
