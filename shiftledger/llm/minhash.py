"""Shingles, MinHash signatures and the search for pairs of similar items.

An item is a distinct set of word shingles, named by a digest of the whole set, so equal sets are one item with a number of
copies. The search runs in four steps:

1. band hashes of the items are shuffled, and members of a bucket are tied to its least member;
2. the components of these ties are candidate clusters: every pair that shares a bucket lies within one;
3. each item's full shingle set is sent to its cluster, once, or to the block pairs that a large cluster is cut into;
4. there all pairs are compared on the full sets by products of incidence matrices. What leaves a task is one row per item:
   how many copies it is linked to and the least item it is connected with. Pairs are never emitted.

The classes are the components of step 4's ties.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import stage
from shiftledger.llm.components import components

WORDS = 5
THRESHOLD = 0.8
#: Share of pairs at exactly the threshold that meet in a band.
RECALL = 0.9999
#: A cluster is cut into blocks of about so many items and shingles.
BLOCK_ITEMS = 512
BLOCK_SHINGLES = 2_000_000
#: Rows of (id, item) that may be broadcast to pick the texts to compare; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Columns of an incidence matrix in memory at once.
COLUMNS = 4096

MIX = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most_bands: int = 24) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest false candidates, whose needed bands stay within the limit."""
    best = None
    for rows in range(1, 17):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands <= most_bands:
            best = (bands, rows)
    if best is None:
        raise ValueError("no band count within the limit reaches this recall")
    return best


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    values = (values ^ (values >> np.uint64(32))) * MIX
    return values ^ (values >> np.uint64(29))


def shingle_hashes(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all texts' shingles one after the other, number per text).

    Words lie between white space. A text of fewer words has one shingle of all of them, one without words none.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), np.diff(offsets))
    coded = pc.dictionary_encode(flat)
    names = coded.dictionary.to_pandas()
    by_name = pd.util.hash_array(names.to_numpy(dtype=object), categorize=False) if len(names) else np.zeros(0, np.uint64)
    filled = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0 if len(names) else np.zeros(0, bool)
    codes = coded.indices.to_numpy().astype(np.int64)
    real = filled[codes]
    hashes, owner = mixed(by_name)[codes][real], owner[real]
    counts = np.bincount(owner, minlength=len(lists))
    ends = np.cumsum(counts)
    starts = ends - counts
    size = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    first = np.repeat(starts, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
    width = np.repeat(np.minimum(counts, words), size)
    padded = np.concatenate([hashes, np.zeros(words, dtype=np.uint64)])
    rolled = np.zeros(len(first), dtype=np.uint64)
    for k in range(words):
        inside = (width > k).astype(np.uint64)
        rolled = rolled * np.uint64(0x100000001B3) + (padded[first + k] + np.uint64(k + 1)) * inside
    return mixed(rolled), size


def signatures(hashes: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One row of band hashes per text that has shingles, in order."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    seeds = np.random.default_rng(11).integers(1, 2**63, size=(bands, rows, 2), dtype=np.uint64)
    result = np.zeros((len(starts), bands), dtype=np.uint64)
    if not len(starts):
        return result
    for band in range(bands):
        value = np.full(len(starts), band + 1, dtype=np.uint64)
        for row in range(rows):
            xor, factor = seeds[band, row]
            value = mixed(value * MIX + np.minimum.reduceat((hashes ^ xor) * (factor | np.uint64(1)), starts))
        result[:, band] = value
    return result


def sets_of(hashes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted."""
    ends = np.cumsum(counts)
    return [np.unique(hashes[end - count : end]) for end, count in zip(ends.tolist(), counts.tolist(), strict=True)]


def set_name(shingles: np.ndarray) -> bytes | None:
    """Digest of a whole set; none for a text without words."""
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest() if len(shingles) else None


def short_name(item: bytes | None) -> int | None:
    """The first 64 bits of a set's name. Items that agree in them are only put in one cluster."""
    return int.from_bytes(item[:8], "little", signed=True) if item else None


def candidate_clusters(signed: DataFrame) -> DataFrame:
    """(no, cluster) for every item that shares a band bucket with another; rows of ``signed`` have no and bands."""
    buckets = signed.select("no", F.explode("bands").alias("bucket"))
    leaders = buckets.groupBy("bucket").agg(F.min("no").alias("leader"), F.max("no").alias("_last"))
    leaders = leaders.where("leader <> _last").drop("_last")
    ties = stage(buckets.join(leaders, "bucket").where("no <> leader").select("no", "leader").distinct(), "ties")
    return components(ties.select(F.col("no").alias("a"), F.col("leader").alias("b"))).select(
        F.col("node").alias("no"), F.col("root").alias("cluster")
    )


def block_plan(members: DataFrame) -> DataFrame:
    """Add block and blocks to (item, cluster, n): clusters are cut by a hash of the item."""
    sizes = members.groupBy("cluster").agg(F.count("*").alias("_items"), F.sum("n").alias("_shingles"))
    blocks = F.ceil(F.greatest(F.col("_items") / BLOCK_ITEMS, F.col("_shingles") / BLOCK_SHINGLES)).cast("int")
    cut = members.join(sizes.select("cluster", blocks.alias("blocks")), "cluster")
    return cut.withColumn("block", F.pmod(F.xxhash64("item"), "blocks").cast("int"))


def block_pairs(rows: DataFrame) -> DataFrame:
    """Send each row to the pairs of blocks that its block is part of: (low, high)."""
    other = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.withColumns({"low": F.least("block", "_other"), "high": F.greatest("block", "_other")}).drop("_other")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = often > 1
    number = np.cumsum(common) - 1
    use = common[column]
    owner, column = owner[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = int(common.sum())
    for first in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        seen = np.zeros((len(sets), min(COLUMNS, width - first)), dtype=np.float32)
        seen[owner[a:b], column[a:b] - first] = 1
        shared += seen @ seen.T
    return shared


def compare_block(table: pa.Table, threshold: float) -> pa.Table:
    """Links within one pair of blocks: item, links (copies of the items linked to), tie (least item connected here)."""
    rows = {}
    for item, block, copies, blob in zip(*(table.column(c).to_pylist() for c in ("item", "block", "copies", "shingles")), strict=True):
        rows[item] = (block, copies, np.frombuffer(blob, dtype="<u8"))
    items = sorted(rows)
    block = np.array([rows[i][0] for i in items])
    copies = np.array([rows[i][1] for i in items], dtype=np.int64)
    sets = [rows[i][2] for i in items]
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    if len(items) < 2:
        return pa.table({"item": pa.array([], pa.binary()), "links": pa.array([], pa.int64()), "tie": pa.array([], pa.binary())})
    shared = shared_counts(sets)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    if table.column("low")[0].as_py() != table.column("high")[0].as_py():
        # Pairs within one block are compared where it is paired with itself.
        linked &= block[:, None] != block[None, :]
    links = linked @ copies
    label = np.arange(len(items))
    while True:
        following = np.minimum(label, np.where(linked, label[None, :], len(items)).min(axis=1))
        following = following[following]
        if np.array_equal(following, label):
            break
        label = following
    found = np.flatnonzero(links)
    return pa.table(
        {
            "item": pa.array([items[i] for i in found], pa.binary()),
            "links": pa.array(links[found], pa.int64()),
            "tie": pa.array([items[label[i]] for i in found], pa.binary()),
        }
    )


def linked_items(members: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(item, links) and (item, class) from rows (item, copies, shingles, cluster, block, low, high)."""
    compare = lambda table: compare_block(table, threshold)
    compared = members.groupBy("cluster", "low", "high").applyInArrow(compare, "item binary, links long, tie binary")
    compared = stage(compared, "links")
    links = compared.groupBy("item").agg(F.sum("links").alias("links"))
    ties = components(compared.select(F.col("item").alias("a"), F.col("tie").alias("b")))
    return links, ties.select(F.col("node").alias("item"), F.col("root").alias("class"))
