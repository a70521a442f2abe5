"""Best-fit packing of token sequences by exact complements.

The plan is made on the number of pieces of each length, a table of at most ``capacity`` rows whatever the
corpus. For a length, from long to short, the gap that it leaves is looked up among the sums of one, two or
three lengths still available; a combination that fills it exactly is used as often as its scarcest length
allows. What is left is packed best-fit, again by counts. Each step of the plan uses up a length or a kind of
open bin, so the plan has a few rows per length. Pieces are then numbered within their length on Spark and
find their place in the plan by that number.

Defined results: a null text is an empty one; a document always has its end id, so each gives at least one
piece; equal rows are packed as documents of their own; null ids are kept; an empty table gives an empty one.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.llm.common import arrow_batch_bytes, rank_within, stage
from shiftledger.llm.tokens import encoder, slices

CAPACITY = 2048
#: Packing follows other stages in a pipeline, whose memory the executors still hold: it works in smaller portions.
CACHE_ENTRIES = 300_000
SLICE = 1 << 20
BATCH_BYTES = "4m"

Pattern = tuple[list[int], int]


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """One row per piece: ``keep``, piece, start, length and ids (unsigned 32-bit, little-endian)."""
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType(
        [
            *fields,
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def cut(batches):
        encode = encoder(tokenizer, CACHE_ENTRIES).encode
        for whole in batches:
            for batch in slices(whole, "_text", SLICE):
                ids, counts = encode(batch.column("_text"))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
                pieces = (counts + capacity - 1) // capacity
                owner = np.repeat(np.arange(len(counts)), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, counts[owner] - start)
                edges = np.concatenate(([0], np.cumsum(length))) * 4
                blob = pa.Array.from_buffers(
                    pa.binary(), len(length), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(ids.astype("<u4"))]
                )
                kept = [batch.column(c).take(pa.array(owner)) for c in keep]
                arrays = [*kept, pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), blob]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])
            pa.default_memory_pool().release_unused()

    rows = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    return rows.mapInArrow(cut, schema)


class _Sums:
    """Which sums one and two available lengths make, as bits of whole numbers."""

    def __init__(self, left: np.ndarray):
        self.left = left
        self.stale = True

    def pairs(self) -> np.ndarray:
        if self.stale:
            lengths = np.flatnonzero(self.left).tolist()
            single = sum(1 << length for length in lengths)
            double = 0
            for length in lengths:
                double |= single << length
            size = len(self.left)
            raw = (double & ((1 << size) - 1)).to_bytes(size // 8 + 1, "little")
            self.table = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), bitorder="little")[:size].astype(bool)
            self.stale = False
        return self.table


def _pair(left: np.ndarray, gap: int) -> tuple[int, int] | None:
    """Two available lengths with the sum ``gap``: of all, those that can be used together most often."""
    if gap < 2:
        return None
    low = np.arange(1, gap // 2 + 1)
    often = np.minimum(left[low], left[gap - low])
    if gap % 2 == 0:
        often[-1] = left[gap // 2] // 2
    best = int(np.argmax(often))
    return (best + 1, gap - best - 1) if often[best] > 0 else None


def _complement(left: np.ndarray, gap: int, sums: _Sums) -> list[int] | None:
    """One, two or three available lengths that fill ``gap`` exactly."""
    if left[gap] > 0:
        return [gap]
    if pair := _pair(left, gap):
        return list(pair)
    low = np.arange(1, gap // 3 + 1)
    for length in low[(left[low] > 0) & sums.pairs()[gap - low]].tolist()[::-1]:
        left[length] -= 1
        pair = _pair(left, gap - length)
        left[length] += 1
        if pair:
            return [length, *pair]
    return None


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Kinds of bins and how many of each: ([lengths in it], bins)."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in counts.items():
        left[length] = count
    bins: list[Pattern] = []
    if left[capacity]:
        bins.append(([capacity], int(left[capacity])))
        left[capacity] = 0
    sums = _Sums(left)
    # A shorter length than a quarter leaves more than three of its like can fill.
    for length in range(capacity - 1, (capacity - 1) // 4, -1):
        while left[length] > 0:
            left[length] -= 1
            found = _complement(left, capacity - length, sums)
            left[length] += 1
            if not found:
                break
            need = Counter([length, *found])
            times = min(int(left[x]) // n for x, n in need.items())
            for x, n in need.items():
                left[x] -= n * times
                sums.stale |= left[x] == 0
            bins.append((sorted(need.elements(), reverse=True), times))
    return bins + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Longest first, each into the open bin with the least room that holds it; equal bins are kept together."""
    open_bins: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    has = np.zeros(capacity + 1, dtype=bool)
    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            room = length + int(np.argmax(has[length:]))
            if has[room]:
                lengths, bins = open_bins[room].pop()
                used = min(bins, count)
                if used < bins:
                    open_bins[room].append((lengths, bins - used))
                grown = [*lengths, length]
            else:
                each = min(count, capacity // length)
                used, room, grown = count // each, capacity - (each - 1) * length, [length] * each
            count -= used * (len(grown) if not has[room] else 1)
            has[room] = bool(open_bins[room])
            open_bins[room - length].append((grown, used))
            has[room - length] = True
    return [pattern for group in open_bins for pattern in group]


def _slots(bins: list[Pattern]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), by length and rank: pieces ``first rank`` and on go there."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for lengths, times in bins:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def place(pieces: DataFrame, bins: list[Pattern], seed: list[str]) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length``, following a plan for exactly their lengths."""
    slots = _slots(bins)
    # Ranks within a length stay below 2**44, lengths below 2**19.
    keys = (slots[:, 0] << 44) + slots[:, 1]
    ranked = rank_within(pieces, ["length"], F.xxhash64(*seed), [F.col(c) for c in seed], "_rank")
    added = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    schema = T.StructType([*pieces.schema.fields, *added])
    names = pieces.columns

    def find(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "_rank"))
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            sequence = slots[at, 2] + rank - slots[at, 1]
            kept = [batch.column(name) for name in names]
            arrays = [*kept, pa.array(sequence), pa.array(slots[at, 3])]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(find, schema)


def pack(pieces: DataFrame, seed: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Pack rows with a ``length`` of 1 to ``capacity`` into as few sequences as the method finds.

    Adds sequence_id (from 0) and offset. ``seed`` names columns that tell rows apart. The input is read
    twice, so hand a stored table. To the driver go the counts by length: ``capacity`` rows at most.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    return place(pieces, plan_bins(counts, capacity), seed)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = tokenized_pieces(docs, tokenizer, end_id, capacity)
    narrow = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    with arrow_batch_bytes(docs.sparkSession, BATCH_BYTES):
        narrow = stage(narrow, "pieces")
    return pack(narrow, ["doc_id", "piece", "ids_crc32"], capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """Whole sequences from placed pieces with ``ids``: sequence_id, length, ids (binary), documents in order.

    A group is one sequence, so it holds ``capacity`` ids at most.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids", "doc_id", "piece")))
    grouped = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    return grouped.select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("long"), lambda total, p: total + p["length"]).alias("length"),
        F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"])).alias("documents"),
    )
