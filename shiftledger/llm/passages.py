"""Repeated passages, wherever they lie and however they are broken into lines.

Only words count, so a passage may begin inside a long line or go over many short ones. Pieces are found as MinHash does: of the
hashes of all ``PIECE``-word runs within each ``WINDOW`` words, the least marks the run that stands for that window. It
depends on these words alone, so a repeated window has the same piece wherever it lies, and an insertion elsewhere
shifts nothing: each run of ``WINDOW`` or more words that repeats shares a piece with certainty. Pieces that agree in all
their words (by a name of 128 bits) are a class; overlapping and touching pieces of a text with the same fate are joined to spans.

Defined results: a null or empty text and one of fewer than ``WINDOW`` words have no piece; words lie between white space; the
first piece of a class by (id, place) stays, a null id before all others; rows with equal ids and texts are one document;
an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm import minhash as mh
from shiftledger.llm.common import arrow_batch_bytes, stage
from shiftledger.llm.tokens import slices

WINDOW = 50
PIECE = 25
#: Windows that one piece can stand for.
REACH = WINDOW - PIECE + 1
#: Text bytes looked at together; their tables take about fifty times as much.
SLICE = 1 << 18
BATCH_BYTES = "4m"

_FACTORS = (np.uint64(0x100000001B3), np.uint64(0xD6E8FEB86659FD93))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, owner, first character, character after the last) of each word."""
    joined = pc.fill_null(texts.cast(pa.large_string()), "").to_pylist()
    # A line end after each text keeps words of two texts apart.
    blobs = [t.encode("utf-8", "surrogatepass") for t in joined]
    data = np.frombuffer(b"\n".join([*blobs, b""]), dtype=np.uint8)
    sizes = np.array([len(b) + 1 for b in blobs], dtype=np.int64)
    firsts = np.cumsum(sizes) - sizes
    filled = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(filled.astype(np.int8), prepend=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return np.zeros(0, np.uint64), begin, begin, begin
    inside = np.flatnonzero(filled)
    size = end - begin
    offsets = np.cumsum(size) - size
    place = np.arange(len(inside)) - np.repeat(offsets, size)
    hashes = mh.mixed(np.add.reduceat(mh.mixed((place.astype(np.uint64) << np.uint64(8)) + data[inside] + np.uint64(1 << 40)), offsets))
    owner = np.searchsorted(firsts, begin, side="right") - 1
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    before = chars[firsts[owner]]
    return hashes, owner, chars[begin] - before, chars[end] - before


def _runs(hashes: np.ndarray, factor: np.uint64) -> np.ndarray:
    """Hash of the ``PIECE`` words from each place on."""
    if len(hashes) < PIECE:
        return np.zeros(0, np.uint64)
    result = np.zeros(len(hashes) - PIECE + 1, dtype=np.uint64)
    for k in range(PIECE):
        result *= factor
        result += hashes[k : k + len(result)]
    return mh.mixed(result)


def _marked(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, name, more of the name) of the runs that stand for a window of their text."""
    runs = _runs(hashes, _FACTORS[0])
    if len(hashes) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    least, reach = runs, 1
    while reach < REACH:
        step = min(reach, REACH - reach)
        least, reach = np.minimum(least[:-step], least[step:]), reach + step
    inside = owner[: len(least)] == owner[WINDOW - 1 :]
    # The least of a window is marked at its last place in the window, so that a row of equal runs is not marked all along.
    stands = np.zeros(len(runs), dtype=bool)
    open_ones = inside.copy()
    for k in range(REACH - 1, -1, -1):
        hit = np.flatnonzero(open_ones & (runs[k : k + len(least)] == least))
        stands[hit + k] = True
        open_ones[hit] = False
    at = np.flatnonzero(stands)
    return at, runs[at], _runs(mh.mixed(hashes ^ mh.MIX), _FACTORS[1])[at]


def pieces(rows: DataFrame) -> DataFrame:
    """id, text_key, start, n_chars, name, more of all pieces of rows (id, text)."""

    def cut(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                hashes, owner, start, end = _words(batch.column("text"))
                at, name, more = _marked(hashes, owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.select(["id", "text_key"]).take(pa.array(owner[at])).columns,
                        pa.array(start[at]),
                        pa.array((end[at + PIECE - 1] if len(at) else at) - start[at]),
                        pa.array(name.view(np.int64)),
                        pa.array(more.view(np.int64)),
                    ],
                    names=["id", "text_key", "start", "n_chars", "name", "more"],
                )
            pa.default_memory_pool().release_unused()

    keyed = rows.select("id", F.xxhash64("text").alias("text_key"), "text")
    return keyed.mapInArrow(cut, "id long, text_key long, start long, n_chars long, name long, more long")


def passage_spans(rows: DataFrame) -> DataFrame:
    """id, text_key, start, n_chars, class_id, class_start, removed: spans of rows (id, text) whose pieces occur more than once.

    ``class_id`` and ``class_start`` tell where the span's first piece stands first.
    """
    with arrow_batch_bytes(rows.sparkSession, BATCH_BYTES):
        found = stage(pieces(rows), "pieces")
    first = F.min(F.struct("id", "text_key", "start")).alias("first")
    repeated = found.groupBy("name", "more").agg(F.count("*").alias("times"), first).where("times > 1").drop("times")
    # Written, so that both sides of the join are plain shuffles and Spark can split a piece that very many texts have.
    repeated = stage(repeated, "repeated")
    met = found.join(repeated, ["name", "more"])
    stays = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_key") == F.col("first.text_key")) & (F.col("start") == F.col("first.start"))
    judged = met.select("id", "text_key", "start", "n_chars", "first", (~stays).alias("removed")).distinct()

    in_text = Window.partitionBy("id", "text_key", "removed").orderBy("start")
    before = F.max(F.col("start") + F.col("n_chars")).over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    # One white space may lie between.
    marked = judged.withColumn("_new", (F.col("start") > F.coalesce(before + 1, F.lit(-1))).cast("int"))
    islands = marked.withColumn("_span", F.sum("_new").over(in_text))
    return islands.groupBy("id", "text_key", "removed", "_span").agg(
        F.min("start").alias("start"),
        (F.max(F.col("start") + F.col("n_chars")) - F.min("start")).alias("n_chars"),
        F.min_by("first.id", "start").alias("class_id"),
        F.min_by("first.start", "start").alias("class_start"),
    ).drop("_span")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per span that repeats: doc_id, start, n_chars, class_doc_id, class_start, removed."""
    spans = passage_spans(docs.select(F.col("doc_id").cast("long").alias("id"), "text"))
    return spans.select(
        F.col("id").alias("doc_id"),
        "start",
        "n_chars",
        F.col("class_id").alias("class_doc_id"),
        "class_start",
        "removed",
    )


def without_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans to be removed cut out of their texts; of each class the first piece in the order of rows stays.

    Rows are told apart by a written number, and carried whole whatever their columns are called.
    """
    rows = stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("id")), "numbered")
    spans = passage_spans(rows.select("id", F.col("row.text").alias("text"))).where("removed")
    cuts = spans.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "n_chars"))).alias("cuts"))
    joined = rows.join(cuts, "id", "left").withColumn("text", F.col("row.text"))
    last = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))
    piece = lambda at, end: F.substring("text", (at + 1).cast("int"), (end - at).cast("int"))
    step = lambda s, c: F.struct(F.concat(s["text"], piece(s["at"], c["start"])).alias("text"), (c["start"] + c["n_chars"]).alias("at"))
    whole = F.aggregate("cuts", last, step, lambda s: F.concat(s["text"], piece(s["at"], F.char_length("text").cast("long"))))
    text = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(whole)
    return joined.select(F.col("row").withField("text", text).alias("row")).select("row.*")
