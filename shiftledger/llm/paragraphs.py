"""Repeated paragraphs: MinHash banding over paragraphs, verified by exact Jaccard, removals by components.

A paragraph is a line of a text. Equal paragraphs are one item with copies, so only different ones are compared. Bands are
tuned for recall: paragraphs that have nothing in common share no shingle, so short bands bring few false candidates.
Of each class the paragraph with the least (doc_id, paragraph) stays and all others are to be removed.

Defined results: a null or empty text has no paragraph; paragraphs of fewer than ``min_words`` words are left alone;
a paragraph that repeats within a document is removed there too; a null doc_id comes before all others; rows with equal ids
and texts are repeats of each other; an empty table gives an empty one. Columns but doc_id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm import minhash as mh
from shiftledger.llm import passages
from shiftledger.llm.common import arrow_batch_bytes, stage
from shiftledger.llm.tokens import slices

MIN_WORDS = 20
RECALL = 0.9995
MOST_BANDS = 8
SLICE = 1 << 20
BATCH_BYTES = "4m"


def _lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(paragraphs of all texts, owner, number within the text, first character)."""
    lists = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
    counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    lines = lists.flatten()
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    number = np.arange(len(owner)) - first[owner]
    ends = np.cumsum(pc.utf8_length(lines).to_numpy().astype(np.int64) + 1)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    return lines, owner, number, starts - (starts[first[owner]] if len(owner) else 0)


def signed_paragraphs(docs: DataFrame, threshold: float, recall: float, min_words: int) -> DataFrame:
    """Each paragraph with at least ``min_words`` words; bands where a task first meets an item."""
    bands, rows = mh.choose_bands(threshold, recall, MOST_BANDS)

    def sign(batches):
        met = set()
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                lines, owner, number, start = _lines(batch.column("text"))
                words = pc.count_substring_regex(lines, r"[^ \t-\r]+").to_numpy()
                long = np.flatnonzero(words >= max(1, min_words))
                lines, owner, number, start = lines.take(pa.array(long)), owner[long], number[long], start[long]
                hashes, counts = mh.shingle_hashes(lines)
                names = [mh.set_name(s) for s in mh.sets_of(hashes, counts)]
                shown = mh.signatures(hashes, counts, bands, rows).view("int64").tolist()
                new = [name not in met and not met.add(name) for name in names]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(owner)),
                        pa.array(number.astype(np.int32)),
                        pa.array(start),
                        pa.array(pc.utf8_length(lines).cast(pa.int64())),
                        pa.array(names, pa.binary()),
                        pa.array([mh.short_name(name) for name in names], pa.int64()),
                        pa.array(counts),
                        pa.array([b if first else None for b, first in zip(shown, new, strict=True)], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "paragraph", "start", "n_chars", "item", "no", "n", "bands"],
                )
            pa.default_memory_pool().release_unused()

    schema = "doc_id long, paragraph int, start long, n_chars long, item binary, no long, n long, bands array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sign, schema)


def _with_shingles(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Members (first.doc_id, first.paragraph, item, ...) with their shingle sets; a document's text travels once."""
    kept = ["item", "copies", "cluster", "blocks", "block"]
    per_doc = members.groupBy(F.col("first.doc_id").alias("_id")).agg(
        F.collect_list(F.struct(F.col("first.paragraph").alias("paragraph"), *kept)).alias("members")
    )
    if members.count() <= mh.BROADCAST_ROWS:
        per_doc = F.broadcast(per_doc)
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), "text")
    rows = texts.join(per_doc, F.col("_doc").eqNullSafe(F.col("_id"))).select("text", "members")

    def attach(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                lines, owner, number, _ = _lines(batch.column("text"))
                first = np.searchsorted(owner, np.arange(batch.num_rows))
                count = np.bincount(owner, minlength=batch.num_rows)
                found, at = [], []
                for row, members_of in enumerate(batch.column("members").to_pylist()):
                    inside = [m for m in members_of if m["paragraph"] < count[row]]
                    found += inside
                    at += [int(first[row]) + m["paragraph"] for m in inside]
                sets = mh.sets_of(*mh.shingle_hashes(lines.take(pa.array(at, pa.int64()))))
                right = [(m, s) for m, s in zip(found, sets, strict=True) if mh.set_name(s) == m["item"]]
                columns = {k: [m[k] for m, _ in right] for k in kept}
                columns["shingles"] = [s.astype("<u8").tobytes() for _, s in right]
                yield pa.RecordBatch.from_pydict(columns, schema=ARROW)

    ARROW = pa.schema(
        {"item": pa.binary(), "copies": pa.int64(), "cluster": pa.int64(), "blocks": pa.int32(), "block": pa.int32(), "shingles": pa.binary()}
    )
    return rows.mapInArrow(attach, "item binary, copies long, cluster long, blocks int, block int, shingles binary")


def repeated_paragraphs(
    docs: DataFrame, threshold: float = mh.THRESHOLD, recall: float = RECALL, min_words: int = MIN_WORDS
) -> DataFrame:
    """One row per paragraph that has a repeat: doc_id, paragraph, start, n_chars, class_doc_id, class_paragraph,
    class_size (paragraphs), removed."""
    # Texts pass to Python in batches bounded by bytes, not by rows.
    with arrow_batch_bytes(docs.sparkSession, BATCH_BYTES):
        rows = stage(signed_paragraphs(docs, threshold, recall, min_words), "paragraphs")
    items = rows.groupBy("item", "no", "n").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "paragraph")).alias("first")
    )
    items = stage(items, "items")
    members = items.join(mh.candidate_clusters(rows), "no")
    planned = stage(mh.block_plan(members).drop("n", "no"), "members")
    with arrow_batch_bytes(docs.sparkSession, BATCH_BYTES):
        _, classes = mh.linked_items(mh.block_pairs(_with_shingles(docs, planned)), threshold)

    named = items.join(classes, "item", "left").withColumn("class", F.coalesce("class", "item"))
    heads = named.groupBy("class").agg(F.min("first").alias("head"), F.sum("copies").alias("class_size"))
    repeated = named.select("item", "class").join(heads.where("class_size > 1"), "class").select("item", "head", "class_size")
    found = rows.select("doc_id", "paragraph", "start", "n_chars", "item").join(repeated, "item")
    stays = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("paragraph") == F.col("head.paragraph"))
    return found.select(
        "doc_id",
        "paragraph",
        "start",
        "n_chars",
        F.col("head.doc_id").alias("class_doc_id"),
        F.col("head.paragraph").alias("class_paragraph"),
        "class_size",
        (~stays).alias("removed"),
    )


def repeated_substrings(docs: DataFrame) -> DataFrame:
    """All that repeats, one row each: doc_id, kind, start, n_chars, class_doc_id (where it stays), removed.

    Kind ``paragraph`` are lines that resemble another line (``repeated_paragraphs``), ``passage`` spans of words that stand
    elsewhere too, inside long lines or over short ones (``passages``); both may cover the same words.
    """
    lines = repeated_paragraphs(docs).withColumn("kind", F.lit("paragraph"))
    spans = passages.repeated_passages(docs).withColumn("kind", F.lit("passage"))
    kept = ["doc_id", "kind", "start", "n_chars", "class_doc_id", "removed"]
    return lines.select(kept).unionByName(spans.select(kept))


def without_repeats(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """``docs`` with the removed paragraphs cut out of their texts; a document has one list of them."""
    cut = repeats.where("removed").groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("paragraph").alias("_cut"))
    joined = docs.join(cut, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    left = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains("_cut", i))
    text = F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return joined.withColumn("text", text).select(*docs.columns)
