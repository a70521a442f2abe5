"""Similarity join of documents on word n-grams by MinHash banding, verified on the full n-gram sets.

Defined results: words lie between white space; a text of fewer than five words is one n-gram; a text without words (null,
empty) has no links and is a class of its own; rows with equal n-gram sets link to each other; a class is named by its
least doc_id (null only if all are null); an empty table gives an empty one. Columns but doc_id and text are not looked at.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm import minhash as mh
from shiftledger.llm.common import stage
from shiftledger.llm.tokens import slices

SLICE = 2 << 20


def signed(docs: DataFrame, threshold: float, recall: float) -> DataFrame:
    """doc_id, item, no, n (distinct n-grams) of every document, and bands where a task first meets an item."""
    bands, rows = mh.choose_bands(threshold, recall)

    def sign(batches):
        met = {None}
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                hashes, counts = mh.shingle_hashes(batch.column("text"))
                sets = mh.sets_of(hashes, counts)
                signature = iter(mh.signatures(hashes, counts, bands, rows).view("int64").tolist())
                names = [mh.set_name(s) for s in sets]
                shown = [next(signature) if name else None for name in names]
                new = [name not in met and not met.add(name) for name in names]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(names, pa.binary()),
                        pa.array([mh.short_name(name) for name in names], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([b if first else None for b, first in zip(shown, new, strict=True)], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "item", "no", "n", "bands"],
                )

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows_in.mapInArrow(sign, "doc_id long, item binary, no long, n long, bands array<long>")


def with_shingles(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Add the full n-gram sets to members (doc_id, item, ...), from the documents' texts."""
    chosen = members.withColumnRenamed("doc_id", "_id")
    if members.count() <= mh.BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), "text")
    rows = texts.join(chosen, F.col("_doc").eqNullSafe(F.col("_id"))).drop("_doc", "_id")
    kept = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept) + ", shingles binary"

    def attach(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                sets = mh.sets_of(*mh.shingle_hashes(batch.column("text")))
                # Rows with the id but another text are not the item.
                right = pa.array([mh.set_name(s) == item for s, item in zip(sets, batch.column("item").to_pylist(), strict=True)])
                blobs = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
                columns = [*(batch.column(c) for c in kept), blobs]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "shingles"]).filter(right)

    return rows.mapInArrow(attach, schema)


def similar_documents(docs: DataFrame, threshold: float = mh.THRESHOLD, recall: float = mh.RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, n_links (documents with at least this similarity, copies counted)."""
    rows = stage(signed(docs, threshold, recall), "signatures")
    worded = rows.where("item is not null")
    items = worded.groupBy("item", "no", "n").agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"))
    items = stage(items, "items")
    members = items.join(mh.candidate_clusters(worded), "no")
    planned = stage(mh.block_plan(members).drop("n", "no"), "members")
    links, classes = mh.linked_items(mh.block_pairs(with_shingles(docs, planned)), threshold)

    named = items.select("item", "copies", "doc_id").join(classes, "item").join(links, "item")
    heads = named.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    linked = named.join(heads, "class").select("item", "links", "class_id")
    per_item = items.select("item", "copies", "doc_id").join(linked, "item", "left").select(
        "item",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    per_item = stage(per_item, "classes")
    alone = rows.where("item is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return worded.select("doc_id", "item").join(per_item, "item").drop("item").unionByName(alone)


def one_per_class(docs: DataFrame, threshold: float = mh.THRESHOLD) -> DataFrame:
    """One document of each class of near copies: the one with the least id, of equal ids any one, null ids last.

    Rows are told apart by a written number: rows with other texts stay whatever their ids, and all columns are kept.
    """
    rows = stage(docs.select(F.struct("*").alias("document"), F.monotonically_increasing_id().alias("number")), "numbered")
    classes = similar_documents(rows.select(F.col("number").alias("doc_id"), F.col("document.text").alias("text")), threshold)
    # Only rows with a link have something to lose.
    linked = stage(classes.where("n_links > 0").select(F.col("doc_id").alias("number"), F.col("class_id").alias("class")), "linked")
    ids = rows.select("number", F.col("document.doc_id").alias("id")).join(linked, "number")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "number")
    members = stage(ids.select("class", place.alias("place")), "members")
    heads = members.groupBy("class").agg(F.min("place").alias("head"))
    gone = members.join(heads, "class").where("place.number <> head.number").select("place.number")
    return rows.join(stage(gone, "near"), "number", "left_anti").select("document.*")
