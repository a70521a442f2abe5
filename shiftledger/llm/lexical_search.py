"""Ranked search by weighted terms over an inverted index with per-term geometric blocks.

Documents are dealt into shards of bounded size. Within a shard each term has a list of the documents that hold it; the list
is clustered by the documents' similarity (their vectors, randomly projected, against representatives from the list) into
blocks, and a block keeps the coordinatewise maximum of its documents' vectors. An item's product with that summary is an upper
bound of its score for every document of the block, so a block is skipped only where the bound lies below the item's
tenth best score so far: the result is exact. Lists of an item are visited from the heaviest term on, until the terms that are
left can't reach that score even together. The tenth best score is carried from shard to shard within a task.

Only terms of the items are kept, so a first pass over the texts leaves narrow rows; numbers of the whole
corpus (documents, terms, documents per term) come from these. Items are searched in blocks of bounded size, one pass each.

Defined results: a null or empty text has no term and is never found; repeated rows are documents of their own; equal scores go
by ascending doc_id, null ids first; an item without a known term has no rows; items with equal ids are ranked each;
empty tables give an empty result. Columns but doc_id, item_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm.common import stage
from shiftledger.llm.tokens import slices

BEST = 10
SLICE = 2 << 20
#: Documents of a shard, and cells of its matrix of documents and terms, at most.
SHARD_DOCS = 2048
SHARD_CELLS = 8_000_000
#: Documents of a block, on average.
BLOCK = 32
#: Dimensions that documents are projected to for clustering.
DIMENSIONS = 16
#: Items of one pass, and their terms, at most.
ITEMS = 2000
ITEM_TERMS = 200_000
#: Ranking goes by slices of documents first, so that no task meets all candidates of an item.
SLICES = 64

#: Bytes of terms stay (A-Z lower-cased), all others become spaces.
_BYTES = np.array([b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)], dtype=np.uint8)


def term_lists(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(all terms in order, text that each belongs to)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    edges = pa.py_buffer((offsets - offsets[0]).astype(np.int64))
    plain = pa.LargeStringArray.from_buffers(len(texts), edges, pa.py_buffer(_BYTES[data]))
    lists = pc.ascii_split_whitespace(plain)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    flat = lists.flatten()
    filled = pc.greater(pc.binary_length(flat), 0)
    return pc.dictionary_encode(flat.filter(filled)), owner[filled.to_numpy(zero_copy_only=False)]


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, terms (distinct) of each item."""

    def distinct(batches):
        for batch in batches:
            terms, owner = term_lists(batch.column("text"))
            names = terms.dictionary.to_pylist()
            codes = terms.indices.to_numpy()
            each = np.split(codes, np.searchsorted(owner, np.arange(1, batch.num_rows)))
            lists = pa.array([[names[k] for k in np.unique(x)] for x in each], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists], names=["item_id", "terms"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(distinct, "item_id long, terms array<string>")


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[str]]]]:
    """Items with their terms, so many at a time as one pass takes."""
    block, size = [], 0
    for row in item_terms(items).toLocalIterator():
        if block and (len(block) == ITEMS or size + len(row["terms"]) > ITEM_TERMS):
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["terms"]))
        size += len(row["terms"])
    if block:
        yield block


def vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, n (terms with repeats), terms (numbers in ``vocabulary``) and times of documents with at least one term."""
    known = pa.array(vocabulary, pa.large_string())

    def count(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                terms, owner = term_lists(batch.column("text"))
                n = np.bincount(owner, minlength=batch.num_rows)
                number = pc.fill_null(pc.index_in(terms.dictionary, value_set=known), -1).to_numpy().astype(np.int64)
                number = number[terms.indices.to_numpy()]
                met = number >= 0
                cells, times = np.unique(owner[met] * len(vocabulary) + number[met], return_counts=True)
                per_doc = np.bincount(cells // max(len(vocabulary), 1), minlength=batch.num_rows)
                edges = pa.array(np.concatenate(([0], np.cumsum(per_doc))).astype(np.int32))
                lists = [pa.ListArray.from_arrays(edges, pa.array(x.astype(np.int32))) for x in (cells % max(len(vocabulary), 1), times)]
                found = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), *lists], names=["doc_id", "n", "terms", "times"])
                yield found.filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, times array<int>")


def weights(counted: DataFrame, vocabulary: list[str], documents: int) -> np.ndarray:
    """Weight of each term of the vocabulary; one row per term goes to the driver."""
    found = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for row in found:
        df[row["term"]] = row["df"]
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


class Shard:
    """Lists, blocks and summaries of some documents: rows of ``impact`` are documents, columns the terms they hold."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, edges: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weight: np.ndarray):
        self.ids, self.null = ids, null
        self.terms, column = np.unique(terms, return_inverse=True)
        self.weight = weight[self.terms]
        owner = np.repeat(np.arange(len(ids)), np.diff(edges))
        self.impact = np.zeros((len(ids), len(self.terms)), dtype=np.int64)
        self.impact[owner, column] = impacts * self.weight[column]
        self.most = self.impact.max(axis=0)
        order = np.argsort(column, kind="stable")
        self.holders = np.split(owner[order], np.cumsum(np.bincount(column, minlength=len(self.terms)))[:-1])
        # Directions of documents in few dimensions, for telling like from unlike.
        turn = np.random.default_rng(7).standard_normal((len(self.terms), DIMENSIONS)).astype(np.float32)
        flat = self.impact.astype(np.float32) @ turn
        self.direction = flat / np.maximum(np.linalg.norm(flat, axis=1, keepdims=True), 1e-9)
        self.blocks: dict[int, tuple[list[np.ndarray], np.ndarray]] = {}

    def blocked(self, column: int) -> tuple[list[np.ndarray], np.ndarray]:
        """(documents of each block, summaries) of a term's list; made when it is first visited."""
        if column not in self.blocks:
            docs = self.holders[column]
            heads = docs[:: max(1, len(docs) // (-(-len(docs) // BLOCK)))]
            nearest = (self.direction[docs] @ self.direction[heads].T).argmax(axis=1)
            order = np.argsort(nearest, kind="stable")
            docs, nearest = docs[order], nearest[order]
            starts = np.flatnonzero(np.diff(nearest, prepend=-1))
            summaries = np.maximum.reduceat(self.impact[docs], starts, axis=0)
            self.blocks[column] = (np.split(docs, starts[1:]), summaries)
        return self.blocks[column]

    def search(self, columns: np.ndarray, floor: int, offer) -> None:
        """Hand all documents that may score ``floor`` or more to ``offer``, which returns the floor from then on."""
        columns = columns[np.argsort(-self.most[columns], kind="stable")]
        rest = np.cumsum(self.most[columns][::-1])[::-1]
        new = np.ones(len(self.ids), dtype=bool)
        for place, column in enumerate(columns.tolist()):
            if rest[place] < max(floor, 1):
                # Documents that hold none of the terms before stay below the floor.
                return
            blocks, summaries = self.blocked(column)
            hold = summaries[:, columns].sum(axis=1) >= floor
            if not hold.any():
                continue
            docs = np.concatenate([blocks[b] for b in np.flatnonzero(hold)])
            docs = docs[new[docs]]
            new[docs] = False
            if len(docs):
                scores = self.impact[np.ix_(docs, columns)].sum(axis=1)
                use = scores >= max(floor, 1)
                floor = offer(scores[use], docs[use])


class Best:
    """The ``most`` best documents of an item so far, by score, then id, null ids first."""

    def __init__(self, most: int):
        self.most, self.floor = most, 0
        self.score, self.null, self.id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def offer(self, score: np.ndarray, null: np.ndarray, doc_id: np.ndarray) -> int:
        score, null, doc_id = (np.concatenate(x) for x in ((self.score, score), (self.null, null), (self.id, doc_id)))
        order = np.lexsort((doc_id, ~null, -score))[: self.most]
        self.score, self.null, self.id = score[order], null[order], doc_id[order]
        if len(order) == self.most:
            self.floor = int(self.score[-1])
        return self.floor


def _shards(batches: Iterator[pa.RecordBatch], most_docs: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of ``most_docs`` rows; the last may be shorter."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most_docs - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == most_docs:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def best_in_tasks(counted: DataFrame, items: list[np.ndarray], weight: np.ndarray, documents: int, terms: int, best: int) -> DataFrame:
    """item (its place in ``items``, arrays of term numbers), score, doc_id: the best of each task's documents."""
    most_docs = max(1, min(SHARD_DOCS, SHARD_CELLS // max(len(weight), 1)))

    def search(batches):
        kept = [Best(best) for _ in items]
        for table in _shards(batches, most_docs):
            table = table.combine_chunks()
            ids = table.column("doc_id").combine_chunks()
            null = pc.is_null(ids).to_numpy(zero_copy_only=False)
            ids = pc.fill_null(ids, 0).to_numpy()
            lists = [table.column(c).combine_chunks() for c in ("terms", "times")]
            numbers, times = (x.flatten().to_numpy().astype(np.int64) for x in lists)
            edges = np.concatenate(([0], np.cumsum(pc.list_value_length(lists[0]).to_numpy().astype(np.int64))))
            m = 10 + 90 * table.column("n").to_numpy() * documents // terms
            impacts = 1_000_000_000 * times // (1000 * times + 8 * np.repeat(m, np.diff(edges)))
            shard = Shard(ids, null, edges, numbers, impacts, weight)
            place = np.full(len(weight), -1, dtype=np.int64)
            place[shard.terms] = np.arange(len(shard.terms))
            for item, own in enumerate(items):
                columns = place[own]
                columns = columns[columns >= 0]
                if len(columns):
                    top = kept[item]
                    shard.search(columns, top.floor, lambda s, d, t=top: t.offer(s, shard.null[d], shard.ids[d]))
        for item, top in enumerate(kept):
            if len(top.score):
                doc_id = pa.array(top.id, pa.int64(), mask=top.null)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top.score), item)), pa.array(top.score), doc_id], names=["item", "score", "doc_id"]
                )

    met = counted.where(F.size("terms") > 0).select("doc_id", "n", "terms", "times")
    return met.mapInArrow(search, "item long, score long, doc_id long")


def ranked(found: DataFrame, best: int) -> DataFrame:
    """item, rank, doc_id, score: the best of all tasks, by slices of documents first."""
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SLICES))
    first = found.withColumn("_part", part).withColumn("_place", F.row_number().over(Window.partitionBy("item", "_part").orderBy(*order)))
    final = first.where(F.col("_place") <= best).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return final.where(F.col("rank") <= best).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` highest-scoring documents of each item, scores above 0."""
    spark = docs.sparkSession
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items):
        vocabulary = sorted({term for _, terms in block for term in terms})
        number = {term: k for k, term in enumerate(vocabulary)}
        counted = stage(vectors(docs, vocabulary), "vectors")
        documents, terms = counted.agg(F.count("*"), F.sum("n")).first()
        if not documents or not vocabulary:
            continue
        own = [np.array([number[t] for t in terms_of], dtype=np.int64) for _, terms_of in block]
        found = best_in_tasks(counted, own, weights(counted, vocabulary, documents), documents, terms, best)
        names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(block)], "item long, item_id long")
        placed = ranked(stage(found, "found"), best).join(names, "item")
        result = result.unionByName(placed.select("item_id", "rank", "doc_id", "score"))
    return result
