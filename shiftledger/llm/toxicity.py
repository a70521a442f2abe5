"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier on the distinct words of a text is trained from texts confirmed as toxic and from unlabelled texts only.
The class prior, the share of toxic texts among the labelled ones, corrects the risk: unlabelled texts count as clean ones, less
the share of toxic texts among them. That difference may not fall below zero, which would mean that the classifier learns
the sample by heart; then the step goes back. A proximal L1 step keeps most weights at exactly zero; a word's penalty is at
least the sampling noise of its slope, so that small samples do not learn chance. Labelled texts may hold more toxic ones than the
rest: the scores bound the prior from above (no share of unlabelled texts above a score may be less than the prior times that of
toxic ones), and where this bound is lower, training is repeated with it.

Training is bounded: at most ``POSITIVES`` toxic and ``UNLABELLED`` other texts, chosen by a seeded hash of their ids, in the
driver's numpy; scores are made over all documents in Arrow tasks.

Defined results: null and empty texts have no word and get the score of that; without a toxic label all scores are the prior (0
without labels); of several labels of an id, toxic wins; rows with equal ids fall into the same fold; an empty table gives
an empty one.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import in_fold
from shiftledger.llm.tokens import slices

#: Bounds of the training sample, in documents.
POSITIVES, UNLABELLED = 2500, 6000
#: Words in fewer sampled texts have no weight.
LEAST_TEXTS = 8
STEPS, RATE, L1 = 300, 0.05, 0.0004
THRESHOLD = 0.3
SLICE = 4 << 20

_EDGES = string.punctuation + "«»„“”‚‘’¡¿…"


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the distinct words met, word numbers of all texts one after the other, their owners)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()).astype(np.int64))
    coded = pc.dictionary_encode(lists.flatten())
    words = np.array([w.strip(_EDGES).lower() for w in coded.dictionary.to_pylist()], dtype=object)
    hashes = pd.util.hash_array(words, categorize=False) if len(words) else np.zeros(0, np.uint64)
    return hashes, coded.indices.to_numpy().astype(np.int64), owner


@dataclass
class Model:
    """Hashes of words with a weight, ascending, their weights and the bias."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def of_words(self, rows: list[np.ndarray]) -> np.ndarray:
        """Scores of rows of distinct word hashes."""
        known = [self.weights[np.isin(self.words, row, assume_unique=True)].sum() for row in rows]
        return 1 / (1 + np.exp(-(np.array(known) + self.bias)))

    def scores(self, texts: pa.Array) -> np.ndarray:
        hashes, codes, owner = distinct_words(texts)
        weight = np.zeros(len(hashes))
        number = np.zeros(len(hashes), dtype=np.int64)
        if len(self.words) and len(hashes):
            number = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            weight = np.where(self.words[number] == hashes, self.weights[number], 0.0)
        counts = weight[codes] != 0
        pairs = np.unique(owner[counts] * (len(self.words) + 1) + number[codes[counts]])
        total = np.bincount(pairs // (len(self.words) + 1), self.weights[pairs % (len(self.words) + 1)] if len(pairs) else None, minlength=len(texts))
        return 1 / (1 + np.exp(-(total + self.bias)))


def train_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Minimise the non-negative risk over rows of distinct word hashes."""
    rows = [*positive, *unlabelled]
    sizes = np.array([len(r) for r in rows])
    vocabulary, column, often = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    kept = often >= LEAST_TEXTS
    number = np.cumsum(kept) - 1
    owner = np.repeat(np.arange(len(rows)), sizes)[kept[column]]
    column = number[column[kept[column]]]
    width = int(kept.sum())
    is_positive = np.arange(len(rows)) < len(positive)
    seen = np.bincount(column[~is_positive[owner]], minlength=width) / max(1, len(unlabelled))
    noise = prior * np.sqrt(seen * (1 - seen) * (1 / max(1, len(positive)) + 1 / max(1, len(unlabelled))))
    penalty = np.maximum(L1, noise)
    share = np.where(is_positive, 1 / max(1, len(positive)), 1 / max(1, len(unlabelled)))
    weights, bias = np.zeros(width), float(np.log(prior / (1 - prior)))
    mean, spread = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        score = np.bincount(owner, weights[column], minlength=len(rows)) + bias
        chance = 1 / (1 + np.exp(-score))
        loss = np.logaddexp(0, score)
        clean = (loss * share)[~is_positive].sum() - prior * (loss * share)[is_positive].sum()
        # Slopes by score: toxic texts as toxic, and the corrected risk of clean ones.
        toxic_slope = np.where(is_positive, prior * share * (chance - 1), 0.0)
        clean_slope = np.where(is_positive, -prior, 1.0) * share * chance
        slope = toxic_slope + clean_slope if clean >= 0 else -clean_slope
        gradient = np.append(np.bincount(column, slope[owner], minlength=width), slope.sum())
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient * gradient
        change = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-5)
        weights, bias = weights - change[:-1], bias - float(change[-1])
        shrink = RATE * penalty / (np.sqrt(spread[:-1] / (1 - 0.99**step)) + 1e-5)
        weights = np.sign(weights) * np.maximum(np.abs(weights) - shrink, 0.0)
    used = weights != 0
    return Model(vocabulary[kept][used], weights[used], bias)


def train_bounded(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Train with the given prior, and again if the scores show that it is too high."""
    model = train_nnpu(positive, unlabelled, prior)
    bound = prior_bound(model.of_words(positive), model.of_words(unlabelled))
    return train_nnpu(positive, unlabelled, bound) if 0 < bound < prior else model


def prior_bound(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Upper bound of the share of toxic texts among unlabelled ones, from scores of both.

    Of the unlabelled texts above any score, the toxic ones alone are the prior times the share of toxic texts above it. Each
    share is given one standard error to the safe side.
    """
    at = np.unique(positive)
    above = [1 - np.searchsorted(np.sort(x), at) / len(x) for x in (positive, unlabelled)]
    error = [np.sqrt(a * (1 - a) / len(x)) for a, x in zip(above, (positive, unlabelled), strict=True)]
    low, high = above[0] - error[0], above[1] + error[1]
    return float(min(1.0, (high[low > 0] / low[low > 0]).min(initial=1.0)))


def held_out() -> Column:
    return in_fold("doc_id", 4, 2)


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Learn from rows of ``docs`` (doc_id, text) and of ``labels`` (doc_id, toxic) given; leave held-out ones out before."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    seen = known.agg(F.count("*"), F.coalesce(F.avg((F.col("toxic") == 1).cast("double")), F.lit(0.0))).first()
    prior = seen[1]
    # Ids only; the first by hash are kept per task before they meet.
    order = [F.xxhash64("doc_id", F.lit(17)), "doc_id"]
    ids = docs.select("doc_id").where("doc_id is not null")
    first = known.where("toxic = 1").select("doc_id").orderBy(*order).limit(positives).withColumn("toxic", F.lit(1))
    other = ids.orderBy(*order).limit(unlabelled).withColumn("toxic", F.lit(0))
    chosen = F.broadcast(first.unionByName(other))
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")

    def featurise(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                hashes, codes, owner = distinct_words(batch.column("text"))
                ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
                found = [np.unique(hashes[codes[a:b]]).astype("<u8").tobytes() for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.binary())], names=["toxic", "words"])

    rows = sorted((r["toxic"], bytes(r["words"])) for r in texts.select("toxic", "text").mapInArrow(featurise, "toxic int, words binary").collect())
    sets = {k: [np.frombuffer(w, "<u8").astype(np.uint64) for t, w in rows if t == k] for k in (0, 1)}
    if not sets[1] or not sets[0] or not 0 < prior < 1:
        chance = min(max(prior, 1e-9), 1 - 1e-9)
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(chance / (1 - chance))))
    return train_bounded(sets[1], sets[0], prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text."""

    def judge(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                found = pa.array(model.scores(batch.column("text")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(judge, "doc_id long, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted; learns from rows that are not held out."""
    model = train(docs.where(~held_out()), labels.where(~held_out()))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))
