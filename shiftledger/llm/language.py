"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of 1 to 3 lower-case characters are hashed to ``WIDTH`` features. Document frequencies are counted over all
training documents. The classifier is trained by follow-the-regularised-leader with L1 and L2 penalties, which keeps
most weights at exactly zero, on a bounded, seeded sample: at most ``SAMPLE`` documents per language. A part of that
sample is kept from training to fit one temperature, which makes the largest class probability a usable score.

Training happens in the driver on the sample's features (at most ``SAMPLE`` documents per language, each with at most ``WIDTH``
features, of their whole texts); everything else runs over all documents.

Defined results: a text without letter (null and empty among them) is ``und`` with score 0; without training documents
every text is; rows with equal ids fall into the same fold; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.llm.common import arrow_batch_bytes, in_fold, stage
from shiftledger.llm.tokens import release_encoder, slices

WIDTH = 1 << 15
#: Bound of the training sample, distinct documents per language, in equal parts from so many slices of a hash.
SAMPLE = 1024
SAMPLE_SLICES = 64
EPOCHS = 4
UNKNOWN = "und"
#: Text bytes turned into features at a time; a slice takes about a hundred times as many bytes of tables.
SLICE = 1 << 18
BATCH_BYTES = "4m"

#: Settings of follow-the-regularised-leader: learning rate, its damping, L1 and L2 penalty.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.01

_LETTER = r"\p{L}"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, counts, number of features per text): each text's distinct hashed n-grams, sorted."""
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")).to_pylist()
    sizes = np.array([len(t) for t in lowered], dtype=np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(lowered), dtype=np.int64), sizes)
    keys = []
    value = np.zeros(len(points), dtype=np.uint64)
    for n in range(3):
        if len(points) <= n:
            break
        value = (value[: len(points) - n] + points[n:] + np.uint64(1)) * _STEP
        value ^= value >> np.uint64(29)
        inside = owner[n:] == owner[: len(points) - n]
        hashed = (value >> np.uint64(64 - 15)).astype(np.int64)
        keys.append((owner[: len(points) - n] * WIDTH + hashed)[inside])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(lowered), np.int64)
    joined = np.concatenate(keys)
    # A small slice has a table of all its (text, feature) cells; texts are short against it.
    if len(lowered) * WIDTH <= 4 * len(joined):
        cells = np.bincount(joined, minlength=len(lowered) * WIDTH)
        found = np.flatnonzero(cells)
        often = cells[found]
    else:
        found, often = np.unique(joined, return_counts=True)
    return found % WIDTH, often, np.bincount(found // WIDTH, minlength=len(lowered))


@dataclass
class Model:
    """Languages, weights (feature x language), bias, inverse document frequency and temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    temperature: float = 1.0

    def scores(self, features: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Class scores of texts given by their features one after the other."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        value = (1 + np.log(counts)) * self.idf[features]
        norm = np.sqrt(np.bincount(owner, value * value, minlength=len(sizes)))
        columns = [np.bincount(owner, value * self.weights[features, k], minlength=len(sizes)) for k in range(len(self.languages))]
        return np.stack(columns, axis=1) / np.maximum(norm, 1e-12)[:, None] + self.bias


def _softmax(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return grown / grown.sum(axis=-1, keepdims=True)


def train_ftrl(
    row: Callable[[int], tuple[np.ndarray, np.ndarray]], used: np.ndarray, labels: np.ndarray, classes: int, epochs: int = EPOCHS
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias from the (features, unit-length values) that ``row`` gives for the numbers ``used``, one at a time, in a seeded order."""
    z = np.zeros((WIDTH + 1, classes))
    squares = np.zeros((WIDTH + 1, classes))

    def weights(at):
        return np.where(
            np.abs(z[at]) <= L1, 0.0, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(squares[at])) / ALPHA + L2)
        )

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(used)):
            features, values = row(used[i])
            at, x = np.append(features, WIDTH), np.append(values, 1.0)
            w = weights(at)
            error = _softmax(x @ w)
            error[labels[i]] -= 1.0
            gradient = x[:, None] * error[None, :]
            grown = squares[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(squares[at])) / ALPHA * w
            squares[at] = grown
    w = weights(np.arange(WIDTH + 1))
    return w[:-1], w[-1]


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least log loss, by bisection of its logarithm's slope."""
    if not len(labels):
        return 1.0
    low, high = -3.0, 3.0
    for _ in range(40):
        middle = (low + high) / 2
        scaled = scores / np.exp(middle)
        slope = ((_softmax(scaled) * scaled).sum(axis=1) - scaled[np.arange(len(labels)), labels]).mean()
        # The loss falls with a larger divisor while the expected score exceeds that of the true class.
        low, high = (middle, high) if slope > 0 else (low, middle)
    return float(np.exp((low + high) / 2))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and in how many each feature occurs; at most WIDTH rows reach the driver."""

    def count(batches):
        release_encoder()
        total = np.zeros(WIDTH + 1, dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                features, _, sizes = gram_features(batch.column("text"))
                total[:WIDTH] += np.bincount(features, minlength=WIDTH)
                total[WIDTH] += len(sizes)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"feature": found, "n": total[found]})

    rows = docs.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    frequencies = np.zeros(WIDTH + 1, dtype=np.int64)
    for r in rows:
        frequencies[r["feature"]] = r["n"]
    return int(frequencies[WIDTH]), frequencies[:WIDTH]


def training_rows(training: DataFrame, sample: int) -> DataFrame:
    """A seeded sample of about ``sample`` documents per language, fewer where a language has few: lang, features, counts of whole texts."""
    # Ranked on hashes alone and within slices of them, so that no language meets in one task; rows with equal id and text are one.
    keyed = training.withColumn("key", F.xxhash64("doc_id", "text"))
    slice_of = F.pmod(F.xxhash64("key"), F.lit(SAMPLE_SLICES))
    first = Window.partitionBy("lang", "_slice").orderBy("key")
    most = -(-sample // SAMPLE_SLICES)
    ranked = keyed.groupBy("lang", "key").agg(slice_of.alias("_slice")).withColumn("_n", F.row_number().over(first))
    chosen = ranked.where(F.col("_n") <= most).select("lang", "key")
    # At most ``sample`` rows per language.
    texts = keyed.join(F.broadcast(chosen), ["lang", "key"], "left_semi").select("lang", "key", "text")

    def featurise(batches):
        release_encoder()
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                features, counts, sizes = gram_features(batch.column("text"))
                ends = np.concatenate(([0], np.cumsum(sizes))) * 4
                blobs = [
                    pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(v.astype("<i4"))])
                    for v in (features, counts)
                ]
                yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("key"), *blobs], names=["lang", "key", "features", "counts"])

    found = texts.mapInArrow(featurise, "lang string, key long, features binary, counts binary")
    return found.groupBy("lang", "key").agg(F.any_value("features").alias("features"), F.any_value("counts").alias("counts")).drop("key")


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from documents with a language: doc_id, text, lang."""
    training = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    number, frequencies = document_frequencies(training)
    idf = np.log((1 + number) / (1 + frequencies)) + 1
    # Partition by partition, so neither the JVM nor Python of the driver holds the sample more than once.
    rows = sorted((r["lang"], r["features"], r["counts"]) for r in training_rows(training, sample).toLocalIterator())
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((WIDTH, 0)), np.zeros(0), idf)
    labels = np.array([languages.index(r[0]) for r in rows])
    held = np.random.default_rng(5).random(len(rows)) < 0.15

    def prepared(i: int) -> tuple[np.ndarray, np.ndarray]:
        """A row's features and its values at unit length; made anew each time, as all of them take several times the sample."""
        features = np.frombuffer(rows[i][1], "<i4").astype(np.int64)
        values = (1 + np.log(np.frombuffer(rows[i][2], "<i4").astype(np.int64))) * idf[features]
        return features, values / max(np.sqrt((values * values).sum()), 1e-12)

    used = np.flatnonzero(~held)
    weights, bias = train_ftrl(prepared, used, labels[used], len(languages))
    model = Model(languages, weights, bias, idf)
    if held.any():
        kept = np.flatnonzero(held)
        scores = np.stack([values @ weights[features] + bias for features, values in map(prepared, kept)])
        model.temperature = fit_temperature(scores, labels[kept])
    return model


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, lang_pred and score (calibrated probability of the predicted language) for every text."""

    def guess(batches):
        release_encoder()
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                texts = batch.column("text")
                letters = pc.match_substring_regex(pc.fill_null(texts, ""), _LETTER).to_numpy(zero_copy_only=False)
                names, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
                if model.languages:
                    chances = _softmax(model.scores(*gram_features(texts)) / model.temperature)
                    best = chances.argmax(axis=1)
                    names = np.where(letters, np.array(model.languages, dtype=object)[best], UNKNOWN)
                    score = np.where(letters, chances[np.arange(len(best)), best], 0.0)
                arrays = [*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "lang_pred", "score"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*(docs.schema[c] for c in keep), *added])
    return docs.select(*keep, "text").mapInArrow(guess, schema)


def _held_out() -> Column:
    return in_fold("doc_id", 5, 0)


def language_report(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learns from documents that are not held out."""
    model = train(docs.where(~_held_out()), sample)
    return predict(docs, model).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame, least_score: float = 0.4, sample: int = SAMPLE) -> DataFrame:
    """Documents with a language: those without letters, and those of which no language reaches ``least_score``, go.

    Each row is judged by its own text; all columns are kept.
    """
    model = train(docs.where(~_held_out()), sample)
    judged = predict(docs.select(F.struct("*").alias("_all"), "text"), model, keep=("_all",))
    kept = judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("_all.*")
    # Whole rows pass through Python here, in batches bounded by bytes.
    with arrow_batch_bytes(docs.sparkSession, BATCH_BYTES):
        return stage(kept, "recognised")

