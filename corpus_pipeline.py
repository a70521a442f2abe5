"""A training corpus from documents: language, exact and near duplicates, mixing, packing.

Each stage gets what the one before kept, written as Parquet in the shared folder and read again. All stages but the last return
the columns of documents; the mix repeats a document's row as often as it is taken, and the last stage places
the pieces of every row in sequences.

Defined results, by stage. Language: a null text, an empty one and one without letters go; each row is judged by its own text, whatever its
id. Exact: of equal texts the row with the least id stays, null ids last, of equal ids one. Near: the same rule within each group; rows with
other texts stay even where ids repeat or lack. Mixing: a null source is a source of its own; documents of no words are not taken.
Packing: every row is packed as a document of its own, repeats too. Columns are carried whatever their names; an empty
table gives an empty one in each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftledger.llm import exact_stream, language, mixing, ngram_join, packing
from shiftledger.llm.common import documents, stage
from shiftledger.llm.tokens import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognised language."""
    return language.recognised(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each normalised text."""
    return exact_stream.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by 5-word n-grams at a Jaccard index of 0.8 or more."""
    return ngram_join.one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out whole documents until each source meets its target."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all rows into sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Training, state and signatures have no SQL form; the tests follow the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
