"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftledger.llm import exact_stream, host_reputation, language, lexical_search, mixing, ngram_join, packing, paragraphs
from shiftledger.llm import permuterm, phrases, sharding, token_files, toxicity
from shiftledger.llm.common import documents
from shiftledger.llm.tokens import tokenizer_path

def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op2_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity_report(documents(spark, sf_dir), labels)


def op4_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_to_orc(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_substrings(documents(spark, sf_dir))


def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the operator that looks at whole lines, which SQL can express."""
    return paragraphs.repeated_paragraphs(documents(spark, sf_dir))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op8_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.fingerprint_report(documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_stream.dedup_report(documents(spark, sf_dir))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permuterm.spelling_variants(documents(spark, sf_dir))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("pages", "labels"))
    judged = host_reputation.judge_urls(pages, labels)
    return judged.select("page_id", "host", "path", "rule", "verdict", "labelled", "good")


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_extendible_sharding,
        op3_toxicity,
        op4_token_orc,
        op5_substring_dedup,
        op5_paragraph_dedup,
        op6_ngram_join,
        op7_mixing,
        op8_phrase_fingerprints,
        op9_exact_dedup,
        op10_language,
        op11_spelling_variants,
        op12_lexical_search,
        op13_url_filter,
    )
}
