"""Spelling variants of words by permuterm rotations.

Each word is marked with an end sign and turned: of ``ab`` these are ``ab$``, ``b$a``, ``$ab``. Turned so that an edited character stands
last, two words that differ there agree in all that stands before it: ``a?b`` gives the prefix ``b$a`` whatever ``?`` is, and
the whole rotation ``b$a`` belongs to the one word ``ab`` that lacks the character. So the sorted rotations hold
every replacement and every indel as one prefix range. The ranges are scanned in order, and each
member gets how many near words stand with it and the best of them; pairs are not written. A range has one member per
letter of the alphabet and one more, whatever the corpus.

A deletion from a row of equal letters gives one word from several places; only the first place is counted.

Defined results: a null text has no words; a null id reads as the empty text in ``edited``; repeated rows count
as often as they occur; words are compared by code points; an empty table gives an empty one. Columns
but doc_id and text are not looked at.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm.common import stage

LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 6
LEAST_TIMES = 5
#: A near word is the form of a word if it occurs so many times as often.
RATIO = 5
#: Of the hashes of (document, run), one in so many loses a letter.
EDIT_EVERY = 199


def edited_runs(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``word`` for each run of letters, lower-cased, with the fixed share of runs that lose a letter.

    Shorter runs are left out at once, as no run grows.
    """
    found = F.regexp_extract_all("text", F.lit(f"({LETTERS}{{{least_length},}})"), 1)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    runs = runs.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % EDIT_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES) -> DataFrame:
    """word, n: distinct words long and frequent enough, counted over all documents before the shuffle."""
    words = edited_runs(docs, least_length).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_times)


def rotations(words: DataFrame) -> DataFrame:
    """key, word, n, kind: each prefix that skips one letter (kind 1, or 2 if the letter before is another), each whole rotation (0)."""
    size = F.length("word")

    def turned(after, before):
        return F.concat(F.col("word").substr(after + 1, size), F.lit("$"), F.col("word").substr(F.lit(1), before))

    letter = lambda i: F.col("word").substr(i + 1, F.lit(1))
    row = lambda key, kind: F.struct(key.alias("key"), kind.alias("kind"))
    new = lambda i: F.when((i == 0) | (letter(i) != letter(i - 1)), 2).otherwise(1)
    places = F.sequence(F.lit(0), size - 1)
    skipping = F.transform(places, lambda i: row(turned(i + 1, i), new(i)))
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: row(turned(i, i), F.lit(0)))
    return words.select("word", "n", F.inline(F.concat(skipping, whole)))


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near (words at one insertion, deletion or replacement), best: struct (n, word) of the most frequent of them."""
    ranges = Window.partitionBy("key").orderBy(F.desc("n"), "word")
    whole = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    this = F.struct("n", "word")
    scanned = rotations(words).select(
        "word",
        "kind",
        F.row_number().over(ranges).alias("place"),
        F.first(this).over(whole).alias("first"),
        F.nth_value(this, 2).over(whole).alias("second"),
        F.sum((F.col("kind") > 0).cast("int")).over(whole).alias("skipping"),
        F.sum((F.col("kind") == 2).cast("int")).over(whole).alias("new"),
        F.sum((F.col("kind") == 0).cast("int")).over(whole).alias("whole"),
    )
    # In a range are words that skip a letter here and at most one that lacks it.
    met = scanned.where("skipping > 0 and skipping + whole > 1")
    count = F.when(F.col("kind") == 0, F.col("new")).otherwise(
        F.col("skipping") - 1 + F.when(F.col("kind") == 2, F.col("whole")).otherwise(0)
    )
    best = F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("first"))
    ranked = met.select("word", count.alias("near"), F.struct((-best["n"]).alias("n"), best["word"].alias("word")).alias("best"))
    found = ranked.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return found.select("word", "n_near", F.struct((-F.col("best.n")).alias("n"), F.col("best.word").alias("word")).alias("best"))


def roots(links: DataFrame, hops: int) -> DataFrame:
    """word, root: the last of the chain word, form, form of the form... by doubling, for chains of at most ``hops``."""
    reached = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(hops, 1)))):
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = reached.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"))
        reached = stage(joined, "roots")
    return reached


def grouped_words(words: DataFrame, ratio: int = RATIO, least_times: int = LEAST_TIMES) -> DataFrame:
    """word, n, form, form_n, n_near, root for a vocabulary (word, n) in which each word occurs ``least_times`` or more."""
    words = stage(words, "words")
    found = words.join(near_words(words), "word", "left")
    is_form = F.col("best.n") >= ratio * F.col("n")
    formed = stage(
        found.select(
            "word",
            "n",
            F.when(is_form, F.col("best.word")).alias("form"),
            F.when(is_form, F.col("best.n")).alias("form_n"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        ),
        "forms",
    )
    most = words.agg(F.max("n")).first()[0] or least_times
    # Each form occurs ``ratio`` times as often as the word before it.
    hops = math.floor(math.log(max(most / least_times, 1), ratio) + 1e-9)
    links = formed.where("form is not null").select("word", "form")
    rooted = formed.join(roots(links, hops), "word", "left")
    return rooted.withColumn("root", F.coalesce("root", "word")).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words of whole texts."""
    return grouped_words(vocabulary(docs))
