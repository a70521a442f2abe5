"""Mixing sources to target weights by subset sums over document lengths.

Targets follow the weights up to a cap per source. A source whose target is at least its size gives every
document once; the rest of each target is met by a subset of its documents, chosen by counts per exact length:
first the same share of each length, then bounded-knapsack dynamic programming over the lengths still available
for what remains. Which documents of a length are taken is decided by a seeded hash.

Defined results: a null text has size 0; a null source is a source of its own, after all others; documents of
size 0 are never taken; rows with equal ids are documents of their own; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm.common import WORD, rank_within, stage

#: Largest remainder, in words, that the dynamic programme fills.
DP_WIDTH = 1 << 16
#: Largest remainder that it fills where very long documents keep the other steps from coming near.
WIDE = 1 << 22


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: str = "source") -> Column:
    """Source as a key without nulls; sorts by code point, null last."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(key, source_size, target) from (key, size): one row per source.

    Sharing the excess of capped sources again and again ends where each target is the smaller of its cap and
    a common level times its weight. Sources are taken by rising cap per weight; the level is the first at
    which the sources not yet capped can hold what the capped ones leave.
    """
    sources = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy("key")
    place = F.row_number().over(in_order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighted = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * cap)
    rising = Window.orderBy(F.col("most") / F.col("weight"), "key")
    earlier = rising.rowsBetween(Window.unboundedPreceding, -1)
    later = rising.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * share - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    ) / F.sum("weight").over(later)
    levels = weighted.withColumn("level", level)
    free = F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "key", "level")))
    found = levels.withColumn("common", free.over(everything)["level"])
    target = F.when(F.col("common").isNull(), F.col("most")).otherwise(F.least("most", F.col("common") * F.col("weight")))
    return found.select("key", "source_size", target.alias("target"))


def fill_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their sum is near ``budget`` and never above it."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    # The same share of each length, in whole numbers: the integer division never overshoots.
    taken = np.array([int(c) * budget // total for c in counts], dtype=np.int64)
    left = counts - taken
    rest = budget - int((taken * lengths).sum())
    shared, open_budget = taken.copy(), rest
    falling = np.argsort(-lengths, kind="stable")
    for i in falling:
        # Long ones by count, until the programme below can reach the rest.
        if rest <= DP_WIDTH:
            break
        more = min(int(left[i]), (rest - DP_WIDTH // 2) // int(lengths[i]))
        if more > 0:
            taken[i], left[i] = taken[i] + more, left[i] - more
            rest -= more * int(lengths[i])
    if rest > DP_WIDTH * 2:
        # All left are longer than rest - DP_WIDTH / 2, so one more fits at most: the longest that does.
        for i in falling:
            if left[i] and lengths[i] <= rest:
                taken[i], left[i] = taken[i] + 1, left[i] - 1
                rest -= int(lengths[i])
                break
    result = taken + _knapsack(lengths, left, min(rest, DP_WIDTH * 2))
    if budget - int((result * lengths).sum()) > DP_WIDTH // 2 and open_budget <= WIDE:
        # Very long documents kept these steps from coming near: the programme alone finds the best sum.
        result = shared + _knapsack(lengths, counts - shared, open_budget)
    return result


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: the largest reachable sum up to ``budget``. Reached sums are bits of one whole number.

    A length with n documents becomes packs of 1, 2, 4, ... documents. ``by`` notes the pack that first
    reached a sum, so walking back meets packs in falling order, each once.
    """
    chosen = np.zeros(len(lengths), dtype=np.int64)
    if budget <= 0:
        return chosen
    mask, reached = (1 << (budget + 1)) - 1, 1
    by = np.full(budget + 1, -1, dtype=np.int64)
    packs: list[tuple[int, int]] = []
    for i, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        size = 1
        count = min(count, budget // length)
        while count > 0:
            size = min(size, count)
            new = (reached << (length * size)) & mask & ~reached
            if new:
                raw = np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), dtype=np.uint8)
                by[np.flatnonzero(np.unpackbits(raw, bitorder="little")[: budget + 1])] = len(packs)
                reached |= new
            packs.append((i, size))
            count, size = count - size, size * 2
            if reached >> budget & 1:
                break
        if reached >> budget & 1:
            break
    at = reached.bit_length() - 1
    while at:
        i, size = packs[by[at]]
        chosen[i] += size
        at -= size * int(lengths[i])
    return chosen


def _choose(group: pd.DataFrame) -> pd.DataFrame:
    """One source's lengths: how often each document is taken for sure, and how many of a length once more."""
    # Rows arrive in any order; the choice must not depend on it.
    group = group.sort_values("size", ignore_index=True)
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    sure = int(target // size)
    more = fill_budget(group["size"].to_numpy(), group["n"].to_numpy(), int(target) - sure * size)
    return pd.DataFrame({"key": group["key"], "size": group["size"], "sure": sure, "more": more})


def sized(rows: DataFrame) -> DataFrame:
    """number, doc_id, digest (of the text), key and size of rows (number, doc_id, text, source): one pass over the texts, written."""
    narrow = rows.select("number", "doc_id", F.xxhash64("text").alias("digest"), _source_key().alias("key"), word_count().alias("size"))
    return stage(narrow, "sizes")


def taken_times(
    narrow: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 7
) -> DataFrame:
    """number, doc_id, size, source_size, target and times (how often the mix takes the document) of ``sized`` rows.

    The table per source and length grows with the longest text, not with the corpus.
    """
    lengths = narrow.groupBy("key", "size").agg(F.count("*").alias("n"))
    targets = source_targets(lengths.select("key", (F.col("size") * F.col("n")).alias("size")), weights, share, cap)
    positive = lengths.where("size > 0").join(targets, "key")
    quotas = positive.groupBy("key").applyInPandas(_choose, "key string, size long, sure int, more long")
    order = [F.col("doc_id"), F.col("digest")]
    ranked = rank_within(narrow, ["key", "size"], F.xxhash64("doc_id", F.lit(seed)), order, "rank")
    times = F.coalesce(F.col("sure") + (F.col("rank") < F.col("more")).cast("int"), F.lit(0))
    joined = ranked.join(targets, "key").join(quotas, ["key", "size"], "left")
    return joined.select("number", "doc_id", "size", "source_size", "target", times.alias("times"))


def _numbered(docs: DataFrame) -> DataFrame:
    """Whole rows as one column, with a written number that tells them apart."""
    return stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")), "mix-rows")


def _parts(rows: DataFrame) -> DataFrame:
    return rows.select("number", "row.doc_id", "row.text", "row.source")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 7) -> DataFrame:
    """Add size, source_size, target and times (how often the mix takes the document) to documents.

    Needs doc_id, text and source; keeps ``docs``' columns but those it adds and a few names of its own.
    """
    own = ("size", "source_size", "target", "times", "key", "n", "sure", "more", "_rank")
    kept = [c for c in docs.columns if c not in own]
    rows = _numbered(docs)
    times = taken_times(sized(_parts(rows)), weights, share, cap, seed).drop("doc_id")
    return rows.join(times, "number").select(*[F.col("row")[c].alias(c) for c in kept], "size", "source_size", "target", "times")


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted). No text is shuffled."""
    numbered = docs.select(F.monotonically_increasing_id().alias("number"), "doc_id", "text", "source")
    mixed = taken_times(sized(numbered))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its columns whatever their names. Texts are joined last."""
    rows = _numbered(docs)
    times = taken_times(sized(_parts(rows))).where("times > 0").select("number", "times")
    return rows.join(times, "number").select(F.explode(F.array_repeat("row", F.col("times"))).alias("row")).select("row.*")
