"""Document fingerprints by locally consistent parsing.

A text is a row of symbols. Deterministic coin tossing turns neighbouring, different symbols into labels of a few bits that
depend on a fixed number of symbols to the left; places with a locally greatest label end a phrase. A phrase's name is
a hash of its symbols, and names are the symbols of the next level. Whether a place ends a phrase depends on a few symbols
around it only, so equal stretches of two texts get the same names but near their ends, at whatever offset they lie.

The fingerprint keeps, of the names of each level, the least hashes (bottom-k, ``SKETCHES`` by level; the lowest two bits tell the
level). Likeness estimates the Jaccard index of two texts' name sets level by level and weighs the levels by the names they
compare and by the length of their phrases: a long text is told by its long phrases, a short one, which has hardly
any, by the shorter ones. All texts are compared in the same way.

Defined results: a null text is empty; the fingerprint of the empty text is empty; likeness of two empty fingerprints is 1,
of an empty and another 0; rows come in descending doc_id, nulls last, equal ids by text; a single row is its own
next document; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names kept of each level, from the shortest phrases on.
SKETCHES = (32, 64, 128)
#: How much longer phrases are from level to level.
GROWTH = 3
#: Characters parsed at once.
BATCH_CHARS = 1 << 20
#: Text bytes per partition, as a guide to their number.
PART_BYTES = 16 << 20

_FOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _reduce(labels: np.ndarray, head: np.ndarray) -> np.ndarray:
    """One round of coin tossing: twice the place of the lowest bit that differs from the left neighbour, plus that bit."""
    left = np.empty_like(labels)
    left[0], left[1:] = ~labels[0], labels[:-1]
    left[head] = ~labels[head]
    differs = labels ^ left
    lowest = differs & (~differs + np.uint64(1))
    place = np.log2(lowest.astype(np.float64)).astype(np.uint64)
    return place * np.uint64(2) + ((labels >> place) & np.uint64(1))


def fold(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level up: (phrase names, owner). ``owner`` tells texts apart and only rises."""
    if not len(names):
        return names, owner
    # A run of one symbol is one symbol with a count, so that neighbours differ.
    first = np.ones(len(names), dtype=bool)
    first[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    run = np.diff(np.append(at, len(names))).astype(np.uint64)
    symbols, owner = _mix(names[at] + run * _FOLD), owner[at]
    head = np.ones(len(symbols), dtype=bool)
    head[1:] = owner[1:] != owner[:-1]
    labels = symbols
    # 64 bits become 7, then 4, then 3: three rounds leave labels below 8.
    for _ in range(3):
        labels = _reduce(labels, head)
    level = labels.astype(np.int8)
    top = np.zeros(len(level), dtype=bool)
    top[1:-1] = (level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])
    # A text's first symbol has no left neighbour; the text before it must not matter.
    top[head] = False
    start = head.copy()
    start[1:] |= top[:-1]
    begins = np.flatnonzero(start)
    size = np.diff(np.append(begins, len(symbols)))
    place = np.arange(len(symbols)) - np.repeat(begins, size)
    # The order within a phrase counts: each symbol is mixed with its place before they are added up.
    phrase = np.add.reduceat(_mix(symbols + (place.astype(np.uint64) + np.uint64(1)) * _FOLD), begins)
    return _mix(phrase), owner[begins]


def _least(names: np.ndarray, edges: np.ndarray, most: int, level: int) -> list[np.ndarray]:
    """The ``most`` least distinct names of each text, marked with their level; names of a text lie between its edges."""
    names = (names & ~np.uint64(3)) | np.uint64(level)
    sizes = np.diff(edges)
    # Of many names only those below a bound are sorted; where copies make them too few, all are.
    share = np.minimum(1.0, 2.5 * most / np.maximum(sizes, 1))
    bound = np.repeat(np.where(share < 1, share * 2.0**64, np.inf), sizes)
    low = names < bound
    kept, at = names[low], np.concatenate(([0], np.cumsum(low)))[edges]
    result = []
    for k, (a, b) in enumerate(zip(at.tolist(), at[1:].tolist(), strict=False)):
        found = np.unique(kept[a:b])
        if len(found) < most and share[k] < 1:
            found = np.unique(names[edges[k] : edges[k + 1]])
        result.append(found[:most])
    return result


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The least phrase names of all levels of each text, level after level."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    names, owner = _mix(points.astype(np.uint64) + np.uint64(1)), np.repeat(np.arange(len(texts)), sizes)
    levels = []
    for level, most in enumerate(SKETCHES):
        names, owner = fold(names, owner)
        levels.append(_least(names, np.searchsorted(owner, np.arange(len(texts) + 1)), most, level))
    return [np.concatenate(parts) for parts in zip(*levels, strict=True)]


def as_text(values: np.ndarray) -> str:
    return base64.b64encode(values.astype("<u8").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype="<u8")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Weighed mean of the levels' Jaccard indices, each estimated on the least names of the union; exact while both fit."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    total = weight = 0.0
    level_a, level_b = a & np.uint64(3), b & np.uint64(3)
    for level, most in enumerate(SKETCHES):
        x, y = a[level_a == level], b[level_b == level]
        union = np.union1d(x, y)
        if len(x) == most or len(y) == most:
            union = union[:most]
        both = np.intersect1d(x, y, assume_unique=True)
        shared = np.count_nonzero(both <= union[-1]) if len(union) else 0
        factor = len(union) * GROWTH**level / most
        total, weight = total + factor * shared / max(len(union), 1), weight + factor
    return float(total / weight)


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """Sketches of texts, parsed together in stretches of about ``BATCH_CHARS`` characters."""
    result, group, size = [], [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= BATCH_CHARS:
            result += sketches(group)
            group, size = [], 0
    return result + sketches(group) if group else result


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as many first characters of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _dealer(bounds: np.ndarray, leads: dict[int, tuple[int | None, int]] | None):
    """An Arrow task that adds ``part`` and ``ahead``; the first documents of a range (``leads``: part to id and the
    range before) are sent to the range before as well."""

    def deal(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            none = ids.is_null().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy()
            part = np.searchsorted(bounds, -values, side="right")
            part[none] = len(bounds)
            rows, ahead = np.arange(len(part)), np.zeros(len(part), dtype=bool)
            if leads:
                first = [
                    k for k, (p, v, n) in enumerate(zip(part.tolist(), values.tolist(), none.tolist(), strict=True))
                    if leads[p][0] == (None if n else v)
                ]
                before = [leads[p][1] for p in part[first].tolist()]
                rows = np.concatenate([rows, np.array(first, dtype=np.int64)])
                part = np.concatenate([part, np.array(before, dtype=np.int64)])
                ahead = np.concatenate([ahead, np.ones(len(first), dtype=bool)])
            columns = [c.take(pa.array(rows)) for c in batch.columns]
            names = [*batch.schema.names, "part", "ahead"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(part.astype(np.int32)), pa.array(ahead)], names=names)

    return deal


def ranged(docs: DataFrame) -> tuple[DataFrame, int]:
    """Documents in ranges of descending doc_id (part), each range followed by the next one's first document (ahead).

    The bounds are quantiles of the ids. The driver sees one id per range.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size, ids = rows.agg(F.sum(F.octet_length("text")), F.count("doc_id")).first()
    wanted = min(max(1, (size or 0) // PART_BYTES + 1), max(1, ids))
    quantiles = [k / wanted for k in range(1, wanted)]
    found = rows.stat.approxQuantile("doc_id", quantiles, 0.2 / wanted) if quantiles else []
    bounds = np.array(sorted({-int(b) for b in found}), dtype=np.int64)
    only_ids = rows.select("doc_id").mapInArrow(_dealer(bounds, None), "doc_id long, part int, ahead boolean")
    heads = {r["part"]: r["head"] for r in only_ids.groupBy("part").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)
    leads = {part: (heads[part], order[k - 1]) for k, part in enumerate(order)}
    return rows.mapInArrow(_dealer(bounds, leads), "doc_id long, text string, part int, ahead boolean"), len(bounds) + 1


def neighbours(docs: DataFrame) -> DataFrame:
    """Per partition: its documents in descending doc_id, then the first one of the next range."""
    sent, parts = ranged(docs)
    return sent.repartitionById(parts, F.col("part")).sortWithinPartitions("ahead", F.col("doc_id").desc_nulls_last(), "text")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Texts are shuffled once. A partition is read as a stream; only one batch of texts is in memory.
    """

    def report(batches):
        waiting: list[tuple] = []
        done = False
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                rows = list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "ahead")), strict=True))
                if done:
                    continue
                for k, row in enumerate(rows):
                    if row[2]:
                        rows, done = rows[: k + 1], True
                        break
                waiting += rows
                if len(waiting) > 1:
                    yield from _reported(waiting)
                    waiting = waiting[-1:]

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return neighbours(docs).select("doc_id", "text", "ahead").mapInArrow(report, schema)


def _reported(rows: list[tuple]):
    """Rows for all but the last of consecutive documents."""
    texts = [r[1] for r in rows]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    own, other = fingerprints(texts), fingerprints(changed)
    frame = pd.DataFrame(
        {
            "doc_id": pd.array([r[0] for r in rows[:-1]], dtype="Int64"),
            "n_chars": [len(t) for t in texts[:-1]],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": [as_text(x) for x in own[:-1]],
            "edited_fingerprint": [as_text(x) for x in other],
            "near_edited": [likeness(a, b) for a, b in zip(own, other, strict=False)],
            "near_next": [likeness(a, b) for a, b in zip(own, own[1:], strict=False)],
        }
    )
    yield pa.RecordBatch.from_pandas(frame, preserve_index=False)
