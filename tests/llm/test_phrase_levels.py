"""Fingerprints of all levels: the least names by plain sorting, likeness against exact Jaccard, short texts."""

import os

import numpy as np
import pyarrow.parquet as pq
import pytest

from shiftledger.llm import phrases

SF = "/root/testdata/sf0.01"


def plain_levels(text):
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    names, owner = phrases._mix(points + np.uint64(1)), np.zeros(len(points), dtype=np.int64)
    found = []
    for level in range(len(phrases.SKETCHES)):
        names, owner = phrases.fold(names, owner)
        found.append(np.unique((names & ~np.uint64(3)) | np.uint64(level)))
    return found


def test_least_names_are_those_of_plain_sorting():
    rng = np.random.default_rng(1)
    texts = ["", "a", "aaaaaaaaaa" * 900, "".join(rng.choice(list("abc "), 9000)), "é" * 3, "".join(rng.choice(list("abcdefgh"), 40))]
    texts.append(("one two three four five six seven " * 400)[:9001])
    for text, got in zip(texts, phrases.fingerprints(texts), strict=True):
        want = [x[:k] for x, k in zip(plain_levels(text), phrases.SKETCHES, strict=True)]
        assert np.array_equal(got, np.concatenate(want))


def test_likeness_is_near_the_exact_index_of_the_levels():
    rng = np.random.default_rng(2)
    body = "".join(rng.choice(list("abcdefghij "), 6000))
    for share in (0.2, 0.5, 0.8):
        cut = int(len(body) * share)
        other = body[:cut] + "".join(rng.choice(list("abcdefghij "), len(body) - cut))
        a, b = phrases.fingerprints([body, other])
        exact = [len(np.intersect1d(x, y)) / len(np.union1d(x, y)) for x, y in zip(plain_levels(body), plain_levels(other), strict=True)]
        weights = [phrases.GROWTH**k for k in range(len(exact))]
        assert abs(phrases.likeness(a, b) - np.average(exact, weights=weights)) < 0.09
    assert phrases.likeness(a, a) == 1 and phrases.likeness(a, a[:0]) == 0 and phrases.likeness(a[:0], a[:0]) == 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")
def test_short_texts_share_names_with_their_edits():
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).sort_by([("doc_id", "descending")])
    texts = [t or "" for t in table.column("text").to_pylist()]
    own, other = phrases.fingerprints(texts[:-1]), phrases.fingerprints([phrases.edited(a, b) for a, b in zip(texts, texts[1:], strict=False)])
    near = np.array([phrases.likeness(a, b) for a, b in zip(own, other, strict=True)])
    following = np.array([phrases.likeness(a, b) for a, b in zip(own, own[1:], strict=False)])
    short = np.array([0 < len(t) < 60 for t in texts[:-1]])
    assert near[short].mean() > 0.25 and near[~short].mean() > 0.45 and np.median(following) < 0.05
