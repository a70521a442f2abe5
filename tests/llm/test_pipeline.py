"""The pipeline's stages, each against brute force on its own input."""

import os
import re

import pytest

import corpus_pipeline as cp
from shiftledger.llm.common import documents, stage

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


def test_stages(spark):
    docs = documents(spark, SF)
    columns, rows = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, function in cp.STAGES[:3]:
        docs = stage(function(spark, docs, SF), name)
        assert docs.columns == columns
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= set(rows)
        if name == "language_id":
            assert {i for i in rows if re.search(r"[^\W\d_]", rows[i] or "")} >= set(ids) and len(ids) >= 0.98 * len(rows)
        if name == "exact_dedup":
            first = {}
            for i in sorted(rows):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i] or ""), i)
            assert set(ids) == set(first.values())
        rows = {i: rows[i] for i in ids}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in rows.items() for w in [t.split()]}
    assert not any(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a in sets for b in sets if a < b)

    mixed = stage(cp.STAGES[3][1](spark, docs, SF), "mixing")
    words = lambda df: sum(len((r["text"] or "").split()) for r in df.select("text").collect())
    assert mixed.columns == columns and 0.97 * 1.5 * words(docs) <= words(mixed) <= 1.5 * words(docs) + 1
    packed = cp.STAGES[4][1](spark, mixed, SF)
    assert packed.where("piece = 0").count() == mixed.count()
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
