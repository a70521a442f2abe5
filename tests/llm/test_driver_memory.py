"""What training in the driver may hold."""

import os
import tracemalloc

import pytest

from shiftledger.llm import language
from shiftledger.llm.common import documents

SF = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


def test_training_holds_the_sample_once(spark):
    docs = documents(spark, SF)
    known = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    held = sum(len(r["features"]) + len(r["counts"]) for r in language.training_rows(known, language.SAMPLE).collect())
    tracemalloc.start()
    try:
        language.train(docs)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    print(held, most)
    # Counts per feature and weights take a fixed 16 MB at most.
    assert most < 2 * held + (16 << 20)
