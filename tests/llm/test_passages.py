"""Repeated passages against brute force, wherever they lie in lines."""

import os

import pytest

from shiftledger.llm import passages

SF = "/root/testdata/sf0.01"


def stretches(texts, least):
    """Per text: first word of each run of ``least`` words that has an earlier place (id, word) elsewhere."""
    first, found = {}, {}
    for doc, text in sorted(texts.items()):
        words = (text or "").split()
        found[doc] = []
        for k in range(len(words) - least + 1):
            at = first.setdefault(tuple(words[k : k + least]), (doc, k))
            if at != (doc, k):
                found[doc].append(k)
    return found


def check(texts, rows):
    """Each window that repeats holds a removed piece, and each removed span consists of runs that stand earlier."""
    removed = {}
    for r in rows:
        if r["removed"]:
            text = texts[r["doc_id"]]
            first = len(text[: r["start"]].split())
            count = len(text[r["start"] : r["start"] + r["n_chars"]].split())
            assert count >= passages.PIECE
            removed.setdefault(r["doc_id"], set()).update(range(first, first + count))
    short = stretches(texts, passages.PIECE)
    for doc, gone in removed.items():
        assert gone <= {w for k in short[doc] for w in range(k, k + passages.PIECE)}
    for doc, starts in stretches(texts, passages.WINDOW).items():
        for k in starts:
            inside = removed.get(doc, set()) & set(range(k, k + passages.WINDOW))
            assert len(inside) >= passages.PIECE, (doc, k)
    return removed


def test_passages_in_lines_of_any_length(spark):
    own = lambda name, n: [f"{name}{i}" for i in range(n)]
    passage, other = own("päss", 54), own("short", 60)
    broken = "\n".join(" ".join(other[i : i + 6]) for i in range(0, 60, 6))
    texts = {
        1: " ".join(own("a", 25) + passage[:15]) + "\n" + " ".join(passage[15:] + own("b", 6)) + "\n" + " ".join(own("c", 30) + other),
        2: "é " + " ".join(own("d", 30) + passage + own("e", 40)),
        3: " ".join(own("f", 12)) + "\n" + broken + "\n" + " ".join(own("g", 12)),
        4: " ".join(own("h", 30) + passage[:19] + own("i", 30)),
        5: "wort " * 400, 6: None, 7: "", 8: " ".join(own("k", 39)),
    }
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id LONG, text STRING")
    rows = passages.repeated_passages(docs).collect()
    removed = check(texts, rows)
    assert set(removed) == {2, 3, 5}
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 5} and {r["class_doc_id"] for r in rows} == {1, 5}
    left = {r["doc_id"]: (r["text"] or "").split() for r in passages.without_passages(docs).collect()}
    assert left == {d: [w for k, w in enumerate((t or "").split()) if k not in removed.get(d, ())] for d, t in texts.items()}


def test_ids_that_repeat_or_lack_and_names_that_clash(spark):
    text = " ".join(f"t{i}" for i in range(70))
    data = [(None, text, 1, 2), (None, text, 1, 2), (3, text, 1, 2), (3, "x " + text, 1, 2)]
    docs = spark.createDataFrame(data, "doc_id LONG, text STRING, id INT, cuts INT")
    left = passages.without_passages(docs)
    assert left.columns == docs.columns and left.where("id = 1 and cuts = 2").count() == 4
    sizes = sorted(len((r["text"] or "").split()) for r in left.collect())
    assert sizes[3] == 70 and max(sizes[:3]) < 50
    assert passages.repeated_passages(docs.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")
def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = passages.repeated_passages(docs).collect()
    check(texts, rows)
    assert 900 in {r["doc_id"] for r in rows if r["class_doc_id"] == 39}
