"""Edge cases and brute force for the training-data operators."""

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shiftledger.llm import components, exact_stream, language, minhash, mixing, ngram_join, packing, paragraphs
from shiftledger.llm import phrases, queries, sharding, token_files, tokens, toxicity

pytest.importorskip("public_tokenizers")

SF = "/root/testdata/sf0.001"

# A name that operators use inside clashes with "size"; "key" and "n" are plain extra columns.
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, size LONG, key STRING"
COMMON = "one two three four five six seven eight nine ten " * 3


def edge_rows():
    return [
        (1, None, None, None, 7, "k"), (2, "", "en", "a", None, None), (3, "  \t\n ", "en", "a", 1, "k"),
        (4, COMMON, "en", "b", 1, "k"), (4, COMMON, "en", "b", 1, "k"), (None, COMMON + " x", None, "b", 2, "k"),
        (5, "idiot " + COMMON, "en", None, 3, "k"), (6, "wort " * 30_000, "de", "a", 3, "k"),
        (7, "a  b   c \n d  e", "de", "c", 3, "k"), (8, "1 2 3 !!!", "fr", "c", 3, "k"),
    ]


@pytest.fixture
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def labels_of(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id LONG, quality INT, toxic INT")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.tokenizer_path(name))
    texts = [r[1] or "" for r in edge_rows()] + ["a  ", " a", "\n  b", "İ ΣΑΣ é", "<|endoftext|> x", "a\x1cb c", " ́b"]
    texts += ["x <|endoftext|> y <|startoftext|>", "<|ENDOFTEXT|>", "foo<|endof", "text|>", "a\n\nb", "a\nb\n", "don't. DON'TS 'tis x's'", "3.5 5'6 a,b;c"]
    texts += [" x \ny", "x\n y", "tab\t.x\r\ny", "a.\n.b", "x\u00a0y.", "a\u3000.b", " .\n ,", "日本。a.b\nc", "\n", "\nb", "e\u0301.", "a" * 5000 + "." * 5000]
    for most in (3, 20, 1000):
        encoder = tokens.Encoder(tokens.tokenizer_path(name), most)
        for portion in (texts, texts[5:], texts[::-1]):
            ids, counts = encoder.encode(pa.array(portion))
            got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
            assert got == [plain.encode(t, add_special_tokens=False).ids for t in portion]


@pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")
def test_whole_queries_equal_the_library(spark):
    from tokenizers import Tokenizer

    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    crc = lambda ids: zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())

    def encoded(name, end):
        plain = Tokenizer.from_file(tokens.tokenizer_path(name))
        return [(d, [*e.ids, end]) for (d, _), e in zip(docs, plain.encode_batch([t for _, t in docs], add_special_tokens=False), strict=True)]

    start, want = 0, []
    for d, ids in encoded("byte_bpe_50k.json", 2):
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.QUERIES["op4_token_orc"](spark, SF).collect()]
    assert sorted(got) == want
    want = [(d, k // 2048, k, len(ids[k : k + 2048]), crc(ids[k : k + 2048])) for d, ids in encoded("word_bpe_49k.json", 0) for k in range(0, len(ids), 2048)]
    rows = queries.QUERIES["op1_best_fit_packing"](spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want


CLASHING = "doc_id LONG, text STRING, lang STRING, source STRING, size LONG, key STRING, n LONG, sure LONG, rank LONG, times LONG, target DOUBLE, " \
    "number LONG, row LONG, digest STRING, document STRING, class_id LONG, _all INT, copy INT"


@pytest.mark.parametrize("stage_of", [language.recognised, exact_stream.deduplicated, ngram_join.one_per_class, mixing.mixed_documents])
def test_stages_carry_clashing_columns_and_odd_ids(spark, stage_of):
    """Rows that a stage keeps come out as they went in; repeated and null ids lose nothing."""
    other = " ".join(f"wort{k}" for k in range(40))
    texts = [(3, COMMON), (7, COMMON), (7, other), (None, COMMON + "end"), (None, COMMON + "stop"), (None, None), (8, "")]
    rows = [(d, t, "en", "a", 7, "key", 7, 7, 7, 7, 0.5, 7, 7, "digest", "document", 7, 7, 7) for d, t in texts]
    docs = spark.createDataFrame(rows, CLASHING)
    left = stage_of(docs)
    assert left.schema.names == docs.schema.names
    got = sorted((tuple(r) for r in left.collect()), key=str)
    assert set(got) <= set(rows)
    kept = [(r[0], r[1]) for r in got]
    if stage_of is exact_stream.deduplicated:
        assert sorted(kept, key=str) == sorted([(3, COMMON), (7, other), *texts[3:5], (8, "")], key=str)
    if stage_of is ngram_join.one_per_class:
        assert sorted(kept, key=str) == sorted([(3, COMMON), (7, other), *texts[5:]], key=str)
    if stage_of is mixing.mixed_documents:
        assert (7, other) in kept and (None, None) not in kept
    assert stage_of(docs.limit(0)).count() == 0


def test_packing_edges(edge, nothing):
    path = tokens.tokenizer_path("word_bpe_49k.json")
    rows = packing.pack_documents(edge, path).collect()
    assert len([r for r in rows if r["doc_id"] == 4]) == 2 and any(r["doc_id"] is None for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert {r["ids_crc32"] for r in rows if r["doc_id"] in (1, 2, 3)} == {zlib.crc32(b"\0\0\0\0")}
    assert packing.pack_documents(nothing, path).count() == 0


def test_plan_uses_exact_complements():
    bins = packing.plan_bins({9: 2, 1: 1, 6: 1, 3: 1, 5: 1, 2: 1, 4: 1}, 10)
    used = [length for lengths, times in bins for length in lengths * times]
    assert sorted(used) == [1, 2, 3, 4, 5, 6, 9, 9] and sum(t for _, t in bins) == 4
    rng = np.random.default_rng(1)
    counts = {int(k): int(rng.integers(1, 50)) for k in rng.integers(1, 2049, 300)}
    plan = packing.plan_bins(counts)
    total = sum(k * n for k, n in counts.items())
    assert sum(sum(p) * t for p, t in plan) == total and all(sum(p) <= 2048 for p, _ in plan)
    # No two pieces longer than half a sequence fit into one.
    least = max(total / 2048, sum(n for k, n in counts.items() if k > 1024))
    assert least <= sum(t for _, t in plan) <= 1.1 * least


def test_whole_sequences(spark, edge):
    path = tokens.tokenizer_path("word_bpe_49k.json")
    pieces = packing.tokenized_pieces(edge.where("doc_id > 4"), path)
    placed = packing.pack(pieces, ["doc_id", "piece"])
    made = packing.sequences(placed).collect()
    assert sum(len(r["ids"]) for r in made) == 4 * pieces.agg(F.sum("length")).first()[0]


def test_sharding_edges(spark, edge, nothing):
    rows = sharding.assign_shards(edge, limit=200).collect()
    assert len(rows) == 10
    shards = {}
    for r in rows:
        shards.setdefault((r["shard"], r["part"]), []).append(r["bytes"])
    assert all(sum(b) <= 200 or len(b) == 1 for b in shards.values())
    assert sharding.assign_shards(nothing).count() == 0
    same = spark.createDataFrame([(1, "x" * 90)] * 7, "doc_id LONG, text STRING")
    got = sharding.assign_shards(same, limit=200).collect()
    assert sorted(r["shard_docs"] for r in got) == [1, 2, 2, 2, 2, 2, 2] and not any(r["oversized"] for r in got)


def test_toxicity(spark, edge, nothing):
    words = [f"w{i}" for i in range(300)]
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(words, 30)) for _ in range(600)]
    rows = [(i, t + (" scum, trash" if i % 6 == 0 else ""), None, None, None, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = labels_of(spark, *[(i, 0, int(i % 6 == 0)) for i in range(0, 600, 2)], (None, 1, 1), (2, None, None))
    got = {r["doc_id"]: r for r in toxicity.toxicity_report(docs, labels).collect()}
    held = [i for i in got if got[i]["held_out"]]
    assert held and all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert np.mean([got[i]["predicted"] == int(i % 6 == 0) for i in held]) > 0.95
    assert toxicity.toxicity_report(edge, labels_of(spark)).count() == 10
    assert toxicity.toxicity_report(nothing, labels).count() == 0


def test_token_files(spark, edge, nothing, tmp_path):
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    got = token_files.encode_to_orc(edge, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8]
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    assert got[1]["n_tokens"] == 1 and got[1]["ids_crc32"] == zlib.crc32((2).to_bytes(4, "little"))
    assert token_files.encode_to_orc(nothing, path).count() == 0
    token_files.write_tokens(edge, str(tmp_path / "t.orc"), path)
    plan = token_files.read_tokens(spark, str(tmp_path / "t.orc")).where("doc_id = 6")
    assert plan.count() == 1 and "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,6)]" in plan._jdf.queryExecution().toString()


def test_paragraphs_edges(spark, nothing):
    long = " ".join(f"t{i}" for i in range(60))
    near = long.replace("t59", "other")
    docs = spark.createDataFrame(
        [(1, f"intro\n{long}\nend"), (2, f"{near}"), (2, None), (None, long), (3, ""), (4, f"{long}\n{long}"), (5, "short line\nshort line")],
        "doc_id LONG, text STRING",
    )
    rows = paragraphs.repeated_paragraphs(docs)
    got = {(r["doc_id"], r["paragraph"]): r for r in rows.collect()}
    assert set(got) == {(1, 1), (2, 0), (None, 0), (4, 0), (4, 1)} and {r["class_size"] for r in got.values()} == {5}
    assert [k for k, r in got.items() if not r["removed"]] == [(None, 0)]
    texts = {r["doc_id"]: r["text"] for r in paragraphs.without_repeats(docs.where("text is not null"), rows).collect()}
    assert texts == {1: "intro\nend", 2: "", None: long, 3: "", 4: "", 5: "short line\nshort line"}
    assert paragraphs.repeated_paragraphs(nothing).count() == 0


def brute_links(texts):
    sets = []
    for t in texts:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    linked = lambda a, b: bool(a) and bool(b) and len(a & b) >= 0.8 * len(a | b)
    return [sum(linked(a, b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]


def test_join_against_brute_force(spark, edge, nothing):
    rng = np.random.default_rng(4)
    base = [rng.integers(0, 1000, 80).astype(str).tolist() for _ in range(12)]
    texts = []
    for words in base:
        for changes in (0, 0, 1, 2, 4, 8):
            copy = list(words)
            for at in rng.integers(0, 80, changes):
                copy[at] = "z"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    got = {r["doc_id"]: r["n_links"] for r in ngram_join.similar_documents(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_links(texts)
    edges = ngram_join.similar_documents(edge).collect()
    assert sorted(r["n_links"] for r in edges) == [0, 0, 0, 0, 0, 0, 3, 3, 3, 3] or len(edges) == 10
    assert sorted(r["n_links"] for r in edges) == sorted(brute_links([r[1] for r in edge_rows()]))
    assert ngram_join.similar_documents(nothing).count() == 0


def test_large_clusters_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ITEMS", 4)
    words = [f"q{i}" for i in range(100)]
    texts = [" ".join([*words[:k], "x", *words[k + 1 :]]) for k in range(0, 60, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    rows = ngram_join.similar_documents(docs).collect()
    assert {r["doc_id"]: r["n_links"] for r in rows} == dict(enumerate(brute_links(texts))) and {r["class_id"] for r in rows} == {0}


def test_bands_reach_the_recall():
    for recall in (0.9, 0.999, 0.9999):
        bands, rows = minhash.choose_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (200, 200)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}
    assert components.components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_mixing(spark, edge, nothing):
    rows = mixing.mix(edge).collect()
    assert len(rows) == 10 and all(0 <= r["times"] <= 2 for r in rows) and "key" not in rows[0].asDict()
    for r in rows:
        same = [x for x in rows if x["source"] == r["source"]]
        assert sum(x["size"] * x["times"] for x in same) <= r["target"] + 1e-6
    assert mixing.mix_report(nothing).count() == 0
    docs = spark.createDataFrame([(i, "w " * (1 + i % 40), f"s{i % 4}") for i in range(2000)], "doc_id LONG, text STRING, source STRING")
    first, again = (sorted(map(tuple, mixing.mix_report(d).collect())) for d in (docs, docs.repartition(7)))
    assert first == again
    for source in range(4):
        part = [r for r in first if r[0] % 4 == source]
        # Lengths of one source are equal modulo 4, so not every sum can be made.
        assert 0 <= part[0][3] - sum(r[4] for r in part) < 4
    assert abs(sum({r[0] % 4: r[3] for r in first}.values()) - 1.5 * sum(r[1] for r in first)) < 1e-6


def test_knapsack_is_exact():
    lengths, counts = np.array([7, 11, 13]), np.array([3, 2, 1])
    sums = {a * 7 + b * 11 + c * 13 for a in range(4) for b in range(3) for c in range(2)}
    for budget in range(56):
        taken = mixing._knapsack(lengths, counts, budget)
        assert (taken <= counts).all() and (taken * lengths).sum() == max(s for s in sums if s <= budget)


def test_budget_of_very_long_documents():
    lengths, ones = np.array([200_000, 200_001, 200_002]), np.ones(3, dtype=np.int64)
    for budget, most in ((220_000, 200_002), (199_999, 0), (200_000, 200_000), (200_001, 200_001), (430_000, 400_003), (599_999, 400_003)):
        taken = mixing.fill_budget(lengths, ones, budget)
        assert (taken <= ones).all() and int((taken * lengths).sum()) == most
    lengths = np.array([150_000, 150_001, 200_000])
    assert mixing.fill_budget(lengths, ones, 300_001).tolist() == [1, 1, 0]
    # A remainder beyond the widest programme.
    huge = np.array([5_000_000, 5_000_001])
    assert mixing.fill_budget(huge, ones[:2], 5_010_000).tolist() == [0, 1]


def test_fingerprints(spark, edge, nothing):
    rows = phrases.fingerprint_report(edge).collect()
    assert len(rows) == 10
    by = {}
    for r in rows:
        by.setdefault(r["n_chars"], set()).add(r["fingerprint"])
    assert len(by[len(COMMON)]) == 1
    assert phrases.fingerprint_report(nothing).count() == 0
    assert phrases.fingerprint_report(edge.limit(1)).count() == 1
    rng = np.random.default_rng(3)
    body = "".join(rng.choice(list("abcdefgh "), 4000))
    a, b = phrases.fingerprints(["shifted by some characters " + body, body])
    assert phrases.likeness(a, b) > 0.9 and phrases.likeness(*phrases.fingerprints([body, body[::-1]])) < 0.1
    # Texts parsed together do not touch each other.
    assert all((x == y).all() for x, y in zip(phrases.fingerprints([body, "ab", body]), [b, phrases.fingerprints(["ab"])[0], b], strict=True))


def test_neighbours_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PART_BYTES", 400)
    docs = spark.createDataFrame([(i * 3, f"text {i} " * 9) for i in range(60)], "doc_id LONG, text STRING").repartition(5)
    texts = {i * 3: f"text {i} " * 9 for i in range(60)}
    import hashlib

    for r in phrases.fingerprint_report(docs).collect():
        following = texts.get(r["doc_id"] - 3, texts[177])
        assert r["edited_sha256"] == hashlib.sha256(phrases.edited(texts[r["doc_id"]], following).encode()).hexdigest()


def test_exact_dedup_edges(spark, edge, nothing):
    rows = exact_stream.dedup_report(edge).collect()
    assert len(rows) == 10 and sum(r["kept"] for r in rows if r["doc_id"] == 4) == 1
    empty = [r for r in rows if r["doc_id"] in (1, 2)]
    assert {r["keep_id"] for r in empty} == {1} and {r["group_size"] for r in empty} == {2}
    assert exact_stream.dedup_report(nothing).count() == 0
    kept = exact_stream.deduplicated(edge)
    assert kept.columns == edge.columns and kept.count() == sum(r["kept"] for r in rows)


def test_colliding_digests_are_told_apart(spark, edge):
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1).cast("binary")
    docs = edge.unionByName(edge.limit(4))
    key = lambda df: sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in df.collect())
    assert key(exact_stream.exact_groups(docs, weak, batch_bytes=1)) == key(exact_stream.exact_groups(docs))


def test_language(spark, edge, nothing):
    rng = np.random.default_rng(6)
    letters = {"en": list("abcde "), "de": list("defghi "), "fr": list("ghijkl ")}
    rows = [(i, "".join(rng.choice(letters[k], 80)), k, "s", None, None) for i in range(240) for k in [list(letters)[i % 3]]]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r for r in language.language_report(docs).collect()}
    assert np.mean([got[i]["lang_pred"] == rows[i][2] for i in got if got[i]["held_out"]]) > 0.95
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.language_report(edge).collect()}
    assert {found[i] for i in (1, 2, 3, 8)} == {("und", 0.0)} and found[6][0] in ("en", "de", "fr")
    assert language.language_report(nothing).count() == 0
    assert {r[0] for r in language.recognised(edge).select("doc_id").collect()}.isdisjoint({1, 2, 3, 8})
