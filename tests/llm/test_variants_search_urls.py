"""Spelling variants, ranked search and the URL filter against plain loops, with odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from shiftledger.llm import host_reputation as hr
from shiftledger.llm import lexical_search as ls
from shiftledger.llm import permuterm as pt

DOCS = "doc_id LONG, text STRING, n LONG, key STRING, word STRING, terms STRING"


def docs_of(spark, texts):
    return spark.createDataFrame([(d, t, 1, "k", "w", "t") for d, t in texts], DOCS)


# --- spelling variants ---------------------------------------------------------


def edits(word, letters):
    out = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    for i in range(len(word)):
        out |= {word[:i] + word[i + 1 :]} | {word[:i] + c + word[i + 1 :] for c in letters}
    return out - {word}


def plain_groups(counts):
    """word -> (form, root, n, n_near, form_n) by looking at all edits of each word."""
    letters = {c for w in counts for c in w}
    near = {w: [x for x in edits(w, letters) if x in counts] for w in counts}
    best = {w: min(x, key=lambda o: (-counts[o], o)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if counts[b] >= 5 * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def plain_words(texts):
    counts = Counter()
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) | 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def as_dict(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_words_near_each_other(spark):
    rng = random.Random(3)
    words = {"aaaaaa": 5, "aaaaaaa": 30, "aaaaaaaa": 200, "baaaaa": 5, "élaaaa": 7, "elaaaa": 40, "abcabc": 9, "abcab": 9}
    words |= {"".join(rng.choice("abé") for _ in range(rng.choice([6, 7, 8]))): rng.choice([5, 6, 30, 160]) for _ in range(250)}
    words["bbbbbb"], words["bbbbba"], words["bbbbbc"] = 5, 30, 30
    table = spark.createDataFrame(list(words.items()), "word STRING, n LONG")
    assert as_dict(pt.grouped_words(table)) == plain_groups(words)


def test_variants_of_documents(spark):
    rng = random.Random(5)
    base = ["Wonderful", "wonderfull", "wonderfu", "naïveté", "naiveté", "NAÏVETé", "straße", "strasse", "x" * 40, "ÉCOLES", "écoles"]
    texts = [(k, " ".join(rng.choices(base, k=60)) + ", a1" * (k % 3)) for k in range(40)]
    texts += [(None, None), (None, "wonderful " * 7), (7, ""), (7, "wonderful-Wonderful\n" * 400), (7, "wonderful-Wonderful\n" * 400)]
    docs = docs_of(spark, texts)
    assert as_dict(pt.spelling_variants(docs)) == plain_groups(plain_words(texts))
    # Some runs lose a letter, in every place that the hash may name.
    runs = [(d, f"abcdef{chr(97 + d % 26)}{chr(97 + d // 26 % 26)}") for d in range(6000)]
    got = Counter(r["word"] for r in pt.edited_runs(docs_of(spark, runs)).collect())
    want = Counter()
    for d, run in runs:
        h = zlib.crc32(f"{d}:{run}".encode())
        want[run[: h % 8] + run[h % 8 + 1 :] if h % 199 == 0 else run] += 1
    assert got == want and any(len(w) == 7 for w in got)
    assert pt.spelling_variants(docs.limit(0)).count() == 0


# --- ranked search ---------------------------------------------------------------


def plain_search(texts, items, best=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    docs = [(d, Counter(terms(t))) for d, t in texts]
    docs = [(d, c) for d, c in docs if c]
    number, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    rows = []
    for item, text in items:
        found = []
        for d, c in docs:
            m = 100 - 90 + (90 * sum(c.values()) * number) // total
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) if c[t]
            )
            if score > 0:
                found.append((-score, d is not None, d or 0, d))
        rows += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(found)[:best])]
    return sorted(rows, key=str)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ls, "SHARD_DOCS", 60)
    monkeypatch.setattr(ls, "BLOCK", 5)
    rng = random.Random(11)
    words = [f"w{k}" for k in range(300)]
    often = words[:12]
    texts = [(k, " ".join(rng.choices(often, k=8) + rng.choices(words, k=rng.choice([3, 30, 200])))) for k in range(400)]
    items = [(k, " ".join(rng.choices(often, k=4) + rng.choices(words, k=9))) for k in range(25)]
    # Copies of an item among the documents, ties, odd rows.
    texts += [(1000 + k, items[k % 3][1].upper()) for k in range(40)] + [(None, items[0][1]), (5, items[0][1]), (5, items[0][1])]
    texts += [(2000, None), (2001, ""), (2002, "?! \n"), (2003, "w1 " * 50_000), (2004, "É tés\x7fİ w2")]
    items += [(50, None), (51, ""), (52, "nowhere"), (None, "w1 W2"), (3, "w7"), (53, "é TÉS")]
    docs = docs_of(spark, texts).repartition(3)
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id LONG, text STRING, score LONG")
    got = sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in ls.search(docs, table).collect()], key=str)
    assert got == plain_search(texts, items)
    monkeypatch.setattr(ls, "ITEMS", 7)
    again = sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in ls.search(docs, table).collect()], key=str)
    assert again == got
    assert ls.search(docs.limit(0), table).count() == 0 and ls.search(docs, table.limit(0)).count() == 0


def test_blocks_are_skipped_only_below_the_floor():
    rng = np.random.default_rng(2)
    dense = np.where(rng.random((300, 40)) < 0.2, rng.integers(1, 1000, (300, 40)), 0)
    dense[:150, 20:] = 0
    dense[150:, :20] = 0
    dense[::3, 0] += 1
    owner, terms = np.nonzero(dense)
    edges = np.concatenate(([0], np.cumsum((dense > 0).sum(axis=1))))
    shard = ls.Shard(np.arange(300), np.zeros(300, bool), edges, terms, dense[owner, terms], np.ones(40, np.int64))
    for columns in (np.arange(5), np.arange(3, 30), np.array([39])):
        top, met = ls.Best(10), []

        def offer(score, docs, top=top, met=met):
            met.extend(docs.tolist())
            return top.offer(score, shard.null[docs], shard.ids[docs])

        shard.search(columns, 0, offer)
        score = dense[:, columns].sum(axis=1)
        want = sorted(((-s, d) for d, s in enumerate(score.tolist()) if s > 0))[:10]
        assert [(-s, d) for s, d in zip(top.score.tolist(), top.id.tolist(), strict=True)] == want
        assert len(met) == len(set(met))
    for blocks, summaries in shard.blocks.values():
        assert all((summaries[k] == dense[b].max(axis=0)).all() for k, b in enumerate(blocks))


# --- url filter ------------------------------------------------------------------


def test_rules_hosts_and_paths(spark):
    urls = {
        "http://A.Example.NET/en/x?y": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "https://a.example.net/de/": ("a.example.net", "/de/", "net/", "block"),
        "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "https://example.com/de/?q": ("example.com", "/de/", "example.com/de/", "block"),
        "https://x.org/fr/#a": ("x.org", "/fr/", "org/fr/", "allow"),
        "https://x.org": ("x.org", "", None, "allow"),
        "x://y.net?/": ("y.net", "", None, "allow"),
        "//a.net/": ("", "", None, "allow"),
        "a://b://c.net/": ("b:", "//c.net/", None, "allow"),
        "http://net/É\nü#": ("net", "/É\nü", "net/", "block"),
        "": ("", "", None, "allow"), None: ("", "", None, "allow"),
    }
    rows = [(k if k else None, u, "h", "r", 1) for k, u in enumerate(urls)] + [(1, "https://a.example.net/de/", "h", "r", 1)]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, host STRING, rule STRING, number INT")
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    got = hr.judge_urls(pages, labels).collect()
    by = {rows[r["page_id"] or 0][1]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert len(got) == len(rows) and by == urls
    kept = hr.allowed_pages(pages, labels)
    assert kept.columns == pages.columns
    assert sorted(str(r["url"]) for r in kept.collect()) == sorted(str(u) for u, x in urls.items() if x[3] == "allow")
    assert hr.judge_urls(pages.limit(0), labels).count() == 0


def test_bad_hosts_are_blocked_and_doubt_is_not(spark):
    rng, pages, labels = random.Random(1), [], []
    good = {"bad.spam.com": 0.05, "other.spam.com": 0.1, "fine.site.com": 0.9, "good.place.co.uk": 0.95, "half.site.com": 0.6}
    for host, share in good.items():
        for _ in range(400 if host.startswith("bad") else 60):
            pages.append((len(pages), f"https://{host}/{len(pages)}"))
            labels.append((len(pages) - 1, int(rng.random() < share), 0))
    for host in ("new.spam.com", "new.site.com", "1.2.3.4:80", "me@new.place.co.uk"):
        pages.append((len(pages), f"https://{host}/x"))
    labels += [(0, 1, 0), (None, 0, 0), (5, None, 1), (10**9, 0, 0)]
    pages_df, labels_df = spark.createDataFrame(pages, "page_id LONG, url STRING"), spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")
    hosts = {r["host"]: r for r in hr.judge_urls(pages_df, labels_df).collect()}
    assert {h for h, r in hosts.items() if r["verdict"] == "block"} >= {"bad.spam.com", "other.spam.com"}
    assert not {"fine.site.com", "good.place.co.uk", "half.site.com", "new.site.com", "1.2.3.4:80"} & {h for h, r in hosts.items() if r["verdict"] == "block"}
    # A host without labels is judged by its domain.
    assert hosts["new.spam.com"]["share"] < 0.3 < 0.6 < hosts["new.site.com"]["share"]
    assert hosts["bad.spam.com"]["labelled"] == 400


@pytest.mark.parametrize("host, domain, suffix", [
    ("a.b.example.com", "example.com", "com"), ("x.co.uk", "x.co.uk", "co.uk"), ("a.x.co.uk", "x.co.uk", "co.uk"), ("co.uk", "co.uk", "uk"),
    ("1.2.3.4:8080", "1.2.3.4", ""), ("u:p@h.org:1", "h.org", "org"), ("localhost", "localhost", "localhost"), ("", "", ""),
])
def test_domain_of(spark, host, domain, suffix):
    row = hr.with_domain(spark.createDataFrame([(host,)], "host STRING")).first()
    assert (row["domain"], row["suffix"]) == (domain, suffix)


def test_strength_by_moments(spark):
    rng = np.random.default_rng(4)
    rows = [(int(n), int(rng.binomial(n, rng.beta(8, 2))), 0.8) for n in rng.integers(1, 60, 3000)]
    strong = hr.strength(spark.createDataFrame(rows, "labelled LONG, good LONG, mean DOUBLE"))
    assert 8 < strong < 12.5
    same = [(50, int(rng.binomial(50, 0.8)), 0.8) for _ in range(300)]
    assert hr.strength(spark.createDataFrame(same, "labelled LONG, good LONG, mean DOUBLE")) > 150
    assert hr.strength(spark.createDataFrame(rows, "labelled LONG, good LONG, mean DOUBLE").limit(0)) == hr.WEAKEST
