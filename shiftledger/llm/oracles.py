"""DuckDB SQL for the operators that SQL can express over whole tables."""

_WORDS = r"""regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"""

_GRAMS = """CASE WHEN len(words) >= 5 THEN list_distinct(list_transform(range(1, len(words) - 3),
    lambda i: array_to_string(words[i:i+4], chr(31)))) WHEN len(words) > 0 THEN [array_to_string(words, chr(31))] ELSE [] END"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_TERMS = r"regexp_extract_all(translate(text, {0}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(_AZ)

#: Strength of a beta prior around ``mean`` from outcomes, by moments.
_STRENGTH = """SELECT CASE WHEN coalesce(most, 0) = 0 THEN 1.0 WHEN excess <= 0 THEN 10000.0
    ELSE greatest(1.0, least(10000.0, most / excess - 1)) END AS s
  FROM (SELECT sum((good - labelled * mean) * (good - labelled * mean) / labelled - mean * (1 - mean)) AS excess,
    sum((labelled - 1) * (mean * (1 - mean))) AS most FROM {0} WHERE labelled > 0)"""

_CRC_STEP = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"

ORACLES = {
    "op11_spelling_variants": f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, _: {_CRC_STEP}) ORDER BY i) AS t
  FROM (SELECT unnest(range(0, 256)) AS i)
), runs AS (
  SELECT doc_id, translate(run, {_AZ}) AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL
), coded AS (
  SELECT run, times, [4294967295] || flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS bytes
  FROM runs
), hashed AS (
  SELECT run, times, xor(list_reduce(bytes, lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS h
  FROM coded, crc_table
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word,
    sum(times)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(times) >= 5
), places AS (
  SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM words
), gaps AS (
  SELECT word, n, left(word, i) || '$' || substr(word, i + 1) AS gap, false AS skips FROM places
  UNION ALL
  SELECT word, n, left(word, i) || '$' || substr(word, i + 2), true FROM places WHERE i < length(word)
), near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n
  FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.word <> b.word AND (a.skips OR b.skips)
), best AS (
  SELECT word, count(*) AS n_near FROM near GROUP BY word
), first_near AS (
  SELECT word, n, other, other_n FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
), forms AS (
  SELECT w.word, w.n, CASE WHEN f.other_n >= 5 * w.n THEN f.other END AS form, CASE WHEN f.other_n >= 5 * w.n THEN f.other_n END AS form_n,
    coalesce(b.n_near, 0)::BIGINT AS n_near
  FROM words w LEFT JOIN best b USING (word) LEFT JOIN first_near f USING (word)
), chains AS (
  SELECT word, form AS reached, 1 AS hops FROM forms WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, f.form, c.hops + 1 FROM chains c JOIN forms f ON f.word = c.reached WHERE f.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(reached, hops) AS root FROM chains GROUP BY word
)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN ends USING (word)
""",
    "op12_lexical_search": f"""
WITH terms AS (
  SELECT row_number() OVER () AS doc, doc_id, unnest({_TERMS}) AS term FROM documents
), counted AS (
  SELECT doc, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), sizes AS (
  SELECT doc, sum(tf)::BIGINT AS n FROM counted GROUP BY doc
), corpus AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM sizes
), wanted AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM counted, corpus GROUP BY term, docs
), scored AS (
  SELECT item_id, doc_id, doc, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // all_terms))))::BIGINT AS score
  FROM wanted JOIN counted USING (term) JOIN weights USING (term) JOIN sizes USING (doc), corpus GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
""",
    "op13_url_filter": f"""
WITH rests AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_AZ}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), ruled AS (
  SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
), outcomes AS (
  SELECT doc_id AS page_id, min(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END)::BIGINT AS good
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), hosts AS (
  SELECT host, count(o.page_id) AS labelled, coalesce(sum(o.good), 0)::BIGINT AS good FROM parts LEFT JOIN outcomes o USING (page_id) GROUP BY host
), named AS (
  SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM hosts
), tree AS (
  SELECT host, labelled, good, CASE WHEN regexp_matches(name, '^[0-9.]*$') THEN '' ELSE string_split(name, '.')[-1] END AS suffix,
    CASE WHEN regexp_matches(name, '^[0-9.]*$') THEN name ELSE array_to_string(string_split(name, '.')[-2:], '.') END AS domain
  FROM named
), overall AS (
  SELECT (sum(good) + 1) / (sum(labelled) + 2) AS mean, sum(labelled) AS k FROM tree
), suffixes AS (
  SELECT suffix, labelled, good, mean, mean * (1 - mean) / (k + 3) AS spread
  FROM (SELECT suffix, sum(labelled)::BIGINT AS labelled, sum(good)::BIGINT AS good FROM tree GROUP BY suffix), overall
), suffix_means AS (
  SELECT suffix, (s * mean + good) / (s + labelled) AS post, post * (1 - post) / (s + labelled + 1) + (s / (s + labelled)) ** 2 * spread AS spread
  FROM suffixes, ({_STRENGTH.format("suffixes")})
), domains AS (
  SELECT suffix, domain, labelled, good, post AS mean, spread
  FROM (SELECT suffix, domain, sum(labelled)::BIGINT AS labelled, sum(good)::BIGINT AS good FROM tree GROUP BY ALL) JOIN suffix_means USING (suffix)
), domain_means AS (
  SELECT suffix, domain, (s * mean + good) / (s + labelled) AS post, post * (1 - post) / (s + labelled + 1) + (s / (s + labelled)) ** 2 * spread AS spread
  FROM domains, ({_STRENGTH.format("domains")})
), judged AS (
  SELECT host, labelled, good, post AS mean, spread FROM tree JOIN domain_means USING (suffix, domain)
), shares AS (
  SELECT host, labelled, good, (s * mean + good) / (s + labelled) AS share,
    share * (1 - share) / (s + labelled + 1) + (s / (s + labelled)) ** 2 * spread AS spread
  FROM judged, ({_STRENGTH.format("judged")})
)
SELECT page_id, r.host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN share + 1.645 * sqrt(spread) < 0.5 THEN 'block' ELSE 'allow' END AS verdict, labelled, good
FROM ruled r JOIN shares s ON r.host = s.host
""",
    "op2_extendible_sharding": """
WITH sizes AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hashed
  FROM documents
), nodes AS (
  SELECT depth, hashed >> (60 - depth) AS prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM sizes, (SELECT unnest(range(0, 61))::INTEGER AS depth) GROUP BY ALL
), leaves AS (
  SELECT n.* FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix >> 1
  WHERE (n.shard_bytes <= 1048576 OR n.shard_docs = 1)
    AND (n.depth = 0 OR NOT (p.shard_bytes <= 1048576 OR p.shard_docs = 1))
)
SELECT doc_id, bytes, depth, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard,
  0::BIGINT AS part, shard_bytes, shard_docs, shard_bytes > 1048576 AS oversized
FROM sizes JOIN leaves ON hashed >> (60 - depth) = prefix
""",
    "op5_paragraph_dedup": f"""
WITH RECURSIVE lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10)))))::INTEGER AS paragraph
  FROM documents WHERE text IS NOT NULL
), placed AS (
  SELECT *, length(line)::BIGINT AS n_chars, {_WORDS.format("line")} AS words,
    coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY paragraph ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM lines
), long AS (
  SELECT *, list_sort({_GRAMS}) AS grams FROM placed WHERE len(words) >= 20
), items AS (
  SELECT row_number() OVER () AS item, grams FROM (SELECT DISTINCT grams FROM long)
), flat AS (SELECT item, unnest(grams) AS gram FROM items),
shared AS (
  SELECT a.item AS x, b.item AS y, count(*) AS n FROM flat a JOIN flat b ON a.gram = b.gram AND a.item <> b.item GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN items i ON i.item = x JOIN items j ON j.item = y
  WHERE n >= 0.8 * (len(i.grams) + len(j.grams) - n) - 1e-9
), reach AS (
  SELECT item AS x, item AS y FROM items UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), classes AS (SELECT x AS item, min(y) AS class FROM reach GROUP BY x),
members AS (SELECT doc_id, paragraph, start, n_chars, class FROM long JOIN items USING (grams) JOIN classes USING (item)),
heads AS (
  SELECT class, min((doc_id, paragraph)) AS head, count(*) AS class_size FROM members GROUP BY class HAVING count(*) > 1
)
SELECT doc_id, paragraph, start, n_chars, head[1] AS class_doc_id, head[2] AS class_paragraph, class_size,
  (doc_id, paragraph) <> head AS removed
FROM members JOIN heads USING (class)
""",
    "op6_ngram_join": f"""
WITH RECURSIVE worded AS (SELECT doc_id, {_WORDS.format("text")} AS words FROM documents),
sets AS (SELECT doc_id, {_GRAMS} AS grams FROM worded),
flat AS (SELECT doc_id, unnest(grams) AS gram FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM flat a JOIN flat b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sets i ON i.doc_id = x JOIN sets j ON j.doc_id = y
  WHERE n >= 0.8 * (len(i.grams) + len(j.grams) - n) - 1e-9
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), classes AS (SELECT x, min(y) AS class_id FROM reach GROUP BY x)
SELECT x AS doc_id, class_id, (SELECT count(*) FROM links WHERE links.x = classes.x) AS n_links FROM classes
""",
    "op9_exact_dedup": r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept,
  sha256(text) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY text)
""",
}
