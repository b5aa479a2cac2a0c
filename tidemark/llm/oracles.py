"""DuckDB SQL with the rows of the queries that SQL can express."""

OP1 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS turn FROM s
), v AS (
  SELECT source, source_size, turn, source_size * 3.0::DOUBLE AS stop,
         CASE (turn - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM w
), r AS (
  SELECT *,
         (SELECT sum(source_size) FROM v)::DOUBLE - coalesce(sum(stop) OVER before, 0) AS remaining,
         (SELECT sum(weight) FROM v) - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM v
  WINDOW before AS (ORDER BY stop / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size,
         least(stop, weight * (SELECT max(remaining / weight_left) FROM r WHERE stop * weight_left >= remaining * weight)) AS target,
         ('0x' || substr(md5(coalesce('17:s' || source, '17:n')), 1, 6))::BIGINT AS start
  FROM r
), n AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.start,
         CASE WHEN t.source_size = 0 THEN 0 ELSE floor(t.target / t.source_size * 16777216)::BIGINT END AS share,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS FIRST) - 1 AS rank
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, (((rank + 1) * share + start) // 16777216 - (rank * share + start) // 16777216)::BIGINT AS copies FROM n
)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM c
"""

OP3 = r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
  FROM h
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(host, '(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.') THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""

ORACLES = {
    "op1_mix": OP1,
    "op3_url_filter": OP3,
}

OP7 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
), t AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g
), c AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM t, range(5) r(k) WHERE n > 1 GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(translate(text, E' \t\n\x0b\x0c\r', ''))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         length(text) - length(replace(text, '!', '')) AS n_marks,
         length(regexp_replace(text, '\P{L}+', '', 'g')) AS n_letters,
         list_filter(string_split(text, E'\n'), lambda x: length(translate(x, E' \t\n\x0b\x0c\r', '')) > 0) AS lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN c ON d.doc_id = c.doc_id
), b AS (
  SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND 5 * n_marks <= n_words
       AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 2 * n_letters >= word_chars
       AND 10 * n_dup_lines <= 3 * len(lines) AS kept
FROM b
"""

ORACLES["op7_quality_rules"] = OP7

OP2 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)
), t AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY gram) AS n FROM g
), c AS (
  SELECT DISTINCT doc_id, i + k AS i FROM t, range(35) r(k) WHERE n > 1
), x AS (
  SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id
), s AS (
  SELECT d.doc_id, w, coalesce(gone, []) AS gone,
         CASE WHEN gone IS NULL THEN w ELSE list_transform(
           list_filter(list_zip(w, range(1, len(w) + 1)), lambda p: NOT list_contains(gone, p[2])), lambda p: p[1]) END AS kept
  FROM d LEFT JOIN x ON d.doc_id = x.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM s
"""

ORACLES["op2_substring_dedup"] = OP2

# The crc32 of the id's digits, bit by bit; only its lowest bit is asked for.
OP13 = r"""
WITH RECURSIVE v AS (
  SELECT doc_id, source, text,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS front,
         list_reduce(
           list_concat([4294967295::BIGINT], flatten(list_transform(
             string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, o: CASE WHEN o >= 0 THEN xor(a, o) ELSE xor(a >> 1, (a & 1) * 3988292384) END) AS crc
  FROM documents
), u AS (
  SELECT *, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS altered
  FROM v
), leaves AS (
  SELECT doc_id, source, leaf, sha256(front || coalesce(strlen(altered) || ':' || altered, '-')) AS held,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n
  FROM u
), tree AS (
  SELECT source, 0 AS level, place, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
  FROM tree WHERE n > 1 GROUP BY source, level, place // 3, n
), runs AS (
  SELECT source, level, place // 3 AS run, list(digest ORDER BY place) AS h FROM tree WHERE n > 1 GROUP BY ALL
), subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1
), upper_tree AS (
  SELECT 0 AS level, place, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
  FROM upper_tree WHERE n > 1 GROUP BY level, place // 3, n
), upper_runs AS (
  SELECT level, place // 3 AS run, list(digest ORDER BY place) AS h FROM upper_tree WHERE n > 1 GROUP BY ALL
), climb AS (
  SELECT doc_id, leaf, source, 0 AS level, place, n, held, '' AS proof FROM leaves
  UNION ALL
  SELECT doc_id, leaf, c.source, c.level + 1, place // 3, (n + 2) // 3,
         sha256(array_to_string(h[1:place % 3] || [held] || h[place % 3 + 2:], '')),
         proof || array_to_string(h[1:place % 3] || h[place % 3 + 2:], '')
  FROM climb c JOIN runs r ON c.source IS NOT DISTINCT FROM r.source AND c.level = r.level AND c.place // 3 = r.run
  WHERE n > 1
), upper_climb AS (
  SELECT doc_id, leaf, digest AS subroot, 0 AS level, s.place, s.n, held, proof
  FROM climb c JOIN subroots s ON c.source IS NOT DISTINCT FROM s.source WHERE c.n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, c.level + 1, place // 3, (n + 2) // 3,
         sha256(array_to_string(h[1:place % 3] || [held] || h[place % 3 + 2:], '')),
         proof || array_to_string(h[1:place % 3] || h[place % 3 + 2:], '')
  FROM upper_climb c JOIN upper_runs r ON c.level = r.level AND c.place // 3 = r.run
  WHERE n > 1
)
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, held AS folded_root, held = t.digest AS verified
FROM upper_climb c JOIN upper_tree t ON c.n = 1 AND t.n = 1
"""

ORACLES["op13_manifest"] = OP13

OP11 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), k AS (
  SELECT doc_id, t, len(t)::BIGINT AS n, row_number() OVER () AS row FROM d WHERE len(t) > 0
), s AS (
  SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM k
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), p AS (
  SELECT row, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT row, doc_id, n, unnest(t) AS term FROM k) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s
), x AS (
  SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL
), r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM x WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

ORACLES["op11_search"] = OP11

OP12 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE
      WHEN len(w) = 0 THEN []
      WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS grams
  FROM d
), k AS (
  SELECT doc_id, len(grams)::BIGINT AS n, grams, md5(array_to_string(grams, chr(10))) AS class FROM s
), c AS (
  SELECT class, min(doc_id) AS node, any_value(n) AS n, any_value(grams) AS grams FROM k WHERE n > 0 GROUP BY class
), t AS (
  SELECT node, n, unnest(grams) AS token FROM c
), p AS (
  SELECT a.node AS u, b.node AS v
  FROM t a JOIN t b ON a.token = b.token AND a.node < b.node AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.node, a.n, b.node, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), l AS (
  SELECT u, v FROM p UNION SELECT v, u FROM p
), reach AS (
  SELECT node, node AS other FROM c
  UNION
  SELECT node, v FROM reach JOIN l ON other = u
), first AS (
  SELECT node, min(other) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, k.n AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM k LEFT JOIN c ON k.class = c.class LEFT JOIN first ON c.node = first.node
"""

ORACLES["op12_ngram_join"] = OP12
