"""DuckDB SQL for the operators that SQL can express."""

WS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, line_no, line,
         translate(trim(line, {WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), firsts AS (
  SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT keyed.*, (first_doc IS NOT NULL AND doc_id <> first_doc) AS gone
  FROM keyed LEFT JOIN firsts ON keyed.k = firsts.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

SOURCE_MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), total AS (
  SELECT source, sum(size)::HUGEINT AS total,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source
), filled AS (
  SELECT *, sum(total) OVER () * 3 AS budget,
         coalesce(sum(total * 4) OVER (ORDER BY total::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(w) OVER (ORDER BY total::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM total
), capped AS (
  SELECT *, total * 4 * rest <= (budget - before) * w AS is_capped FROM filled
), share AS (
  SELECT (budget - before)::DOUBLE AS num, (rest * 2)::DOUBLE AS den FROM capped WHERE NOT is_capped
  ORDER BY total::DOUBLE / w, source NULLS LAST LIMIT 1
), target AS (
  SELECT source, total::BIGINT AS source_size,
         CASE WHEN is_capped THEN (total * 2)::DOUBLE ELSE w::DOUBLE * (SELECT num FROM share) / (SELECT den FROM share) END AS target
  FROM capped
), rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0 AS draw
  FROM sized JOIN target ON sized.source IS NOT DISTINCT FROM target.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""

SUBSTRING_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM texts
), windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM texts WHERE len(ws) >= 20)
), repeats AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1
), judged AS (
  SELECT words.doc_id, word, j,
         coalesce(max(i) OVER (PARTITION BY words.doc_id ORDER BY j ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM words LEFT JOIN repeats ON words.doc_id = repeats.doc_id AND words.j = repeats.i
)
SELECT texts.doc_id, max(len(ws))::BIGINT AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM texts LEFT JOIN judged ON texts.doc_id = judged.doc_id GROUP BY texts.doc_id
"""

NGRAM_JACCARD = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM texts WHERE len(ws) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM met JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reached.x, edges.y FROM reached JOIN edges ON reached.y = edges.x
), component AS (
  SELECT x, min(y) AS component_id FROM reached GROUP BY x
)
SELECT texts.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, component_id
FROM texts JOIN component ON component.x = texts.doc_id LEFT JOIN sizes ON sizes.doc_id = texts.doc_id
"""

DECONTAMINATION = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), item_words AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item, least(len(ws), 10) AS size, list_slice(ws, i, i + least(len(ws), 10) - 1) AS win
  FROM item_words, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i) WHERE len(ws) > 0
), sizes AS (
  SELECT DISTINCT size FROM item_windows
), doc_windows AS (
  SELECT r, size, i, list_slice(ws, i, i + size - 1) AS win
  FROM lowered, sizes, LATERAL (SELECT unnest(range(1, len(ws) - size + 2)) AS i) WHERE len(ws) >= size
), found AS (
  SELECT r, i, d.size, item FROM doc_windows d JOIN item_windows b ON d.win = b.win
), hit AS (
  SELECT r, count(DISTINCT i + k)::BIGINT AS n_hit FROM (SELECT DISTINCT r, i, size FROM found), LATERAL (SELECT unnest(range(0, size)) AS k) GROUP BY r
), held AS (
  SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN hit USING (r) LEFT JOIN held USING (r)
"""

#: crc32 of a decimal number: fold over its bytes, eight shifts each.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295::BIGINT)"""

CONVERSATION_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS o
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS lender, {_CRC32} % 6 AS h FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, t.o AS place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.lender AND t.o < c.h
  UNION ALL
  SELECT c.conv_id, t.o - c.h + least(c.h, coalesce(b.n, 0)), t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.o >= c.h LEFT JOIN convs b ON b.conv_id = c.lender
), listed AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS s FROM rebuilt GROUP BY conv_id
), whole AS (
  SELECT c.conv_id, coalesce(s, []) AS s FROM convs c LEFT JOIN listed USING (conv_id)
), paths AS (
  SELECT conv_id, d, list_slice(s, 1, d) AS k, CASE WHEN d > 0 THEN length(s[d].text) ELSE 0 END AS n_chars, len(s) AS total
  FROM whole, LATERAL (SELECT unnest(range(0, len(s) + 1)) AS d)
), nodes AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_chars) AS n_chars,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = total), '') AS ends
  FROM paths GROUP BY k, d
), children AS (
  SELECT list_slice(k, 1, d - 1) AS k, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), linked AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN children c ON n.k = c.k AND n.d = c.d
  LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.k = list_slice(n.k, 1, n.d - 1)
), summed AS (
  SELECT p.k, p.d, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.n_chars) AS saved_tokens
  FROM linked u JOIN paths p ON p.conv_id = u.conv_id AND p.d <= u.d GROUP BY p.k, p.d
)
SELECT l.conv_id, l.d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM linked l JOIN summed s ON l.k = s.k AND l.d = s.d
"""
