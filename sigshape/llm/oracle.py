"""DuckDB SQL of the queries that SQL can express, over whole tables."""


def crc32_sql(text: str) -> str:
    """CRC-32 (reflected, polynomial 0xEDB88320) of an ASCII text, bit by bit."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
      lambda acc, byte: list_reduce(list_prepend(xor(acc, byte), list_transform(range(8), lambda bit: 0::BIGINT)),
                                    lambda v, bit: xor(v >> 1, 3988292384 * (v & 1)))))"""


ORACLE = {
    "op5_exact_dedup": """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
""",
    "op10_decontamination": """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS phrase, least(len(w), 10) AS k, w[s:s + 9] AS terms
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
pos AS (
  SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, ks WHERE len(w) >= k)),
m AS (SELECT p.doc_id, p.s, p.k, win.item_id FROM pos p JOIN win ON p.phrase = win.phrase AND p.k = win.k),
hit AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(s, s + k)) AS x FROM m) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id),
term AS (SELECT phrase, t, min(o) AS o FROM (SELECT phrase, unnest(terms) AS t, unnest(range(len(terms))) AS o FROM
         (SELECT DISTINCT phrase, terms FROM win)) GROUP BY phrase, t),
dw AS (SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS at FROM d),
freq AS (SELECT t, count(*) AS n FROM dw GROUP BY t),
anchor AS (
  SELECT phrase, t FROM (
    SELECT phrase, term.t, row_number() OVER (PARTITION BY phrase ORDER BY coalesce(n, 0), term.t) AS r
    FROM term LEFT JOIN freq ON term.t = freq.t) WHERE r = 1),
cand AS (
  SELECT DISTINCT d.doc_id, a.phrase, d.w[greatest(dw.at - 15, 0) + 1:dw.at + 16] AS around
  FROM dw JOIN anchor a ON dw.t = a.t JOIN d ON d.doc_id = dw.doc_id),
near AS (
  SELECT c.doc_id, count(DISTINCT win.item_id) AS n_near
  FROM cand c JOIN win ON c.phrase = win.phrase WHERE list_has_all(c.around, win.terms) GROUP BY c.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
""",
    "op11_prefix_trie": f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 5 AS base, {crc32_sql("CAST(c AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT c FROM t)),
again AS (
  SELECT convs.c, 0 AS part, t.p, r, x FROM convs JOIN t ON t.c = convs.base AND t.p <= convs.h
  UNION ALL
  SELECT t.c, 1, t.p, r, x FROM convs JOIN t ON t.c = convs.c AND t.p > convs.h),
steps AS (
  SELECT c, row_number() OVER w AS d, octet_length(encode(x)) AS n,
         sha256(string_agg(concat(length(r), ':', r, length(x), ':', x), '') OVER w) AS prefix
  FROM again WINDOW w AS (PARTITION BY c ORDER BY part, p ROWS UNBOUNDED PRECEDING)),
member AS (
  SELECT c, d, n, prefix FROM steps UNION ALL SELECT c, 0, 0, '' FROM convs),
last AS (SELECT c, max(d) AS len FROM member GROUP BY c),
node AS (
  SELECT prefix, min(m.c) AS conv_id, any_value(m.d) AS depth, any_value(n) AS n, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c) FILTER (m.d = len), '')) AS ends_sha256
  FROM member m JOIN last USING (c) GROUP BY prefix),
up AS (                                       -- every node with the prefixes it starts with, itself included
  SELECT node.prefix, a.prefix AS above, a.d = node.depth - 1 AS is_parent
  FROM node JOIN member a ON a.c = node.conv_id AND a.d <= node.depth),
kids AS (SELECT above AS prefix, count(*) AS n_children FROM up WHERE is_parent GROUP BY above),
sums AS (
  SELECT above AS prefix, sum(CASE WHEN kids.prefix IS NULL THEN 1 ELSE 0 END) AS n_leaves,
         sum((n_convs - 1) * n) AS saved_tokens
  FROM up JOIN node USING (prefix) LEFT JOIN kids USING (prefix) GROUP BY above)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, node.n_convs,
       CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN sums USING (prefix) LEFT JOIN kids USING (prefix)
LEFT JOIN up ON up.prefix = node.prefix AND is_parent LEFT JOIN node parent ON parent.prefix = up.above
""",
    "op12_structure_repair": f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS x,
         {crc32_sql("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS hit
  FROM conversations),
hit AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE r END AS r,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(x, '[.!?]', '', 'g') ELSE x END AS x,
         unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw),
placed AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), 'none') AS g, turn, r, x, left(r, 1) AS c,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x) AS p
  FROM hit),
t AS (
  SELECT *, CASE WHEN NOT regexp_matches(x, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY g, r, x ORDER BY p) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(x, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(c) OVER (PARTITION BY g ORDER BY p) || c AS pair
  FROM placed),
stats AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(p) AS n
  FROM t GROUP BY g),
ins(a, b, w, cost, lines) AS (VALUES          -- what may be inserted before a row, by the role that stood before
  ('', '', '', 0, []::VARCHAR[]), ('', 'u', 'I', 5, ['user:']), ('', 'a', 'II', 10, ['user:', 'assistant:']),
  ('s', 's', '', 0, []), ('s', 'u', 'I', 5, ['user:']), ('s', 'a', 'II', 10, ['user:', 'assistant:']),
  ('u', 'u', '', 0, []), ('u', 'a', 'I', 5, ['assistant:']), ('a', 'a', '', 0, []), ('a', 'u', 'I', 5, ['user:'])),
own(b, e, role, z, w, cost) AS (VALUES        -- what a row may become: kept by its initial, renamed, deleted
  ('', '', NULL, 's', 'K', 0), ('', '', NULL, 'u', 'K', 0), ('s', '', NULL, 'u', 'K', 0), ('a', '', NULL, 'u', 'K', 0), ('u', '', NULL, 'a', 'K', 0),
  ('', '', 'user', 'u', 'R', 1), ('s', '', 'user', 'u', 'R', 1), ('a', '', 'user', 'u', 'R', 1), ('u', '', 'assistant', 'a', 'R', 1),
  ('', 'D', NULL, '', 'D', 2), ('s', 'D', NULL, 's', 'D', 2), ('u', 'D', NULL, 'u', 'D', 2), ('a', 'D', NULL, 'a', 'D', 2)),
dp(g, i, state, cost, audit, lines) AS (
  SELECT g, CAST(0 AS BIGINT), '', 0, '', []::VARCHAR[] FROM stats
  UNION ALL
  SELECT g, i, state, cost, audit, lines FROM (
    SELECT dp.g, dp.i + 1 AS i, own.z AS state,
           dp.cost + ins.cost + own.cost + CASE WHEN t.fault = 'truncated' AND own.w <> 'D' THEN 5 ELSE 0 END AS cost,
           dp.audit || ins.w || own.w AS audit,
           CASE WHEN own.w = 'D' THEN list_concat(dp.lines, ins.lines)
                ELSE list_concat(list_concat(dp.lines, ins.lines), [coalesce(own.role, t.r) || ':' || t.x]) END AS lines,
           row_number() OVER (PARTITION BY dp.g, own.z
             ORDER BY dp.cost + ins.cost + own.cost + CASE WHEN t.fault = 'truncated' AND own.w <> 'D' THEN 5 ELSE 0 END,
                      dp.audit || ins.w || own.w) AS best
    FROM dp JOIN t ON t.g = dp.g AND t.p = dp.i + 1 JOIN ins ON ins.a = dp.state JOIN own ON own.b = ins.b
    WHERE own.w = 'D' OR t.fault IN ('', 'truncated') AND (own.w = 'R' OR own.z = t.c)) WHERE best = 1),
done AS (
  SELECT g, cost, audit, lines FROM (
    SELECT dp.g, dp.cost + ins.cost AS cost, dp.audit || ins.w AS audit, list_concat(dp.lines, ins.lines) AS lines,
           row_number() OVER (PARTITION BY dp.g ORDER BY dp.cost + ins.cost, dp.audit || ins.w) AS best
    FROM dp JOIN stats ON stats.g = dp.g AND stats.n = dp.i JOIN ins ON ins.a = dp.state
    WHERE ins.b = 'a' OR ins.b = '') WHERE best = 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats ON stats.g = coalesce(CAST(c.conv_id AS VARCHAR), 'none')
LEFT JOIN done ON done.g = coalesce(CAST(c.conv_id AS VARCHAR), 'none')
""",
}
