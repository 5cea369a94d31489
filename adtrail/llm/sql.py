"""What the queries must return, in DuckDB's SQL."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DEDUP = f"""
WITH d AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""

_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(LOWER.format("coalesce(text, '')"))} AS words FROM documents),
b AS (SELECT item_id, {_WORDS.format(LOWER.format("coalesce(text, '')"))} AS words FROM benchmark),
sized AS (SELECT *, least(len(words), 10) AS n FROM b WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[s:s + n - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS s FROM sized)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, s, array_to_string(words[s:s + n - 1], ' ') AS w
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM d, sizes WHERE len(words) >= n)),
hits AS (SELECT doc_id, n, s, item_id FROM places JOIN windows USING (n, w)),
n_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
n_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN n_items USING (doc_id)
"""

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (
  SELECT doc_id, s, array_to_string(words[s:s + 12], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS s FROM d)),
owned AS (SELECT doc_id, s, doc_id > min(doc_id) OVER (PARTITION BY w) AS gone FROM places),
removed AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM owned WHERE gone),
word AS (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS text
  FROM word ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT *, octet_length(encode(html))::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS most FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> most THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> most THEN most END AS refers_to
FROM s
"""

INFILL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id::VARCHAR) AS x,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
         ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4
  FROM d),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
         array_to_string(units[b + 1:], '') AS s
  FROM cut)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

INTERACTION = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
bits AS (
  SELECT part, {'A': len(words) < 100,
                'B': 100 * len(list_distinct(words)) < 80 * len(words),
                'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text),
                'D': regexp_matches(text, '[#$%&*|]'),
                'E': doc_id > min(doc_id) OVER (PARTITION BY text)} AS f,
         coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
  FROM d LEFT JOIN labels USING (doc_id)),
failed AS (
  SELECT part, (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END)
             || (CASE WHEN f.C THEN 'C' ELSE '' END) || (CASE WHEN f.D THEN 'D' ELSE '' END)
             || (CASE WHEN f.E THEN 'E' ELSE '' END) AS fs, good, toxic
  FROM bits),
cells AS (
  SELECT part, fs, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failed GROUP BY ALL),
orders(o) AS (
  SELECT '' UNION ALL
  SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(o, x)),
steps AS (
  SELECT o AS filter_order, step, o[step] AS x, o[1:step - 1] AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE length(o) = 5),
judged AS (
  SELECT *, contains(fs, x) AS fails, before <> '' AND regexp_matches(fs, '[' || before || '~]') AS gone
  FROM cells, steps),
counted AS (
  SELECT part, filter_order, step, x,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (NOT gone AND fails), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (gone AND fails), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fs = x), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND fails), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND fails), 0)::BIGINT AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM counted
"""

SQL: dict[str, str] = {
    "op1_warc": WARC,
    "op5_decontaminate": DECONTAMINATE,
    "op7_exact_dedup": DEDUP,
    "op8_substrings": SUBSTRINGS,
    "op11_infill": INFILL,
    "op13_interaction": INTERACTION,
}
