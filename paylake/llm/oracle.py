"""DuckDB SQL for the queries that SQL can express (the other queries are
held against brute-force versions in ``tests/llm``)."""

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), o AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before, lead(role) OVER w AS after,
         replace(replace(text, '\', '\\'), '<|', '\l|') AS shown,
         replace(replace(replace(role, '\', '\\'), '<|', '\l|'), '|>', '|\g') AS shown_role
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(shown) + CASE WHEN before IS NULL OR before <> role THEN length('<|role:' || shown_role || '|>') ELSE 0 END
           + CASE WHEN after IS NULL OR after <> role THEN length('<|end|>') ELSE length('<|sep|>') END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

_LINES = f"""
WITH l AS (
  SELECT doc_id, k, parts[k] AS line, {LOWER.format(f"trim(parts[k], {SPACES})")} AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents), unnest(range(1, len(parts) + 1)) AS u(k)
), shared AS (
  SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), j AS (
  SELECT l.doc_id, l.k, l.line, coalesce(s.first <> l.doc_id, false) AS gone FROM l LEFT JOIN shared s ON l.key = s.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_WORDS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DECONTAM = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS g
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(k) WHERE len(w) > 0
), places_at AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) AS u(k)
), hits AS (SELECT a.doc_id, a.k, a.n, win.item FROM places_at a JOIN win ON a.g = win.g AND a.n = win.n),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(k, k + n)) AS u(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(p.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(i.listed, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places p USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

_SPELLING = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
), runs AS (
  SELECT doc_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '[a-zÀ-ÿ]+')) AS word FROM documents) GROUP BY ALL
), coded AS (
  SELECT doc_id, word, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || word, ''), lambda c:
           CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)]::BIGINT[] END)) AS bytes FROM runs
), hashed AS (
  SELECT word, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM coded, crc
), v AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(word, 1, (h % length(word))::BIGINT) || substr(word, (h % length(word))::BIGINT + 2) ELSE word END AS word, n
    FROM hashed) GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3
), d AS (
  SELECT word, n, k, length(word) AS size, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM v, unnest(range(1, length(word) + 1)) AS u(k)
), pairs AS (
  SELECT a.word, b.word AS near, b.n FROM d a JOIN d b ON a.rest = b.rest AND a.k = b.k AND a.size = b.size AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.rest = v.word
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.rest = v.word
), best AS (
  SELECT word, near, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS k FROM pairs
), f AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.n >= 2 * v.n THEN b.near END AS form,
         CASE WHEN b.n >= 2 * v.n THEN b.n END AS form_n
  FROM v LEFT JOIN best b ON v.word = b.word AND b.k = 1
), walk AS (
  SELECT word, word AS at FROM f UNION ALL SELECT w.word, f.form FROM walk w JOIN f ON w.at = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN walk w ON w.word = f.word JOIN f e ON w.at = e.word WHERE e.form IS NULL
"""

# The pages of the tables mark their text by <article>, headings and paragraphs; the
# references in them are those named here (an ampersand may lack its semicolon).
_PAGES = r"""
WITH b AS (
  SELECT page_id, url, list_filter(list_transform(
           regexp_split_to_array(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '</?(?:p|h1)>'),
           lambda x: trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(
             regexp_replace(x, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'),
             '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM pages
), t AS (SELECT page_id, url, array_to_string(blocks, chr(10) || chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t
"""

ORACLE = {"op4_chat": _CHAT, "op6_linededup": _LINES, "op10_decontam": _DECONTAM, "op11_spelling": _SPELLING, "op13_pages": _PAGES}
