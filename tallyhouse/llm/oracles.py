"""DuckDB SQL for the text queries that SQL can express. It works on words and lines directly,
without the hashes, filters and partial steps of the Spark operators."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# a document is known to a line by the set of its other lines, to its host by the set of all
OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
pos AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w),
win AS (SELECT rid, p, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM pos WINDOW o AS (PARTITION BY rid ORDER BY p)),
rep AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win WHERE c IS NOT NULL),
covered AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM rep WHERE n > 1) GROUP BY rid),
raw AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM w),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
norm AS (
  SELECT rid, source, regexp_replace(regexp_replace({LOWER.format('t')}, '[0-9]+', '0', 'g'), '[\x20\x09\x0B-\x0D]+', ' ', 'g') AS t FROM w),
lines AS (SELECT rid, source, line FROM (SELECT rid, source, trim(unnest(string_split(t, chr(10))), ' ') AS line FROM norm) WHERE line <> ''),
sig AS (SELECT rid, list_sort(list_distinct(list(md5(line)))) AS s FROM lines GROUP BY rid),
line_docs AS (
  SELECT source, line, count(DISTINCT md5(CAST(list_filter(s, lambda x: x <> md5(line)) AS VARCHAR))) AS n
  FROM (SELECT DISTINCT rid, source, line FROM lines) JOIN sig USING (rid) GROUP BY source, line),
host_docs AS (SELECT source, count(DISTINCT s) AS n FROM (SELECT DISTINCT rid, source FROM lines) JOIN sig USING (rid) GROUP BY source),
often AS (
  SELECT l.source, l.line FROM line_docs l JOIN host_docs h ON l.source IS NOT DISTINCT FROM h.source WHERE l.n > 50 AND l.n > 0.01 * h.n),
gone AS (
  SELECT rid, sum(len(string_split(l.line, ' '))) AS n, count(*) AS k
  FROM lines l JOIN often o ON l.line = o.line AND l.source IS NOT DISTINCT FROM o.source GROUP BY rid),
s AS (
  SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(regexp_replace(w.t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(w.t) - length(regexp_replace(w.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words, CAST(coalesce(gone.k, 0) AS BIGINT) AS n_removed_lines
  FROM w LEFT JOIN dup USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN gone USING (rid))
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed_words >= 0.4 * n_words AS kept
FROM s
"""

OP4 = rf"""
WITH p AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages),
h AS (
  SELECT page_id, coalesce({LOWER.format("regexp_extract(rest, '^[^/?#]*')")}, '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
r AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) v(rh, rp, verdict)),
best AS (
  SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
  FROM h JOIN r ON (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
plain AS (
  SELECT regexp_replace(regexp_replace(url, '#.*$', ''), '^https?:', 'http:') AS url
  FROM pages JOIN h USING (page_id) WHERE substr(md5(url), 1, 2) < '1a' OR regexp_matches(host, '(^|\.)spam-')),
urls AS (
  SELECT page_id, url FROM pages
  UNION ALL SELECT NULL, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_medium=list#listed' FROM plain),
cut AS (
  SELECT page_id, substr(url, position('://' IN url) + 3) AS rest,
    list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=&]*|ref|fbclid|gclid)(=|$)'))) AS params
  FROM urls WHERE position('://' IN url) > 0),
canon AS (
  SELECT page_id, regexp_replace(regexp_replace({LOWER.format("regexp_extract(rest, '^[^/?#]*')")}, '^www\.', ''), '\.?(:(80|443))?$', '') AS site,
    regexp_replace(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '/+$', '')
      || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS page
  FROM cut),
hit AS (SELECT DISTINCT page_id FROM canon JOIN (SELECT DISTINCT site, page FROM canon WHERE page_id IS NULL AND site <> '') USING (site, page) WHERE page_id IS NOT NULL)
SELECT h.page_id, h.host, h.path, best.rule,
  coalesce(best.verdict, CASE WHEN hit.page_id IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  hit.page_id IS NOT NULL AS listed
FROM h LEFT JOIN best USING (page_id) LEFT JOIN hit USING (page_id)
"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, upper(sha1(t)) AS x FROM p),
w AS (SELECT x, max(page_id) AS winner FROM d GROUP BY x)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(x, 5 * g + 1, 5) AS BIGINT) >> s) & 31 AS INTEGER) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> winner THEN winner END AS refers_to
FROM d JOIN w USING (x)
"""

OP10 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS x
  FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT rid, n, s, array_to_string(w[s : s + n - 1], ' ') AS x
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rid, s, dw.n, item_id FROM dw JOIN iw ON dw.x = iw.x AND dw.n = iw.n),
words AS (SELECT rid, count(DISTINCT p) AS k FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS k, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.k, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.k, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.k, 0) > 0 AND 20 * coalesce(words.k, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

# the CRC takes the bits of a text from the lowest of each byte on; polynomial 0xEDB88320 = 3988292384
OP11 = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '[a-zÀ-ÿ]{{7,}}')) AS run FROM documents) GROUP BY ALL),
bytes AS (SELECT *, hex(encode(doc_id || ':' || run)) AS x FROM runs),
crc AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, 4 * length(x)),
    lambda i: (CAST('0x' || substr(x, 2 * (i // 8) + 1, 2) AS BIGINT) >> (i % 8)) & 1)), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) AS h
  FROM bytes),
cut AS (
  SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM crc),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
del AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS p FROM v)),
pairs AS (
  SELECT v.word AS a, d.word AS b FROM v JOIN del d ON v.word = d.rest
  UNION SELECT d.word, v.word FROM v JOIN del d ON v.word = d.rest
  UNION SELECT c.word, d.word FROM del c JOIN del d ON c.rest = d.rest AND c.p = d.p AND c.word <> d.word),
near AS (SELECT a AS word, count(*) AS n_near, max(n) AS top FROM pairs JOIN v ON v.word = b GROUP BY a),
forms AS (
  SELECT v.word, min(b) AS form, min(top) AS form_n FROM v JOIN near USING (word) JOIN pairs ON a = v.word JOIN v w ON w.word = b AND w.n = top
  WHERE top >= 10 * v.n GROUP BY v.word),
chain AS (SELECT word, form AS root FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root),
ends AS (SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms))
SELECT v.word, form, coalesce(root, v.word) AS root, v.n, coalesce(n_near, 0) AS n_near, form_n
FROM v LEFT JOIN near USING (word) LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)
"""

OP12 = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, e.vec_id, CAST(list_sum(list_transform(list_zip(q.v, e.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM e AS q JOIN e ON q.vec_id % 20 = 0 AND e.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

ORACLE_SQL = {"op1_quality_rules": OP1, "op4_url_filter": OP4, "op6_warc": OP6, "op10_decontamination": OP10, "op11_spelling": OP11, "op12_top_k": OP12}
