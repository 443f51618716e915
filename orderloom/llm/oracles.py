"""DuckDB SQL for the registered queries that SQL can express."""

#: Words of a text: runs of anything but space and U+0009-U+000D.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRING_DEDUP = rf"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, {WORDS} AS w FROM documents),
windows AS (
  SELECT k, i, array_to_string(w[i:i + 34], ' ') AS words
  FROM (SELECT k, w, unnest(range(1, len(w) - 33)) AS i FROM docs)
),
repeated AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY words) AS n FROM windows) WHERE n > 1),
gone AS (SELECT k, list(DISTINCT p) AS places FROM (SELECT k, unnest(range(i, i + 35)) AS p FROM repeated) GROUP BY k),
kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
         CASE WHEN places IS NULL THEN w
              ELSE list_transform(list_filter(range(1, len(w) + 1), lambda p: NOT list_contains(places, p)), lambda p: w[p]) END AS kept
  FROM docs LEFT JOIN gone USING (k)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM kept
"""

JACCARD_JOIN = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 5 THEN range(1, len(w) - 3) WHEN len(w) > 0 THEN [1] ELSE [] END) AS i FROM docs)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)
),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id
"""

#: Host, path and the form that aliases share; see url_filter.
_HOST = r"coalesce(translate(regexp_extract({u}, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_PATH = r"coalesce(regexp_extract({u}, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '')"
_QUERY = r"""array_to_string(list_sort(list_filter(string_split(regexp_extract({u}, '^.*?://[^?#]*\?([^#]*)', 1, 's'), '&'),
  lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|gclid|fbclid|ref|mc_[a-z]+)=', 'i'))), '&')"""
_FORM = f"""CASE WHEN contains({{u}}, '://') THEN {_HOST} || regexp_replace({_PATH}, '/+$', '') ||
  CASE WHEN {_QUERY} <> '' THEN '?' || {_QUERY} ELSE '' END END"""

URL_FILTER = rf"""
WITH RECURSIVE rules(verdict, rule, h, p) AS (VALUES
  ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'), ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
  ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
seen AS (SELECT page_id, url, html, {_HOST.format(u="url")} AS host, {_PATH.format(u="url")} AS path, {_FORM.format(u="url")} AS form FROM pages),
named AS (
  SELECT form, replace(regexp_replace(raw, '&(amp|#0*38|#x0*26);', '&', 'gi'), '&#47;', '/') AS url FROM (SELECT form, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?i)<link\b[^>]*'), lambda t: regexp_matches(t, '(?i)[^\w-]rel\s*=\s*("([^"]*\s)?canonical["\s]|''([^'']*\s)?canonical[''\s]|canonical\b)')),
      lambda t: regexp_extract(t, '(?i)[^\w-]href\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(list_filter(regexp_extract_all(html, '(?i)<meta\b[^>]*'), lambda t: regexp_matches(t, '(?i)[^\w-]http-equiv\s*=\s*["'']?refresh\b')),
      lambda t: regexp_extract(t, '(?i)[^\w-]content\s*=\s*["'']?\s*[0-9.]*\s*;\s*url\s*=\s*[''"]?([^"''\s>]+)', 1)))) AS raw
  FROM seen WHERE form IS NOT NULL) WHERE raw <> ''
),
ends AS (SELECT form, url, {_HOST.format(u="url")} AS host, {_PATH.format(u="url")} AS path, {_FORM.format(u="url")} AS other FROM named WHERE contains(url, '://')),
edges AS (SELECT form AS a, other AS b FROM ends UNION SELECT other, form FROM ends),
places AS (SELECT form, host, path FROM seen WHERE form IS NOT NULL UNION SELECT other, host, path FROM ends),
fits AS (
  SELECT s.host, s.path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM seen UNION SELECT DISTINCT host, path FROM ends) s
  JOIN rules ON (s.host = h OR ends_with(s.host, '.' || h)) AND starts_with(s.path, p) GROUP BY ALL
),
said AS (SELECT form, bool_or(verdict = 'allow') AS allowed, bool_or(verdict = 'block') AS blocked FROM places JOIN fits USING (host, path) GROUP BY form),
reach(a, b) AS (SELECT form, form FROM places UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
shared AS (SELECT a AS form, CASE WHEN bool_or(allowed) THEN 'allow' WHEN bool_or(blocked) THEN 'block' END AS verdict FROM reach JOIN said ON b = said.form GROUP BY a)
SELECT page_id, s.host, s.path, rule, coalesce(f.verdict, shared.verdict, 'allow') AS verdict
FROM seen s LEFT JOIN fits f ON s.host = f.host AND s.path = f.path LEFT JOIN shared ON s.form = shared.form
"""

FILTER_AUDIT = rf"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masked AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM docs LEFT JOIN marks USING (doc_id)
),
counts AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM masked GROUP BY ALL),
bits(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS o
  FROM bits a, bits b, bits c, bits d, bits e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
),
steps AS (SELECT filter_order, step, o[step] AS bit, coalesce(list_sum(o[1:step - 1]), 0)::INTEGER AS before FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM orders)),
audit AS (
  SELECT part, filter_order, step, bit, sum(n) FILTER (mask & (before | bit) = 0) AS kept, sum(n) FILTER (mask & before = 0 AND mask & bit <> 0) AS removed,
         sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & before = 0 AND mask & bit <> 0) AS good_lost, sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0) AS toxic_lost
  FROM counts, steps GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM audit
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
),
counts AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) t(m) WHERE len(w) >= m) GROUP BY ALL
),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang),
found AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE m > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM found) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longest
  FROM (SELECT lang, w, a, m, s, unnest(range(1, m - s + 2)) AS i FROM found, (VALUES (2), (3)) t(s) WHERE s < m) GROUP BY ALL
),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN inner_phrases i USING (lang, phrase) WHERE i.longest IS NULL OR 100::HUGEINT * i.longest < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
