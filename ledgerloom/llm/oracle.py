"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

#: the words of a text
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH sized AS (
    SELECT doc_id, source, len({_WORDS}) AS size,
           md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
    FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
listed AS (
    SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight,
           3 * source_size AS cap
    FROM per),
filled AS (
    SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(CAST(sum(cap) OVER before AS DOUBLE), 0) AS left_size,
           CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER before AS BIGINT), 0) AS left_weight,
           row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place
    FROM listed
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT left_size, left_weight, place FROM filled WHERE left_size * weight / left_weight <= cap ORDER BY place LIMIT 1),
plan AS (
    SELECT f.source, f.source_size,
           CAST(CASE WHEN f.place >= l.place THEN l.left_size * f.weight / l.left_weight ELSE f.cap END AS DOUBLE) AS target
    FROM filled f LEFT JOIN level l ON true),
whole AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM plan),
queue AS (
    SELECT s.doc_id, s.source, s.size, w.source_size, w.target, w.epochs,
           CAST(floor(w.target + 0.5) AS BIGINT) - w.epochs * w.source_size AS goal,
           coalesce(CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.turn, s.doc_id, s.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS ahead
    FROM sized s JOIN whole w ON s.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, goal - ahead)) AS BIGINT) AS taken
FROM queue
"""

OP5 = r"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM numbered),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
    SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS dropped
    FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r
"""

OP6 = r"""
WITH hosts AS (
    SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched,
           regexp_replace(regexp_extract(lower(coalesce(url, '')),
               '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#@]+\]|[^/?#:@\[\]]+)', 1), '\.$', '') AS host,
           regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS path
    FROM pages),
labelled AS (SELECT *, string_split(host, '.') AS labels FROM hosts),
names AS (
    SELECT page_id, fetched, path, CASE WHEN host = '' THEN []
           WHEN regexp_full_match(host, '\d{1,3}(\.\d{1,3}){3}|\[.*\]') THEN [host]
           ELSE list_distinct([host] || list_transform(range(2, len(labels) + 1), lambda n: array_to_string(labels[len(labels) - n + 1:], '.')))
           END AS names
    FROM labelled),
wide AS (
    SELECT page_id, fetched, names || CASE WHEN path = '' THEN [] ELSE list_transform(names, lambda x: x || '/' || path) END AS keys
    FROM names),
keyed AS (SELECT page_id, fetched, unnest(keys) AS key FROM wide),
named AS (
    SELECT key, CAST('0x' || substr(md5(key), 1, 2) AS INTEGER) AS d0, CAST('0x' || substr(md5(key), 3, 2) AS INTEGER) AS d1,
           CAST('0x' || substr(md5(key), 5, 2) AS INTEGER) AS d2, CAST('0x' || substr(md5(key), 7, 2) AS INTEGER) AS d3
    FROM (SELECT DISTINCT key FROM keyed)),
listed AS (
    SELECT *, ['adult', 'malware', 'spam'][d0 % 3 + 1] AS category, DATE '2024-01-01' + d1 AS first_day
    FROM named WHERE d0 % 4 = 0),
spans AS (
    SELECT key, category, first_day AS valid_from,
           CASE WHEN d3 % 3 >= 1 THEN first_day + d2 + 1 ELSE DATE '9999-12-31' END AS valid_until FROM listed
    UNION ALL
    SELECT key, category, first_day + d2 + 31, DATE '9999-12-31' FROM listed WHERE d3 % 3 = 2),
hits AS (
    SELECT k.page_id, count(*) AS n_entries, min({'category': s.category, 'key': s.key}) AS hit
    FROM keyed k JOIN spans s ON k.key = s.key AND k.fetched >= s.valid_from AND k.fetched < s.valid_until
    GROUP BY k.page_id)
SELECT h.page_id, h.url, h.fetched, x.page_id IS NOT NULL AS blocked, CAST(coalesce(x.n_entries, 0) AS BIGINT) AS n_entries,
       x.hit.category AS category, x.hit.key AS matched_key
FROM hosts h LEFT JOIN hits x ON h.page_id = x.page_id
"""

OP10 = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM worded),
classes AS (SELECT list_sort(s) AS s, min(doc_id) AS rep, list(doc_id) AS ids FROM sets WHERE len(s) > 0 GROUP BY 1),
shingles AS (SELECT rep, len(s) AS n, unnest(s) AS shingle FROM classes),
pairs AS (
    SELECT a.rep AS a, b.rep AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.rep < b.rep
    WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reached AS (
    SELECT rep AS node, rep AS seen FROM classes
    UNION
    SELECT r.node, e.b FROM reached r JOIN edges e ON r.seen = e.a),
components AS (SELECT node, min(seen) AS component_id FROM reached GROUP BY node),
members AS (SELECT unnest(c.ids) AS doc_id, k.component_id FROM classes c JOIN components k ON c.rep = k.node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN members m ON s.doc_id = m.doc_id
"""

OP12 = r"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
               lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents),
per AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
hashed AS (
    SELECT run, times, xor(list_reduce(
               list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                   lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [195, ord(x) - 64] END))),
               lambda c, b: xor(c >> 8, steps[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) AS h
    FROM per, crc),
damaged AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) + 2 AS BIGINT))
           ELSE run END AS word, times
    FROM hashed),
words AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
places AS (SELECT word, n, unnest(range(length(word))) AS k FROM words),
cut AS (SELECT word, n, k, left(word, k) || substr(word, k + 2) AS short FROM places),
near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.k = b.k AND a.short = b.short AND a.word <> b.word
    UNION
    SELECT w.word, w.n, c.word, c.n FROM words w JOIN cut c ON w.word = c.short
    UNION
    SELECT c.word, c.n, w.word, w.n FROM words w JOIN cut c ON w.word = c.short),
best AS (SELECT word, n, count(*) AS n_near, min({'less': -other_n, 'other': other}) AS b FROM near GROUP BY word, n),
forms AS (SELECT word, b.other AS form, -b.less AS form_n FROM best WHERE -b.less >= 5 * n),
path AS (
    SELECT word, form AS root FROM forms
    UNION
    SELECT p.word, f.form FROM path p JOIN forms f ON p.root = f.word),
roots AS (SELECT word, root FROM path WHERE root NOT IN (SELECT word FROM forms))
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, CAST(coalesce(b.n_near, 0) AS BIGINT) AS n_near, f.form_n
FROM words w LEFT JOIN best b USING (word) LEFT JOIN forms f USING (word) LEFT JOIN roots r USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_source_mixing": OP1,
        "op5_line_dedup": OP5,
        "op6_url_filters": OP6,
        "op10_jaccard_join": OP10,
        "op12_spelling_variants": OP12,
    }
