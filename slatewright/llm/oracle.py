"""The same results in DuckDB SQL, for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + 9], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM item_windows),
places AS (SELECT k, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
found AS (
  SELECT p.k, p.s, p.n, x.item_id
  FROM (SELECT k, n, s, array_to_string(w[s : s + n - 1], ' ') AS words FROM places) p
  JOIN item_windows x ON x.n = p.n AND x.words = p.words
),
hit AS (SELECT k, count(DISTINCT word) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS word FROM found) GROUP BY k),
items AS (
  SELECT k, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (k) LEFT JOIN items USING (k)
"""

_QUALITY_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
places AS (
  SELECT k, s, array_to_string(w[s : s + 7], ' ') AS words FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS s FROM d WHERE len(w) >= 8)
),
several AS (SELECT k, s FROM places QUALIFY count(*) OVER (PARTITION BY k, words) > 1),
repeated AS (SELECT k, count(DISTINCT word) AS n FROM (SELECT k, unnest(range(s, s + 8)) AS word FROM several) GROUP BY k),
counts AS (
  SELECT k, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS n_capitals,
    coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN repeated USING (k)
),
measures AS (
  SELECT k, lang, source, unnest([
    {'m': 'symbols', 'v': 1000 * n_symbols // n_words, 'least': 12},
    {'m': 'repeats', 'v': 1000 * n_repeat_words // n_words, 'least': 25},
    {'m': 'dup_lines', 'v': 1000 * n_dup_lines // n_lines, 'least': 25},
    {'m': 'capitals', 'v': 1000 * n_capitals // word_chars, 'least': 20},
    {'m': 'word_length', 'v': 100 * word_chars // n_words, 'least': 60}], recursive := true)
  FROM counts WHERE n_words > 0
),
sketch AS (
  SELECT lang, source, m, least, (v >> low) << low AS r, count(*) AS n
  FROM (SELECT *, greatest(0, length(bin(v)) - 6) AS low FROM measures) GROUP BY ALL
),
own AS (
  SELECT lang, source, m, least, max(total) AS total, min(r) FILTER (below * 4 >= total) AS q1,
    min(r) FILTER (below * 4 >= total * 2) AS q2, min(r) FILTER (below * 4 >= total * 3) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, m ORDER BY r) AS below, sum(n) OVER (PARTITION BY lang, source, m) AS total FROM sketch)
  GROUP BY lang, source, m, least
),
shared AS (
  SELECT lang, m, min(r) FILTER (below * 4 >= total) AS q1,
    min(r) FILTER (below * 4 >= total * 2) AS q2, min(r) FILTER (below * 4 >= total * 3) AS q3
  FROM (
    SELECT *, sum(n) OVER (PARTITION BY lang, m ORDER BY r) AS below, sum(n) OVER (PARTITION BY lang, m) AS total
    FROM (SELECT lang, m, r, sum(n) AS n FROM sketch GROUP BY lang, m, r)
  ) GROUP BY lang, m
),
quartiles AS (
  SELECT o.lang, o.source, o.m, o.least, if(o.total < 30, s.q1, o.q1) AS q1, if(o.total < 30, s.q2, o.q2) AS q2, if(o.total < 30, s.q3, o.q3) AS q3
  FROM own o JOIN shared s ON o.lang IS NOT DISTINCT FROM s.lang AND o.m = s.m
),
broken AS (
  SELECT k, string_agg(x.m, ',' ORDER BY x.m) AS broken
  FROM measures x JOIN quartiles q ON x.lang IS NOT DISTINCT FROM q.lang AND x.source IS NOT DISTINCT FROM q.source AND x.m = q.m
  WHERE x.v > q.q2 + 8 * greatest(q.least, q.q2 - q.q1) OR (x.m = 'word_length' AND x.v < q.q2 - 8 * greatest(q.least, q.q3 - q.q2))
  GROUP BY k
),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND broken IS NULL AS kept, coalesce(broken, '') AS broken
FROM judged LEFT JOIN broken USING (k)
"""

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _address(url: str) -> str:
    host = rf"translate(regexp_extract(coalesce({url}, ''), '^(?s:.*?)://([^/?#]*)', 1), {_UPPER}) AS host"
    return host + rf", regexp_extract(coalesce({url}, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path"


def _node(url: str) -> str:
    whole = rf"regexp_replace(trim({url}, ' '), '(?s)#.*$', '')"
    head = rf"regexp_extract({whole}, '^((?s:.*?)://[^/?#]*)', 1)"
    return f"translate({head}, {_UPPER}) || substr({whole}, length({head}) + 1)"


_URL_BLOCKS = rf"""
WITH RECURSIVE rules(verdict, own, prefix) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
tags AS (
  SELECT url, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM pages
  WHERE url IS NOT NULL AND regexp_matches(coalesce(html, ''), '(?i)canonical|http-equiv')
),
targets AS (
  SELECT url, replace(CASE
    WHEN regexp_matches(tag, '(?i)rel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)href\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?i)http-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?is)url\s*=\s*["'']?([^"''\s>]+)', 1)
  END, '&amp;', '&') AS target FROM tags
),
bases AS (
  SELECT url, regexp_replace(trim(target), '(?s)#.*$', '') AS target, regexp_extract(url, '^(?s)(.*?://[^/?#]*)', 1) AS site,
    substr(regexp_replace(url, '(?s)[?#].*$', ''), length(site) + 1) AS path FROM targets WHERE target IS NOT NULL
),
whole AS (
  SELECT url, CASE
    WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
    WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') OR target = '' OR site = '' THEN NULL
    WHEN starts_with(target, '//') THEN regexp_extract(site, '^(?s)(.*?:)//', 1) || target
    WHEN starts_with(target, '/') THEN site || target
    WHEN starts_with(target, '?') THEN site || path || target
    ELSE site || regexp_replace(path, '(?s)[^/]*$', '') || if(contains(path, '/'), '', '/') || target
  END AS target FROM bases
),
parts AS (
  SELECT url, target, regexp_extract(target, '^(?s)(.*?://[^/?]*)', 1) AS head, regexp_extract(target, '(?s)(\?.*)$', 1) AS query,
    regexp_replace(substr(target, length(head) + 1), '(?s)\?.*$', '') AS path FROM whole
),
plain AS (
  SELECT url, CASE WHEN regexp_matches(path, '(^|/)[.][.]?(/|$)') THEN head || list_reduce(
      list_prepend('', string_split(path, '/')[2:]),
      lambda kept, s: CASE WHEN s = '.' THEN kept WHEN s = '..' THEN regexp_replace(kept, '/[^/]*$', '') ELSE kept || '/' || s END
    ) || if(string_split(path, '/')[-1] IN ('.', '..'), '/', '') || query ELSE target END AS target
  FROM parts
),
links AS (SELECT DISTINCT {_node("url")} AS a, {_node("target")} AS b FROM plain WHERE contains(target, '://')),
ties AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(a, b) AS (SELECT a, a FROM ties UNION SELECT r.a, e.b FROM reached r JOIN ties e ON e.a = r.b),
addresses AS (SELECT DISTINCT a AS node, {_address("a")} FROM ties),
node_rules AS (
  SELECT node, arg_max(r.verdict, length(r.own || r.prefix)) AS verdict
  FROM addresses JOIN rules r ON (host = r.own OR ends_with(host, '.' || r.own)) AND starts_with(path, r.prefix) GROUP BY node
),
stopped AS (
  SELECT r.a AS node FROM reached r JOIN node_rules v ON v.node = r.b GROUP BY r.a
  HAVING bool_or(v.verdict = 'block') AND NOT bool_or(v.verdict = 'allow')
),
rows AS (SELECT row_number() OVER () AS k, page_id, url, {_address("url")} FROM pages),
own AS (
  SELECT k, arg_max(r.own || r.prefix, length(r.own || r.prefix)) AS rule, arg_max(r.verdict, length(r.own || r.prefix)) AS verdict
  FROM rows JOIN rules r ON (host = r.own OR ends_with(host, '.' || r.own)) AND starts_with(path, r.prefix) GROUP BY k
)
SELECT page_id, host, path, rule, coalesce(own.verdict, if(stopped.node IS NOT NULL, 'block', 'allow')) AS verdict
FROM rows LEFT JOIN own USING (k) LEFT JOIN stopped ON stopped.node = {_node("url")}
"""

ORACLE: dict[str, str] = {
    "op2_quality_rules": _QUALITY_RULES,
    "op7_decontaminate": _DECONTAMINATE,
    "op8_url_blocks": _URL_BLOCKS,
}

ORACLE["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece
  FROM documents WHERE text IS NOT NULL
),
words AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
grams AS (
  SELECT lang, k AS words, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3)) v(k) WHERE len(w) >= k
),
counts AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE words = 1 GROUP BY lang),
candidates AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE words > 1 AND f >= 10),
heads AS (
  SELECT lang, phrase, words, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM candidates, (VALUES (1), (2)) v(k) WHERE k < words
),
cuts AS (
  SELECT c.lang, c.phrase, c.words, c.a, k, l.f AS l, r.f AS r,
    ((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM heads c JOIN counts l ON l.lang = c.lang AND l.phrase = c.head JOIN counts r ON r.lang = c.lang AND r.phrase = c.tail
),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS most
  FROM candidates, (VALUES (1), (2)) v(i) WHERE words = 3 GROUP BY 1, 2
),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase AND s.words = 2
  WHERE g.most IS NULL OR 100 * g.most < 50 * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

ORACLE["op12_nearest"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 20
"""
