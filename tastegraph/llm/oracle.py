"""DuckDB SQL that recomputes the queries which SQL can express."""

from __future__ import annotations

from tastegraph.llm import quality, urls

_WORD = "[^ \\x09-\\x0D]+"
_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
_SHOUTS, _SYMBOLS = quality.SHOUTS, quality.SYMBOLS


def _rules_sql() -> str:
    tests = []
    for r in quality.DEFAULT_RULES:
        if r.lowest is not None:
            tests.append(f"{r.metric} >= {float(r.lowest)}")
        if r.highest is not None:
            tests.append(f"{r.metric} <= {float(r.highest)}")
    return " AND ".join(tests)


QUALITY_RULES = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls
  FROM documents),
windows AS (
  SELECT row_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w
  FROM (SELECT row_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM docs)),
repeated AS (
  SELECT row_id, i FROM (SELECT *, count(*) OVER (PARTITION BY row_id, w) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT row_id, count(DISTINCT i + o) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS o) GROUP BY row_id),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^{_SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines,
         length(regexp_replace(t, '[^{_SHOUTS}]+', '', 'g')) AS shouts,
         length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS capitals,
         length(regexp_replace(t, '[^\\p{{L}}]+', '', 'g')) AS letters,
         len(list_filter(ws, lambda x: x IN ({_STOP}))) AS stops,
         len(list_filter(ls, lambda x: left(ltrim(x), 1) IN ('-', '•', '*'))) AS bullets,
         len(list_filter(ls, lambda x: rtrim(x) LIKE '%...' OR rtrim(x) LIKE '%…')) AS ellipses
  FROM docs LEFT JOIN covered c USING (row_id)),
r AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
    CASE WHEN n_words > 0 THEN shouts / n_words ELSE 0 END AS shouts_per_word,
    CASE WHEN letters > 0 THEN capitals / letters ELSE 0 END AS capital_share,
    CASE WHEN n_words > 0 THEN stops / n_words ELSE 0 END AS stop_word_share,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share,
    CASE WHEN n_lines > 0 THEN bullets / n_lines ELSE 0 END AS bullet_line_share,
    CASE WHEN n_lines > 0 THEN ellipses / n_lines ELSE 0 END AS ellipsis_line_share,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND {_rules_sql()}) AS kept
FROM r
"""

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.DEMO_RULES)

URL_FILTERS = f"""
WITH rules(rh, rp, rv) AS (VALUES {_RULES}),
p AS (
  SELECT row_number() OVER () AS row_id, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
q AS (
  SELECT row_id, page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
hits AS (
  SELECT row_id, rh || rp AS rule, rv,
         row_number() OVER (PARTITION BY row_id ORDER BY length(rh || rp) DESC, length(rh) DESC, rv DESC) AS k
  FROM q JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, '{urls.DEFAULT_VERDICT}') AS verdict
FROM q LEFT JOIN (SELECT * FROM hits WHERE k = 1) USING (row_id)
"""

EXACT_TOP_K = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

FILL_IN_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[ \\x09-\\x0D]*[^ \\x09-\\x0D]+|[ \\x09-\\x0D]+') AS u
  FROM documents),
g AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM g),
p AS (
  SELECT *, array_to_string(list_slice(u, 1, a), '') AS prefix, array_to_string(list_slice(u, a + 1, b), '') AS middle,
         array_to_string(list_slice(u, b + 1, n), '') AS suffix
  FROM f)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

NEAR_DEDUP = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS ws
  FROM documents),
sets AS (
  SELECT row_id, doc_id, CASE WHEN len(ws) < 2 THEN ws
         ELSE list_sort(list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) END AS v
  FROM docs),
nodes AS (
  SELECT row_number() OVER () AS node, v, len(v) AS size, min(doc_id) AS rep
  FROM sets WHERE len(v) > 0 AND doc_id IS NOT NULL GROUP BY v),
grams AS (SELECT node, size, unnest(v) AS g FROM nodes),
pairs AS (
  SELECT a.node AS a, b.node AS b FROM grams a JOIN grams b ON a.g = b.g AND a.node < b.node
  GROUP BY a.node, b.node, a.size, b.size HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(a, b) AS (
  SELECT node, node FROM nodes UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
classes AS (SELECT r.a AS node, min(n.rep) AS root FROM reach r JOIN nodes n ON n.node = r.b GROUP BY r.a)
SELECT s.doc_id, len(s.v)::BIGINT AS n_shingles,
  CASE WHEN s.doc_id IS NOT NULL THEN coalesce(c.root, s.doc_id) END AS component_id,
  coalesce(s.doc_id = coalesce(c.root, s.doc_id), TRUE) AS kept
FROM sets s LEFT JOIN nodes n ON n.v = s.v LEFT JOIN classes c ON c.node = n.node"""
