"""DuckDB SQL that must give the rows of the registered queries."""

from __future__ import annotations

from keypanel.llm.license_scan import GAP_WORDS, K, LEAST_SHARE, PHRASES, TEMPLATES
from keypanel.llm.quality_rules import RULES, STOP_WORDS
from keypanel.llm.words import LOWER, UPPER

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"


def words_sql(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{WORD}')"


def rules_sql(rules=RULES) -> str:
    bounds = [f"{m} >= {low}" for m, low, _ in rules if low is not None]
    return " AND ".join(bounds + [f"{m} <= {high}" for m, _, high in rules if high is not None])


URLS = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
SELECT page_id, host, path, rh || rp AS rule, coalesce(v, 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) = 1
"""


def contamination_sql(docs: str = "documents", tail: str | None = None) -> str:
    return f"""
WITH it AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words_sql('text')} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s + 1 : s + least(len(w), 10)], ' ') AS win
  FROM (SELECT item, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS s FROM it WHERE len(w) > 0)),
d AS (SELECT *, {words_sql('text')} AS w FROM {docs}),
pos AS (SELECT doc_id, w, unnest(range(len(w))) AS p FROM d),
cut AS (SELECT doc_id, p, n, array_to_string(w[p + 1 : p + n], ' ') AS win
        FROM pos JOIN (SELECT DISTINCT n FROM win) ON p + n <= len(w)),
hit AS (SELECT doc_id, p, cut.n, item FROM cut JOIN win USING (win)),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
        FROM hit GROUP BY 1)
""" + (tail or """
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
""")


CONTAMINATION = contamination_sql()

_STOPS = ", ".join(f"'{w}'" for line in STOP_WORDS.values() for w in line.split())

QUALITY = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{SPACED}')) AS l
           FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 3], ' ') AS gram
      FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 2, 0))) AS i FROM d)),
twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS q FROM twice) GROUP BY 1),
m AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS n_stop_words
      FROM d LEFT JOIN rep USING (doc_id)),
r AS (SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbol_ratio,
             n_stop_words / greatest(n_words, 1) AS stop_word_ratio, n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio,
             n_repeat_words / greatest(n_words, 1) AS repeat_word_ratio,
             (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND {rules_sql()}) AS kept
FROM r
"""


def _template_rows() -> str:
    rows = [f"('{kind}', '{label}', {len(text.split())}, {i}, '{' '.join(text.split()[i:i + K])}')"
            for kind, table in (("phrase", PHRASES), ("notice", TEMPLATES)) for label, text in table
            for i in range(len(text.split()) - K + 1)]
    return ", ".join(rows)


LICENSES = f"""
WITH tpl(kind, label, n, tpos, gram) AS (VALUES {_template_rows()}),
d AS (SELECT doc_id, {words_sql('text')} AS w FROM documents),
pos AS (SELECT doc_id, p, array_to_string(w[p + 1 : p + {K}], ' ') AS gram
        FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - {K - 1}, 0))) AS p FROM d)),
v AS (SELECT doc_id, kind, label, n, p - tpos AS diagonal, tpos, p FROM pos JOIN tpl USING (gram)),
base AS (SELECT doc_id, label, diagonal AS start FROM v WHERE kind = 'phrase'
         GROUP BY doc_id, label, n, diagonal HAVING count(*) = n - {K - 1}),
diag AS (SELECT DISTINCT doc_id, label, diagonal FROM v WHERE kind = 'notice'),
new AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= {GAP_WORDS} THEN 0 ELSE 1 END AS fresh FROM diag
        WINDOW o AS (PARTITION BY doc_id, label ORDER BY diagonal)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, label ORDER BY diagonal) AS span FROM new),
parts AS (SELECT doc_id, label, n, span, p, unnest(range(tpos, tpos + {K})) AS t
          FROM v JOIN runs USING (doc_id, label, diagonal) WHERE kind = 'notice'),
spans AS (SELECT doc_id, label, count(DISTINCT t) / n AS share FROM parts GROUP BY doc_id, label, n, span
          HAVING share >= {LEAST_SHARE} AND max(p) + {K - 1} - min(p) < n + {2 * GAP_WORDS}),
found AS (SELECT doc_id, label, start, 1.0 AS share FROM base UNION ALL SELECT doc_id, label, NULL, share FROM spans),
agg AS (SELECT doc_id, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word,
               coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (start IS NOT NULL), '') AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
        FROM found GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN agg USING (doc_id)
"""


PERSPECTIVES = """
WITH t AS (
  SELECT conv_id, turn, CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE role END AS role,
         replace(coalesce(text, ''), '<|', '<\\|') || '<|end|>' || chr(10) AS body, coalesce(text, '') AS raw
  FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE coalesce(role, '') <> '' AND role <> 'system'),
r AS (
  SELECT t.conv_id, speaker, turn, t.role, raw, body, t.role = speaker AS own,
         CASE WHEN t.role = speaker THEN '<|assistant|>' WHEN t.role = 'system' THEN '<|system|>'
              ELSE '<|user name=' || replace(t.role, '<|', '<\\|') || '|>' END || chr(10) AS head
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (SELECT *, sum(length(head) + length(body)) OVER (
        PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, role, raw ROWS UNBOUNDED PRECEDING) AS stop FROM r)
SELECT conv_id, speaker, CAST(0 AS BIGINT) AS block, CAST(0 AS BIGINT) AS lot, CAST(count(*) AS INTEGER) AS n_turns,
       string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, raw) AS text,
       coalesce(string_agg((stop - length(body)) || '-' || stop, ',' ORDER BY stop) FILTER (own), '') AS mask
FROM o GROUP BY conv_id, speaker
"""

REVISITS = """
WITH c AS (
  SELECT page_id, html, page_id % 3 = 0 AS full_response, page_id * 60 AS at, CAST(page_id // 12 AS VARCHAR) AS v,
         regexp_extract(url, '^[^:]+://[^/]+/[^/]+/') AS uri FROM pages),
u AS (SELECT *, CASE WHEN uri <> '' THEN lower(regexp_extract(uri, '^([^:]+://[^/]+)', 1)) || regexp_extract(uri, '^[^:]+://[^/]+(.*)$', 1) END AS url FROM c),
a AS (SELECT v.page_id, v.url, v.v, r.page_id AS response_id, r.v AS rv, r.html
      FROM (SELECT * FROM u WHERE NOT full_response) v
      ASOF LEFT JOIN (SELECT * FROM u WHERE full_response AND url IS NOT NULL) r ON v.url = r.url AND v.at > r.at),
s AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no-response'
                     WHEN page_id % 5 = 0 AND page_id % 2 <> 0 THEN 'unvalidated'
                     WHEN v = rv THEN 'resolved' ELSE 'mismatch' END AS state FROM a)
SELECT page_id, url, response_id, state,
       CASE WHEN state = 'resolved' THEN 'Content-Type: text/html' || chr(10) || 'Content-Length: ' || octet_length(encode(html)) || chr(10)
         || CASE WHEN page_id % 5 <> 0 THEN 'Last-Modified: day ' || rv || chr(10) || 'etag: W/"' || v || '"'
                 ELSE 'ETag: "' || rv || '"' || chr(10) || 'Last-Modified: day ' || v END
         || chr(10) || 'cache-control: max-age=90' || chr(10) || 'Age: ' || page_id END AS headers,
       CASE WHEN state = 'resolved' THEN md5(html) END AS payload_md5
FROM s
"""
