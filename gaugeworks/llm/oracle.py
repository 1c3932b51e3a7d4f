"""SQL for the corpus queries that SQL can express, over the same tables."""

from __future__ import annotations

from gaugeworks.llm.secret_scan import RULES

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

URL_FILTERS = f"""
WITH parsed AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {_LOWER}) AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com'))
         AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com'))
         AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    END AS rule
  FROM parsed)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END
         AS verdict
FROM ruled"""

# Turns are (head, body) pieces; the mask adds up the lengths of the pieces before.
CHAT_PERSPECTIVES = """
WITH base AS (
  SELECT conv_id AS d, role AS r, text AS x,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place
  FROM conversations),
speakers AS (
  SELECT DISTINCT conv_id AS d, role AS speaker FROM conversations
  WHERE role IS NOT NULL AND role <> 'system'),
pieces AS (
  SELECT b.d, s.speaker, CAST(b.place // 64 AS INTEGER) AS part, b.place,
         coalesce(b.r = s.speaker, false) AS own,
         CASE WHEN b.r = s.speaker THEN '<|assistant|>' || chr(10)
              WHEN b.r = 'system' THEN '<|system|>' || chr(10)
              WHEN b.r IS NULL THEN '<|user|>' || chr(10)
              ELSE '<|user ' || replace(b.r, '<|', '< |') || '|>' || chr(10) END AS head,
         replace(coalesce(b.x, ''), '<|', '< |') || '<|end|>' AS body
  FROM base b JOIN speakers s ON b.d IS NOT DISTINCT FROM s.d),
placed AS (
  SELECT *, CAST(coalesce(sum(length(head) + length(body) + 1) OVER (
              PARTITION BY d, speaker ORDER BY place
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begun
  FROM pieces)
SELECT d AS conv_id, speaker, part, CAST(count(*) AS INTEGER) AS n_turns, min(begun) AS start,
       string_agg(head || body || chr(10), '' ORDER BY place) AS rendered,
       coalesce(string_agg((begun + length(head)) || '-' || (begun + length(head) + length(body)), ','
                           ORDER BY place) FILTER (WHERE own), '') AS mask
FROM placed GROUP BY d, speaker, part"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), "
    + _LOWER
    + r"), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

# Windows are told apart by their joined words: a blank is in no word.
BENCHMARK_DECONTAMINATION = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size,
         array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS win
  FROM items, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS r(k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM item_windows),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
doc_windows AS (
  SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS win
  FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS r(k)),
met AS (SELECT d.doc_id, d.size, d.k, i.item FROM doc_windows d JOIN item_windows i USING (size, win)),
hit AS (
  SELECT doc_id, count(DISTINCT k + j) AS n_hit
  FROM met, unnest(range(0, size)) AS r(j) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)"""

NGRAM_JACCARD = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + least(len(w), 5) - 1], ' ') AS s
  FROM docs, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS r(k) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common o JOIN sizes p ON o.a = p.doc_id JOIN sizes q ON o.b = q.doc_id
  WHERE 100 * o.n >= 80 * (p.n + q.n - o.n)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles,
       least(d.doc_id, (SELECT min(b) FROM reach r WHERE r.a = d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes USING (doc_id)"""

# Every document with its links; documents of equal sets are linked with each other.
NGRAM_JACCARD_JOIN = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + least(len(w), 5) - 1], ' ') AS s
  FROM docs, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS r(k) WHERE len(w) > 0),
sets AS (SELECT doc_id, list(s ORDER BY s) AS shingles, count(*) AS n FROM shingles GROUP BY doc_id),
classes AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY shingles) AS class_id FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, count(*) AS n_links
  FROM common o JOIN classes p ON o.a = p.doc_id JOIN classes q ON o.b = q.doc_id
  WHERE 100 * o.n >= 80 * (p.n + q.n - o.n) GROUP BY a)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, class_id, coalesce(n_links, 0) AS n_links
FROM docs d LEFT JOIN classes c USING (doc_id) LEFT JOIN links l ON d.doc_id = l.a"""


def _pattern(text: str) -> str:
    return text.replace("'", "''")


# Matches are marked by control characters and their places are summed up.
_MATCHES = " UNION ALL ".join(
    f"SELECT doc_id, {k} AS k, '{rule.kind}' AS kind, {rule.least} AS least, "
    f"string_split(regexp_replace(t, '{_pattern(rule.pattern)}', "
    "chr(1) || '\\0' || chr(2), 'g'), chr(1)) AS pieces FROM docs"
    for k, rule in enumerate(RULES)
)
_FOUND = " UNION ALL ".join(
    f"SELECT *, length(regexp_extract(match, '{_pattern(rule.pattern)}', {rule.group})) AS size "
    f"FROM places WHERE k = {k} AND i > 1"
    for k, rule in enumerate(RULES)
)
SECRET_SCANS = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
marked AS ({_MATCHES}),
pieces AS (
  SELECT doc_id, k, kind, least, i, pieces[i] AS piece
  FROM marked, unnest(range(1, len(pieces) + 1)) AS r(i) WHERE len(pieces) > 1),
places AS (
  SELECT doc_id, k, kind, least, i, split_part(piece, chr(2), 1) AS match,
         coalesce(sum(length(piece) - (i > 1)::INT) OVER (
           PARTITION BY doc_id, k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS start
  FROM pieces),
found AS ({_FOUND}),
spans AS (
  SELECT doc_id, k, kind, start,
         kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(match) AS BIGINT) AS span
  FROM found WHERE size >= least),
listed AS (
  SELECT doc_id, string_agg(span, ',' ORDER BY start, k) AS spans,
         string_agg(span, ',' ORDER BY start, k) FILTER (WHERE k < 3) AS base,
         count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
         count(*) FILTER (WHERE k = 2) AS n_hex
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM docs d LEFT JOIN listed USING (doc_id)"""

FILL_IN_MIDDLE = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1,
         CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM docs),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p,
         coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM cut),
made AS (
  SELECT doc_id, n, form, length(p) AS p_size, length(m) AS m_size,
         CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END AS o FROM parts),
placed AS (
  SELECT *, strpos(o, '<P>') AS at_p, strpos(o, '<S>') AS at_s, strpos(o, '<M>') AS at_m FROM made)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN p_size END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN m_size END AS middle_chars,
       sha256(o) AS output_sha256,
       sha256(CASE form
         WHEN 'psm' THEN substr(o, 4, at_s - 4) || substr(o, at_m + 3) || substr(o, at_s + 3, at_m - at_s - 3)
         WHEN 'spm' THEN substr(o, at_p + 3, at_m - at_p - 3) || substr(o, at_m + 3) || substr(o, 4, at_p - 4)
         ELSE o END) AS restored_sha256
FROM placed"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_filters": URL_FILTERS,
        "op6_chat_perspectives": CHAT_PERSPECTIVES,
        "op8_benchmark_decontamination": BENCHMARK_DECONTAMINATION,
        "op10_ngram_jaccard": NGRAM_JACCARD,
        "op10_ngram_jaccard_join": NGRAM_JACCARD_JOIN,
        "op11_secret_scans": SECRET_SCANS,
        "op13_fill_in_middle": FILL_IN_MIDDLE,
    }
