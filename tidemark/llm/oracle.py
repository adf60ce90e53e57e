"""DuckDB SQL for the queries that SQL can express.

The other queries (fingerprints, trained models, token ids, HTML, corpus
disclosure) are held against brute force or held-out accuracy in the tests.
"""

from __future__ import annotations

from tidemark.llm.licenses import CATALOGUE, END_OF_TERMS, NAMES, SPELLINGS, TEXTS, TITLES, VERBS
from tidemark.llm.secret_scan import ALLOWED, THRESHOLDS, WINDOW

OP5 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM (SELECT item_id, w, least(10, len(w)) AS n FROM item WHERE len(w) > 0))),
occ AS (
  SELECT d.r, d.i, win.n, win.item_id
  FROM (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)) d
  JOIN win ON win.n = d.n AND win.s = d.s),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM occ) GROUP BY r),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS s
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS t FROM occ WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""

OP7 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM pair)
WHERE rank <= 5
"""


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


MARKS = r"^[ \t#/*;%!>|<-]*"
ANY_COPYRIGHT = MARKS + r"(?:copyright|\(c\)|©|all rights reserved)"
LICENSE_COPYRIGHT = MARKS + (r"copyright[ \t]+(?:holders?|owners?|notices?|statements?|laws?|licen[sc]e|interest|and|or)\b")
WORDING = (r"(?:released under|licen[sc]ed under|distributed under|this work is licen[sc]ed|permission is hereby|permission to use|"
           r"redistribution and use|everyone is permitted)\b")


def canonical_sql(text: str) -> str:
    """The canonical form of each line of ``text``; of a copyright statement only licence wording after it stays."""
    sql = f"""array_to_string(list_transform(string_split(lower({text}), chr(10)), lambda line:
      CASE WHEN regexp_matches(line, {quoted(ANY_COPYRIGHT)}) AND NOT regexp_matches(line, {quoted(LICENSE_COPYRIGHT)})
        THEN regexp_extract(line, {quoted(ANY_COPYRIGHT + '.*?[ \\t](' + WORDING + '.*)$')}, 1) ELSE line END), chr(10))"""
    for other, one in SPELLINGS:
        sql = f"replace({sql}, {quoted(other)}, {quoted(one)})"
    signs = r"\x00-\x09\x0B-\x1F\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F©“”‘’«»–—"
    return f"regexp_replace({sql}, '\\x20*[{signs}][{signs}\\x20]*|\\x20{{2,}}', ' ', 'g')"


def values(rows) -> str:
    return ", ".join(f"({', '.join(quoted(v) for v in row)})" for row in rows)


# The whole catalogue: rows of its own, entire texts with and without what follows their terms, with bullets and titles, notices.
OP6 = f"""
WITH entire(l, t) AS (VALUES {values((p.stem, p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt")))}),
title(l, title) AS (VALUES {values(TITLES.items())}),
listed AS (SELECT l, t, title FROM entire JOIN title USING (l)
  UNION ALL SELECT l, regexp_replace(t, '(?m)^\\d\\. ', '* ', 'g'), title FROM entire JOIN title USING (l)),
notice(l, t) AS (VALUES {values((name, form) for name, forms in NAMES for form in forms)}),
verb(v) AS (VALUES {values((v,) for v in VERBS)}),
catalogue(l, t) AS (VALUES {values(CATALOGUE)}
  UNION ALL SELECT l, t FROM entire
  UNION ALL SELECT l, split_part(t, '{END_OF_TERMS}', 1) || e FROM entire, (VALUES (''), ('{END_OF_TERMS}')) AS ends(e)
    WHERE contains(t, '{END_OF_TERMS}')
  UNION ALL SELECT l, t FROM listed UNION ALL SELECT l, title || chr(10) || chr(10) || t FROM listed
  UNION ALL SELECT l, v || ' ' || t || '.' FROM notice, verb),
known AS (
  SELECT trim(regexp_replace({canonical_sql('t')}, '\\x20*\\n[\\x20\\n]*', ' ', 'g')) AS form, min(l) AS license
  FROM catalogue GROUP BY form HAVING form <> ''),
doc AS (SELECT row_number() OVER () AS r, doc_id, {canonical_sql("coalesce(text, '')")} AS form FROM documents),
line AS (
  SELECT r, string_agg(license, ',' ORDER BY license) AS lines, count(*) AS n
  FROM (SELECT DISTINCT r, license FROM (SELECT r, trim(unnest(string_split(form, chr(10)))) AS form FROM doc) u
        JOIN known USING (form)) GROUP BY r)
SELECT doc_id, license AS whole, coalesce(lines, '') AS lines, coalesce(n, 0) AS n_licenses
FROM doc LEFT JOIN known ON known.form = trim(regexp_replace(doc.form, '\\x20*\\n[\\x20\\n]*', ' ', 'g'))
LEFT JOIN line USING (r)
"""


def spans_sql(kind: str, rank: int, pattern: str, condition: str) -> str:
    """(r, start, rank, kind, end) of the matches ``m`` that meet ``condition``: pieces and matches alternate."""
    return f"""
  SELECT r, s AS start, {rank} AS rank, '{kind}' AS kind, s + length(m) AS "end", m
  FROM (SELECT r, i, m, CAST(sum(length(g)) OVER w + sum(length(m)) OVER w - length(m) AS BIGINT) AS s
        FROM (SELECT r, unnest(range(1, len(f) + 1)) AS i, unnest(f) AS m, unnest(g[1:len(f)]) AS g
              FROM (SELECT r, regexp_extract_all(text, {quoted(pattern)}) AS f,
                      string_split_regex(text, {quoted(pattern)}) AS g FROM doc) WHERE len(f) > 0)
        WINDOW w AS (PARTITION BY r ORDER BY i))
  WHERE {condition}"""


KEYWORD = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
MIXED = " AND ".join(["regexp_matches(c.m, '[0-9]')", "regexp_matches(c.m, '[A-Za-z]')",
                      *(f"NOT regexp_matches(c.m, {quoted(p)})" for p in ALLOWED)])
OP8 = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS ({spans_sql('assign', 0, KEYWORD + '[A-Za-z0-9+/_.=-]+',
                    "length(regexp_replace(m, " + quoted('^' + KEYWORD) + ", '')) >= 6")}
  UNION ALL {spans_sql('access', 1, 'AKIA[A-Z0-9]+', 'length(m) >= 20')}
  UNION ALL {spans_sql('hex', 2, '[0-9a-f]+', 'length(m) >= 24')}),
cand AS ({spans_sql('entropy', 3, '[A-Za-z0-9+/_=-]{20,}', 'true')}),
odd AS (
  SELECT c.* FROM cand c
  WHERE {MIXED}
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = c.r AND b.start < c."end" AND b."end" > c.start)
    AND round(list_max(list_transform(range(1, length(c.m) - {WINDOW - 2}),
          lambda i: list_aggregate(string_split(substr(c.m, i, {WINDOW}), ''), 'entropy'))), 9) >=
        CASE WHEN regexp_full_match(c.m, '[0-9a-f]+|[0-9A-F]+') THEN {THRESHOLDS['hex']}
             WHEN regexp_full_match(c.m, '[A-Za-z0-9]+') THEN {THRESHOLDS['alnum']} ELSE {THRESHOLDS['base64']} END),
every AS (SELECT * FROM base UNION ALL SELECT * FROM odd),
said AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) FILTER (rank < 3) AS base_spans,
    string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) AS spans
  FROM every GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN said USING (r)
"""

OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS r,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
pos AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS nth FROM pair WHERE same
  QUALIFY nth <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM pos p JOIN pair n ON n.r = p.r AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.r, p.nth ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 10
"""

OP12 = r"""
SELECT doc_id, first_value(doc_id) OVER same AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER same = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW same AS (PARTITION BY t ORDER BY doc_id NULLS LAST)
"""

OP13 = r"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT c, c - c % 20 AS base, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: list_reduce([xor(a, b)] || range(8), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM own)),
sized AS (
  SELECT conv.*, least(h, (SELECT count(*) FROM own WHERE own.c = conv.base)) AS k FROM conv),
re AS (
  SELECT s.c, o.pos AS d, o.role, o.text FROM sized s JOIN own o ON o.c = s.base AND o.pos <= s.k
  UNION ALL
  SELECT s.c, o.pos - s.h + s.k, o.role, o.text FROM sized s JOIN own o ON o.c = s.c AND o.pos > s.h),
seq AS (
  SELECT c, coalesce(list([role, text] ORDER BY d) FILTER (d IS NOT NULL), []) AS s
  FROM conv LEFT JOIN re USING (c) GROUP BY c),
pre AS (SELECT c, s, d, s[1:d] AS p FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seq)),
node AS (
  SELECT p, any_value(d) AS d, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d), '') AS ends,
    (count(*) - 1) * coalesce(len(regexp_extract_all(p[len(p)][2], '[^\x20\x09-\x0D]+')), 0) AS save
  FROM pre GROUP BY p),
up AS (
  SELECT n.*, m.conv_id AS parent_conv_id FROM node n LEFT JOIN node m ON n.d > 0 AND m.p = n.p[1:n.d - 1]),
kid AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
below AS (
  SELECT n.p[1:a.i] AS p, sum(CASE WHEN kid.p IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(save) AS saved_tokens
  FROM node n LEFT JOIN kid ON kid.p = n.p, LATERAL (SELECT unnest(range(0, n.d + 1)) AS i) a GROUP BY 1)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM up LEFT JOIN kid USING (p) JOIN below USING (p)
"""

ORACLE: dict[str, str] = {
    "op5_decontamination": OP5,
    "op6_licenses": OP6,
    "op7_topk": OP7,
    "op8_secrets": OP8,
    "op11_hard_negatives": OP11,
    "op12_exact_dedup": OP12,
    "op13_prefix_trie": OP13,
}
