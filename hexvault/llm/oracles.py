"""DuckDB forms of the operators that SQL can express, over the same tables."""

from __future__ import annotations

from hexvault.llm import quality_rules as Q
from hexvault.llm import secret_scan as S

_WORD = r"[^\x20\x09-\x0D]+"


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: str, pattern: str, group: int = 0, keep: str = "true") -> str:
    """start, end and value of every match: gaps and matches interleave."""
    p = _text(pattern)
    return f"""
    SELECT r, '{kind}' AS kind, a AS s, a + length(m[i]) AS e, v[i] AS value FROM (
      SELECT r, m, v, i, list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT
             + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0)::BIGINT AS a
      FROM (SELECT r, regexp_extract_all(t, {p}, 0) AS m, regexp_extract_all(t, {p}, {group}) AS v,
                   string_split_regex(t, {p}) AS g FROM d WHERE regexp_matches(t, {p})) x,
           unnest(range(1, len(m) + 1)) u(i)) y
    WHERE {keep.replace('value', 'v[i]')}"""


_KIND = "list_position([" + ", ".join(f"'{k}'" for k in S.KINDS) + "], kind)"
_SPANS = f"coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, {_KIND}, e), '')"

SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, concat_ws('/', source, lang) AS repo,
                  coalesce(text, '') AS t FROM documents),
base AS ({_matches('assign', S.ASSIGN, 2, f'length(value) >= {S.MIN_ASSIGN_VALUE}')}
  UNION ALL {_matches('access', S.ACCESS)} UNION ALL {_matches('hex', S.HEX)}),
cand AS (SELECT DISTINCT r, e - length(value) AS s, e, value FROM (
  SELECT * FROM base UNION ALL {_matches('token', S.TOKEN)})),
held AS (SELECT value, count(DISTINCT coalesce(source, chr(1))) AS owners,
                count(DISTINCT coalesce(source, chr(1)) || chr(2) || repo) AS repos FROM cand JOIN d USING (r) GROUP BY value),
judged AS (SELECT r, s, e, CASE WHEN owners >= {S.MIN_EXAMPLE_OWNERS} OR repos >= {S.MIN_EXAMPLE_REPOSITORIES} THEN 'example'
    WHEN owners <= {S.MAX_LIVE_OWNERS} AND repos <= {S.MAX_LIVE_REPOSITORIES} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
         AND NOT regexp_matches(value, {_text(S.PLACEHOLDER)})
         AND len(list_distinct(string_split(value, ''))) >= 8 THEN 'live' END AS kind
  FROM cand JOIN held USING (value)),
added AS (SELECT DISTINCT r, kind, s, e FROM judged WHERE kind IS NOT NULL),
b AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex, {_SPANS} AS spans FROM base GROUP BY r),
a AS (SELECT r, count(*) FILTER (kind = 'live') AS n_live, count(*) FILTER (kind = 'example') AS n_example
      FROM added GROUP BY r),
j AS (SELECT r, {_SPANS} AS spans FROM (SELECT r, kind, s, e FROM base UNION ALL SELECT r, kind, s, e FROM added)
      GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.spans, '')) AS base_sha256, coalesce(j.spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN b USING (r) LEFT JOIN a USING (r) LEFT JOIN j USING (r)
"""

QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS t
           FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS words FROM d),
win AS (SELECT r, i, words[i:i + {Q.WINDOW - 1}] AS g FROM w, unnest(range(1, len(words) - {Q.WINDOW - 2})) u(i)),
twice AS (SELECT r, g FROM win GROUP BY r, g HAVING count(*) > 1),
rep AS (SELECT r, count(*) AS n FROM (
  SELECT DISTINCT r, unnest(range(i, i + {Q.WINDOW})) AS p FROM win JOIN twice USING (r, g)) GROUP BY r),
lines AS (SELECT r, host, t, line, lower(array_to_string(regexp_extract_all(line, '{_WORD}'), ' ')) AS h
          FROM (SELECT r, host, t, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '{_WORD}')),
hosts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
often AS (SELECT host, h FROM (SELECT host, h, count(DISTINCT t) AS c FROM lines GROUP BY host, h) JOIN hosts USING (host)
          WHERE c > {Q.MANY_LINE_DOCUMENTS}
             OR (c > {Q.MIN_LINE_DOCUMENTS} AND c > n * {Q.MAX_LINE_SHARE}::DOUBLE)
             OR (c > {Q.MIN_SMALL_DOCUMENTS} AND c > n * {Q.MAX_SMALL_SHARE}::DOUBLE)),
per AS (SELECT r, count(*) AS n_lines, count(DISTINCT line) AS n_distinct, sum(length(l.h)) AS chars,
               sum(length(l.h)) FILTER (o.h IS NOT NULL) AS gone, count(*) FILTER (o.h IS NOT NULL) AS n_gone
        FROM lines l LEFT JOIN (SELECT host AS oh, h FROM often) o ON l.host = o.oh AND l.h = o.h
        GROUP BY r),
s AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_lines - n_distinct, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
             coalesce(chars, 0) AS chars, coalesce(gone, 0) AS gone, coalesce(n_gone, 0) AS n_removed_lines
      FROM w LEFT JOIN rep USING (r) LEFT JOIN per USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_lines,
       (n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words) AS base_failed,
       NOT (n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words)
         AND chars - gone >= {Q.MIN_LEFT_SHARE}::DOUBLE * chars AS kept
FROM s
"""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: 160 bits as 32 letters of five bits: every five hex digits give four.
_BASE32 = " || ".join(
    f"substr('{_LETTERS}', 1 + ((('0x' || substr(sha1(p), {5 * k + 1}, 5))::BIGINT >> {b}) & 31)::INT, 1)"
    for k in range(8) for b in (15, 10, 5, 0))

ARCHIVES = f"""
WITH d AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
last AS (SELECT p, max(page_id) AS last FROM d GROUP BY p)
SELECT page_id, octet_length(encode(p)) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM d JOIN last USING (p)
"""

SUBSTRINGS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words
           FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(words[i:i + 19], ' ') AS g
        FROM d, unnest(range(1, len(words) - 18)) u(i)),
ranked AS (SELECT r, i, rank() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, i) AS n FROM win),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS p FROM ranked WHERE n > 1),
each AS (SELECT r, words[p] AS word, p FROM d, unnest(range(1, len(words) + 1)) u(p)),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
         FROM each ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

FILTERS = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS words FROM d),
m AS (SELECT part, (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
        + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask,
        coalesce(doc_id IN (SELECT l.doc_id FROM labels l WHERE l.quality = 1 AND l.doc_id IS NOT NULL), false) AS good,
        coalesce(doc_id IN (SELECT l.doc_id FROM labels l WHERE l.toxic = 1 AND l.doc_id IS NOT NULL), false) AS toxic
      FROM w),
cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x
          FROM m GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (SELECT '' AS o, 0 AS before, 0 AS bit, 0 AS done
  UNION ALL SELECT o || f, before + orders.bit, letters.bit, done + 1 FROM orders, letters
  WHERE NOT contains(o, f)),
steps AS (SELECT a.o AS filter_order, b.done AS step, b.before, b.bit FROM orders a JOIN orders b
          ON a.done = 5 AND b.done > 0 AND b.o = left(a.o, b.done)),
counted AS (SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN g ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN x ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM counted
"""

FILL_MIDDLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS k,
             [('0x' || substr(h, 1, 8))::BIGINT, ('0x' || substr(h, 9, 8))::BIGINT,
              ('0x' || substr(h, 17, 8))::BIGINT, ('0x' || substr(h, 25, 8))::BIGINT] AS h FROM d),
c AS (SELECT doc_id, t, k, len(k) AS n, least(h[1] % (len(k) + 1), h[2] % (len(k) + 1)) AS a,
             greatest(h[1] % (len(k) + 1), h[2] % (len(k) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90
                  THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM w),
p AS (SELECT *, array_to_string(k[1:a], '') AS p, array_to_string(k[a + 1:b], '') AS m,
             array_to_string(k[b + 1:], '') AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
              ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

#: Hexadecimal texts: a byte is two characters, so plain string functions see bytes.
SUFFIXES = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
blocks AS (SELECT r, k, substr(x, 2000 * k + 1, 2398) AS y FROM d, unnest(range(0, length(x) // 2000 + 1)) u(k)),
win AS (SELECT r, 1000 * k + j AS i, md5_number(substr(y, 2 * j + 1, 400)) AS g
        FROM blocks, unnest(range(0, length(y) // 2 - 199)) u(j)),
rep AS (SELECT r, i FROM win JOIN (SELECT g FROM win GROUP BY g HAVING count(*) > 1) USING (g)),
marked AS (SELECT r, i, (i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + 200, -1))::INT AS fresh FROM rep),
spans AS (SELECT r, min(i) AS a, max(i) + 200 AS b
          FROM (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS k FROM marked) GROUP BY r, k),
pieces AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS p, a AS q FROM spans
  UNION ALL SELECT r, max(b), max(length(x)) // 2 FROM spans JOIN d USING (r) GROUP BY r),
kept AS (SELECT r, string_agg(substr(x, 2 * p + 1, 2 * (q - p)), '' ORDER BY p) AS t, count(*) - 1 AS n
         FROM pieces JOIN d USING (r) GROUP BY r)
SELECT doc_id, length(x) // 2 AS n_bytes, (length(x) - coalesce(length(t), length(x))) // 2 AS n_removed,
       coalesce(n, 0) AS n_spans, sha256(unhex(coalesce(t, x))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

ORACLES = {"op1_secret_scan": SECRETS, "op2_quality_rules": QUALITY, "op6_warc": ARCHIVES,
           "op8_substring_dedup": SUBSTRINGS, "op11_filter_audit": FILTERS, "op12_fill_middle": FILL_MIDDLE,
           "op13_suffix_dedup": SUFFIXES}
