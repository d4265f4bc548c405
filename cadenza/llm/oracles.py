"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

#: Lines of every document, three-line windows over whole lines (no hashes),
#: later occurrences, covered lines, and the text rebuilt from the others.
LINE_DEDUP = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM {docs} WHERE text IS NOT NULL),
w AS (
  SELECT a.doc_id, a.pos, a.line || chr(10) || b.line || chr(10) || c.line AS win
  FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
           JOIN l c ON a.doc_id = c.doc_id AND c.pos = a.pos + 2),
r AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS occ
  FROM w WHERE regexp_matches(win, '[^ \t\n\x0B\f\r]')),
cov AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM r, (VALUES (0), (1), (2)) t(k) WHERE occ > 1),
f AS (
  SELECT l.doc_id, l.pos, l.line, cov.pos IS NOT NULL AS gone
  FROM l LEFT JOIN cov ON l.doc_id = cov.doc_id AND l.pos = cov.pos),
isle AS (
  SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS g
  FROM f WHERE gone),
span AS (SELECT doc_id, g, min(pos) AS s, max(pos) AS e FROM isle GROUP BY doc_id, g),
spans AS (
  SELECT doc_id, string_agg(s || '-' || e, ',' ORDER BY s) AS removed_spans
  FROM span GROUP BY doc_id),
d AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM f GROUP BY doc_id)
SELECT d.doc_id, d.n_lines, d.n_removed, coalesce(spans.removed_spans, '') AS removed_spans, d.text
FROM d LEFT JOIN spans USING (doc_id)
UNION ALL
SELECT doc_id, 0, 0, '', NULL FROM {docs} WHERE text IS NULL
"""

#: Roles and digests of pages from the table itself, without archives.
WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (
  SELECT payload_digest, max(page_id) AS response FROM p WHERE payload_bytes >= 1000
  GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest
"""

def _found(kind: int, pattern: str, least: int, group: int) -> str:
    """Spans of one kind. Each match begins after the gaps and matches before it."""
    return f"""
  SELECT doc_id, owner, repo, {kind} AS kind, start, start + length(hit) AS "end", value FROM (
    SELECT doc_id, owner, repo, hit, value, sum(length(gap)) OVER w
           + coalesce(sum(length(hit)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS start
    FROM (SELECT doc_id, owner, repo, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit,
                 unnest(vals) AS value, unnest(gaps[1:len(hits)]) AS gap
          FROM (SELECT doc_id, owner, repo, regexp_extract_all(t, '{pattern}', 0) AS hits,
                       regexp_extract_all(t, '{pattern}', {group}) AS vals,
                       regexp_split_to_array(t, '{pattern}') AS gaps FROM d))
    WINDOW w AS (PARTITION BY doc_id ORDER BY i))
  WHERE length(value) >= {least}"""


_ANY_CASE = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in
                     ("password", "passwd", "secret", "token", "api_?key"))

#: Base kinds and tokens, owners per value, and the spans of each document.
SECRETS = f"""
WITH d AS (SELECT doc_id, source AS owner, concat_ws('/', source, lang) AS repo,
                  coalesce(text, '') AS t FROM documents),
base AS ({_found(0, f"({_ANY_CASE})[\"'']?[ ]*[:=][ ]*[\"'']?([A-Za-z0-9+/_.=-]+)", 12, 2)}
  UNION ALL {_found(1, "AKIA[A-Z0-9]+", 18, 0)}
  UNION ALL {_found(2, "[0-9a-f]{{16,}}".replace("{{", "{").replace("}}", "}"), 16, 0)}),
wide AS (SELECT * FROM ({_found(3, "[A-Za-z0-9+/_=-]{20,}", 20, 0)}) x
  WHERE regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
    AND regexp_matches(value, '[0-9]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = x.doc_id AND b.start < x."end"
                    AND x.start < b."end")),
al AS (SELECT * FROM base UNION ALL SELECT * FROM wide),
own AS (SELECT value, count(DISTINCT owner) <= 2 AS live FROM al GROUP BY value),
s AS (SELECT al.*, live, ['assign', 'access', 'hex', 'token'][kind + 1] || ':' || start || ':' || "end" AS sp
      FROM al JOIN own USING (value) WHERE kind < 3 OR live),
g AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
             count(*) FILTER (kind = 2) AS n_hex,
             string_agg(sp, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
             string_agg(sp, ',' ORDER BY start, kind) AS spans,
             count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
      FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN g USING (doc_id)
"""

#: Features, buckets (CRC-32 byte by byte over a table made by its rule), gains, weights, noise, ranks.
RESAMPLE = r"""
WITH steps AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)::BIGINT[]),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab),
d AS (SELECT doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'),
        '[^ ]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(regexp_replace(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'),
        '[^ ]+') AS w FROM benchmark),
raw AS (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM d),
tgt AS (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM b),
code AS (
  SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      range(1, octet_length(encode(f)) + 1), lambda i: ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT)),
      lambda c, x: xor(c // 256, tab[xor(c % 256, x) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM (SELECT f FROM raw UNION ALL SELECT f FROM tgt)), steps),
s AS (SELECT bucket, count(*)::DOUBLE AS s FROM raw JOIN code USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*)::DOUBLE AS t FROM tgt JOIN code USING (f) GROUP BY bucket),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS ns, (SELECT coalesce(sum(t), 0) FROM t) AS nt),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (ns + 10000) / ((s + 1) * (nt + 10000)))) AS g
  FROM s LEFT JOIN t USING (bucket), n),
w AS (
  SELECT doc_id, count(*) AS n_features, floor(sum(g) / count(*))::BIGINT AS weight
  FROM raw JOIN code USING (f) JOIN gain USING (bucket) GROUP BY doc_id),
z AS (
  SELECT d.doc_id, len(d.w) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN w USING (doc_id)),
r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM z WHERE words >= 20)
SELECT z.doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM z LEFT JOIN r USING (doc_id)
"""

#: Filters on whole texts, all orders by a self join, removal steps from places in the order.
FILTER_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents),
lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
x AS (
  SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, doc_id > min(doc_id) OVER (PARTITION BY t) AS e,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM d LEFT JOIN lab USING (doc_id)),
g AS (SELECT part, a, b, c, d, e, good, toxic, count(*) AS n FROM x GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
o AS (
  SELECT l1.l || l2.l || l3.l || l4.l || l5.l AS o FROM l l1, l l2, l l3, l l4, l l5
  WHERE len(list_distinct([l1.l, l2.l, l3.l, l4.l, l5.l])) = 5),
r AS (
  SELECT part, o, n, good, toxic, [a, b, c, d, e] AS fails,
         least(if(a, instr(o, 'A'), 9), if(b, instr(o, 'B'), 9), if(c, instr(o, 'C'), 9),
               if(d, instr(o, 'D'), 9), if(e, instr(o, 'E'), 9)) AS gone
  FROM g, o),
s AS (
  SELECT part, o, step, substr(o, step, 1) AS letter,
         coalesce(sum(n) FILTER (gone > step), 0) AS kept, coalesce(sum(n) FILTER (gone = step), 0) AS removed,
         coalesce(sum(n) FILTER (gone < step AND fails[ascii(substr(o, step, 1)) - 64]), 0) AS redundant,
         coalesce(sum(n) FILTER (fails[ascii(substr(o, step, 1)) - 64]
                  AND len(list_filter(fails, lambda v: v)) = 1), 0) AS unique_fails,
         coalesce(sum(n) FILTER (gone = step AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (gone = step AND toxic), 0) AS toxic_lost
  FROM r, range(1, 6) st(step) GROUP BY part, o, step)
SELECT part, o AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM s
"""

ORACLE_SQL = {"op2_secret_ownership": SECRETS, "op1_line_dedup": LINE_DEDUP.format(docs="documents"), "op9_warc": WARC,
              "op11_importance_resampling": RESAMPLE, "op12_filter_audit": FILTER_AUDIT}
