"""DuckDB SQL for the rows of this package's queries, each by a plainer way than its operator's."""

from __future__ import annotations

from . import license_lookup

# Every string of 100 bytes (as hex), numbered by its places; all but the first place are covered.
OP1_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substring(h, 2 * p + 1, 200) AS s
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM d)),
c AS (SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
i AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run
      FROM (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM c)),
r AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM i GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
g AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
             string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
      FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(head, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""

# The checksum runs over half bytes with a table of 16 entries; sizes are cumulated in id order.
OP4_SQL = r"""
WITH t AS (SELECT list_transform(range(0, 16), lambda n: list_reduce([CAST(n AS BIGINT), 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
d AS (SELECT doc_id, string_split(hex(encode(coalesce(text, ''))), '') AS h FROM documents),
c AS (SELECT doc_id, len(h) // 2 + 16 AS size,
        xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, len(h)), lambda i:
            CAST(instr('0123456789ABCDEF', h[i + 2 - 2 * (i % 2)]) - 1 AS BIGINT))),
          lambda x, v: xor(x >> 4, t.t[1 + (xor(x, v) & 15)])), 4294967295) AS text_crc32
      FROM d, t),
o AS (SELECT *, sum(size) OVER (ORDER BY doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS start, sum(size) OVER () AS total FROM c),
s AS (SELECT *, least(39, ((2 * start + size) * 40) // (2 * total)) AS shard FROM o)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY start) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""

# Occurrences in DuckDB: the position of each window's words in the document's words, by joining every
# run of a window's length with the windows.
OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
v AS (
  SELECT DISTINCT item_id, len(w[s : s + 9]) AS n, array_to_string(w[s : s + 9], ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
runs AS (
  SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, s, n FROM runs JOIN v USING (n, key)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM m GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
"""

# SHA-1 in hexadecimal is spelt out in bits, five of which make a base32 character.
OP7_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS digest FROM p),
bits AS (SELECT page_id, n, digest, array_to_string(list_transform(range(1, 41), lambda i:
           right('000' || bin(CAST('0x' || substring(digest, i, 1) AS INTEGER)), 4)), '') AS z FROM h),
f AS (SELECT digest, min(page_id) AS first FROM h GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(0, 5), lambda j: CAST(substring(z, 5 * i + j + 1, 1) AS INTEGER) * CAST(pow(2, 4 - j) AS INTEGER)))::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits JOIN f USING (digest)
"""

# All pairs of documents that share a shingle, counted; classes by reaching.
OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
      GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(v, label) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, reach.label FROM reach JOIN e ON e.a = reach.v)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(label) AS component_id
FROM reach JOIN d ON d.doc_id = reach.v LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

OP10_SQL = r"""
WITH known AS (SELECT * FROM (VALUES {notices}) AS t(license_id, text)),
spell AS (SELECT MAP {{{spellings}}} AS m),
units AS (SELECT CAST(doc_id AS VARCHAR) AS id, 0 AS known, text FROM documents
  UNION ALL SELECT license_id, 1, text FROM known),
lines AS (
  SELECT id, known, text, list_filter(list_transform(
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: NOT regexp_matches(l, '^\s*(?i:copyright|\(c\)|©)')),
    lambda l: array_to_string(list_transform(
      string_split(trim(regexp_replace(lower(l), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' '),
      lambda w: coalesce(m[w], w)), ' ')), lambda l: l <> '') AS ls FROM units, spell),
k AS (SELECT DISTINCT id AS license_id, sha256(array_to_string(ls, ' ')) AS digest FROM lines WHERE known = 1 AND len(ls) > 0),
d AS (SELECT CAST(id AS BIGINT) AS doc_id, ls FROM lines WHERE known = 0),
u AS (
  SELECT doc_id, 0 AS pos, sha256(array_to_string(ls, ' ')) AS digest FROM d
  UNION ALL SELECT doc_id, pos, sha256(ls[pos]) FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS pos FROM d)),
f AS (
  SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) FILTER (WHERE pos = 0) AS whole,
    string_agg(DISTINCT license_id, ',' ORDER BY license_id) FILTER (WHERE pos > 0) AS notices,
    count(DISTINCT pos) FILTER (WHERE pos > 0) AS n_notices
  FROM u JOIN k USING (digest) GROUP BY doc_id)
SELECT doc_id, coalesce(whole, '') AS whole, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM d LEFT JOIN f USING (doc_id)
""".format(notices=", ".join("('{}', '{}')".format(*n) for n in license_lookup.NOTICES),
           spellings=", ".join(f"'{a}': '{b}'" for a, b in license_lookup.EQUIVALENT.items()))

# The cheapest edits by a table over (row, state) that keeps the least (cost, audit) of each.
OP12_SQL = r"""
WITH RECURSIVE t AS (SELECT list_transform(range(0, 16), lambda n: list_reduce([CAST(n AS BIGINT), 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        string_split(hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))), '') AS h FROM conversations),
c AS (SELECT conv_id, turn, role, text,
        xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, len(h)), lambda i:
            CAST(instr('0123456789ABCDEF', h[i + 2 - 2 * (i % 2)]) - 1 AS BIGINT))),
          lambda x, v: xor(x >> 4, t.t[1 + (xor(x, v) & 15)])), 4294967295) % 20 AS k FROM h, t),
r AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN k = 0 THEN [] WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM r),
f AS (SELECT conv_id, turn, role, text, i, left(role, 1) AS x, right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS z,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM n),
g AS (SELECT *, z = '' AS blank, z <> '' AND again AS dup, z <> '' AND NOT again AND z NOT IN ('.', '!', '?') AS cut FROM f),
e AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, {'c': 0, 'a': ''} AS b FROM g
  UNION ALL
  SELECT conv_id, i, q, min(b) FROM (
    SELECT conv_id, i, o.q AS q, {'c': b.c + o.c, 'a': b.a || o.a} AS b FROM (
      SELECT conv_id, g.i, b, unnest(
        CASE WHEN blank OR dup THEN [] ELSE [{'q': CASE WHEN p = 2 THEN 3 ELSE 2 END, 'c': k + 1 + 5 * CAST(cut AS INT), 'a': ins || 'R'}] END
        || CASE WHEN NOT blank AND NOT dup AND x = CASE WHEN p = 2 THEN 'a' ELSE 'u' END
             THEN [{'q': CASE WHEN p = 2 THEN 3 ELSE 2 END, 'c': k + 5 * CAST(cut AS INT), 'a': ins || 'K'}] ELSE [] END
        || CASE WHEN NOT blank AND NOT dup AND x = 's' AND p = 0 THEN [{'q': 1, 'c': k + 5 * CAST(cut AS INT), 'a': ins || 'K'}] ELSE [] END
        || [{'q': p, 'c': k + 2, 'a': ins || 'D'}]) AS o
      FROM (SELECT conv_id, e.i, b, CASE WHEN m = 0 THEN q WHEN (q = 2) = (m = 1) THEN 3 ELSE 2 END AS p, 5 * m AS k, repeat('I', CAST(m AS BIGINT)) AS ins
            FROM e, (SELECT unnest([0, 1, 2]) AS m)) AS s
      JOIN g USING (conv_id) WHERE g.i = s.i + 1))
  GROUP BY conv_id, i, q),
z AS (SELECT conv_id, min({'c': b.c + 5 * m, 'a': b.a || repeat('I', CAST(m AS BIGINT))}) AS b
      FROM (SELECT *, CASE q WHEN 2 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS m FROM e) JOIN (SELECT conv_id, max(i) AS i FROM g GROUP BY conv_id) USING (conv_id, i) GROUP BY conv_id),
l AS (SELECT conv_id, unnest(string_split(b.a, '')) AS l, unnest(range(1, len(b.a) + 1)) AS j FROM z),
w AS (SELECT conv_id, l, j, count(*) FILTER (l <> 'I') OVER o AS i, count(*) FILTER (l <> 'D') OVER o AS m FROM l
      WINDOW o AS (PARTITION BY conv_id ORDER BY j)),
y AS (SELECT w.*, role, text, bool_or(m = 1 AND l = 'K' AND x = 's') OVER (PARTITION BY w.conv_id) AS s
      FROM w LEFT JOIN g ON w.conv_id = g.conv_id AND w.i = g.i AND w.l <> 'I'),
u AS (SELECT conv_id, sha256(coalesce(string_agg(
        CASE WHEN l = 'K' THEN role WHEN (m - CAST(s AS INT)) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN l = 'I' THEN '' ELSE text END,
        chr(10) ORDER BY j) FILTER (l <> 'D'), '')) AS sha FROM y GROUP BY conv_id),
a AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN a USING (conv_id) LEFT JOIN z USING (conv_id) LEFT JOIN u USING (conv_id)
"""


def _op13_round(k: int) -> str:
    """Distances of all parts to all entries of the codebook ck, the nearest, and their floored means."""
    return f"""
n{k} AS MATERIALIZED (SELECT v, p, x, min({{'d': list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))), 'e': e}}) AS b
  FROM part JOIN c{k} USING (p) GROUP BY v, p, x),
m{k} AS (SELECT p, e, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
  SELECT p, e, i, sum(x) AS s, count(*) AS n FROM (SELECT p, b.e AS e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS x FROM n{k}) GROUP BY p, e, i)),
c{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(f, c) AS c FROM c{k} LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS f FROM m{k} GROUP BY p, e) USING (p, e)),"""


OP13_SQL = r"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS v, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT v, vec_id, p, w[p * (len(w) // 16) + 1 : (p + 1) * (len(w) // 16)] AS x FROM kept, (SELECT unnest(range(0, 16)) AS p)),
c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM part WHERE vec_id IN (SELECT DISTINCT vec_id FROM kept ORDER BY vec_id LIMIT 64)),""" + _op13_round(0) + _op13_round(1) + r"""
n2 AS (SELECT v, p, min({'d': list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))), 'e': e}) AS b
  FROM part JOIN c2 USING (p) GROUP BY v, p),
r AS (SELECT v, string_agg(printf('%02x', b.e), '' ORDER BY p) AS code, CAST(sum(b.d) AS BIGINT) AS error FROM n2 GROUP BY v)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) FROM (SELECT p, e, unnest(c) AS x, unnest(range(0, len(c))) AS i FROM c2)) AS codebooks_sha256
FROM r JOIN kept USING (v)
"""
