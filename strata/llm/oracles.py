"""DuckDB SQL for the queries that SQL can express, over the whole tables."""

from __future__ import annotations

_REACH = """
reach(v, r) AS (SELECT {id}, {id} FROM {table} UNION SELECT e.a, reach.r FROM reach JOIN edges e ON e.b = reach.v),
named AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v)"""

OP2 = f"""
WITH RECURSIVE doubles AS (
  SELECT vec_id, label, [x::DOUBLE for x in embedding] AS e FROM embeddings
),
good AS (
  SELECT * FROM doubles WHERE label IS NOT NULL AND vec_id IS NOT NULL AND e IS NOT NULL
  AND len([x for x in e if x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x for x in e if x <> 0]) > 0
),
edges AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93
),
{_REACH.format(id="vec_id", table="embeddings")},
counts AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT x.vec_id, coalesce(n, 0) AS n_links, component_id, x.vec_id = component_id AS kept
FROM embeddings x LEFT JOIN counts ON a = x.vec_id LEFT JOIN named ON v = x.vec_id
"""

OP5 = """
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (
  SELECT doc_id, n, p, substr(h, 256 * p + 1, 354) AS h
  FROM (SELECT doc_id, h, length(h) // 2 - 49 AS n, unnest(range(0, (length(h) // 2 - 49 + 127) // 128)) AS p
    FROM raw WHERE length(h) >= 100)
),
windows AS (
  SELECT doc_id, 128 * p + i AS i, substr(h, 2 * i + 1, 100) AS w
  FROM (SELECT doc_id, p, h, unnest(range(0, least(128, n - 128 * p))) AS i FROM pieces)
),
least AS (SELECT w, min(doc_id) AS m FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
covered AS (
  SELECT doc_id, i, lag(i) OVER o AS before, lead(i) OVER o AS after
  FROM windows JOIN least USING (w) WHERE m < doc_id WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
counts AS (
  SELECT doc_id, sum(least(50, coalesce(after - i, 50))) AS n_removed,
    count(*) FILTER (before IS NULL OR i - before > 50) AS n_spans
  FROM covered GROUP BY doc_id
),
edges AS (
  SELECT doc_id, i + 50 AS start, coalesce(after, 1000000000) AS stop FROM covered WHERE after IS NULL OR after - i > 50
  UNION ALL SELECT doc_id, 0, min(i) FROM covered GROUP BY doc_id
),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * start + 1, 2 * (stop - start)), '' ORDER BY start) AS h
  FROM edges JOIN raw USING (doc_id) GROUP BY doc_id
)
SELECT r.doc_id, (length(r.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.h, r.h))) AS kept_sha256
FROM raw r LEFT JOIN counts c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

OP6 = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5
      THEN [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id
),
edges AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)
),
{_REACH.format(id="doc_id", table="documents")}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN named ON v = d.doc_id
"""

# Five hexadecimal digits are four letters of base 32.
OP9 = """
WITH hashed AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
digits AS (
  SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, h,
    [strpos('0123456789abcdef', substr(h, i, 1)) - 1 for i in range(1, 41)] AS d FROM hashed
),
digests AS (
  SELECT page_id, payload_bytes, h, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    (d[5 * (k // 4) + 1] * 65536 + d[5 * (k // 4) + 2] * 4096 + d[5 * (k // 4) + 3] * 256
      + d[5 * (k // 4) + 4] * 16 + d[5 * (k // 4) + 5]) // [32768, 1024, 32, 1][k % 4 + 1]) % 32, 1)
    for k in range(0, 32)], '') AS payload_digest
  FROM digits
),
first AS (SELECT h, min(page_id) AS m FROM hashed GROUP BY h)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> m THEN m END AS refers_to
FROM digests JOIN first USING (h)
"""

# The table of the 256 one-byte CRCs comes from eight halvings of each value.
OP11 = """
WITH crcs AS (
  SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(b))
),
split AS (
  SELECT 'd' AS part, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark
),
lists AS (
  SELECT part, doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM split
),
features AS (
  SELECT part, r, f, count(*) AS n FROM (
    SELECT part, r, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) AS f FROM lists)
  GROUP BY ALL
),
hexes AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, [16 * (strpos('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1)
    + strpos('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1 for i in range(0, length(h) // 2)]),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket FROM hexes, crcs
),
counted AS (
  SELECT bucket, coalesce(sum(n) FILTER (part = 'd'), 0) AS s, coalesce(sum(n) FILTER (part = 'b'), 0) AS t
  FROM features JOIN hashed USING (f) GROUP BY bucket
),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counted),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS g FROM counted, totals
),
sums AS (
  SELECT r, sum(n) AS n, sum(n * g) AS g FROM features JOIN hashed USING (f) JOIN gains USING (bucket)
  WHERE part = 'd' GROUP BY r
),
weighed AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features,
    CASE WHEN n > 0 THEN (sums.g - ((sums.g % n) + n) % n) // n ELSE 0 END::BIGINT AS weight,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM lists LEFT JOIN sums USING (r) WHERE part = 'd'
),
noised AS (
  SELECT *, list_reduce(list_prepend(0::BIGINT, [strpos('0123456789abcdef', substr(h, i, 1)) - 1 for i in range(1, 9)]),
    lambda a, b: 16 * a + b) AS u FROM weighed
),
scored AS (
  SELECT doc_id, n_words, n_features, weight,
    weight + floor(-1000 * ln(-ln((u + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM noised
),
placed AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) END AS place,
    25 * count(*) FILTER (n_words >= 20) OVER () // 100 AS wanted FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN place END AS rank FROM placed
"""

ORACLE_SQL = {
    "op2_cover_tree": OP2,
    "op5_suffix_array": OP5,
    "op6_minhash": OP6,
    "op9_warc": OP9,
    "op11_prefix_crc_resampling": OP11,
}
