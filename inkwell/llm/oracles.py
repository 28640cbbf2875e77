"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from inkwell.llm.mixing import BLOCK_WORDS, LEAST_BLOCKS, SHARD_ROWS

WORD = r"[^\x20\x09-\x0D]+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{ALPHABET}', '{ALPHABET.lower()}')"


OP1 = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
    CAST(('0x' || substr(md5('42|' || coalesce(CAST(doc_id AS VARCHAR), chr(0)) || '|' || md5(coalesce(text, ''))), 1, 8)) AS BIGINT) AS h FROM documents),
s AS (SELECT *, greatest(1, least({BLOCK_WORDS}, source_size // {LEAST_BLOCKS})) AS block FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n FROM d GROUP BY source)),
w AS (SELECT *, [5.0, 2.0, 1.0][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)]::DOUBLE AS w, 2 * source_size AS cap FROM s),
l AS (SELECT *, row_number() OVER o AS nth, CAST(sum(source_size) OVER () * 3 - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2 AS DOUBLE)
    / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * 2) AS level FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
g AS (SELECT min_by(level, nth) AS level FROM l WHERE level * w <= cap),
t AS (SELECT l.* EXCLUDE (level), coalesce(least(CAST(cap AS DOUBLE), l.w * g.level), CAST(cap AS DOUBLE)) AS target FROM l, g),
t1 AS (SELECT *, CAST(round(sum(target) OVER ()) AS BIGINT) AS seats, sum(target) OVER () AS alls, count(*) OVER () AS m FROM t),
t2 AS (SELECT *, CAST(greatest(0, floor(seats * target / alls - (m * target / (2 * alls) + 1))) AS BIGINT) AS base, CAST(ceil(seats * target / alls + m * target / (2 * alls) + 1) AS BIGINT) AS top FROM t1 WHERE target > 0),
t4 AS (SELECT source, base, seats - sum(base) OVER () AS o, target, base AS b, top FROM t2),
t5 AS (SELECT source, o, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST, k) AS r FROM (SELECT source, o, target, unnest(range(b, top + 1)) AS k FROM t4)),
q AS (SELECT t4.source, any_value(t4.base) + count(t5.r) AS seats FROM t4 LEFT JOIN t5 ON t4.source IS NOT DISTINCT FROM t5.source AND t5.r <= t5.o GROUP BY t4.source),
d1 AS (SELECT d.*, s.block, h % CAST(ceil(s.n / {SHARD_ROWS}) AS BIGINT) AS shard FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
h0 AS (SELECT source, shard, any_value(block) AS block, CAST(sum(size) AS BIGINT) AS words FROM d1 GROUP BY source, shard),
h1 AS (SELECT *, CASE WHEN words > 0 THEN greatest(1, CAST(round(words / block) AS BIGINT)) ELSE 0 END AS blocks FROM h0),
h2 AS (SELECT h1.*, sum(blocks) OVER p AS alls, count(*) OVER p AS m, least(coalesce(CAST(round(q.seats / block) AS BIGINT), 0), 2 * sum(blocks) OVER p) AS seats
    FROM h1 LEFT JOIN q ON h1.source IS NOT DISTINCT FROM q.source WINDOW p AS (PARTITION BY h1.source)),
h3 AS (SELECT *, CASE WHEN alls > 0 THEN CAST(greatest(0, floor(seats * blocks / alls - (m * blocks / (2 * alls) + 1))) AS BIGINT) ELSE 0 END AS base,
    CASE WHEN alls > 0 THEN CAST(ceil(seats * blocks / alls + m * blocks / (2 * alls) + 1) AS BIGINT) ELSE 0 END AS top FROM h2),
h4 AS (SELECT *, seats - sum(base) OVER (PARTITION BY source) AS o FROM h3),
h5 AS (SELECT source, shard, o, row_number() OVER (PARTITION BY source ORDER BY blocks / (2 * k + 1) DESC, shard, k) AS r FROM (SELECT source, shard, o, blocks, unnest(range(base, top + 1)) AS k FROM h4 WHERE blocks > 0)),
h6 AS (SELECT h4.source, h4.shard, any_value(h4.words) AS words, any_value(h4.blocks) AS blocks, least(any_value(h4.base) + count(h5.r), 2 * any_value(h4.blocks)) AS quota
    FROM h4 LEFT JOIN h5 ON h4.source IS NOT DISTINCT FROM h5.source AND h4.shard = h5.shard AND h5.r <= h5.o GROUP BY h4.source, h4.shard),
h7 AS (SELECT source, shard, words, CASE WHEN blocks > 0 THEN quota // blocks ELSE 0 END AS copies, CASE WHEN blocks > 0 THEN quota % blocks ELSE 0 END AS rest, blocks,
    CASE WHEN blocks > 0 THEN CAST(('0x' || substr(md5('43|' || coalesce(source, chr(0)) || '|' || CAST(shard AS VARCHAR)), 1, 8)) AS BIGINT) % blocks ELSE 0 END AS pos FROM h6),
h8 AS (SELECT *, CASE WHEN rest = 0 THEN 0 ELSE pos * words // blocks END AS a1, CASE WHEN rest = 0 THEN 0 WHEN pos + rest <= blocks THEN (pos + rest) * words // blocks ELSE words END AS b1,
    CASE WHEN rest > 0 AND pos + rest > blocks THEN (pos + rest - blocks) * words // blocks ELSE 0 END AS b2 FROM h7),
f AS (SELECT d1.*, sum(size) OVER (PARTITION BY source, shard ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS hi FROM d1)
SELECT f.doc_id, f.size, t.source_size, t.target,
    CAST(h8.copies * f.size + greatest(0, least(h8.b1, f.hi) - greatest(h8.a1, f.hi - f.size)) + greatest(0, least(h8.b2, f.hi) - (f.hi - f.size)) AS BIGINT) AS taken
FROM f JOIN h8 ON f.source IS NOT DISTINCT FROM h8.source AND f.shard = h8.shard JOIN t ON f.source IS NOT DISTINCT FROM t.source
"""

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h, min(page_id) OVER (PARTITION BY sha1(html)) AS first_id FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda b:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, CAST(5 * i + 1 AS INT), 5) AS INT) >> b) & 31), 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d
"""

OP4 = f"""
WITH d AS (SELECT doc_id, {lower("text")} AS t FROM documents),
g AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP5 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({lower("text")}, '{ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({lower("text")}, '{ALNUM}') AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i: array_to_string(w[i : i + 12], ' '))) AS t FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS t FROM d, sizes WHERE len(w) >= n),
m AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (n, t)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM m)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(it.n_items, 0) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP6 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lower("text")}, '{WORD}') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i : i + 3], ' '))) AS g FROM d WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
m AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM m JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
r AS (SELECT doc_id, doc_id AS node FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.node = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(node) AS least FROM r GROUP BY 1) c USING (doc_id)
"""

OP11 = """
WITH c AS (SELECT click_id, first(struct_pack(ts := ts, kind := kind, cents := cents) ORDER BY ts NULLS LAST, kind NULLS FIRST, cents NULLS FIRST) AS r
    FROM (SELECT click_id, ts, kind, CASE WHEN abs(100 * value) < 144115188075855872 THEN CAST(floor(100 * value + 0.5) AS BIGINT) END AS cents FROM clicks) GROUP BY click_id),
d AS (SELECT click_id, r.ts AS ts, r.kind AS kind, r.cents AS cents FROM c WHERE r.ts IS NOT NULL),
w AS (SELECT *, list_sort(list(cents) FILTER (WHERE cents IS NOT NULL) OVER (PARTITION BY kind ORDER BY ts RANGE BETWEEN INTERVAL 360 MINUTES PRECEDING AND CURRENT ROW)) AS v FROM d),
m AS (SELECT *, coalesce(len(v), 0) AS n, v[(len(v) + 1) // 2] + v[len(v) // 2 + 1] AS m2 FROM w),
g AS (SELECT *, list_sort(list_transform(v, lambda x: abs(2 * x - m2))) AS e FROM m)
SELECT click_id, kind, CAST(n AS BIGINT) AS n, CASE WHEN n >= 5 THEN m2 END AS median2, CASE WHEN n >= 5 THEN e[(n + 1) // 2] + e[n // 2 + 1] END AS mad4,
  CASE WHEN n >= 5 THEN 2 * abs(2 * cents - m2) > 5 * (e[(n + 1) // 2] + e[n // 2 + 1]) END AS far
FROM g
"""
