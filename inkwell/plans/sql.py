"""DuckDB SQL for the registered queries of the curation engine, written apart from the column expressions."""

from __future__ import annotations

PRIMARY, BIOLOGY = ["rewh", "thatin", "ononst"], ["this", "with"]
RULE = {
    "include_stems": ["things", "standing", "erations", "tion"],
    "include_terms": ["rewh", "and the"],
    "shared_terms": ["onst"],
    "exclude_terms": ["orre", "thatin"],
    "exclude_phrases": ["of the", "in the"],
}
STOP = (
    "a an the and or but nor so yet is are was were be been being am have has had having do does did doing will would could should may might must shall can "
    "of in to for with on at by from as into that this these those it its they them their not no only also just very more most other some using use used show shows study studies new novel"
).split()
SHORT = ["mr", "ai", "ls", "qc", "iv"]


def arr(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[\s\x{{0B}}\x{{A0}}\x{{FEFF}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g'))"


def decode(x: str) -> str:
    for name, char in (("nbsp", " "), ("amp", "&"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("#x27", "''")):
        x = f"regexp_replace({x}, '&{name};', '{char}', 'gi')"
    return x


def strip(x: str) -> str:
    x = decode(x)
    for p in ("<script.*?</script>", "<style.*?</style>", "<[^>]+>"):
        x = f"regexp_replace({x}, '{p}', ' ', 'gis')"
    return squeeze(x)


P = r"""p AS (SELECT doc_id AS id, doc_id AS ord, trim(r) AS title, trim(substr(text, length(r) + 2)) AS abstract, source, source AS journal, lang, n_chars, text
  FROM (SELECT *, regexp_extract(text, '^([^.\n]*)', 1) AS r FROM documents))"""


def cat(n: int) -> str:
    return f"SELECT 'src' || i AS id, CAST(i + 1 AS INT) AS priority, CASE WHEN i % 3 = 0 THEN 'broad-science' ELSE 'life-science-only' END AS scope FROM range({n}) t(i)"


V = "v AS (SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS verdict FROM labels)"


def held(words, hay: str) -> str:
    return f"list_filter({arr(words)}, lambda k: contains({hay}, k))"


HAY = "lower(concat_ws(' ', nullif(title, ''), nullif(abstract, '')))"
S = f"""s AS (SELECT *, CASE WHEN len(a) > 0 THEN 'single-cell-spatial' WHEN len(b) > 0 THEN 'biology' ELSE 'other' END AS section, list_concat(a, b) AS matched
  FROM (SELECT *, {held(PRIMARY, HAY)} AS a, {held(BIOLOGY, HAY)} AS b FROM p))"""

TOKENS = rf"""list_filter(string_split_regex(trim(regexp_replace(regexp_replace(lower(title), '[''’]', '', 'g'), '[^a-z0-9+-]+', ' ', 'g')), ' +'),
  lambda t: t IN ({", ".join(repr(x) for x in SHORT)}) OR (length(t) >= 3 AND NOT regexp_full_match(t, '[0-9]+') AND t NOT IN ({", ".join(repr(x) for x in STOP)})))"""
STEM = """CASE WHEN length(w) <= 2 THEN w WHEN w LIKE '%ies' AND length(w) > 4 THEN w[:-4] || 'y' WHEN w LIKE '%oes' AND length(w) > 4 THEN w[:-3] WHEN w LIKE '%ves' AND length(w) > 4 THEN w[:-4] || 'f'
  WHEN w LIKE '%ses' AND length(w) > 4 THEN w[:-3] WHEN w LIKE '%ches' OR w LIKE '%shes' OR w LIKE '%xes' OR w LIKE '%zes' THEN w[:-3] WHEN w LIKE '%es' AND length(w) > 3 THEN w[:-3]
  WHEN w LIKE '%s' AND w NOT LIKE '%ss' AND length(w) > 3 THEN w[:-2] WHEN w LIKE '%ing' AND length(w) > 5 THEN w[:-4] WHEN w LIKE '%edly' AND length(w) > 6 THEN w[:-5]
  WHEN w LIKE '%ly' AND length(w) > 4 THEN w[:-3] WHEN w LIKE '%ed' AND length(w) > 4 THEN w[:-3] WHEN w LIKE '%en' AND length(w) > 4 THEN w[:-3] ELSE w END"""
SPACED = r"regexp_replace(lower(title), '\s+', ' ', 'g')"
T = f"""k AS (SELECT *, {TOKENS} AS words FROM p), st AS (SELECT *, list_transform(words, lambda w: {STEM}) AS stems, {SPACED} AS hay FROM k),
r0 AS (SELECT *, list_filter(['thing', 'stand', 'eration', 'tion'], lambda x: list_contains(stems, x)) AS by_stem, {held(RULE["include_terms"] + RULE["shared_terms"], "hay")} AS by_term,
  list_filter(words, lambda w: w IN ({", ".join(repr(x) for x in RULE["include_terms"])})) AS by_word, list_concat({held(RULE["exclude_phrases"], "hay")}, {held(RULE["exclude_terms"], "hay")}) AS ex FROM st),
r1 AS (SELECT *, list_concat(by_stem, list_concat(by_term, list_filter(list_distinct(by_word), lambda w: NOT list_contains(by_term, w)))) AS inc, len(by_term) + len(by_word) AS terms FROM r0),
rule AS (SELECT *, CASE WHEN len(ex) > 0 AND terms = 0 THEN 'no' WHEN len(inc) > 0 THEN 'yes' ELSE 'no' END AS verdict,
  CASE WHEN len(ex) > 0 AND terms = 0 THEN [] ELSE inc END AS includes, CASE WHEN (len(ex) > 0 AND terms = 0) OR len(inc) > 0 THEN ex ELSE [] END AS excludes FROM r1)"""

L = f"""c AS ({cat(15)}), q AS (SELECT doc_id AS id, (doc_id % 21) / 20.0 AS conf FROM labels),
l AS (SELECT s.*, CASE WHEN source = 'src19' THEN 'preprint' WHEN length(title) < 8 THEN 'skip' WHEN conf IS NOT NULL THEN CASE WHEN conf >= 0.75 THEN 'line-a' ELSE 'line-b' END
  WHEN section = 'single-cell-spatial' THEN 'line-a' ELSE 'line-b' END AS line, CASE WHEN coalesce(source, '') <> 'src19' AND length(title) >= 8 AND conf IS NOT NULL THEN 'llm' ELSE 'keyword-fallback' END AS line_method, coalesce(c.priority, 999) AS priority
  FROM s LEFT JOIN q ON s.id = q.id LEFT JOIN c ON s.source = c.id)"""
RANK = "CASE line WHEN 'line-a' THEN 0 WHEN 'line-b' THEN 1 WHEN 'preprint' THEN 2 ELSE 99 END, priority, title COLLATE en, ord"
F = f"""f AS (SELECT l.*, coalesce(e.n <= 12, false) AS featured FROM l LEFT JOIN (SELECT id, row_number() OVER (ORDER BY {RANK}) AS n FROM l WHERE line <> 'skip' AND abstract <> '') e USING (id))"""

DEDUPE_FIRST_WINS = f"WITH d AS (SELECT *, row_number() OVER (PARTITION BY lower({squeeze('text')}) ORDER BY doc_id) AS n FROM documents) SELECT doc_id, source, lang FROM d WHERE n = 1"
TWO_LEVEL_DEDUPE = f"""WITH a AS (SELECT *, lower({squeeze('text')}) AS k FROM documents), b AS (SELECT *, row_number() OVER (PARTITION BY source, k ORDER BY doc_id) AS n FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS m FROM b WHERE n = 1 AND n_chars >= 200) SELECT doc_id, source FROM c WHERE m = 1"""
IDENTITY_KEY = r"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '10.1234/page.' || page_id WHEN page_id % 3 = 2 AND url <> '' THEN url
  ELSE lower(trim(regexp_replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '\s+', ' ', 'g'))) END AS id FROM pages"""
DUPLICATE_FAIL_CLOSED = "SELECT min(event_id) AS event_id FROM events GROUP BY user_id, event_type, CAST(ts AS DATE) HAVING count(*) = 1"
LAST_WINS_FOLD = "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1"
MISSING_IDS = "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
UNKNOWN_IDS = "SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE source <> 'src3')"
UNIQUE_TITLE_JOIN = rf"""WITH {P}, t AS (SELECT lower({squeeze('title')}) AS t, count(*) AS n, min(id) AS id FROM p GROUP BY 1)
SELECT id AS doc_id, id AS matched, 'id' AS matched_by FROM p WHERE id % 4 = 0
UNION ALL SELECT p.id, t.id, 'title' FROM p JOIN t ON lower({squeeze('title')}) = t.t AND t.n = 1 WHERE p.id % 4 <> 0"""
FIELD_OVERLAY = "SELECT d.doc_id, CASE WHEN quality = 1 THEN 'good' ELSE lang END AS lang FROM documents d LEFT JOIN labels USING (doc_id)"

REPORT_DATE_FILTER = "SELECT event_id, '2024-01-05' AS day FROM events WHERE CAST(ts + INTERVAL 8 HOUR AS DATE) = DATE '2024-01-05'"
REPORT_DATE_FUNNEL = "SELECT event_type, count(*) AS items, count(*) FILTER (value > 100) AS valued, count(*) FILTER (value > 100 AND CAST(ts + INTERVAL 8 HOUR AS DATE) = DATE '2024-01-05') AS on_day FROM events GROUP BY 1"
DEFAULT_REPORT_DAY = "SELECT event_id, CAST(CAST(ts + INTERVAL 8 HOUR AS DATE) - 1 AS VARCHAR) AS day FROM events"
PUBLISHED_DATES = "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) + 1 AS VARCHAR) END AS day FROM orders"
RETENTION_PLAN = "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS label, CAST(ts AS DATE) >= DATE '2024-01-16' AS keep FROM events"

_title = "regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"
HTML_TITLE_STRIP = f"SELECT page_id, CASE WHEN regexp_matches({decode(_title)}, '(?is)<[a-z].*>') THEN 'A&B x ' || {strip(_title)} || ' H2O' ELSE {squeeze(chr(39) + 'A&B x  ' + chr(39) + ' || ' + decode(_title) + ' || ' + chr(39) + ' H2O' + chr(39))} END AS title FROM pages"
HTML_MAIN_TEXT = f"""SELECT page_id, CAST(length(t) AS BIGINT) AS chars, md5(t) AS md5, md5(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS escaped_md5 FROM (SELECT page_id, {strip("html")} AS t FROM pages)"""
HTML_META_EXTRACT = """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'News & Views' WHEN 1 THEN 'Article' END AS kind, page_id % 4 = 1 AS research, CASE WHEN page_id % 2 = 0 AND url <> '' THEN url ELSE 'd ' || page_id END AS abstract FROM pages"""
_UNITS = "chr(128512) || '|' || x || '|' || x || x || '|' || x || chr(128512) || x || '|' || x || ' ' || x || '|A|' || chr(0) || '|'".replace("x", "chr(65533)")
ENTITY_DECODE = f"SELECT page_id, md5({_UNITS} || chr(945) || chr(8211) || page_id || '< ''&#x3b1;AB' || {decode("coalesce(html, '')")}) AS decoded_md5 FROM pages"
JATS_ABSTRACT = f"SELECT doc_id, CASE WHEN length(t) >= 80 AND NOT regexp_matches(t, '(?i)</?[a-z]') THEN t END AS abstract FROM (SELECT doc_id, {strip('text')} AS t FROM documents)"
ENCODED_ABSTRACT = f"WITH {P}, x AS (SELECT id, {squeeze('strip')} AS t FROM (SELECT id, {strip('abstract')} AS strip FROM p)) SELECT id AS doc_id, CASE WHEN id % 3 <> 0 AND length(t) >= 40 THEN t END AS abstract FROM x"
PAYLOAD_TRUNCATE = f"WITH {P}, x AS (SELECT id, CASE WHEN length(abstract) > 2000 THEN substr(abstract, 1, 2000) || '…' ELSE abstract END AS t FROM p) SELECT id AS doc_id, CAST(length(t) AS BIGINT) AS chars, md5(t) AS md5 FROM x"

KEYWORD_SECTION = f"WITH {P}, {S} SELECT id AS doc_id, array_to_string(matched, ',') AS matched, section FROM s"
SECTION_COUNTS = f"WITH {P}, {S} SELECT x.section, count(s.id) AS papers FROM (VALUES ('single-cell-spatial'), ('biology'), ('other')) x(section) LEFT JOIN s USING (section) GROUP BY 1"
KEYWORD_PRESCREEN = f"WITH {P}, {S} SELECT id AS doc_id FROM s WHERE len(a) > 0"
KEYWORD_FALLBACK_VERDICT = f"WITH {P}, {T} SELECT id AS doc_id, verdict, array_to_string(includes, ',') AS includes, array_to_string(excludes, ',') AS excludes FROM rule"
TOKEN_STEM_COUNTS = f"WITH {P}, {T} SELECT stem, count(*) AS titles FROM (SELECT unnest(list_distinct(stems)) AS stem FROM st) GROUP BY 1"
_SOURCES = "cell nature science nature-methods nature-genetics nature-ecology-evolution nature-biotechnology nature-cell-biology nature-neuroscience nature-immunology nature-microbiology science-advances pnas elife plos-biology nature-communications biorxiv".split()
_ENCODED = "nature-communications nature-ecology-evolution nature-biotechnology nature-cell-biology nature-neuroscience nature-immunology nature-microbiology".split()
SKIP_RULES = rf"""WITH {P}, x AS (SELECT id, id % 8 AS n, title AS t, {arr(_SOURCES)}[1 + id % 17] AS source FROM p),
y AS (SELECT *, CASE n WHEN 2 THEN 3 WHEN 5 THEN 4 WHEN 3 THEN 3 WHEN 0 THEN 9 WHEN 1 THEN 9 WHEN 4 THEN 9 ELSE CASE WHEN {squeeze('t')} = '' THEN 0 ELSE len(string_split({squeeze('t')}, ' ')) END END AS words FROM x)
SELECT id AS doc_id, (source IN ({", ".join(repr(s) for s in _ENCODED)}) AND n IN (0, 1)) OR source = 'pnas' AS feed_skip,
  source <> 'biorxiv' AND (id % 5 = 0 OR n IN (0, 1, 3, 4) OR ((source = 'nature' OR source LIKE 'nature-%') AND words <= 4 AND id % 2 <> 0)
    OR (n NOT IN (2, 5) AND regexp_matches(t, '(?i)^(editorial(\s+note)?|author correction|publisher correction|corrigendum|erratum|obituary|reply to)\b'))) AS digest_skip FROM y"""
TEASER_ABSTRACTS = "SELECT doc_id, doc_id % 3 = 0 AS teaser, doc_id % 3 = 1 AS usable FROM documents"
CONFIDENCE_LINES = "SELECT event_id, value / 400 BETWEEN 0 AND 1 AS valid, CASE WHEN value / 400 BETWEEN 0 AND 1 THEN CASE WHEN value / 400 >= 0.75 THEN 'line-a' ELSE 'line-b' END END AS line FROM events"
RECIPIENT_LISTS = "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN replace(c_name, '#', '.') || '@X.org,B@x.org' ELSE replace(c_name, '#', '.') || '@x.org,c@x.org' END AS recipients FROM customer"
AUTHOR_LISTS = "SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN s_name || '|A. B|C D' END AS authors FROM supplier"
KEY_FINGERPRINTS = "SELECT c_custkey, substr(sha256(c_name), 1, 12) AS fingerprint FROM customer"
SUBJECT_LINES = "SELECT CAST(day AS VARCHAR) AS day, event_type, 'Digest · ' || day || ' (' || n || CASE WHEN n = 1 THEN ' paper)' ELSE ' papers)' END AS subject FROM (SELECT CAST(ts + INTERVAL 8 HOUR AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL)"
TOKEN_ESTIMATES = "SELECT doc_id, CAST(ceil((500 + n_chars + 32) / 4) AS BIGINT) AS request, e AS completion, CAST(least(8192, CASE WHEN e = 0 THEN 640 ELSE greatest(ceil(e * CAST(1.35 AS DOUBLE)), e + 400, 640) END) AS BIGINT) AS asked FROM (SELECT *, CASE WHEN doc_id % 30 = 0 THEN 0 ELSE 400 + 280 * (doc_id % 30) END AS e FROM documents)"
FAILURE_TAXONOMY = """WITH x AS (SELECT event_id, CASE event_id % 14 WHEN 0 THEN 'rate_limit' WHEN 1 THEN 'auth' WHEN 2 THEN 'server_error' WHEN 3 THEN 'parse' WHEN 4 THEN 'timeout' WHEN 5 THEN 'network' WHEN 6 THEN 'rate_limit'
  WHEN 7 THEN 'timeout' WHEN 8 THEN 'network' WHEN 9 THEN 'parse' WHEN 10 THEN 'config' WHEN 11 THEN 'length' ELSE 'unknown' END AS kind FROM events)
SELECT event_id, kind, kind IN ('timeout', 'network') AS transport, kind IN ('length', 'parse') AS splittable, event_id % 14 = 3 AS json_mode FROM x"""
RETRY_WAIT_PLAN = """SELECT event_id, CAST(least(60000, CASE event_id % 5 WHEN 0 THEN floor(value) * 1000 + 500 WHEN 1 THEN 20000 WHEN 3 THEN floor(value) * 1000 ELSE 30000 + least(1000, event_id % 3000) END) AS BIGINT) AS wait_ms,
  CASE event_id % 5 WHEN 0 THEN 'retry-after' WHEN 1 THEN 'retry-after' WHEN 3 THEN 'reset-hint' ELSE 'default' END AS source FROM events"""

NATION_DIM_DEFAULT = "SELECT s_suppkey, coalesce(n_name, 'unknown') AS n_name, coalesce(n_regionkey, 999) AS rank FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON s_nationkey = n_nationkey"
CATALOG_DRIFT = f"""WITH c AS ({cat(20)}), d AS (SELECT DISTINCT source AS id, CASE WHEN CAST(substr(source, 4) AS INT) % 4 = 0 THEN 'broad-science' ELSE 'life-science-only' END AS scope FROM documents WHERE source <> 'src7')
SELECT coalesce(c.id, d.id) AS key, c.scope AS left_value, d.scope AS right_value FROM c FULL JOIN d USING (id) WHERE c.scope IS DISTINCT FROM d.scope"""
SOURCE_STATUS_REPORT = f"""WITH c AS ({cat(23)}), n AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), x AS (SELECT id, CASE WHEN id IN ('src2', 'src9') THEN 'skipped' WHEN n > 0 THEN 'ok' ELSE 'empty' END AS status, n FROM c LEFT JOIN n ON id = source)
SELECT id, status, CASE WHEN status = 'ok' THEN n ELSE 0 END AS rows FROM x"""

_R = f"""WITH {P}, {T}, {V}, c AS ({cat(20)}), z AS (SELECT rule.id, CASE WHEN scope = 'life-science-only' THEN 'yes' ELSE coalesce(v.verdict, rule.verdict) END AS verdict,
  CASE WHEN scope = 'life-science-only' THEN 'scope-default' WHEN v.verdict IS NOT NULL THEN 'llm' ELSE 'routing-keyword-fallback' END AS method FROM rule JOIN c ON source = c.id LEFT JOIN v ON rule.id = v.id)"""
_STATS = """SELECT count(*) AS total, count(*) FILTER (method = 'scope-default') AS passed_by_scope, count(*) FILTER (method = 'llm') AS llm_classified, count(*) FILTER (method = 'llm' AND verdict = 'yes') AS llm_yes,
  count(*) FILTER (method = 'llm' AND verdict = 'not_sure') AS llm_not_sure, count(*) FILTER (method = 'llm' AND verdict = 'no') AS llm_no, count(*) FILTER (method LIKE 'routing%') AS fallback_classified,
  count(*) FILTER (method LIKE 'routing%' AND verdict = 'yes') AS fallback_yes, count(*) FILTER (method LIKE 'routing%' AND verdict = 'no') AS fallback_no, count(*) FILTER (verdict <> 'no') AS included, count(*) FILTER (verdict = 'no') AS excluded FROM z"""
ROUTE_VERDICT_MERGE = f"{_R} SELECT id AS doc_id, verdict, method, verdict <> 'no' AS included FROM z"
ROUTE_STATS = f"{_R} {_STATS}"
ROUTE_ALL_DEGRADED = f"{_R.replace(V, V.replace('FROM labels', 'FROM labels WHERE false'))} {_STATS}"
ROUTE_DEGRADE_SPLIT = "SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) THEN 'degraded' ELSE 'kept' END AS side FROM documents"
GATE_FILTER = "SELECT doc_id FROM labels WHERE quality = 1"
GATE_FAIL_OPEN = "SELECT doc_id FROM documents"
RETRY_OVERLAY = "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN NULL WHEN d.doc_id % 3 = 0 THEN CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END ELSE 'not_sure' END AS verdict FROM documents d LEFT JOIN labels l USING (doc_id)"
VERDICT_COUNTS = "SELECT count(*) FILTER (quality = 1) AS yes, CAST(0 AS BIGINT) AS not_sure, count(*) FILTER (quality = 0) AS no FROM labels"
CONFUSION_MATRIX = f"""WITH {P}, {S}, {V}, x AS (SELECT section <> 'other' AS p, verdict = 'yes' AS a FROM s JOIN v USING (id)), c AS (SELECT count(*) FILTER (p AND a) AS tp, count(*) FILTER (p AND NOT a) AS fp, count(*) FILTER (NOT p AND a) AS fn, count(*) FILTER (NOT p AND NOT a) AS tn FROM x)
SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall FROM c"""

RESOLVE_LINES = f"WITH {P}, {S}, {L} SELECT id AS doc_id, line, line_method, priority FROM l"
FEATURED_TOPK = f"WITH {P}, {S}, {L}, {F} SELECT id AS doc_id, line, priority, title FROM f WHERE featured"
SELECTION_STATS = f"""WITH {P}, {S}, {L}, {F} SELECT count(*) AS total, count(*) FILTER (line <> 'skip') AS candidates, count(*) FILTER (featured) AS featured, count(*) FILTER (line <> 'skip' AND NOT featured) AS overflow,
  count(*) FILTER (line = 'line-a') AS line_a, count(*) FILTER (line = 'line-b') AS line_b, count(*) FILTER (line = 'preprint') AS preprint, count(*) FILTER (line = 'skip') AS skip,
  count(*) FILTER (featured AND line = 'line-a') AS featured_line_a, count(*) FILTER (featured AND line = 'line-b') AS featured_line_b, count(*) FILTER (featured AND line = 'preprint') AS featured_preprint,
  count(*) FILTER (NOT featured AND line = 'line-a') AS overflow_line_a, count(*) FILTER (NOT featured AND line = 'line-b') AS overflow_line_b, count(*) FILTER (NOT featured AND line = 'preprint') AS overflow_preprint FROM f"""
OVERFLOW_BY_JOURNAL = f"""WITH {P}, {S}, {L}, {F}, g AS (SELECT journal AS label, min(priority) AS priority, count(*) AS papers FROM f WHERE line <> 'skip' AND NOT featured GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY priority, label COLLATE en) AS position FROM g"""
DISPLAY_ORDER = f"WITH {P}, {S}, {L} SELECT id AS doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {RANK}) AS position FROM l"
CATEGORY_COUNTS = "SELECT CASE WHEN doc_id % 3 = 0 THEN 'unknown' ELSE lang END AS category, count(*) AS papers FROM documents GROUP BY 1"
CATEGORY_LINE = "SELECT string_agg(lang || '=' || n, ', ' ORDER BY lang) AS line FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1)"

BATCH_PLAN = """WITH RECURSIVE d AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
w AS (SELECT source, i, 0 AS batch, 1 AS items, n_chars AS size FROM d WHERE i = 1
  UNION ALL SELECT d.source, d.i, CASE WHEN o THEN batch + 1 ELSE batch END, CASE WHEN o THEN 1 ELSE items + 1 END, CASE WHEN o THEN d.n_chars ELSE size + 1 + d.n_chars END
  FROM w JOIN d ON d.source = w.source AND d.i = w.i + 1, LATERAL (SELECT items + 1 > 8 OR ceil((400 + size + 1 + d.n_chars + 45) / 4) > 2800 OR 200 + 72 * (items + 1) > 0.92 * 900 AS o))
SELECT source, batch, max(items) AS items, CAST(ceil((400 + max(size) + 45) / 4) AS BIGINT) AS input_tokens, 200 + 72 * max(items) AS completion_tokens FROM w GROUP BY source, batch"""
MISSING_RETRY_BATCH = """WITH d AS (SELECT doc_id, doc_id // 11 AS batch, doc_id % 17 = 0 OR doc_id % 23 = 0 AS lost FROM documents),
x AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY doc_id) <= ceil(count(*) OVER (PARTITION BY batch) / 2) AS head, count(*) FILTER (lost) OVER (PARTITION BY batch) AS n FROM d),
y AS (SELECT *, bool_or(lost AND head) OVER (PARTITION BY batch) AS in_head FROM x) SELECT doc_id, batch FROM y WHERE (n > 1 AND lost) OR (n = 1 AND head = in_head)"""
LLM_JSON_EXTRACT = """SELECT event_id, CASE WHEN event_id % 5 < 3 OR event_id % 10 = 4 THEN props END AS json, CASE WHEN event_id % 5 = 3 THEN 'no json object' WHEN event_id % 10 = 9 THEN 'no content' END AS error FROM events"""
VERDICT_ROWS = """WITH d AS (SELECT doc_id // 5 AS batch, doc_id, CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS verdict, bool_or(doc_id % 29 = 0) OVER (PARTITION BY doc_id // 5) AS bad, CAST(row_number() OVER (PARTITION BY doc_id // 5 ORDER BY doc_id) - 1 AS INT) AS pos FROM labels)
SELECT batch, pos, CAST(doc_id AS VARCHAR) AS id, verdict FROM d WHERE NOT bad"""
CONFIDENCE_ROWS = """SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL AND d.doc_id % 10 <> 0 AND d.doc_id % 13 <= 10 THEN (d.doc_id % 13) / 10.0 END AS confidence,
  CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id % 10 = 0 THEN 'duplicate' WHEN d.doc_id % 13 > 10 THEN 'invalid' ELSE 'ok' END AS status FROM documents d LEFT JOIN labels l USING (doc_id)"""
SALVAGE_ROWS = """WITH e AS (SELECT user_id AS batch, event_id % 13 = 0 AS bad_id, event_id % 11 = 0 AS blank, event_id % 9 = 0 AS twice, event_id % 8 <> 0 AS asked, user_id % 10 < 2 AS failed FROM events),
x AS (SELECT batch, failed, asked, CASE WHEN twice THEN 2 ELSE 1 END AS n, bad_id OR blank AS invalid, twice AND asked AND NOT bad_id AS again, NOT bad_id AND NOT blank AND NOT asked AS unknown, NOT bad_id AND NOT blank AND asked AND NOT twice AS good FROM e)
SELECT batch, failed, count(*) FILTER (asked) AS requested, CASE WHEN failed THEN 0 ELSE CAST(coalesce(sum(n) FILTER (invalid), 0) AS BIGINT) END AS invalid, CASE WHEN failed THEN 0 ELSE count(*) FILTER (again) END AS duplicate,
  CASE WHEN failed THEN 0 ELSE CAST(coalesce(sum(n) FILTER (unknown), 0) AS BIGINT) END AS unknown, CASE WHEN failed THEN 0 ELSE count(*) FILTER (good) END AS salvaged, count(*) FILTER (asked) - CASE WHEN failed THEN 0 ELSE count(*) FILTER (good) END AS missing FROM x GROUP BY batch, failed"""
SUMMARY_FIELDS = rf"""WITH {P}, x AS (SELECT id, {squeeze("regexp_replace(title, '[\"\\\\\\n\\t]', '', 'g')")} AS t, id % 7 <> 0 AND id % 10 < 8 AS ok FROM p)
SELECT id AS doc_id, CASE WHEN ok AND t <> '' THEN t END AS title, CASE WHEN ok AND t <> '' THEN 's' END AS summary, CASE WHEN ok AND t <> '' THEN array_to_string(list_transform(range(1, id % 10 + 2), lambda i: 'g' || i), ',') END AS tags FROM x"""
TRAILING_RATE = "SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) // 1000 RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW) AS recent FROM events"
START_SPACING = """WITH e AS (SELECT event_id, user_id, greatest(epoch_us(ts) // 1000, 1704153600000) AS came, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS i FROM events)
SELECT event_id, max(came - i * 7200000) OVER (PARTITION BY user_id ORDER BY i) + i * 7200000 AS start_ms FROM e"""
