"""Queries of the operators that write, scan, count and rank across tasks, each with its SQL."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import rules
from inkwell.functions.text import escape_html
from inkwell.operators import batching, counters, layers, payloads, ranking, report
from inkwell.plans import sql
from inkwell.plans.catalog import catalog, lined, papers, query, read, selected
from inkwell.session import saved, shared_folder
from inkwell.sources import scan, snapshot

# ---- feeds ---------------------------------------------------------------------------------------

#: Pages of a feed, and what is wrong with one feed in seven: no file there, or a page in its place.
FEED_PAGES, GONE, PAGE = 50, 3, 5
#: What XML 1.0 cannot hold.
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]"


def _xml(c) -> F.Column:
    return escape_html(F.regexp_replace(c, CONTROL, ""))


def feeds_of_pages(spark: SparkSession, sf_dir: str) -> str:
    """The pages as feeds of ``FEED_PAGES`` items in the shared folder, a folder a feed, and their catalogue; its address. A feed's rows are written as they stand in order, and none is put together in memory."""
    root = shared_folder(spark, "feeds")
    p = read(spark, sf_dir, "pages").select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("feed", F.coalesce(F.expr(f"page_id div {FEED_PAGES}"), F.lit(-1)))
    on = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(9)).cast("int"))
    dated = F.when(F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(9)) != 8, F.concat(F.lit("<pubDate>Sun, "), F.date_format(on, "dd MMM yyyy"), F.lit(" 10:00:00 GMT</pubDate>"))).otherwise("")
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    item = F.concat(F.lit("<item><title>"), _xml(title), F.lit("</title><link>"), _xml(F.col("url")), F.lit("</link>"), dated, F.lit("<content:encoded>"), _xml(F.col("html")), F.lit("</content:encoded></item>"))
    page = F.pmod("feed", F.lit(7)) == PAGE
    feeds = p.select("feed").distinct()
    head = feeds.select("feed", F.lit(0).alias("k"), F.lit(None).cast("long").alias("page_id"), F.when(page, "<!DOCTYPE html><html>").otherwise('<?xml version="1.0"?><rss version="2.0"><channel>').alias("value"))
    tail = feeds.select("feed", F.lit(2).alias("k"), F.lit(None).cast("long").alias("page_id"), F.when(page, "</html>").otherwise("</channel></rss>").alias("value"))
    lines = head.unionByName(p.select("feed", F.lit(1).alias("k"), "page_id", item.alias("value"))).unionByName(tail).filter(F.pmod("feed", F.lit(7)) != GONE)
    lines.repartition("feed").sortWithinPartitions("feed", "k", "page_id").select("feed", "value").write.partitionBy("feed").text(f"{root}/feeds")
    name = F.concat(F.lit("f"), F.col("feed").cast("string"))
    feeds.select(name.alias("id"), F.concat(F.lit(f"{root}/feeds/feed="), F.col("feed").cast("string")).alias("url")).write.json(f"{root}/catalog")
    return f"{root}/catalog"


_FEED = f"p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, coalesce(CAST(floor(page_id / {FEED_PAGES}) AS BIGINT), -1) AS feed FROM pages)"
_LINES = lambda x: f"replace(replace(regexp_replace({x}, '{CONTROL}', '', 'g'), chr(13) || chr(10), chr(10)), chr(13), chr(10))"
FEED_ITEMS = f"""WITH {_FEED} SELECT 'f' || feed AS source, CAST(row_number() OVER (PARTITION BY feed ORDER BY page_id) - 1 AS INT) AS ord, {_LINES("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")} AS title,
  md5({_LINES("html")}) AS html_md5, {_LINES("url")} AS link, CASE WHEN page_id % 9 <> 8 THEN CAST(DATE '2024-01-01' + CAST(page_id % 9 AS INT) AS DATE) END AS day,
  nullif(concat_ws(', ', CASE WHEN {_LINES("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")} = '' THEN 'title' END, CASE WHEN {_LINES("url")} = '' THEN 'link' END, CASE WHEN page_id % 9 = 8 THEN 'date' END), '') AS lacks
FROM p WHERE (feed % 7 + 7) % 7 NOT IN ({GONE}, {PAGE})"""


@query(FEED_ITEMS)
def feed_items(spark, sf_dir):
    d = scan.scan(spark, feeds_of_pages(spark, sf_dir)).filter("status = 'item'")
    return d.select("source", "ord", "title", F.md5("content_encoded").alias("html_md5"), "link", "day", F.regexp_replace("reason", "^no ", "").alias("lacks"))


@query(f"SELECT source, ord, title, day FROM ({FEED_ITEMS}) WHERE day >= DATE '2024-01-03' AND day < DATE '2024-01-06' AND source IN ('f0', 'f1', 'f2', 'f3', 'f4')")
def feed_items_pushed(spark, sf_dir):
    """Five sources and three days, which the reader filters itself."""
    d = scan.scan(spark, feeds_of_pages(spark, sf_dir), sources=["f0", "f1", "f2", "f3", "f4"], since=date(2024, 1, 3))
    return d.filter(F.col("day") < F.lit(date(2024, 1, 6))).select("source", "ord", "title", "day")


@query(f"""WITH {_FEED} SELECT 'f' || feed AS source, CASE WHEN (feed % 7 + 7) % 7 IN ({GONE}, {PAGE}) THEN 'failed' ELSE 'ok' END AS status,
  CASE (feed % 7 + 7) % 7 WHEN {GONE} THEN '404 not found' WHEN {PAGE} THEN 'ValueError' END AS reason, CASE WHEN (feed % 7 + 7) % 7 NOT IN ({GONE}, {PAGE}) THEN count(*) END AS items FROM p GROUP BY feed""")
def feed_statuses(spark, sf_dir):
    d = scan.statuses(scan.scan(spark, feeds_of_pages(spark, sf_dir)))
    return d.select("source", "status", F.regexp_extract("reason", "^(404 not found|[A-Za-z]+)", 1).alias("reason"), "items").withColumn("reason", F.nullif("reason", F.lit("")))


# ---- snapshots and counters ----------------------------------------------------------------------


@query("""SELECT source, count(*) AS papers, count(*) FILTER (doc_id % 10 = 3) AS on_day FROM documents GROUP BY source""")
def snapshot_manifest(spark, sf_dir):
    """Two runs of snapshots, all papers and those of a day, and what their manifests add up to by source."""
    root, d = shared_folder(spark, "snapshots"), papers(spark, sf_dir)
    for run, rows in (("all", d), ("day", d.filter("id % 10 = 3"))):
        snapshot.write(rows.select("id", "title", "abstract", "source"), root, run, count_by="source", label=run)
    of = lambda run: F.coalesce(F.sum(F.when(F.col("run") == run, F.col("key_rows"))), F.lit(0))
    return snapshot.manifests(spark, root).groupBy(F.col("key").alias("source")).agg(of("all").alias("papers"), of("day").alias("on_day"))


_COUNTED = {"titled": "length(title) >= 8", "preprints": "source = 'src19'"}
STAGE_COUNTERS = f"""WITH {sql.P}, c AS (SELECT *, length(title) >= 8 AS titled, source = 'src19' AS preprint, id % 2 AS run FROM p),
k AS (SELECT 'scan' AS stage, id, titled, preprint, n_chars FROM c UNION ALL SELECT 'screen', id, titled, preprint, n_chars FROM c WHERE titled)
SELECT stage, unnest(['rows', 'titled', 'preprints', 'chars', 'first_id', 'longest']) AS counter, unnest(['sum', 'sum', 'sum', 'sum', 'least', 'greatest']) AS kind,
  unnest([count(*), count(*) FILTER (titled), count(*) FILTER (preprint), CAST(sum(n_chars) AS BIGINT), min(id), CAST(max(n_chars) AS BIGINT)]) AS value FROM k GROUP BY stage"""


@query(STAGE_COUNTERS)
def stage_counters(spark, sf_dir):
    """Two runs (even and odd papers) of two stages, counted while they are written, and merged."""
    root, d = shared_folder(spark, "counted"), papers(spark, sf_dir).select("id", "title", "source", F.col("n_chars").cast("long").alias("n_chars"))
    frames, spec = [], lambda: {"sums": {**{k: F.expr(v) for k, v in _COUNTED.items()}, "chars": F.col("n_chars")}, "least": {"first_id": F.col("id")}, "greatest": {"longest": F.col("n_chars")}}
    for run in (0, 1):
        first, second = counters.Stage("scan", **spec()), counters.Stage("screen", **spec())
        kept = second.of(first.of(d.filter(F.pmod("id", F.lit(2)) == run)).filter("length(title) >= 8"))
        saved(kept, f"{root}/{run}")
        frames.append((first.counters() + second.counters()).frame(spark, str(run)))
    return counters.merged(reduce(DataFrame.unionByName, frames))


@query(f"""WITH {sql.P}, {sql.S}, {sql.L} SELECT unnest(['rows', 'llm_line_a', 'llm_line_b', 'keyword_fallback_line_a', 'keyword_fallback_line_b', 'failed']) AS counter,
  unnest([count(*), count(*) FILTER (line_method = 'llm' AND line = 'line-a'), count(*) FILTER (line_method = 'llm' AND line = 'line-b'), count(*) FILTER (line_method = 'keyword-fallback' AND line = 'line-a'),
  count(*) FILTER (line_method = 'keyword-fallback' AND line = 'line-b'), count(*) FILTER (line IS NULL)]) AS value FROM l""")
def tagging_stats(spark, sf_dir):
    stage = counters.tagging_stage()
    saved(stage.of(lined(spark, sf_dir)).select("id", "line", "line_method"), shared_folder(spark, "tagged"))
    return stage.counters().frame(spark, "day").select("counter", "value")


@query("""WITH a AS (SELECT event_type AS stage, CASE user_id % 5 WHEN 0 THEN 'timeout' WHEN 1 THEN 'rate_limit' ELSE 'ok' END AS outcome, event_id % 3 AS retry, CASE WHEN user_id % 5 = 1 THEN event_id % 1000 END AS wait_ms FROM events)
SELECT stage, unnest(['requests', 'retries', 'answered', 'failed', 'waited_ms', 'longest_ms']) AS counter, unnest([count(*), count(*) FILTER (retry > 0), count(*) FILTER (outcome = 'ok'), count(*) FILTER (outcome <> 'ok'),
  CAST(coalesce(sum(wait_ms), 0) AS BIGINT), CAST(max(wait_ms) AS BIGINT)]) AS value FROM a GROUP BY stage""")
def stage_diagnostics(spark, sf_dir):
    n = F.pmod("user_id", F.lit(5))
    log = read(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), F.when(n == 0, "timeout").when(n == 1, "rate_limit").otherwise("ok").alias("outcome"), F.pmod("event_id", F.lit(3)).alias("retry"), F.when(n == 1, F.pmod("event_id", F.lit(1000))).alias("wait_ms"))
    return counters.attempt_counters(log).select("stage", "counter", "value")


# ---- ranks, batches and timing across tasks ----------------------------------------------------------


@query(f"WITH {sql.P}, {sql.S}, {sql.L} SELECT id AS doc_id, row_number() OVER (ORDER BY {sql.RANK}) AS position FROM l")
def global_display_order(spark, sf_dir):
    d = lined(spark, sf_dir).select("id", "ord", "title", "line", "priority")
    return ranking.global_display_order(d, shared_folder(spark, "order")).select(F.col("id").alias("doc_id"), "position")


@query(f"""WITH {sql.P}, {sql.S}, {sql.L}, {sql.F}, n AS (SELECT *, coalesce(journal, source) AS label, row_number() OVER (PARTITION BY journal ORDER BY {sql.RANK}) AS i FROM f WHERE line <> 'skip' AND NOT featured),
g AS (SELECT label, min(priority) AS priority, count(*) AS papers, string_agg(id, ',' ORDER BY i) FILTER (i <= 8) AS ids, string_agg(title, '|' ORDER BY i) FILTER (i <= 8) AS titles FROM n GROUP BY label)
SELECT *, row_number() OVER (ORDER BY priority, label COLLATE en) AS position FROM g""")
def overflow_list(spark, sf_dir):
    d = ranking.overflow_list(selected(spark, sf_dir), shared_folder(spark, "overflow"), 8)
    text = lambda c: F.array_join(F.transform("rows", lambda r: r[c].cast("string")), "," if c == "id" else "|")
    return d.select("label", "priority", "papers", text("id").alias("ids"), text("title").alias("titles"), "position")


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY kind, client_id ORDER BY ts NULLS LAST, click_id) AS i FROM (SELECT DISTINCT click_id, kind, client_id, ts FROM clicks))
SELECT kind, client_id, string_agg(click_id, ',' ORDER BY i) AS ids FROM n WHERE i <= 3 GROUP BY ALL""")
def key_samples(spark, sf_dir):
    """The first three clicks of each kind and client."""
    d = read(spark, sf_dir, "clicks").select("click_id", "kind", "client_id", "ts").distinct()
    out = ranking.least_of_each(d, ["kind", "client_id"], ["ts", "click_id"], 3, ["click_id"])
    return out.select("kind", "client_id", F.array_join(F.transform("sample", lambda r: r["click_id"].cast("string")), ",").alias("ids"))


@query(sql.BATCH_PLAN)
def batch_plan_ranges(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    packed = batching.pack_ranges(d, "source", ["doc_id"], "n_chars", "routing", 8, 2800, 900, shared_folder(spark, "batches"), 400)
    return batching.batch_estimates(packed, "source", "n_chars", "routing", 400)


@query("""WITH e AS (SELECT event_id, greatest(epoch_us(ts) // 1000, 1704153600000) AS came, row_number() OVER (ORDER BY epoch_us(ts) // 1000, event_id) AS i FROM events)
SELECT event_id, max(came - i * 7200) OVER (ORDER BY i) + i * 7200 AS start_ms FROM e""")
def start_spacing_hot(spark, sf_dir):
    """All starts in one bucket."""
    d = read(spark, sf_dir, "events").select("event_id", F.lit("all").alias("bucket"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at"))
    return batching.spaced_starts_ranges(d, "bucket", "at", ["at", "event_id"], 7_200, shared_folder(spark, "spacing"), F.lit(1_704_153_600_000)).select("event_id", "start_ms")


@query("""SELECT event_id, count(*) OVER (ORDER BY epoch_us(ts) // 1000 RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW) AS recent,
  epoch_us(ts) // 1000 - lag(epoch_us(ts) // 1000) OVER (ORDER BY epoch_us(ts) // 1000, event_id) AS gap_ms FROM events""")
def trailing_rate_hot(spark, sf_dir):
    """All starts in one bucket."""
    return batching.request_rate_slices(read(spark, sf_dir, "events"), "ts", ["event_id"], None, 3600).select("event_id", "recent", "gap_ms")


# ---- payloads and settings -------------------------------------------------------------------------

_ITEM = {
    "gate": "'\"abstract\":' || to_json(coalesce(abstract, ''))",
    "routing": "'\"journal\":' || to_json(coalesce(journal, '')) || ',\"source_id\":' || to_json(coalesce(source, ''))",
    "spatial": "'\"journal\":' || to_json(coalesce(journal, '')) || a",
    "tagging": "'\"journal\":' || to_json(coalesce(journal, '')) || ',\"source_id\":' || to_json(coalesce(source, '')) || ',\"scope\":\"' || scope || '\"' || a",
    "translate": "'\"journal\":' || to_json(coalesce(journal, ''))",
    "summarize": "'\"journal\":' || to_json(coalesce(journal, '')) || ',\"source_id\":' || to_json(coalesce(source, '')) || ',\"scope\":\"' || scope || '\",\"digest_line\":\"line-b\"' || a",
}
_T = r"regexp_replace(abstract, '^[\s\x{A0}\x{FEFF}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+|[\s\x{A0}\x{FEFF}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+$', '', 'g')"
_PAYLOADS = f"""WITH {sql.P}, c AS ({sql.cat(20)}), x AS (SELECT p.*, coalesce(scope, 'life-science-only') AS scope, {_T} AS t FROM p LEFT JOIN c ON p.source = c.id),
y AS (SELECT *, coalesce(',"abstract":' || to_json(CASE WHEN length(t) > 2000 THEN substr(t, 1, 2000) || '…' ELSE t END), '') AS a FROM x),
z AS ({" UNION ALL ".join(f"SELECT id, source, '{s}' AS stage, '{{\"id\":' || to_json(CAST(id AS VARCHAR)) || ',\"title\":' || to_json(coalesce(title, '')) || ',' || {i} || '}}' AS payload FROM y" for s, i in _ITEM.items())})"""


def _scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    scopes = catalog(spark).select(F.col("id").alias("source"), "scope")
    return papers(spark, sf_dir).join(scopes, "source", "left")


@query(f"{_PAYLOADS} SELECT id AS doc_id, stage, CAST(length(payload) AS BIGINT) AS chars, md5(payload) AS md5 FROM z")
def stage_payloads(spark, sf_dir):
    d = payloads.with_payloads(_scoped(spark, sf_dir), list(payloads.FIELDS), ["id"])
    return d.select(F.col("id").alias("doc_id"), "stage", F.col("payload_chars").alias("chars"), F.md5("payload").alias("md5"))


@query(rf"""{_PAYLOADS.replace("WITH ", "WITH RECURSIVE ", 1)}, d AS (SELECT source, length(payload) AS n, row_number() OVER (PARTITION BY source ORDER BY id) AS i FROM z WHERE stage = 'spatial'),
w AS (SELECT source, i, 0 AS batch, 1 AS items, n AS size FROM d WHERE i = 1
  UNION ALL SELECT d.source, d.i, CASE WHEN o THEN batch + 1 ELSE batch END, CASE WHEN o THEN 1 ELSE items + 1 END, CASE WHEN o THEN d.n ELSE size + 1 + d.n END
  FROM w JOIN d ON d.source = w.source AND d.i = w.i + 1, LATERAL (SELECT items + 1 > 8 OR ceil((10 + size + 1 + d.n + 45) / 4) > 1500 OR 120 + 64 * (items + 1) > 0.92 * 8192 AS o))
SELECT source, batch, max(items) AS items, CAST(max(size) - max(items) + 1 AS BIGINT) AS chars FROM w GROUP BY source, batch""")
def payload_batches(spark, sf_dir):
    """Batches of the spatial stage by the exact lengths of its payloads."""
    d = payloads.planned(papers(spark, sf_dir), "spatial", "source", ["id"], (8, 1500, 8192), shared_folder(spark, "payloads"), "0123456789", whole=False)
    return d.groupBy("source", "batch").agg(F.count(F.lit(1)).alias("items"), F.sum("payload_chars").alias("chars"))


_SEGMENTS = ("retail", "wholesale", "online", "public")
CLIENT_RULES = {"segment": layers.Rule(required=True, among=_SEGMENTS), "city": layers.Rule(required=True, pattern="^[A-Z]"), "balance": layers.Rule("number", low=0, high=9000), "source": layers.Rule(among=("crm", "web", "store"))}
_ENTRIES = """e AS (SELECT CAST(client_id AS VARCHAR) AS scope, unnest(['segment', 'city', 'balance', 'source']) AS key, unnest([segment, city, CAST(CAST(balance AS DECIMAL(18, 2)) AS VARCHAR), source]) AS value, 1 AS layer, 0 AS seq FROM clients
  UNION ALL SELECT CAST(client_id AS VARCHAR), unnest(['segment', 'city', 'balance', 'source']), unnest([segment, city, CAST(CAST(balance AS DECIMAL(18, 2)) AS VARCHAR), source]), 2, seq FROM client_changes),
b AS (SELECT scope, key, last(struct_pack(l := layer, v := value) ORDER BY layer, seq, value) AS r FROM e WHERE value IS NOT NULL GROUP BY scope, key), r AS (SELECT scope, key, r.v AS value, CAST(r.l AS INT) AS layer FROM b)"""


def client_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients as settings: a layer of their own rows, and one of the changes, of which the last counts."""
    spread = lambda d, layer, seq: d.select(F.col("client_id").cast("string").alias("scope"), F.explode(F.create_map(*[x for c in CLIENT_RULES for x in (F.lit(c), F.col(c).cast("decimal(18,2)").cast("string") if c == "balance" else F.col(c))])).alias("key", "value"), F.lit(layer).alias("layer"), seq.cast("long").alias("seq"))
    return spread(read(spark, sf_dir, "clients"), 1, F.lit(0)).unionByName(spread(read(spark, sf_dir, "client_changes"), 2, F.col("seq")))


@query(f"WITH {_ENTRIES} SELECT * FROM r")
def layered_settings(spark, sf_dir):
    return layers.resolve(client_entries(spark, sf_dir))


@query(f"""WITH {_ENTRIES}, f AS (SELECT *, CASE key WHEN 'segment' THEN CASE WHEN value NOT IN ('retail', 'wholesale', 'online', 'public') THEN 'not one of retail, wholesale, online, public' END
  WHEN 'city' THEN CASE WHEN NOT regexp_matches(value, '^[A-Z]') THEN 'not of its form' END WHEN 'balance' THEN CASE WHEN CAST(value AS DOUBLE) < 0 THEN 'below 0' WHEN CAST(value AS DOUBLE) > 9000 THEN 'above 9000' END
  ELSE CASE WHEN value NOT IN ('crm', 'web', 'store') THEN 'not one of crm, web, store' END END AS fault FROM r)
SELECT * FROM f WHERE fault IS NOT NULL UNION ALL SELECT scope, key, NULL, NULL, 'missing' FROM (SELECT DISTINCT CAST(client_id AS VARCHAR) AS scope FROM clients), (VALUES ('segment'), ('city')) k(key)
  WHERE (scope, key) NOT IN (SELECT (scope, key) FROM r WHERE scope IS NOT NULL) AND scope IS NOT NULL""")
def settings_faults(spark, sf_dir):
    own = layers.resolve(client_entries(spark, sf_dir))
    return layers.faults(own, CLIENT_RULES, read(spark, sf_dir, "clients").filter("client_id IS NOT NULL").select(F.col("client_id").cast("string").alias("scope")))


# ---- report ------------------------------------------------------------------------------------

_MASK = lambda x: f"CASE WHEN length({x}) > 8 THEN substr({x}, 1, 4) || '…' || right({x}, 4) WHEN {x} IS NOT NULL THEN '***' END"


@query(f"SELECT c_custkey, {_MASK('c_name')} AS masked, {_MASK('short')} AS short FROM (SELECT *, substr(c_name, 1, CAST(c_custkey % 12 AS INT)) AS short FROM customer)")
def key_masks(spark, sf_dir):
    d = read(spark, sf_dir, "customer").select("c_custkey", "c_name", F.substring("c_name", F.lit(1), F.pmod("c_custkey", F.lit(12)).cast("int")).alias("short"))
    return d.select("c_custkey", rules.key_mask(F.col("c_name")).alias("masked"), rules.key_mask(F.col("short")).alias("short"))


_DOI = "CASE page_id % 4 WHEN 0 THEN ' 10.1234/A (b)*c~' || page_id || ' ' WHEN 1 THEN ' ' END"
_ID = "CASE page_id % 4 WHEN 1 THEN '10.5555/x&y+' || page_id WHEN 2 THEN coalesce(url, '') ELSE '10.1/short' END"
_ESC = lambda x: f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(34), '&quot;')"
_URI = "replace(replace(replace(replace(url_encode(doi), '%2A', '*'), '%28', '('), '%29', ')'), '%7E', '~')"


@query(f"""WITH x AS (SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS journal, coalesce(nullif(trim({_DOI}), ''), CASE WHEN regexp_matches({_ID}, '(?i)^10[.][0-9]{{4,9}}/') THEN {_ID} END) AS doi FROM pages)
SELECT page_id, doi, '<p class="journal">' || {_ESC("journal")} || coalesce(' · <a href="https://doi.org/' || {_ESC(_URI)} || '">' || {_ESC("doi")} || '</a>', '') || '</p>' AS line FROM x""")
def doi_lines(spark, sf_dir):
    n = F.pmod("page_id", F.lit(4))
    d = read(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("journal"), F.when(n == 0, F.concat(F.lit(" 10.1234/A (b)*c~"), F.col("page_id").cast("string"), F.lit(" "))).when(n == 1, " ").alias("doi"),
        F.when(n == 1, F.concat(F.lit("10.5555/x&y+"), F.col("page_id").cast("string"))).when(n == 2, F.coalesce("url", F.lit(""))).otherwise("10.1/short").alias("id"),
    )
    return d.select("page_id", rules.shown_doi(F.col("doi"), F.col("id")).alias("doi"), report.journal_line(F.col("journal"), F.col("doi"), F.col("id")).alias("line"))


@query("""WITH x AS (SELECT client_id, CASE WHEN client_id % 2 = 0 THEN 'team@Resend.dev' ELSE 'team@x.org' END AS sender, [coalesce(email, 'none'), 'B@x.org'][1:CAST(1 + client_id % 3 AS INT)] AS recipients,
  CASE WHEN client_id % 5 = 0 THEN ' b@X.org' WHEN client_id % 5 = 1 THEN email WHEN client_id % 5 = 2 THEN 'nobody@x.org' END AS owner FROM clients WHERE client_id IS NOT NULL),
y AS (SELECT *, lower(sender) LIKE '%@resend.dev' AS sandbox, nullif(lower(trim(owner)), '') AS who FROM x),
z AS (SELECT *, list_filter(recipients, lambda a: lower(a) = who) AS own, list_filter(recipients, lambda a: lower(a) <> who) AS others FROM y)
SELECT client_id, array_to_string(CASE WHEN NOT sandbox OR who IS NULL THEN recipients ELSE own END, ',') AS recipients, CASE WHEN sandbox AND who IS NOT NULL THEN array_to_string(others, ',') ELSE '' END AS skipped,
  CASE WHEN sandbox THEN CASE WHEN who IS NULL THEN CASE WHEN len(recipients) > 1 THEN 'several recipients and no owner' END WHEN len(own) = 0 THEN 'owner is no recipient' END END AS error FROM z""")
def sandbox_recipients(spark, sf_dir):
    n = F.pmod("client_id", F.lit(5))
    d = read(spark, sf_dir, "clients").filter("client_id IS NOT NULL").select(
        "client_id", F.when(F.pmod("client_id", F.lit(2)) == 0, "team@Resend.dev").otherwise("team@x.org").alias("sender"),
        F.slice(F.array(F.coalesce("email", F.lit("none")), F.lit("B@x.org")), F.lit(1), (1 + F.pmod("client_id", F.lit(3))).cast("int")).alias("to"), F.when(n == 0, " b@X.org").when(n == 1, F.col("email")).when(n == 2, "nobody@x.org").alias("owner"),
    )
    s = rules.sandboxed(F.col("sender"), F.col("to"), F.col("owner"))
    return d.select("client_id", s.alias("s")).select("client_id", F.array_join("s.to", ",").alias("recipients"), F.array_join("s.skipped", ",").alias("skipped"), "s.error")
