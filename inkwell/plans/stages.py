"""Queries of the pipeline's stages from feed text, API pages and web pages to daily documents, each with its SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import policy
from inkwell.functions.keywords import strings
from inkwell.functions.text import escape_html
from inkwell.operators import enrich, payloads, provider, ranking, registry, selection
from inkwell.plans import sql
from inkwell.plans.catalog import lined, papers, query, read, rule
from inkwell.plans.flows import CONTROL
from inkwell.session import saved, shared_folder
from inkwell.sources import daily, feeds, preprints, scan

NAMES = [s[0] for s in policy.SOURCES]
_ANY = lambda values: ", ".join(f"'{v}'" for v in values)
_NTH = lambda n: f"{sql.arr(NAMES)}[1 + {n} % {len(NAMES)}]"


def nth_source(n) -> F.Column:
    return F.element_at(strings(NAMES), (1 + F.pmod(n, F.lit(len(NAMES)))).cast("int"))


# ---- feed items ----------------------------------------------------------------------------------


def _xml(c) -> F.Column:
    return escape_html(F.regexp_replace(c, CONTROL, ""))


def page_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source, value``: every page as a feed of one item, in the form of one of the catalogued sources; one in three has to be repaired before it parses."""
    p = read(spark, sf_dir, "pages").select(F.coalesce("page_id", F.lit(0)).alias("n"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    titles = strings([name for _, name, *_ in policy.SOURCES])
    p = p.withColumns({"source": nth_source(F.col("n")), "name": F.element_at(titles, (1 + F.pmod("n", F.lit(len(NAMES)))).cast("int"))})
    every = lambda k, r: F.pmod("n", F.lit(k)) == r
    encoded, byline = F.col("source").isin(policy.ENCODED_FEEDS), F.col("source") == "plos-biology"
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    title = F.when(every(5, 0), F.concat(F.lit("Author Correction: "), title)).when(every(5, 1) & (F.col("source") == "pnas"), "In This Issue").otherwise(title)
    header = F.concat(F.lit("<p>"), escape_html(F.col("name")), F.lit(", Published online: 05 January 2024; doi:10.1038/s1</p>"))
    body = F.when(encoded, F.concat(header, "html")).when(byline, F.concat(F.lit("<p> By A. B. and C. D.</p>"), "html"))
    value = F.concat(
        F.lit('<?xml version="1.0"?><rss version="2.0"><channel><item><title>'), _xml(title), F.lit("</title><link>"), _xml(F.col("url")), F.lit("</link>"),
        F.when(every(4, 0), F.concat(F.lit("<guid>doi:10.1234/PAGE."), F.col("n").cast("string"), F.lit("</guid>"))).otherwise(""),
        F.when(every(9, 8), "").otherwise("<pubDate>Fri, 05 Jan 2024 10:00:00 GMT</pubDate>"),
        F.when(every(3, 0), "<prism:doi /><media size= />").otherwise(""),
        F.when(body.isNotNull(), F.concat(F.lit("<content:encoded>"), _xml(body), F.lit("</content:encoded>"))).otherwise(F.concat(F.lit("<description>"), _xml(F.col("html")), F.lit("</description>"))),
        F.lit("</item></channel></rss>"),
    )
    return p.select("source", value.alias("value"))


_ITEM = f"""x AS (SELECT coalesce(page_id, 0) AS n, coalesce(url, '') AS url, regexp_replace(coalesce(html, ''), '{CONTROL}', '', 'g') AS html, {_NTH('coalesce(page_id, 0)')} AS source FROM pages),
y AS (SELECT *, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS t, {sql.strip("html")} AS plain FROM x),
z AS (SELECT *, {sql.squeeze("CASE WHEN n % 5 = 0 THEN 'Author Correction: ' || t WHEN n % 5 = 1 AND source = 'pnas' THEN 'In This Issue' ELSE t END")} AS title, CASE WHEN n % 4 = 0 THEN '10.1234/PAGE.' || n END AS doi FROM y)"""
FEED_PAPERS = f"""WITH {_ITEM} SELECT coalesce(lower(doi), url) AS id, title, 'Fri, 05 Jan 2024 10:00:00 GMT' AS published, url, doi, source, 0 AS ord,
  md5(CASE WHEN source IN ({_ANY(policy.SILENT_FEEDS)}) THEN NULL WHEN source IN ({_ANY(policy.ENCODED_FEEDS)}) THEN CASE WHEN length(plain) >= 40 THEN plain END ELSE nullif(plain, '') END) AS abstract_md5
FROM z WHERE title <> '' AND url <> '' AND n % 9 <> 8 AND NOT (source IN ({_ANY(policy.ENCODED_FEEDS)}) AND n % 5 = 0) AND NOT (source = 'pnas' AND n % 5 = 1)"""


@query(FEED_PAPERS)
def feed_papers(spark, sf_dir):
    items = feeds.parse(page_feeds(spark, sf_dir))
    d = feeds.to_papers(items, registry.sources(spark))
    return d.select("id", "title", "published", "url", "doi", "source", "ord", F.md5("abstract").alias("abstract_md5"))


# ---- preprints -----------------------------------------------------------------------------------

#: Papers of an API category and of one of its pages; which categories fail at their third page, and which have nothing.
CATEGORY, API_PAGE, BROKEN, NOTHING = 200, 25, 1, 3


def preprint_api(spark: SparkSession, sf_dir: str) -> tuple[str, list[str]]:
    """The documents as pages of an API in the shared folder, a category two hundred ids: the pages' address and the categories."""
    root, d = shared_folder(spark, "preprints"), papers(spark, sf_dir)
    n = F.coalesce("id", F.lit(0))
    d = d.select(n.alias("id"), "title", "abstract", F.floor(n / CATEGORY).alias("c"), "n_chars")
    d = saved(ranking.ranked_in_groups(d, "c", [F.col("id"), F.col("n_chars"), F.col("title")], f"{root}/ranked", "i"), f"{root}/records")
    text = F.col("id").cast("string")
    record = F.struct(
        F.col("title"), F.concat(F.lit("Lee, K.; ; Wu "), text).alias("authors"), F.concat(F.lit("10.1101/X"), text).alias("doi"), F.when(F.pmod("id", F.lit(8)) != 7, "2024-01-05").alias("date"),
        F.when(F.pmod("id", F.lit(2)) == 0, "2").alias("version"), F.lit("new results").alias("type"), F.when(F.pmod("id", F.lit(3)) == 0, " cell biology ").alias("category"), F.col("abstract"),
    )
    size = d.groupBy(F.col("c").alias("k")).agg(F.count(F.lit(1)).alias("total"))
    page = d.withColumn("cursor", F.floor((F.col("i") - 1) / API_PAGE) * API_PAGE).groupBy("c", "cursor").agg(F.collect_list(record).alias("collection")).join(size, F.col("c") == F.col("k"))
    kind = F.pmod("c", F.lit(7))
    status = F.when((kind == BROKEN) & (F.col("cursor") == 2 * API_PAGE), "internal error").when(kind == NOTHING, "No posts found").otherwise("ok")
    message = F.array(F.struct(status.alias("status"), F.size("collection").cast("string").alias("count"), F.col("total")))
    page = page.select("c", "cursor", F.to_json(F.struct(message.alias("messages"), "collection")).alias("value"))
    url = f"{root}/api/c={{category}}/{{cursor}}.json"

    def put(rows) -> None:
        for r in rows:
            scan.put(url.format(category=r.c, cursor=r.cursor), r.value.encode())

    page.foreachPartition(put)  # a page is a row and a file; a committer would rename them one by one on the driver
    return url, sorted(str(r[0]) for r in size.select("k").collect())


def preprint_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The API's answers; written, as they would be fetched once more with every use."""
    url, categories = preprint_api(spark, sf_dir)
    spark.dataSource.register(preprints.PreprintSource)
    return saved(spark.read.format("preprints").option("url", url).option("categories", ",".join(categories)).load())


_API = f"""{sql.P}, r AS (SELECT coalesce(id, 0) AS id, title, abstract, CAST(floor(coalesce(id, 0) / {CATEGORY}) AS BIGINT) AS c FROM p),
k AS (SELECT c, count(*) AS n, CASE WHEN c % 7 = {NOTHING} THEN 'empty' WHEN c % 7 = {BROKEN} AND count(*) > {2 * API_PAGE} THEN 'skipped: RuntimeError' ELSE 'ok' END AS status FROM r GROUP BY c)"""


@query(f"""WITH {_API}, x AS (SELECT r.*, {sql.squeeze("title")} AS t, {sql.squeeze("abstract")} AS a FROM r JOIN k USING (c) WHERE status = 'ok' AND id % 8 <> 7)
SELECT '10.1101/x' || id AS id, t AS title, '2024-01-05' AS published, 'https://www.biorxiv.org/content/10.1101/X' || id || CASE WHEN id % 2 = 0 THEN 'v2' ELSE '' END AS url, '10.1101/X' || id AS doi, md5(nullif(a, '')) AS abstract_md5,
  CASE WHEN id % 3 = 0 THEN 'cell biology' ELSE 'new results' END AS kind, 'Lee, K.|Wu ' || id AS authors FROM x WHERE t <> ''""")
def preprint_papers(spark, sf_dir):
    d = preprints.to_papers(preprint_records(spark, sf_dir).filter("status = 'ok'"))
    return d.select("id", "title", "published", "url", "doi", F.md5("abstract").alias("abstract_md5"), F.col("articleType").alias("kind"), F.array_join("authors", "|").alias("authors"))


@query(f"WITH {_API} SELECT CAST(c AS VARCHAR) AS category, status, CASE WHEN status = 'ok' THEN n ELSE 0 END AS records FROM k")
def preprint_statuses(spark, sf_dir):
    """What each category came to: one that fails at a later page counts for nothing."""
    return preprint_records(spark, sf_dir).groupBy(F.col("requested").alias("category"), "status").agg(F.count("doi").alias("records"))


# ---- pages and DOIs ------------------------------------------------------------------------------


@query(rf"""WITH {sql.P}, g AS (SELECT DISTINCT page_id FROM pages), l AS (SELECT DISTINCT doc_id FROM labels), x AS (SELECT p.id, {_NTH("id")} AS source, page_id, l.doc_id AS known, trim(regexp_extract(title, '^([^\n]*)', 1)) AS title,
  CASE id % 3 WHEN 1 THEN 'Lee et al. report on ' || id WHEN 2 THEN abstract END AS abstract FROM p LEFT JOIN g ON page_id = p.id LEFT JOIN l ON l.doc_id = p.id),
y AS (SELECT *, source = 'nature' AS gated, source IN ({_ANY(policy.PAGE_ABSTRACTS)}) AS by_page, source IN ({_ANY(policy.DOI_ABSTRACTS)}) AS by_doi, coalesce(abstract, '') <> '' AS present, id % 3 = 1 AS teaser,
  CASE page_id % 4 WHEN 0 THEN 'News & Views' WHEN 1 THEN 'Article' WHEN 3 THEN 'Review' END AS kind, CASE WHEN page_id % 2 = 0 THEN 'About <x> ' || page_id END AS on_page,
  CASE WHEN known IS NOT NULL AND known % 5 > 0 THEN 'Abstract ' || known || ': ' || repeat('word ', 19) || 'end.' END AS by_number FROM x),
z AS (SELECT *, CASE WHEN (gated OR by_page) AND (NOT present OR teaser) THEN on_page WHEN by_doi AND NOT present THEN by_number END AS found FROM y)
SELECT id AS doc_id, md5(coalesce(found, abstract)) AS abstract_md5, CASE WHEN gated THEN kind END AS kind,
  CASE WHEN gated AND page_id IS NOT NULL AND coalesce(kind, 'News & Views') = 'News & Views' THEN 'excluded' WHEN found IS NOT NULL THEN 'enriched' WHEN (gated OR by_page OR by_doi) AND (NOT present OR teaser) THEN 'kept' ELSE 'passed' END AS outcome FROM z""")
def page_enrichment(spark, sf_dir):
    """Papers of all sources, a third of them without an abstract and a third with a teaser, by the pages and the DOI table."""
    d = papers(spark, sf_dir).withColumn("n", F.col("id"))
    text, three = F.col("id").cast("string"), F.pmod("id", F.lit(3))
    own = d.select(
        "id", nth_source(F.col("id")).alias("source"), F.concat(F.lit("page/"), text).alias("url"), F.concat(F.lit("10.1/D"), text).alias("doi"),
        F.when(three == 1, F.concat(F.lit("Lee et al. report on "), text)).when(three == 2, F.col("abstract")).alias("abstract"), F.lit(None).cast("string").alias("articleType"),
    )
    n, number = F.pmod("page_id", F.lit(4)), F.col("page_id").cast("string")
    kind = F.when(n == 0, "<meta content='News &amp; Views' name='dc.type'>").when(n == 1, '<meta name="dc.type" content=" Article ">').when(n == 3, '<META property="x" CONTENT="Review" NAME="DC.type">').otherwise("")
    about = F.when(F.pmod("page_id", F.lit(2)) == 0, F.concat(F.lit('<meta name="description" content=" About &lt;x&gt;  '), number, F.lit('">'))).otherwise("")
    pages = read(spark, sf_dir, "pages").select(F.concat(F.lit("page/"), number).alias("url"), F.concat(kind, about, F.coalesce("html", F.lit(""))).alias("html"))
    known = F.col("doc_id").cast("string")
    markup = F.when(F.pmod("doc_id", F.lit(5)) > 0, F.concat(F.lit("<jats:p>Abstract "), known, F.lit(f": {'word ' * 19}"), F.lit("<b>end.</b></jats:p>"))).otherwise("<jats:p>short</jats:p>")
    abstracts = read(spark, sf_dir, "labels").select(F.concat(F.lit("10.1/d"), known).alias("doi"), markup.alias("markup"))
    return enrich.enrich(own, pages, abstracts).select(F.col("id").alias("doc_id"), F.md5("abstract").alias("abstract_md5"), F.col("articleType").alias("kind"), "outcome")


# ---- provider stages -----------------------------------------------------------------------------


def _asked(ids: list[str], payload: str) -> str:
    """A provider that answers no more than six papers, stumbles over some and forgets others."""
    sent = [p["id"] for p in json.loads(payload)["papers"]]
    if sent != ids:
        raise provider.ProviderError("unknown", "the payload is not that of its ids")
    if len(ids) > 6:
        raise provider.ProviderError("length")
    if any(int(i) % 31 == 5 for i in ids):
        return "no json"
    rows = [{"id": i, "verdict": ("yes", "no", "not_sure")[int(i) % 3]} for i in ids if int(i) % 13]
    return "So: " + json.dumps({"results": rows}) + " ."


def _called(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(papers, the stage's answers): batches of all papers with an id, by the routing stage's payloads."""
    d = papers(spark, sf_dir).filter("id IS NOT NULL").select(F.col("id").cast("string").alias("id"), "title", "abstract", "journal", "source")
    d = saved(d.join(registry_scopes(spark), "source", "left"))
    planned = payloads.planned(d, "routing", "source", ["id"], (8, 2800, 8192), shared_folder(spark, "calls"))
    packed = planned.withColumn("batch", F.concat_ws(":", F.coalesce("source", F.lit("")), F.col("batch").cast("string")))
    return d, provider.classify_batches(packed, _asked, f"{shared_folder(spark, 'answers')}/routing", budget_ms=86_400_000, concurrency=8)


def registry_scopes(spark: SparkSession) -> DataFrame:
    return registry.sources(spark).select(F.col("id").alias("source"), "scope")


_FATE = "CASE WHEN id % 31 = 5 THEN 'parse' WHEN id % 13 = 0 THEN 'missing' END"


@query(f"WITH {sql.P}, {sql.T} SELECT CAST(id AS VARCHAR) AS id, CASE WHEN {_FATE} IS NULL THEN ['yes', 'no', 'not_sure'][1 + id % 3] ELSE verdict END AS verdict, CASE WHEN {_FATE} IS NULL THEN 'primary' ELSE 'fallback' END AS answered_by FROM rule WHERE id IS NOT NULL")
def routing_cascade(spark, sf_dir):
    """The provider's verdicts, and the title rule's where batches were split, asked again and still lost."""
    d, answers = _called(spark, sf_dir)
    by_title = lambda rest: rest.select("id", rule(F.col("title"))["verdict"].alias("verdict"))
    out = provider.cascade(answers.filter("failure IS NULL").select("id", "verdict"), by_title, d.select("id", "title"))
    return out.select("id", "verdict", F.col("by").alias("answered_by"))


@query(f"""WITH {sql.P}, f AS (SELECT {_FATE} AS failure FROM p WHERE id IS NOT NULL)
SELECT count(*) AS requested, count(*) FILTER (failure IS NULL) AS answered, count(failure) AS failed, count(*) FILTER (failure = 'missing') AS missing, count(*) FILTER (failure = 'parse') AS unparsed FROM f""")
def routing_call_stats(spark, sf_dir):
    own = provider.stage_counts(_called(spark, sf_dir)[1], "verdict")
    of = lambda k: F.coalesce(F.col("kinds")[k], F.lit(0))
    return own.select("requested", "answered", "failed", of("missing").alias("missing"), of("parse").alias("unparsed"))


# ---- daily documents -----------------------------------------------------------------------------

_DAY = "strftime(DATE '2024-01-01' + CAST(coalesce(id, 0) % 30 AS INT), '%Y-%m-%d')"
_DAYS = f"""{sql.P}, {sql.S}, {sql.L}, d AS (SELECT *, {_DAY} AS day, row_number() OVER (PARTITION BY coalesce(id, 0) % 30 ORDER BY {sql.RANK}) AS position FROM l),
n AS (SELECT *, line <> 'skip' AND position <= 12 AS featured FROM d)"""


def daily_documents(spark: SparkSession, sf_dir: str, part: int = daily.PART) -> DataFrame:
    """Thirty days' documents written in parts, a folder a day, and read back: papers in order, and what the gate excluded."""
    root, d = shared_folder(spark, "daily"), lined(spark, sf_dir)
    d = d.select("id", "ord", "title", "source", "section", "line", "line_method", "priority", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.coalesce("id", F.lit(0)), F.lit(30)).cast("int")).cast("string").alias("report_date"))
    d = ranking.ranked_in_groups(d, "report_date", selection.rank_order(), f"{root}/ranked", "position")
    d = saved(d.withColumn("featured", (F.col("line") != "skip") & (F.col("position") <= 12)), f"{root}/placed")
    rows = d.select("report_date", "position", F.col("id").cast("string").alias("id"), "title", F.col("source").alias("sourceId"), "section", F.col("line").alias("digestLine"), F.col("line_method").alias("digestTaggingMethod"), "featured")
    out = d.filter("line = 'skip'").select("report_date", "ord", "id", "title", "line_method")
    out = ranking.ranked_in_groups(out, "report_date", [F.col("ord"), F.col("title")], f"{root}/excluded", "position")
    out = out.select("report_date", "position", F.struct(F.col("id").cast("string").alias("id"), "title").alias("paper"), F.lit("short title").alias("reason"), F.lit("no").alias("verdict"), F.col("line_method").alias("method"))
    daily.write(daily.documents(rows, selection.selection_stats(d, "report_date"), out, part=part), f"{root}/documents")
    return daily.read(spark, f"{root}/documents")


@query(f"WITH {_DAYS} SELECT day AS report_date, CAST(position - 1 AS INT) AS ord, CAST(id AS VARCHAR) AS id, title, source, section, line, line_method, featured FROM n")
def daily_papers(spark, sf_dir):
    d = daily.papers(daily_documents(spark, sf_dir))
    return d.select(F.col("reportDate").alias("report_date"), "ord", "id", "title", F.col("sourceId").alias("source"), "section", F.col("digestLine").alias("line"), F.col("digestTaggingMethod").alias("line_method"), "featured")


@query(f"""WITH {_DAYS} SELECT day AS report_date, count(*) AS total, count(*) FILTER (line <> 'skip') AS candidates, count(*) FILTER (featured) AS featured, count(*) FILTER (line <> 'skip' AND NOT featured) AS overflow,
  count(*) FILTER (line = 'line-a') AS line_a, count(*) FILTER (line = 'preprint') AS preprint, count(*) FILTER (line = 'line-b' AND featured) AS featured_b, count(*) AS papers, count(*) FILTER (line = 'skip') AS excluded FROM n GROUP BY day""")
def daily_counters(spark, sf_dir):
    """The counters that a day's document carries, beside what its parts hold."""
    d, s = daily_documents(spark, sf_dir), F.col("selection")
    most = lambda c, name: F.max(s[c]).alias(name)
    size = lambda c, name: F.sum(F.coalesce(F.size(F.coalesce(c, F.array())), F.lit(0)).cast("long")).alias(name)
    return d.groupBy(F.col("reportDate").alias("report_date")).agg(
        *[most(c, c) for c in ("total", "candidates", "featured", "overflow")], most("lineA", "line_a"), most("preprint", "preprint"), most("featuredLineB", "featured_b"), size("papers", "papers"), size("excludedPapers", "excluded"),
    )
