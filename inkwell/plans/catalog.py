"""Every registered query of the curation engine, with its SQL oracle.

The driver's tables stand in for feeds and papers: a document's first sentence is its title and the
rest its abstract, and its source's number gives priority and scope.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import dates, html, keywords, policy, rules, text
from inkwell.operators import batching, identity, registry, report, retention, routing, selection, structured
from inkwell.plans import sql
from inkwell.session import saved
from inkwell.sources import feeds

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

PRIMARY, BIOLOGY = sql.PRIMARY, sql.BIOLOGY
RULE = sql.RULE
DAY = "2024-01-05"


def query(oracle: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as papers: id, ord, title, abstract, source, lang, n_chars, text."""
    raw = F.regexp_extract("text", r"^([^.\n]*)", 1)
    d = read(spark, sf_dir, "documents").withColumn("_raw", raw)
    return d.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), F.trim("_raw").alias("title"), F.trim(F.expr("substring(text, length(_raw) + 2)")).alias("abstract"), "source", F.col("source").alias("journal"), "lang", "n_chars", "text")


def catalog(spark: SparkSession, n: int = 20) -> DataFrame:
    return spark.range(n).select(
        F.concat(F.lit("src"), F.col("id").cast("string")).alias("id"), (F.col("id") + 1).cast("int").alias("priority"), F.when(F.col("id") % 3 == 0, "broad-science").otherwise("life-science-only").alias("scope")
    )


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "yes").otherwise("no").alias("verdict"))


def sections(d: DataFrame) -> DataFrame:
    hay = keywords.searchable(F.col("title"), F.col("abstract"))
    d = d.withColumn("_p", keywords.matches(hay, PRIMARY)).withColumn("_b", keywords.matches(hay, BIOLOGY))
    return d.withColumn("matched", F.concat("_p", "_b")).withColumn("section", keywords.section(F.col("_p"), F.col("_b"))).drop("_p", "_b")


def rule(title):
    return keywords.title_verdict(title, **RULE)


def lined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with line and priority: preprints, then junk titles, which are skipped, then labelled documents by a confidence and the others by their section."""
    d = sections(papers(spark, sf_dir))
    c = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), ((F.col("doc_id") % 21) / 20.0).alias("_c"))
    line, method = rules.resolved_line(F.col("source"), F.length("title") < 8, F.col("_c"), F.col("section"), ["src19"])
    d = d.join(c, "id", "left").withColumns({"line": line, "line_method": method}).drop("_c")
    return registry.with_dimension(d, catalog(spark, 15), "source", "id", {"priority": policy.MISSING_PRIORITY})


def selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = lined(spark, sf_dir)
    narrow = d.select("id", "ord", "title", "source", "journal", "line", "priority", rules.eligible(F.col("line"), F.col("abstract")).alias("eligible"))
    return selection.select_featured(saved(narrow))


# ---- identity and duplicates -----------------------------------------------------------


@query(sql.DEDUPE_FIRST_WINS)
def dedupe_first_wins(spark, sf_dir):
    d = papers(spark, sf_dir).select("id", "source", "lang", F.lower(text.squeeze(F.col("text"))).alias("k"))
    return identity.first_wins(d, ["k"], "id", ["id", "source", "lang"]).select(F.col("id").alias("doc_id"), "source", "lang")


@query(sql.TWO_LEVEL_DEDUPE)
def two_level_dedupe(spark, sf_dir):
    d = papers(spark, sf_dir).select("id", "source", "n_chars", F.lower(text.squeeze(F.col("text"))).alias("k"))
    return identity.two_level(d, "source", "k", "id", F.col("n_chars") >= 200, ["id", "source"]).select(F.col("id").alias("doc_id"), "source")


@query(sql.IDENTITY_KEY)
def identity_key(spark, sf_dir):
    d = read(spark, sf_dir, "pages")
    guid = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("doi:10.1234/PAGE."), F.col("page_id").cast("string"), F.lit(" .")))
    url = F.when(F.col("page_id") % 3 == 1, "").otherwise(F.col("url"))
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    return d.select("page_id", text.paper_id(text.extract_doi(guid), url, title).alias("id"))


@query(sql.DUPLICATE_FAIL_CLOSED)
def duplicate_fail_closed(spark, sf_dir):
    d = read(spark, sf_dir, "events").select("event_id", F.concat_ws("-", F.col("user_id").cast("string"), "event_type", F.to_date("ts").cast("string")).alias("k"))
    return identity.drop_repeated(d, "k").select("event_id")


@query(sql.LAST_WINS_FOLD)
def last_wins_fold(spark, sf_dir):
    d = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.struct("ts", "event_id").alias("at"))
    return identity.last_wins(d, ["user_id"], "at").select("user_id", "event_id", "event_type")


@query(sql.MISSING_IDS)
def missing_ids(spark, sf_dir):
    return identity.missing(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "doc_id").select("doc_id")


@query(sql.UNKNOWN_IDS)
def unknown_ids(spark, sf_dir):
    asked = read(spark, sf_dir, "documents").filter("source <> 'src3'")
    return identity.unknown(asked, read(spark, sf_dir, "labels"), "doc_id").select("doc_id")


@query(sql.UNIQUE_TITLE_JOIN)
def unique_title_join(spark, sf_dir):
    d = papers(spark, sf_dir)
    rows = d.select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, F.col("id")).otherwise(-F.col("id") - 1).alias("row_id"), F.concat(F.lit(" \t"), "title", F.lit("\n ")).alias("row_title"))
    return identity.match_by_id_or_title(rows, d.select("id", "title"), "row_id", "row_title", "id", "title").select("doc_id", "matched", "matched_by")


@query(sql.FIELD_OVERLAY)
def field_overlay(spark, sf_dir):
    new = read(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").alias("lang"))
    return identity.overlay(read(spark, sf_dir, "documents").select("doc_id", "lang"), new, "doc_id", ["lang"])


# ---- dates ------------------------------------------------------------------------------


@query(sql.REPORT_DATE_FILTER)
def report_date_filter(spark, sf_dir):
    d = read(spark, sf_dir, "events")
    return d.filter(dates.report_day(F.col("ts")) == DAY).select("event_id", dates.report_day(F.col("ts")).cast("string").alias("day"))


@query(sql.REPORT_DATE_FUNNEL)
def report_date_funnel(spark, sf_dir):
    d = read(spark, sf_dir, "events")
    return report.funnel(d, "event_type", {"items": F.lit(True), "valued": F.col("value") > 100, "on_day": dates.report_day(F.col("ts")) == DAY})


@query(sql.DEFAULT_REPORT_DAY)
def default_report_day(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", dates.default_report_day(F.col("ts")).cast("string").alias("day"))


@query(sql.PUBLISHED_DATES)
def published_dates(spark, sf_dir):
    d = read(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    spelled = F.when(F.col("o_orderkey") % 3 == 0, day.cast("string")).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("Sun, "), F.date_format(day, "dd MMM yyyy"), F.lit(" 17:30:00 GMT"))).otherwise("soon")
    return d.select("o_orderkey", dates.report_day(dates.published(spelled)).cast("string").alias("day"))


@query(sql.RETENTION_PLAN)
def retention_plan(spark, sf_dir):
    d = read(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("label"))
    bad = spark.createDataFrame([("2024-02-30",), ("2024-1-5",), ("latest",)], "label string")
    return retention.plan(d.unionByName(bad), "2024-01-25", 10)


# ---- text and pages ----------------------------------------------------------------------


@query(sql.HTML_TITLE_STRIP)
def html_title_strip(spark, sf_dir):
    title = F.concat(F.lit("<b>A&amp;B <i>x</i></b>  "), F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1), F.lit(" H<sub>2</sub>O\n"))
    return read(spark, sf_dir, "pages").select("page_id", text.title_text(title).alias("title"))


@query(sql.HTML_MAIN_TEXT)
def html_main_text(spark, sf_dir):
    plain = text.strip_tags(F.col("html"))
    return read(spark, sf_dir, "pages").select("page_id", F.length(plain).cast("long").alias("chars"), F.md5(plain).alias("md5"), F.md5(text.escape_html(plain)).alias("escaped_md5"))


@query(sql.HTML_META_EXTRACT)
def html_meta_extract(spark, sf_dir):
    kind = F.when(F.col("page_id") % 4 == 0, "News &amp; Views").when(F.col("page_id") % 4 == 1, "Article").otherwise("")
    page = F.concat(F.lit("<meta name='dc.type' content=\""), kind, F.lit('"><meta content="d '), F.col("page_id").cast("string"), F.lit('" property="og:description"><meta name="description" content="'), F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(""), F.lit('">'), F.col("html"))
    d = read(spark, sf_dir, "pages").select("page_id", page.alias("h"))
    t = html.article_type(F.col("h"))
    return d.select("page_id", t.alias("kind"), rules.is_research_page(t).alias("research"), html.page_abstract(F.col("h")).alias("abstract"))


@query(sql.ENTITY_DECODE)
def entity_decode(spark, sf_dir):
    units = "&#55357;&#56832;|&#55357;|&#56832;&#55357;|&#55357;&#55357;&#56832;&#56832;|&#55357; &#56832;|&#65601;|&#" + "9" * 400 + ";|"
    raw = F.concat(F.lit(units + "&#945;&#8211;"), F.col("page_id").cast("string"), F.lit("&amp;lt;&NBSP;&#x27;&#x3b1;&#65;&#"), F.lit("66;"), F.coalesce("html", F.lit("")))
    return read(spark, sf_dir, "pages").select("page_id", F.md5(text.decode_entities(raw)).alias("decoded_md5"))


@query(sql.JATS_ABSTRACT)
def jats_abstract(spark, sf_dir):
    markup = F.concat(F.lit("&lt;jats:p&gt;"), F.col("text"), F.lit("&lt;/jats:p&gt;"))
    return read(spark, sf_dir, "documents").select("doc_id", text.jats_abstract(markup).alias("abstract"))


@query(sql.ENCODED_ABSTRACT)
def encoded_abstract(spark, sf_dir):
    journal = F.when(F.col("id") % 2 == 0, "Letters & Notes").otherwise("Notes (B)")
    head = F.concat(F.lit("<p>"), F.replace(journal, F.lit("&"), F.lit("&amp;")), F.lit(", Published online: 05 May 2026; <a href='x'>doi:10.1/x</a></p>"))
    body = F.concat(head, F.when(F.col("id") % 3 == 0, "Smith et al. report that ").otherwise("<p>"), F.col("abstract"), F.lit("</p>"))
    return papers(spark, sf_dir).select(F.col("id").alias("doc_id"), feeds.encoded_abstract(body, journal).alias("abstract"))


@query(sql.PAYLOAD_TRUNCATE)
def payload_truncate(spark, sf_dir):
    cut = text.truncate(F.col("abstract"))
    return papers(spark, sf_dir).select(F.col("id").alias("doc_id"), F.length(cut).cast("long").alias("chars"), F.md5(cut).alias("md5"))


# ---- keywords and rules -------------------------------------------------------------------


@query(sql.KEYWORD_SECTION)
def keyword_section(spark, sf_dir):
    return sections(papers(spark, sf_dir)).select(F.col("id").alias("doc_id"), F.array_join("matched", ",").alias("matched"), "section")


@query(sql.SECTION_COUNTS)
def section_counts(spark, sf_dir):
    return report.section_counts(sections(papers(spark, sf_dir)))


@query(sql.KEYWORD_PRESCREEN)
def keyword_prescreen(spark, sf_dir):
    hay = keywords.searchable(F.col("title"), F.col("abstract"))
    return papers(spark, sf_dir).filter(F.size(keywords.matches(hay, PRIMARY)) > 0).select(F.col("id").alias("doc_id"))


@query(sql.KEYWORD_FALLBACK_VERDICT)
def keyword_fallback_verdict(spark, sf_dir):
    d = papers(spark, sf_dir).select("id", rule(F.col("title")).alias("v"))
    return d.select(F.col("id").alias("doc_id"), "v.verdict", F.array_join("v.includes", ",").alias("includes"), F.array_join("v.excludes", ",").alias("excludes"))


@query(sql.TOKEN_STEM_COUNTS)
def token_stem_counts(spark, sf_dir):
    return papers(spark, sf_dir).select(F.explode(keywords.stems(F.col("title"))).alias("stem")).groupBy("stem").agg(F.count(F.lit(1)).alias("titles"))


@query(sql.SKIP_RULES)
def skip_rules(spark, sf_dir):
    d = papers(spark, sf_dir)
    n = F.col("id") % 8
    title = (
        F.when(n == 0, F.concat(F.lit("Author Correction: "), "title")).when(n == 1, F.concat(F.lit("reply to: "), "title")).when(n == 2, "In this issue").when(n == 3, "Ada Smith (1920–2001)")
        .when(n == 4, F.concat(F.lit("Some career advice on "), "title")).when(n == 5, "From reading to writing").otherwise(F.col("title"))
    )
    ids = F.array(*[F.lit(s[0]) for s in policy.SOURCES])
    source = F.element_at(ids, (F.col("id") % len(policy.SOURCES) + 1).cast("int"))
    kind = F.when(F.col("id") % 5 == 0, " World View ").when(F.col("id") % 5 == 1, "Article")
    d = d.select("id", title.alias("title"), source.alias("source"), kind.alias("kind"), F.when(F.col("id") % 2 == 0, F.array(F.lit("VISIUM"))).alias("matched"))
    feed = rules.skip_feed_item(F.col("source"), F.col("title"), F.concat(F.lit("https://x.org/10.1073/iti"), F.col("id").cast("string")), F.lit(None).cast("string"))
    return d.select(F.col("id").alias("doc_id"), feed.alias("feed_skip"), rules.skip_in_digest(F.col("title"), F.col("source"), F.col("kind"), F.col("matched")).alias("digest_skip"))


@query(sql.TEASER_ABSTRACTS)
def teaser_abstracts(spark, sf_dir):
    a = F.when(F.col("id") % 3 == 0, F.concat("title", F.lit(" Et al.\n Reveals that"))).when(F.col("id") % 3 == 1, F.concat("title", F.lit(" et al. reported"))).otherwise("  ")
    return papers(spark, sf_dir).select(F.col("id").alias("doc_id"), rules.is_teaser(a).alias("teaser"), rules.usable_abstract(a).alias("usable"))


@query(sql.CONFIDENCE_LINES)
def confidence_lines(spark, sf_dir):
    c = F.col("value") / 400
    d = read(spark, sf_dir, "events").select("event_id", c.alias("c"), rules.valid_confidence(c).alias("valid"))
    return d.select("event_id", "valid", F.when(F.col("valid"), rules.confidence_line(F.col("c"))).alias("line"))


@query(sql.RECIPIENT_LISTS)
def recipient_lists(spark, sf_dir):
    name = F.replace(F.col("c_name"), F.lit("#"), F.lit("."))
    raw = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('["'), name, F.lit('@X.org", " B@x.org", "b@X.org", ""]'))).otherwise(F.concat(name, F.lit("@x.org; "), F.upper(name), F.lit("@x.org ,, c@x.org")))
    return read(spark, sf_dir, "customer").select("c_custkey", F.array_join(rules.recipients(raw), ",").alias("recipients"))


@query(sql.AUTHOR_LISTS)
def author_lists(spark, sf_dir):
    raw = F.when(F.col("s_suppkey") % 5 == 0, " ; ").otherwise(F.concat(F.col("s_name"), F.lit(";  A.  B ;; C\tD")))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(rules.authors(raw), "|").alias("authors"))


@query(sql.KEY_FINGERPRINTS)
def key_fingerprints(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", rules.key_fingerprint(F.col("c_name")).alias("fingerprint"))


@query(sql.SUBJECT_LINES)
def subject_lines(spark, sf_dir):
    d = read(spark, sf_dir, "events").groupBy(dates.report_day(F.col("ts")).alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return d.select(F.col("day").cast("string").alias("day"), "event_type", rules.subject("Digest", F.col("day"), F.col("n")).alias("subject"))


@query(sql.TOKEN_ESTIMATES)
def token_estimates(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    e = rules.completion_tokens("translate", F.col("doc_id") % 30)
    return d.select("doc_id", rules.request_tokens(500, F.col("n_chars")).cast("long").alias("request"), e.cast("long").alias("completion"), rules.completion_cap(e, 8192).cast("long").alias("asked"))


@query(sql.FAILURE_TAXONOMY)
def failure_taxonomy(spark, sf_dir):
    n = F.col("event_id") % 14
    status = F.when(n == 0, 429).when(n == 1, 403).when(n == 2, 503).when(n == 3, 422)
    name = F.when(n == 4, "APIConnectionTimeoutError").when(n == 5, "APIConnectionError").when(n == 6, "RateLimitError")
    message = F.when(n == 7, "Request timed out.").when(n == 8, "read ECONNRESET").when(n == 9, "Unexpected token < in JSON").when(n == 10, "API_KEY is not set").when(n == 3, "response_format json_object is not supported")
    finish = F.when(n == 11, "length").otherwise("stop")
    kind = rules.failure_kind(status, name, message, finish)
    return read(spark, sf_dir, "events").select("event_id", kind.alias("kind"), kind.isin(rules.TRANSPORT).alias("transport"), kind.isin(rules.SPLITTABLE).alias("splittable"), rules.json_mode_unsupported(status, message).alias("json_mode"))


@query(sql.RETRY_WAIT_PLAN)
def retry_wait_plan(spark, sf_dir):
    n = F.col("event_id") % 5
    after = F.when(n == 0, F.concat(F.floor(F.col("value")).cast("string"), F.lit(".5"))).when(n == 1, "Mon, 01 Jan 2024 00:00:20 GMT").when(n == 2, "later")
    hint = F.when(n == 3, F.floor(F.col("value")).cast("string")).when(n == 4, "1700000000")
    plan = dates.wait_plan(dates.retry_after_ms(after, F.lit("2024-01-01 00:00:00").cast("timestamp")), dates.reset_hint_ms(hint), (F.col("event_id") % 3000).cast("long"), policy.WAIT_DEFAULT_MS, policy.JITTER_MAX_MS)
    return read(spark, sf_dir, "events").select("event_id", plan.alias("p")).select("event_id", "p.wait_ms", "p.source")


# ---- dimensions ---------------------------------------------------------------------------


@query(sql.NATION_DIM_DEFAULT)
def nation_dim_default(spark, sf_dir):
    nation = read(spark, sf_dir, "nation").filter("n_nationkey < 20").select("n_nationkey", "n_name", F.col("n_regionkey").alias("rank"))
    d = registry.with_dimension(read(spark, sf_dir, "supplier"), nation, "s_nationkey", "n_nationkey", {"n_name": "unknown", "rank": policy.MISSING_PRIORITY})
    return d.select("s_suppkey", "n_name", "rank")


@query(sql.CATALOG_DRIFT)
def catalog_drift(spark, sf_dir):
    seen = read(spark, sf_dir, "documents").select("source").distinct().filter("source <> 'src7'")
    seen = seen.select(F.col("source").alias("id"), F.when(F.substring("source", 4, 2).cast("int") % 4 == 0, "broad-science").otherwise("life-science-only").alias("scope"))
    return registry.drift(catalog(spark), seen, "id", "scope")


@query(sql.SOURCE_STATUS_REPORT)
def source_status_report(spark, sf_dir):
    errors = spark.createDataFrame([("src2",), ("src9",)], "id string")
    return report.source_status(catalog(spark, 23), read(spark, sf_dir, "documents"), errors)


# ---- routing ------------------------------------------------------------------------------


def routed(spark, sf_dir):
    d = registry.with_scope(papers(spark, sf_dir), catalog(spark))
    v = verdicts(spark, sf_dir)
    return routing.route(d, v, identity.missing(d, v, "id"), rule=rule)


@query(sql.ROUTE_VERDICT_MERGE)
def route_verdict_merge(spark, sf_dir):
    return routed(spark, sf_dir).select(F.col("id").alias("doc_id"), "verdict", "method", "included")


@query(sql.ROUTE_STATS)
def route_stats(spark, sf_dir):
    return routing.routing_stats(routed(spark, sf_dir))


@query(sql.ROUTE_ALL_DEGRADED)
def route_all_degraded(spark, sf_dir):
    d = registry.with_scope(papers(spark, sf_dir), catalog(spark))
    return routing.routing_stats(routing.route(d, None, rule=rule))


@query(sql.ROUTE_DEGRADE_SPLIT)
def route_degrade_split(spark, sf_dir):
    failed = read(spark, sf_dir, "labels").filter("quality = 0").select(F.col("doc_id").alias("id"))
    kept, lost = routing.degraded(papers(spark, sf_dir).select("id"), failed)
    return kept.withColumn("side", F.lit("kept")).unionByName(lost.withColumn("side", F.lit("degraded"))).select(F.col("id").alias("doc_id"), "side")


@query(sql.GATE_FILTER)
def gate_filter(spark, sf_dir):
    v = verdicts(spark, sf_dir)
    return routing.gate(papers(spark, sf_dir).join(v.select("id"), "id", "left_semi"), v).select(F.col("id").alias("doc_id"))


@query(sql.GATE_FAIL_OPEN)
def gate_fail_open(spark, sf_dir):
    return routing.gate(papers(spark, sf_dir), None).select(F.col("id").alias("doc_id"))


@query(sql.RETRY_OVERLAY)
def retry_overlay(spark, sf_dir):
    first = papers(spark, sf_dir).select("id").join(verdicts(spark, sf_dir).filter("id % 3 = 0"), "id", "left")
    retry = verdicts(spark, sf_dir).select("id", F.lit("not_sure").alias("verdict"))
    return routing.retry_overlay(first, retry).select(F.col("id").alias("doc_id"), "verdict")


@query(sql.VERDICT_COUNTS)
def verdict_counts(spark, sf_dir):
    return routing.verdict_counts(verdicts(spark, sf_dir))


@query(sql.CONFUSION_MATRIX)
def confusion_matrix(spark, sf_dir):
    d = sections(papers(spark, sf_dir)).join(verdicts(spark, sf_dir), "id")
    return routing.confusion(d, F.col("section") != "other", F.col("verdict") == "yes")


# ---- selection and report -------------------------------------------------------------------


@query(sql.RESOLVE_LINES)
def resolve_lines(spark, sf_dir):
    return lined(spark, sf_dir).select(F.col("id").alias("doc_id"), "line", "line_method", "priority")


@query(sql.FEATURED_TOPK)
def featured_topk(spark, sf_dir):
    return selected(spark, sf_dir).filter("featured").select(F.col("id").alias("doc_id"), "line", "priority", "title")


@query(sql.SELECTION_STATS)
def selection_stats(spark, sf_dir):
    return selection.selection_stats(selected(spark, sf_dir))


@query(sql.OVERFLOW_BY_JOURNAL)
def overflow_by_journal(spark, sf_dir):
    return selection.overflow_groups(selected(spark, sf_dir))


@query(sql.DISPLAY_ORDER)
def display_order(spark, sf_dir):
    return selection.display_order(lined(spark, sf_dir), "source").select(F.col("id").alias("doc_id"), "source", "position")


@query(sql.CATEGORY_COUNTS)
def category_counts(spark, sf_dir):
    d = papers(spark, sf_dir).withColumn("articleType", F.when(F.col("id") % 3 == 0, " ").otherwise(F.col("lang")))
    return report.category_counts(d)


@query(sql.CATEGORY_LINE)
def category_line(spark, sf_dir):
    return report.category_line(report.category_counts(papers(spark, sf_dir), "lang"))


@query(None)
def daily_document(spark, sf_dir):
    """The day's nested document: featured items in order, with the counters."""
    d = selected(spark, sf_dir)
    top = d.filter("featured").select("ord", "id", "title", "source", "line", "featured")
    return report.daily_document(top, None, selection.selection_stats(d), DAY)


# ---- batches, answers and timing ----------------------------------------------------------------


@query(sql.BATCH_PLAN)
def batch_plan(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    packed = batching.pack(d, "source", ["doc_id"], "n_chars", "routing", 8, 2800, 900, 400)
    return batching.batch_estimates(packed, "source", "n_chars", "routing", 400)


@query(sql.MISSING_RETRY_BATCH)
def missing_retry_batch(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.floor(F.col("doc_id") / 11).alias("batch"), F.col("doc_id").alias("ord"))
    lost = d.filter("id % 17 = 0 OR id % 23 = 0").select("id")
    return structured.retry_batch(d, lost).select(F.col("id").alias("doc_id"), "batch")


@query(sql.LLM_JSON_EXTRACT)
def llm_json_extract(spark, sf_dir):
    n = F.col("event_id") % 5
    content = F.when(n == 0, F.concat(F.lit("Sure: "), "props", F.lit(" {done}"))).when(n == 1, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(n == 2, F.col("props")).when(n == 3, "no braces")
    d = read(spark, sf_dir, "events").select("event_id", structured.answer_object(content, F.when(F.col("event_id") % 10 == 4, F.col("props"))).alias("a"))
    return d.select("event_id", "a.json", "a.error")


@query(sql.VERDICT_ROWS)
def verdict_rows(spark, sf_dir):
    d = read(spark, sf_dir, "labels").select(F.floor(F.col("doc_id") / 5).alias("batch"), "doc_id", F.when(F.col("doc_id") % 29 == 0, "maybe").when(F.col("quality") == 1, "yes").otherwise("no").alias("v"))
    rows = F.sort_array(F.collect_list(F.struct("doc_id", "v")))
    one = F.transform(rows, lambda r: F.concat(F.lit('{"id":"'), r["doc_id"].cast("string"), F.lit('","verdict":"'), r["v"], F.lit('"}')))
    answers = d.groupBy("batch").agg(F.concat(F.lit('{"results":['), F.array_join(one, ","), F.lit("]}")).alias("json"))
    return structured.verdict_rows(answers).select("batch", F.col("pos").cast("int").alias("pos"), "id", "verdict")


@query(sql.CONFIDENCE_ROWS)
def confidence_rows(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), ((F.col("doc_id") % 13) / 10.0).alias("confidence"))
    rows = labels.unionByName(labels.filter("id % 10 = 0"))
    return structured.confidence_rows(rows, papers(spark, sf_dir).select("id")).select(F.col("id").alias("doc_id"), "confidence", "status")


@query(sql.SALVAGE_ROWS)
def salvage_rows(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", "user_id")
    row_id = F.when(F.col("event_id") % 13 == 0, F.col("event_id").cast("string")).otherwise(F.concat(F.lit('"e'), F.col("event_id").cast("string"), F.lit('"')))
    title = F.when(F.col("event_id") % 11 == 0, '"  "').otherwise(F.concat(F.lit('"t'), F.col("event_id").cast("string"), F.lit('"')))
    row = F.concat(F.lit('{"id":'), row_id, F.lit(',"title":'), title, F.lit("}"))
    twice = e.withColumn("row", F.when(F.col("event_id") % 9 == 0, F.concat(row, F.lit(","), row)).otherwise(row))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "row"))), lambda r: r["row"]), ",")
    answers = twice.groupBy(F.col("user_id").alias("batch")).agg(joined.alias("rows")).select("batch", F.concat(F.when(F.col("batch") % 10 == 0, "x").otherwise(""), F.lit('{"results":'), F.when(F.col("batch") % 10 == 1, F.lit("7")).otherwise(F.concat(F.lit("["), "rows", F.lit("]"))), F.lit("}")).alias("json"))
    asked = e.filter("event_id % 8 <> 0").select(F.col("user_id").alias("batch"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"))
    return structured.salvage_titles(answers, asked)[2]


@query(sql.SUMMARY_FIELDS)
def summary_fields(spark, sf_dir):
    d = papers(spark, sf_dir).select("id", F.regexp_replace("title", '["\\\\\n\t]', "").alias("t"))
    tags = F.array_join(F.transform(F.sequence(F.lit(1), (F.col("id") % 10 + 1).cast("int")), lambda i: F.concat(F.lit('" g'), i.cast("string"), F.lit(' "'))), ",")
    json = F.concat(F.lit('{"id":"'), (F.col("id") - F.when(F.col("id") % 7 == 0, 1).otherwise(0)).cast("string"), F.lit('","title":" '), "t", F.lit('","summary":"s","tags":['), tags, F.lit(',""]}'))
    d = d.select("id", structured.summary_fields(json, F.col("id").cast("string")).alias("f"))
    return d.select(F.col("id").alias("doc_id"), "f.title", "f.summary", F.array_join("f.tags", ",").alias("tags"))


@query(sql.TRAILING_RATE)
def trailing_rate(spark, sf_dir):
    return batching.request_rate(read(spark, sf_dir, "events"), "ts", "event_type", 3600).select("event_id", "recent")


@query(sql.START_SPACING)
def start_spacing(spark, sf_dir):
    d = read(spark, sf_dir, "events").select("event_id", "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("at"))
    return batching.spaced_starts(d, "user_id", "at", ["at", "event_id"], 7_200_000, F.lit(1_704_153_600_000)).select("event_id", "start_ms")
