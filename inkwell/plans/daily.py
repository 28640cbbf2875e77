"""The daily pipeline: from feed items and preprint records to the day's document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import dates, keywords, policy, rules
from inkwell.operators import enrich, identity, ranking, registry, report, routing, selection
from inkwell.session import saved, shared_folder
from inkwell.sources import feeds, preprints

#: What each stage takes from outside, keyed by paper id; an absent one stands for a stage that failed as a whole.
NO_PAGES, NO_ABSTRACTS = "url string, html string", "doi string, markup string"


@dataclass
class Answers:
    """Answers of model stages as tables: gate and routing (id, verdict), degraded (ids that routing's batches lost), confidence (id, confidence), summary (id, title, summary, tags)."""

    gate: DataFrame | None = None
    routing: DataFrame | None = None
    degraded: DataFrame | None = None
    confidence: DataFrame | None = None
    summary: DataFrame | None = None


def collect(items: DataFrame, records: DataFrame, gate: DataFrame | None, catalog: DataFrame, day: str) -> DataFrame:
    """Papers of all sources on the report day, first of each id by source and item order.

    Preprints are screened by keyword, then gated, then dated: the gate sees rows of other days, as it decides on content alone.
    """
    rss = feeds.to_papers(items, catalog).withColumn("articleType", F.lit(None).cast("string")).withColumn("authors", F.lit(None).cast("array<string>"))
    screened = saved(preprints.screen(preprints.to_papers(records)).withColumn("ord", F.monotonically_increasing_id()))  # so that the order is the same for all who read it
    api = routing.gate(identity.first_wins(screened, ["id"], "ord"), gate)
    order = {name: i for i, (name, *_) in enumerate(policy.SOURCES)}
    rank = F.element_at(F.create_map(*[x for k, v in order.items() for x in (F.lit(k), F.lit(v))]), F.col("source"))
    both = saved(rss.unionByName(api).withColumn("ord", F.struct(rank.alias("source"), F.col("ord").alias("item"))))
    on_day = dates.report_day(dates.published(F.col("published"))) == F.lit(day).cast("date")
    return identity.two_level(both, "source", "id", "ord", F.coalesce(on_day, F.lit(False)))


def run_day(spark: SparkSession, items: DataFrame, records: DataFrame, day: str, answers: Answers | None = None, pages: DataFrame | None = None, abstracts: DataFrame | None = None) -> dict[str, DataFrame]:
    """papers (with line, featured and position), excluded, and the stages' counters."""
    answers, catalog = answers or Answers(), registry.sources(spark)
    pages = pages if pages is not None else spark.createDataFrame([], NO_PAGES)
    abstracts = abstracts if abstracts is not None else spark.createDataFrame([], NO_ABSTRACTS)
    found = saved(collect(items, records, answers.gate, catalog, day))
    routed = routing.route(registry.with_scope(found, catalog), answers.routing, answers.degraded)
    included, excluded = routing.split(routed)
    enriched = enrich.enrich(included, pages, abstracts)
    d = enriched.filter("outcome <> 'excluded'").drop("outcome")
    hay = keywords.searchable(F.col("title"), F.col("abstract"))
    d = d.withColumn("_p", keywords.matches(hay, policy.PRIMARY_KEYWORDS)).withColumn("_b", keywords.matches(hay, policy.BIOLOGY_KEYWORDS))
    d = d.withColumn("matched", F.concat("_p", "_b")).withColumn("section", keywords.section(F.col("_p"), F.col("_b"))).drop("_p", "_b")
    if answers.confidence is not None:
        once = identity.drop_repeated(answers.confidence, "id").filter(rules.valid_confidence(F.col("confidence")))
        d = d.join(once.select("id", "confidence"), "id", "left")
    else:
        d = d.withColumn("confidence", F.lit(None).cast("double"))
    skipped = rules.skip_in_digest(F.col("title"), F.col("source"), F.col("articleType"), F.col("matched"))
    line, method = rules.resolved_line(F.col("source"), skipped, F.col("confidence"), F.col("section"))
    d = d.withColumns({"line": line, "line_method": method})
    d = registry.with_dimension(d, catalog, "source", "id", {"priority": policy.MISSING_PRIORITY})
    # What the ranks need stands written, so texts are matched once; no task orders all of a day.
    narrow = saved(d.select("id", "ord", "title", "line", "priority", rules.eligible(F.col("line"), F.col("abstract")).alias("eligible")))
    chosen = ranking.global_display_order(selection.select_featured(narrow), shared_folder(spark, "order")).select("id", "featured", "position")
    d = d.join(chosen, "id").withColumn("summary", F.lit(None).cast("string"))
    if answers.summary is not None:
        d = identity.overlay(d, answers.summary, "id", ["summary"])
    stats = selection.selection_stats(d)
    return {
        "papers": d, "excluded": excluded, "routing": routing.routing_stats(routed), "enrichment": enrich.enrich_stats(enriched), "selection": stats,
        "document": report.daily_document(d.select("ord", "id", "title", "journal", "url", "doi", "abstract", "source", "section", "matched", "line", "featured", "summary"), excluded.select("ord", "id", "reason", "verdict", "method"), stats, day),
    }
