"""Abstracts from pages and from a DOI table, joined instead of fetched one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import policy
from inkwell.functions.html import article_type, page_abstract
from inkwell.functions.rules import is_research_page, is_teaser, present, usable_abstract
from inkwell.functions.text import jats_abstract
from inkwell.operators.identity import newest


def enrich(papers: DataFrame, pages: DataFrame, abstracts: DataFrame, url: str = "url", doi: str = "doi") -> DataFrame:
    """``papers`` with abstract, articleType and ``outcome``: passed, enriched, kept (nothing found) or excluded.

    ``pages(url, html)`` and ``abstracts(doi, markup)`` are what was fetched; of rows that repeat a url or doi the last by ``ord`` counts, or the greatest text where that column is missing. Gated sources must have a page of a research
    type (an absent page keeps the paper, as a failed fetch does); the others are only looked up when their abstract is missing or a teaser.
    """
    by = lambda d: "ord" if "ord" in d.columns else None
    p = newest(pages.withColumn("_url", F.col("url")), "_url", ["html"], by(pages)).select("_url", F.col("_new.html").alias("_html"))
    a = abstracts.withColumns({"_doi": F.lower("doi"), "_jats": jats_abstract(F.col("markup"))}).filter("_jats IS NOT NULL")
    a = newest(a, "_doi", ["_jats"], by(abstracts)).select("_doi", F.col("_new._jats").alias("_jats"))
    d = papers.join(p, F.col(url) == F.col("_url"), "left").join(a, F.lower(F.col(doi)) == F.col("_doi"), "left")
    source, usable = F.col("source"), usable_abstract(F.col("abstract"))
    gated, by_page, by_doi = source.isin(policy.GATED_PAGES), source.isin(policy.PAGE_ABSTRACTS), source.isin(policy.DOI_ABSTRACTS)
    d = d.withColumn("_type", article_type(F.col("_html"))).withColumn("_page", page_abstract(F.col("_html")))
    found = F.when((gated | by_page) & ~usable, F.col("_page")).when(by_doi & ~present(F.col("abstract")), F.col("_jats"))
    excluded = gated & F.col("_html").isNotNull() & ~is_research_page(F.col("_type"))
    outcome = F.when(excluded, "excluded").when(found.isNotNull(), "enriched").when((gated | by_page | by_doi) & (~present(F.col("abstract")) | is_teaser(F.col("abstract"))), "kept").otherwise("passed")
    kind = F.when(gated, F.coalesce("_type", F.col("articleType"))).otherwise(F.col("articleType"))
    return d.select(*[F.coalesce(found, F.col("abstract")).alias(c) if c == "abstract" else kind.alias(c) if c == "articleType" else F.col(c) for c in papers.columns], outcome.alias("outcome"))


def enrich_stats(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("outcome") == o).alias(o) for o in ("passed", "enriched", "kept", "excluded")])
