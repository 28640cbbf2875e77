"""Include/exclude routing with verdicts, and its fallbacks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.keywords import title_verdict
from inkwell.operators.identity import newest

REASON = "life-science-routing"


def count_if(condition: Column, name: str) -> Column:
    """A counter that is 0, and not null, over no rows."""
    return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)


def _once(verdicts: DataFrame, key: str, name: str) -> DataFrame:
    """A row an id, so that a join never multiplies papers: of repeated ones the last by ``ord`` (the place in the answers), or the greatest verdict where that column is missing."""
    return newest(verdicts, key, ["verdict"], "ord" if "ord" in verdicts.columns else None).select(key, F.col("_new.verdict").alias(name))


def route(
    papers: DataFrame, verdicts: DataFrame | None, lost: DataFrame | None = None, key: str = "id", title: str = "title", scope: str = "scope", rule: Callable[[Column], Column] = title_verdict, enabled: bool = True
) -> DataFrame:
    """``papers`` with verdict, method, included.

    Rows whose scope passes by default are in. The others take the verdict of ``verdicts(key, verdict)``; those of
    the ids in ``lost`` (the batches that failed: degraded) that have none fall to the title ``rule``, and
    any other row without a verdict is an error. yes and not_sure are in. Without ``verdicts`` (the whole
    stage failed) every row of broad scope is degraded. Not enabled, all rows are in.
    """
    if not enabled:
        return papers.withColumns({"verdict": F.lit(None).cast("string"), "method": F.lit(None).cast("string"), "included": F.lit(True)})
    by_scope = F.coalesce(F.col(scope) == "life-science-only", F.lit(False))
    met = papers.withColumns({"_verdict": F.lit(None).cast("string"), "_lost": F.lit(verdicts is None)})
    if verdicts is not None:
        met = met.drop("_verdict").join(_once(verdicts, key, "_verdict"), key, "left")
        if lost is not None:
            met = met.drop("_lost").join(lost.select(key).distinct().withColumn("_lost", F.lit(True)), key, "left")
    none = F.raise_error(F.concat(F.lit("no routing verdict for "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    verdict = F.when(by_scope, "yes").when(F.col("_verdict").isNotNull(), F.col("_verdict")).when(F.col("_lost"), rule(F.col(title))["verdict"]).otherwise(none)
    method = F.when(by_scope, "scope-default").when(F.col("_verdict").isNotNull(), "llm").otherwise("routing-keyword-fallback")
    out = met.select(*papers.columns, verdict.alias("verdict"), method.alias("method"))
    return out.withColumn("included", F.col("verdict").isin("yes", "not_sure"))


def split(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(included, excluded with their reason)."""
    return routed.filter("included").drop("included"), routed.filter("NOT included").drop("included").withColumn("reason", F.lit(REASON))


def routing_stats(routed: DataFrame) -> DataFrame:
    """One row of counters, zeros over no rows."""
    by = lambda m: F.col("method") == m
    says = lambda v: F.col("verdict") == v
    return routed.agg(
        F.count(F.lit(1)).alias("total"),
        count_if(by("scope-default"), "passed_by_scope"),
        count_if(by("llm"), "llm_classified"), count_if(by("llm") & says("yes"), "llm_yes"), count_if(by("llm") & says("not_sure"), "llm_not_sure"), count_if(by("llm") & says("no"), "llm_no"),
        count_if(by("routing-keyword-fallback"), "fallback_classified"), count_if(by("routing-keyword-fallback") & says("yes"), "fallback_yes"), count_if(by("routing-keyword-fallback") & says("no"), "fallback_no"),
        count_if(F.col("included"), "included"), count_if(~F.col("included"), "excluded"),
    )


def gate(papers: DataFrame, verdicts: DataFrame | None, key: str = "id") -> DataFrame:
    """Only yes passes. A candidate without a verdict is an error; a gate that failed as a whole (``None``) lets all pass."""
    if verdicts is None:
        return papers
    met = papers.join(_once(verdicts, key, "_verdict"), key, "left")
    known = F.coalesce("_verdict", F.raise_error(F.concat(F.lit("no gate verdict for "), F.col(key).cast("string"))))
    return met.filter(known == "yes").select(*papers.columns)


def degraded(papers: DataFrame, failed: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(rows that keep their verdicts, rows whose ids failed)."""
    ids = failed.select(key).distinct()
    return papers.join(ids, key, "left_anti"), papers.join(ids, key, "left_semi")


def retry_overlay(first: DataFrame, retry: DataFrame, key: str = "id") -> DataFrame:
    """Verdicts of a first round; a retry fills in only what it left open."""
    return first.join(_once(retry, key, "_retry"), key, "left").select(*[F.coalesce("verdict", "_retry").alias("verdict") if c == "verdict" else F.col(c) for c in first.columns])


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(*[count_if(F.col("verdict") == v, v) for v in ("yes", "not_sure", "no")])


def confusion(rows: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Counts, precision and recall; null where nothing was predicted or is there."""
    c = rows.agg(count_if(predicted & actual, "tp"), count_if(predicted & ~actual, "fp"), count_if(~predicted & actual, "fn"), count_if(~predicted & ~actual, "tn"))
    ratio = lambda b: F.when(F.expr(b) > 0, F.expr(f"tp / ({b})"))
    return c.withColumn("precision", ratio("tp + fp")).withColumn("recall", ratio("tp + fn"))
