"""Pooled top-k of featured items, its counters, and the order of the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.policy import MAX_FEATURED, MISSING_PRIORITY
from inkwell.functions.rules import eligible, line_rank, visible
from inkwell.operators.routing import count_if


def rank_order(line: str = "line", priority: str = "priority", title: str = "title", ord_: str = "ord") -> list[Column]:
    """Line, source priority, title by locale, and the order of arrival for full ties."""
    return [line_rank(F.col(line)), F.coalesce(F.col(priority), F.lit(MISSING_PRIORITY)), F.collate(F.coalesce(title, F.lit("")), "UNICODE"), F.col(ord_)]


def select_featured(papers: DataFrame, most: int = MAX_FEATURED, key: str = "id") -> DataFrame:
    """``papers(id, line, abstract, priority, title, ord)`` with ``featured``.

    The pools of line-a, line-b and preprints are drained in that order up to ``most``, which is the first ``most`` of
    one order with the pool as its leading key: a bounded top-k a task, then a join with at most ``most`` ids.
    ``papers`` is read twice; where it costs more than reading, it should stand written or checkpointed, without its
    texts: a boolean column ``eligible`` then takes the abstract's place.
    """
    may = F.col("eligible") if "eligible" in papers.columns else eligible(F.col("line"), F.col("abstract"))
    top = papers.filter(may).orderBy(*rank_order()).limit(most).select(F.col(key).alias("_top"), F.lit(True).alias("_featured"))
    return papers.join(F.broadcast(top), F.col(key) == F.col("_top"), "left").select(*[c for c in papers.columns if c != "featured"], F.coalesce("_featured", F.lit(False)).alias("featured"))


def selection_stats(selected: DataFrame, *by: str) -> DataFrame:
    """14 counters, of each value of ``by`` where it is given; a row without a line counts as skip, but is no candidate."""
    line = lambda v: F.coalesce(F.col("line"), F.lit("skip")) == v
    shown, on = visible(F.col("line")), F.col("featured")
    names = {"line_a": "line-a", "line_b": "line-b", "preprint": "preprint"}
    return selected.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), count_if(shown, "candidates"), count_if(on, "featured"), count_if(shown & ~on, "overflow"),
        *[count_if(line(v), n) for n, v in {**names, "skip": "skip"}.items()],
        *[count_if(on & line(v), f"featured_{n}") for n, v in names.items()],
        *[count_if(shown & ~on & line(v), f"overflow_{n}") for n, v in names.items()],
    )


def overflow_groups(selected: DataFrame, journal: str = "journal", source: str = "source") -> DataFrame:
    """Visible rows that are not featured, by journal (or source, where blank): label, least priority, papers, and position by (priority, label)."""
    label = F.coalesce(F.nullif(F.trim(F.col(journal)), F.lit("")), F.col(source))
    groups = selected.filter(visible(F.col("line")) & ~F.col("featured")).groupBy(label.alias("label")).agg(F.min(F.coalesce("priority", F.lit(MISSING_PRIORITY))).alias("priority"), F.count(F.lit(1)).alias("papers"))
    return groups.withColumn("position", F.row_number().over(Window.orderBy("priority", F.collate("label", "UNICODE"))))


def display_order(papers: DataFrame, partition: str | None = None) -> DataFrame:
    """``position`` of every row in the report's order; within ``partition`` where the report has blocks."""
    w = Window.partitionBy(partition) if partition else Window.partitionBy(F.lit(1))
    return papers.withColumn("position", F.row_number().over(w.orderBy(*rank_order())))
