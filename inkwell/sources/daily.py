"""Daily documents: nested rows partitioned by report date."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAPER = (
    "id string, title string, journal string, publishedDate string, url string, doi string, abstract string, articleType string, authors array<string>, sourceId string, "
    "lifeScienceRouting struct<verdict: string, method: string>, matchedKeywords array<string>, section string, digestLine string, digestTaggingMethod string, featured boolean, "
    "titleZh string, summaryZh string, topicTags array<string>"
)
SELECTION = ["total", "candidates", "featured", "overflow", "lineA", "lineB", "preprint", "skip", "featuredLineA", "featuredLineB", "featuredPreprint", "overflowLineA", "overflowLineB", "overflowPreprint"]
_PAPER_STRUCT = f"struct<{PAPER}>"
DOCUMENT = f"reportDate string, generatedAt string, first bigint, papers array<{_PAPER_STRUCT}>, digest struct<enabled: boolean, selection: struct<{', '.join(f'{c}: bigint' for c in SELECTION)}>>, excludedPapers array<struct<paper: {_PAPER_STRUCT}, reason: string, verdict: string, method: string>>, _corrupt string"

#: Papers of a document's part.
PART = 1000

#: What closed columns may hold.
ENUMS = {"section": ["single-cell-spatial", "biology", "other"], "digestLine": ["line-a", "line-b", "preprint", "skip"], "digestTaggingMethod": ["llm", "keyword-fallback"]}


def _outside(name: str, values: list[str]):
    return lambda p: F.coalesce(~p[name].isin(values), F.lit(False))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents as they were written, by older versions too: counters that a file lacks are 0. A file that is no JSON, or has a value outside its list, is an error."""
    d = spark.read.schema(DOCUMENT).option("columnNameOfCorruptRecord", "_corrupt").json(path, multiLine=True)
    d = d.withColumn("reportDate", F.when(F.col("_corrupt").isNull() & F.col("reportDate").isNotNull(), F.col("reportDate")).otherwise(F.raise_error(F.lit("not a daily document")))).drop("_corrupt")
    bad = F.lit(False)
    for name, values in ENUMS.items():
        bad = bad | F.exists("papers", _outside(name, values))
    d = d.withColumn("papers", F.when(bad, F.raise_error(F.concat(F.lit("value out of list on "), "reportDate"))).otherwise(F.col("papers")))
    zero = F.struct(*[F.coalesce(F.col(f"digest.selection.{c}"), F.lit(0)).alias(c) for c in SELECTION])
    return d.withColumn("selection", zero)


def papers(documents: DataFrame) -> DataFrame:
    """A row per paper with its place in the day, from 0, over all parts of the day's document."""
    rows = documents.select("reportDate", "first", F.posexplode("papers").alias("_at", "p"))
    return rows.select("reportDate", (F.coalesce("first", F.lit(0)) + F.col("_at")).cast("int").alias("ord"), "p.*")


def documents(papers: DataFrame, stats: DataFrame, excluded: DataFrame | None = None, day: str = "report_date", part: int = PART) -> DataFrame:
    """Days' documents in parts of at most ``part`` papers, so that none is put together as a whole: report_date, reportDate, first, papers, digest, excludedPapers.

    ``papers`` have ``position`` (from 1 within the day; rows without one are an error) and any of the columns of ``PAPER``; ``stats`` a row a day as
    ``selection.selection_stats`` gives it, which the first part carries. ``excluded(day, position, paper, reason, verdict, method)``
    is cut in parts of the same size; a day with more of them than papers has parts without papers. A day without papers has
    a part for its counters. A null day is an error.
    """
    dated = F.when(F.col(day).isNull(), F.raise_error(F.lit("a row without a day"))).otherwise(F.col(day).cast("string"))
    placed = F.when(F.col("position").isNull(), F.raise_error(F.lit("a paper without a position"))).otherwise(F.col("position")) - 1
    own = [c for c in (x.split()[0] for x in PAPER.split(", ")) if c in papers.columns]

    def in_parts(d: DataFrame, row, name: str) -> DataFrame:
        """A row a part, in which rows stand by their position."""
        rows = F.sort_array(F.collect_list(F.struct(F.col("_at"), row.alias("row"))))
        cut = d.withColumn("_at", placed).withColumns({"_day": dated, "_part": F.floor(F.col("_at") / part)})
        return cut.groupBy("_day", "_part").agg(F.transform(rows, lambda r: r["row"]).alias(name))

    counters = F.struct(*[F.col(re.sub("[A-Z]", lambda m: "_" + m[0].lower(), c)).alias(c) for c in SELECTION])
    head = stats.select(dated.alias("_day"), F.lit(0).cast("long").alias("_part"), F.struct(F.lit(True).alias("enabled"), counters.alias("selection")).alias("digest"))
    both = lambda a, b: a.alias("a").join(b.alias("b"), (F.col("a._day") == F.col("b._day")) & (F.col("a._part") == F.col("b._part")), "full").select(
        *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("_day", "_part")], *[c for c in [*a.columns, *b.columns] if c not in ("_day", "_part")]
    )
    d = both(in_parts(papers, F.struct(*own), "papers"), head)
    if excluded is not None:
        d = both(d, in_parts(excluded, F.struct("paper", "reason", "verdict", "method"), "excludedPapers"))
    return d.select(F.col("_day").alias("report_date"), F.col("_day").alias("reportDate"), (F.col("_part") * part).alias("first"), F.coalesce("papers", F.array()).alias("papers"), *[c for c in ("digest", "excludedPapers") if c in d.columns])


def write(documents: DataFrame, root: str) -> None:
    """A partition per report date, a file per document or part of one; only the dates written are replaced."""
    documents.write.mode("overwrite").option("maxRecordsPerFile", 1).option("partitionOverwriteMode", "dynamic").partitionBy("report_date").json(root)
