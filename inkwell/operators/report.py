"""Counts, funnels, the daily document and its HTML."""

from __future__ import annotations

from html import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.policy import SECTIONS
from inkwell.functions.rules import article_label, featured_bucket, shown_doi, uri_component, visible
from inkwell.functions.text import escape_html
from inkwell.operators.routing import count_if


def section_counts(papers: DataFrame) -> DataFrame:
    """``section, papers`` of all three sections, zeros included."""
    spark = papers.sparkSession
    all_ = spark.createDataFrame([(s,) for s in SECTIONS], "section string")
    return all_.join(papers.groupBy("section").agg(F.count(F.lit(1)).alias("n")), "section", "left").select("section", F.coalesce("n", F.lit(0)).alias("papers"))


def category_counts(papers: DataFrame, column: str = "articleType") -> DataFrame:
    return papers.groupBy(article_label(F.col(column)).alias("category")).agg(F.count(F.lit(1)).alias("papers"))


def category_line(counts: DataFrame) -> DataFrame:
    """One row, ``line``: k=v pairs in order of the key."""
    pairs = F.sort_array(F.collect_list(F.struct("category", F.concat_ws("=", "category", F.col("papers").cast("string")).alias("pair"))))
    return counts.agg(F.array_join(F.transform(pairs, lambda p: p["pair"]), ", ").alias("line"))


def funnel(rows: DataFrame, source: str, stages: dict[str, Column]) -> DataFrame:
    """Per source how many rows pass each stage and all before it; ``stages`` in order, name to condition."""
    so_far, counters = F.lit(True), []
    for name, condition in stages.items():
        so_far = so_far & F.coalesce(condition, F.lit(False))
        counters.append(count_if(so_far, name))
    return rows.groupBy(source).agg(*counters)


def source_status(catalog: DataFrame, rows: DataFrame, errors: DataFrame | None = None, key: str = "id", source: str = "source") -> DataFrame:
    """``id, status, rows`` of every catalogued source: ok, empty, or skipped where it is in ``errors(id)``; a failed source never fails the others."""
    n = rows.groupBy(F.col(source).alias(key)).agg(F.count(F.lit(1)).alias("_n"))
    out = catalog.select(key).join(n, key, "left")
    out = out.join(errors.select(key, F.lit(True).alias("_bad")).distinct(), key, "left") if errors is not None else out.withColumn("_bad", F.lit(None).cast("boolean"))
    status = F.when(F.col("_bad"), "skipped").when(F.col("_n") > 0, "ok").otherwise("empty")
    return out.select(key, status.alias("status"), F.when(status == "ok", F.col("_n")).otherwise(0).alias("rows"))


def daily_document(papers: DataFrame, excluded: DataFrame | None, stats: DataFrame, day: str) -> DataFrame:
    """One nested row: report_date, papers in order, the counters, and excluded rows (null when there are none). A day's papers are few; the order column does not go along."""
    inner = lambda df: F.transform(F.sort_array(F.collect_list(F.struct(F.col("ord"), F.struct(*[c for c in df.columns if c != "ord"]).alias("paper")))), lambda p: p["paper"])
    doc = papers.agg(inner(papers).alias("papers"), F.lit(1).alias("_one")).join(stats.select(F.lit(1).alias("_one"), F.struct(*stats.columns).alias("selection")), "_one")
    if excluded is not None:
        doc = doc.join(excluded.agg(inner(excluded).alias("excluded"), F.lit(1).alias("_one")), "_one").withColumn("excluded", F.when(F.size("excluded") > 0, F.col("excluded")))
    return doc.drop("_one").withColumn("report_date", F.lit(day))


def journal_line(journal: Column, doi: Column, id_: Column) -> Column:
    """HTML of a card's journal, and its DOI with a link where it has one."""
    shown = shown_doi(doi, id_)
    link = F.concat(F.lit(' · <a href="https://doi.org/'), escape_html(uri_component(shown)), F.lit('">'), escape_html(shown), F.lit("</a>"))
    return F.concat(F.lit('<p class="journal">'), escape_html(F.coalesce(journal, F.lit(""))), F.coalesce(link, F.lit("")), F.lit("</p>"))


def tag_chips(tags: Column) -> Column:
    """HTML of topic tags; nothing where there are none."""
    chips = F.array_join(F.transform(F.filter(tags, lambda t: t.isNotNull()), lambda t: F.concat(F.lit('<span class="tag">'), escape_html(t), F.lit("</span>"))), "")
    return F.coalesce(F.when(F.length(chips) > 0, F.concat(F.lit("<div>"), chips, F.lit("</div>"))), F.lit(""))


def card(columns: list[str]) -> Column:
    """HTML of a featured paper: title, journal and DOI, tags, summary or abstract. What a table lacks is left out."""
    of = lambda c: F.col(c) if c in columns else F.lit(None).cast("string")
    title = F.concat(F.lit('<a href="'), escape_html(F.coalesce(of("url"), F.lit(""))), F.lit('">'), escape_html(F.coalesce(of("title"), F.lit(""))), F.lit("</a>"))
    tags = tag_chips(F.col("tags")) if "tags" in columns else F.lit("")
    text = escape_html(F.coalesce(of("summary"), of("abstract"), F.lit("")))
    return F.concat(F.lit("<article><h3>"), title, F.lit("</h3>"), journal_line(F.coalesce(of("journal"), of("source")), of("doi"), of("id")), tags, F.lit("<p>"), text, F.lit("</p></article>"))


def publish(spark: SparkSession, html: str, root: str, day: str, archive: bool = False) -> list[str]:
    """Write a report as ``index.html`` below ``root``, and as the day's file in its archive; the addresses, in any store."""
    paths = [f"{root}/index.html", *([f"{root}/archive/{day}.html"] if archive else [])]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        out = path.getFileSystem(conf).create(path, True)
        out.write(bytearray(html.encode()))
        out.close()
    return paths


#: Headings of the report's blocks, in order.
BLOCKS = {"line-a": "Spatial and single-cell", "line-b": "Life science", "preprint": "Preprints"}


def report_rows(papers: DataFrame) -> DataFrame:
    """What the report shows, in order: visible rows with their block; the caller collects them (a day's few hundred)."""
    shown = papers.filter(visible(F.col("line")))
    return shown.withColumn("block", F.when(F.col("featured"), featured_bucket(F.col("line"))).otherwise("overflow")).withColumn("card", card(papers.columns)).orderBy("position")


def render(rows: list, day: str, title: str = "Daily digest") -> str:
    """HTML of collected ``report_rows``: featured cards by block, then the overflow by journal. No scripts, everything escaped."""
    out = [f"<!doctype html><html><head><meta charset='utf-8'><title>{escape(title)} {day}</title></head><body>", f"<h1>{escape(title)}</h1><p>{day}, {len(rows)} papers</p>"]
    if not rows:
        out.append("<p>No papers today.</p>")
    link = lambda r: f"<a href=\"{escape(r['url'] or '')}\">{escape(r['title'])}</a>"
    for block, heading in BLOCKS.items():
        own = [r for r in rows if r["block"] == block]
        if own:
            out.append(f"<h2>{escape(heading)}</h2>")
            out += [r["card"] for r in own]
        elif rows:
            out.append(f"<h2>{escape(heading)}</h2><p>None today.</p>")
    groups: dict[tuple, list] = {}
    for r in rows:
        if r["block"] == "overflow":
            groups.setdefault(((r["journal"] or "").strip() or r["source"]), []).append(r)
    if groups:
        out.append("<h2>More</h2>")
        for label, own in sorted(groups.items(), key=lambda g: (min(r["priority"] for r in g[1]), g[0])):
            out.append(f"<h3>{escape(label)}</h3><ul>" + "".join(f"<li>{link(r)}</li>" for r in own) + "</ul>")
    return "\n".join([*out, "</body></html>\n"])


def id_sample(df: DataFrame, key: str = "id", most: int = 8) -> str:
    """The first ids for a log line, and how many more there are."""
    ids = [str(r[0]) for r in df.select(key).orderBy(key).limit(most + 1).collect()]
    return ", ".join(ids) if len(ids) <= most else ", ".join(ids[:most]) + f" (+{df.count() - most} more)"
