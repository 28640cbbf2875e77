"""Feed files and items to papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import policy
from inkwell.functions.rules import is_teaser, skip_feed_item
from inkwell.functions.text import MARKUP, SPACE, blank_to_null, bound, extract_doi, paper_id, squeeze, strip_tags, title_text, trim_space


def looks_like_feed(text: Column) -> Column:
    """XML of a feed and not an error page, by its first 800 characters."""
    head = F.lower(F.substring(F.regexp_replace(text, r"^\s+", ""), 1, 800))
    page = F.startswith(head, F.lit("<!doctype")) | F.startswith(head, F.lit("<html"))
    return ~page & (F.startswith(head, F.lit("<?xml")) | F.contains(head, F.lit("<rss")) | F.contains(head, F.lit("<rdf:rdf")) | F.contains(head, F.lit("<feed")))


def repaired(xml: Column) -> Column:
    """Self-closed prism elements written out, attributes without a value given an empty one."""
    xml = F.regexp_replace(xml, r"(?i)<prism:(\w+)\s*/>", "<prism:$1></prism:$1>")
    return F.regexp_replace(xml, r"(\s)([\w:-]+)=\s*(/|>)", '$1$2=""$3')


#: An item as its parts are spelled in RSS 2.0, RDF and Atom; prefixes are taken off before parsing.
ITEM = "title string, link string, guid string, pubDate string, dc_date string, published string, updated string, dc_identifier string, dc_source string, content_encoded string, description string, summary string, content string"
ELEMENT = r"(?s)(<(item|entry)\b.*?</\2>)"


def _plain(xml: Column) -> Column:
    """Prefixes joined to names, and Atom's link address as text, so one schema reads every kind."""
    xml = F.regexp_replace(xml, r"<(/?)(\w+):", "<$1$2_")
    xml = F.regexp_replace(xml, r"(\s)(\w+):(\w+)=", "$1$2_$3=")
    return F.regexp_replace(xml, r"<link\b[^>]*href=[\"']([^\"']*)[\"'][^>]*?(/>|>\s*</link>)", "<link>$1</link>")


def parse(files: DataFrame, source: str = "source", xml: str = "value") -> DataFrame:
    """``source, ord`` and the item's parts, a row per item. An item that does not parse is repaired once; a file with one that this does not help counts as empty."""
    read = lambda c: F.from_xml(_plain(c), f"{ITEM}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"})
    once = lambda x: bound(read(x), lambda i: F.when(i["_corrupt"].isNotNull(), read(repaired(x))).otherwise(i))
    d = files.filter(looks_like_feed(F.col(xml))).select(F.col(source).alias("source"), F.transform(F.regexp_extract_all(xml, F.lit(ELEMENT), F.lit(1)), once).alias("_items"))
    sound = bound(F.col("_items"), lambda own: F.when(~F.exists(own, lambda i: i["_corrupt"].isNotNull()), own))  # no filter, which would parse once more
    return d.select("source", F.posexplode(sound).alias("ord", "i")).select("source", "ord", "i.*").drop("_corrupt")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``source`` (the file's name) and its whole text, from any store."""
    return spark.read.text(path, wholetext=True).withColumn("source", F.regexp_extract(F.input_file_name(), r"([^/]+)\.xml$", 1))


#: What stands between a journal's name and the date in its feed's headers.
ONLINE = ", published online:"


def _headed(text: Column, journal: Column) -> Column:
    """The text begins with the journal's name, whatever the case and the spelling of an ampersand, and the words that follow it there."""
    plain = lambda c: F.lower(F.replace(c, F.lit("&amp;"), F.lit("&")))
    return F.coalesce(F.startswith(plain(text), F.concat(plain(journal), F.lit(ONLINE))), F.lit(False))


def encoded_abstract(content: Column, journal: Column) -> Column:
    """Text of a feed whose items begin with the journal's own header, in markup or as text; null when under 40 characters, or a teaser.

    A first paragraph that is the header goes as a whole. Of a header in plain text goes what leads up to the first semicolon, and a DOI after it.
    """

    def body(raw: Column) -> Column:
        closes = F.regexp_instr(raw, F.lit("(?i)</p>"))
        first = raw.rlike("(?i)^<p>") & _headed(trim_space(F.substring(raw, F.lit(4), F.length(raw))), journal) & (closes > 0)
        return F.when(first, F.substring(raw, closes + 4, F.length(raw))).otherwise(raw)

    def plain(text: Column) -> Column:
        dated = F.substring(text, F.length(journal) + len(ONLINE) + 1, F.length(text))
        headed = _headed(text, journal) & dated.rlike("^[^;]+;")
        return trim_space(F.when(headed, F.regexp_replace(F.regexp_replace(dated, rf"^[^;]+;{SPACE}*", ""), rf"(?i)^doi:\S+{SPACE}*", "")).otherwise(text))

    text = bound(strip_tags(bound(trim_space(content), body)), plain)
    return bound(text, lambda t: F.when((F.length(t) >= 40) & ~is_teaser(t), t))


def default_abstract(*candidates: Column) -> Column:
    text = bound(F.coalesce(*candidates), lambda raw: F.when(raw.rlike(MARKUP), strip_tags(raw)).otherwise(squeeze(raw)))
    return bound(text, blank_to_null)


def byline_abstract(content: Column, snippet: Column | None = None) -> Column:
    """Text without a leading paragraph of authors; without a text, that of the plain ``snippet``."""
    text = blank_to_null(squeeze(strip_tags(F.regexp_replace(content, r"(?is)^<p>\s*by\b.*?</p>\s*", ""))))
    return text if snippet is None else F.coalesce(text, snippet_abstract(snippet))


def snippet_abstract(snippet: Column) -> Column:
    """A plain text; one that begins with its authors loses its first paragraph, or its first line where it has no other paragraph."""
    t = trim_space(snippet)
    paragraphs = F.filter(F.transform(F.split(t, r"\n\s*\n"), squeeze), lambda p: F.length(p) > 0)
    rest = F.when(F.size(paragraphs) > 1, F.array_join(F.slice(paragraphs, 2, F.greatest(F.size(paragraphs), F.lit(1))), " ")).otherwise(squeeze(F.regexp_replace(t, r"(?is)^by\b.*?\n+", "")))
    return blank_to_null(F.when(t.rlike(r"(?i)^by\b"), rest).otherwise(squeeze(t)))


def to_papers(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Feed items to papers: id, title, journal, published, url, doi, abstract, source, ord.

    Items that their source's rule skips, and those without title, address or date, are left out. The abstract is taken by
    the source's own rule.
    """
    dim = catalog.select(F.col("id").alias("_id"), F.col("name").alias("journal"))
    d = items.join(F.broadcast(dim), F.col("source") == F.col("_id")).drop("_id")
    d = d.filter(~skip_feed_item(F.col("source"), F.col("title"), F.col("link"), F.col("guid")))
    title, url = title_text(F.coalesce("title", F.lit(""))), trim_space(F.coalesce("link", F.lit("")))
    date = F.coalesce("pubDate", "dc_date", "published", "updated")
    doi = F.coalesce(*[extract_doi(F.col(c)) for c in ("guid", "dc_identifier", "dc_source", "link")])
    content = F.coalesce("content_encoded", "content", "description")
    abstract = (
        F.when(F.col("source").isin(policy.SILENT_FEEDS), F.lit(None).cast("string"))
        .when(F.col("source").isin(policy.ENCODED_FEEDS), encoded_abstract(content, F.col("journal")))
        .when(F.col("source") == "plos-biology", byline_abstract(F.coalesce("content_encoded", "content", F.when(F.col("description").rlike(MARKUP), F.col("description"))), F.col("description")))
        .otherwise(default_abstract(F.col("description"), F.col("summary"), content))
    )
    out = d.select(title.alias("title"), "journal", date.alias("published"), url.alias("url"), doi.alias("doi"), abstract.alias("abstract"), "source", "ord")
    out = out.filter((F.length("title") > 0) & (F.length("url") > 0) & (F.length("published") > 0))
    return out.select(paper_id(F.col("doi"), F.col("url"), F.col("title")).alias("id"), *out.columns)
