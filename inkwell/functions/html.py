"""Fields of web pages as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.text import SPACE, blank_to_null, bound, decode_entities, squeeze, strip_tags, trim_space

#: What marks the abstract in a journal's pages: its section's id, and a class of the block inside it.
SECTION_ID, CONTENT_CLASS = "abs1-section", "c-article-section__content"


def meta_tags(html: Column) -> Column:
    """The page's meta tags in order: name and property in lower case, and content. Attributes may come in any order; a value ends at the next quotation mark of either kind."""
    value = lambda tag, a: F.regexp_extract(tag, rf"""(?i)\W{a}=["']([^"']*)["']""", 1)
    return F.transform(
        F.regexp_extract_all(html, F.lit(r"(?i)<meta[^>]+>"), F.lit(0)),
        lambda t: F.struct(F.lower(value(t, "name")).alias("name"), F.lower(value(t, "property")).alias("property"), value(t, "content").alias("content")),
    )


def meta(tags: Column, name: str, attribute: str = "name") -> Column:
    """Of ``meta_tags``, the first content that is not empty under a name (or property), decoded."""
    own = F.filter(tags, lambda t: (t[attribute] == name) & (t["content"] != ""))
    return decode_entities(F.get(own, F.lit(0))["content"])


def article_type(html: Column) -> Column:
    return bound(meta_tags(html), lambda tags: blank_to_null(trim_space(meta(tags, "dc.type"))))


def abstract_section(html: Column) -> Column:
    """Text of the abstract section's content block.

    What follows the section's id is cut at closing divs. The section goes to where two of them close in a row, and
    the block is what follows its opening tag in the first piece that has one.
    """
    id_ = F.regexp_instr(html, F.lit(f"""(?i)id=["']{SECTION_ID}["']"""))
    opening = f"""(?is)^.*?class=["'][^"']*{CONTENT_CLASS}[^"']*["'][^>]*>"""

    def block(pieces: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(2))), lambda i: F.coalesce(F.get(pieces, i - 1).rlike(f"^{SPACE}*$"), F.lit(False)) & (i < F.size(pieces)))
        inside = F.slice(pieces, F.lit(1), F.coalesce(F.get(ends, F.lit(0)) - 1, F.lit(0)))
        return F.regexp_replace(F.get(F.filter(inside, lambda p: p.rlike(opening)), F.lit(0)), opening, "")

    after = F.when(id_ > 0, F.substring(html, id_, F.length(html)))
    return blank_to_null(strip_tags(bound(F.split(after, r"(?i)</div>"), block)))


def page_abstract(html: Column) -> Column:
    """The first of description, dc.description, og:description and the abstract section that has text."""
    names = [("description", "name"), ("dc.description", "name"), ("og:description", "property")]
    named = bound(meta_tags(html), lambda tags: F.coalesce(*[blank_to_null(squeeze(meta(tags, n, a))) for n, a in names]))
    return F.coalesce(named, blank_to_null(squeeze(abstract_section(html))))
