"""Text clean-up as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.policy import INLINE_TAGS

#: White space as web scripting languages define it: ASCII and Unicode separators, and the byte-order mark.
SPACE = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
SPACES = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
MARKUP = r"(?is)<[a-z].*>"
DOI = r"(?i)\b10\.\d{4,9}/[-._;()/:A-Z0-9]+\b"
#: How often nested inline tags are unwrapped at once; deeper ones take a loop.
NESTING = 4


def bound(x: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` names it."""
    return F.transform(F.array(x), then)[0]


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def trim_space(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACES))


def squeeze(x: Column) -> Column:
    """Runs of white space to one blank, none at the ends."""
    return F.trim(F.regexp_replace(x, f"{SPACE}+", " "))


def unit(n: Column) -> Column:
    """The UTF-16 unit of a double; larger numbers wrap as they do there, and one beyond all doubles is 0."""
    return F.nanvl(n % F.lit(65536.0), F.lit(0.0)).cast("long")


def utf16(*units: Column) -> Column:
    """The character of a unit that is no surrogate, or of a high and a low one. (chr() wraps at 256.)"""
    return F.decode(F.unhex(F.concat(*[F.lpad(F.hex(u), 4, "0") for u in units])), "UTF-16BE")


def decode_entities(x: Column) -> Column:
    """Named entities in a fixed order, then decimal ones, however many: the text is split at them and each part's number becomes its character. A surrogate without its other half becomes U+FFFD, as no text can hold it."""
    for name, char in (("nbsp", " "), ("amp", "&"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("#x27", "'")):
        x = F.regexp_replace(x, f"(?i)&{name};", char)
    return bound(x, _numbered)


def _numbered(x: Column) -> Column:
    digits = lambda p: F.regexp_extract(p, r"^(\d+);", 1)
    part = lambda p, i: F.struct(
        F.when(i > 0, unit(F.nullif(digits(p), F.lit("")).cast("double"))).alias("unit"), F.when(i > 0, F.regexp_replace(p, r"^\d+;", "")).otherwise(p).alias("rest")
    )
    high, low = (lambda u, a=a: F.coalesce(u.between(a, a + 0x3FF), F.lit(False)) for a in (0xD800, 0xDC00))

    def character(parts: Column, p: Column, i: Column) -> Column:
        """A high and a low surrogate side by side are one character, which the high one writes; one by itself is none."""
        before, after = F.get(parts, i - 1), F.get(parts, i + 1)
        paired = high(p["unit"]) & (p["rest"] == "") & low(after["unit"])
        written = low(p["unit"]) & high(before["unit"]) & (before["rest"] == "")
        lone = high(p["unit"]) | low(p["unit"])
        c = F.when(written, "").when(paired, utf16(p["unit"], after["unit"])).when(lone, "\ufffd").otherwise(utf16(p["unit"]))
        return F.concat(F.coalesce(c, F.lit("")), p["rest"])

    split = F.transform(F.split(x, r"&#(?=\d+;)"), part)
    decoded = bound(split, lambda parts: F.transform(parts, lambda p, i: character(parts, p, i)))
    return F.when(x.rlike(r"&#\d+;"), F.array_join(decoded, "")).otherwise(x)


def _unwrapped(x: Column) -> Column:
    pair = rf"(?is)<({'|'.join(INLINE_TAGS)})\b[^>]*>(.*?)</\1>"
    once = lambda t: F.regexp_replace(t, pair, "$2")
    for _ in range(NESTING):
        x = once(x)

    def rest(t: Column) -> Column:
        ends = F.sequence(F.lit(1), F.regexp_count(t, F.lit("</")))  # each further pass takes away one or more
        return F.when(t.rlike(pair), F.aggregate(ends, t, lambda y, _: F.when(y.rlike(pair), once(y)).otherwise(y))).otherwise(t)

    return bound(x, rest)


def strip_tags(x: Column) -> Column:
    """Entities decoded, scripts and styles dropped, every tag a blank, white space squeezed."""
    x = decode_entities(x)
    for pattern in (r"(?is)<script.*?</script>", r"(?is)<style.*?</style>", r"<[^>]+>"):
        x = F.regexp_replace(x, pattern, " ")
    return squeeze(x)


def strip_inline_tags(x: Column) -> Column:
    """Inline formatting unwrapped without a blank, however deep; whatever markup is left goes as in ``strip_tags``."""
    return bound(_unwrapped(decode_entities(x)), lambda t: F.when(t.rlike(MARKUP), strip_tags(t)).otherwise(squeeze(t)))


def title_text(x: Column) -> Column:
    return F.when(x.rlike(MARKUP), strip_inline_tags(x)).otherwise(squeeze(x))


def extract_doi(x: Column) -> Column:
    return blank_to_null(F.regexp_extract(x, f"({DOI})", 1))


def paper_id(doi: Column, url: Column, title: Column) -> Column:
    """Identity: the DOI whatever its case, else the address as it is, else the title."""
    return F.coalesce(F.lower(blank_to_null(doi)), blank_to_null(url), F.lower(squeeze(title)))


def escape_html(x: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(char), F.lit(name))
    return x


def jats_abstract(x: Column) -> Column:
    """Plain text of a marked-up abstract; null when short (under 80) or when markup is left."""
    plain = strip_tags(decode_entities(x))
    return F.when((F.length(plain) >= 80) & ~plain.rlike(r"(?i)</?[a-z]"), plain)


def truncate(x: Column, most: int = 2000) -> Column:
    return F.when(F.length(x) > most, F.concat(F.substring(x, 1, most), F.lit("…"))).otherwise(x)
