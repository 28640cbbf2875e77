"""Keyword, token and stem matching as column expressions; vocabularies are parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.policy import EXCLUDE_PHRASES, EXCLUDE_TERMS, INCLUDE_STEMS, INCLUDE_TERMS, SHARED_INCLUDE_TERMS, SHORT_WORDS, STOP_WORDS
from inkwell.functions.text import SPACE


def strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.expr("cast(array() AS array<string>)")


def searchable(title: Column, abstract: Column) -> Column:
    """Title and abstract with a blank between, empty ones left out."""
    return F.concat_ws(" ", F.nullif(title, F.lit("")), F.nullif(abstract, F.lit("")))


def matches(text: Column, keywords: Sequence[str]) -> Column:
    """The keywords that the text holds anywhere, whatever the case, in the order given."""
    return held(F.lower(F.coalesce(text, F.lit(""))), keywords)


def held(low: Column, keywords: Sequence[str]) -> Column:
    """The keywords that a lower-cased text holds. Higher-order functions know no common subexpressions, so the text is bound once, as an element, and the keywords are lower-cased here."""
    if not keywords:
        return strings([])
    return F.transform(F.array(low), lambda t: F.array_compact(F.array(*[F.when(F.contains(t, F.lit(k.lower())), F.lit(k)) for k in keywords])))[0]


def section(primary: Column, biology: Column) -> Column:
    return F.when(F.size(primary) > 0, "single-cell-spatial").when(F.size(biology) > 0, "biology").otherwise("other")


def tokens(title: Column) -> Column:
    """Title words: lower case, apostrophes gone, split at what is not a-z 0-9 + -; stop words, numbers and words under three characters are left out, listed short ones kept."""
    clean = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "['’]", ""), "[^a-z0-9+-]+", " ")
    return F.filter(
        F.split(F.trim(clean), " +"),
        lambda t: t.isin(SHORT_WORDS) | ((F.length(t) >= 3) & ~t.rlike(r"^\d+$") & ~t.isin(STOP_WORDS)),
    )


#: Endings in order of trial, the least length of a word that loses one, how much goes, what comes instead.
ENDINGS = [
    ("ies", 5, 3, "y"), ("oes", 5, 2, ""), ("ves", 5, 3, "f"), ("ses", 5, 2, ""), ("ches", 0, 2, ""), ("shes", 0, 2, ""), ("xes", 0, 2, ""), ("zes", 0, 2, ""),
    ("es", 4, 2, ""), ("s", 4, 1, ""), ("ing", 6, 3, ""), ("edly", 7, 4, ""), ("ly", 5, 2, ""), ("ed", 5, 2, ""), ("en", 5, 2, ""),
]


def stem(word: Column) -> Column:
    """The word without its first matching ending; words of one or two characters stay."""
    w = F.lower(word)
    out = F.when(F.length(w) <= 2, w)
    for ending, least, gone, instead in ENDINGS:
        fits = F.endswith(w, F.lit(ending)) & (F.length(w) >= least)
        if ending == "s":
            fits &= ~F.endswith(w, F.lit("ss"))
        out = out.when(fits, F.concat(F.left(w, F.length(w) - gone), F.lit(instead)))
    return out.otherwise(w)


def stems(title: Column) -> Column:
    return F.array_distinct(F.transform(tokens(title), stem))


def stem_text(word: str) -> str:
    """``stem`` of a plain string, for vocabularies."""
    w = word.lower()
    if len(w) <= 2:
        return w
    for ending, least, gone, instead in ENDINGS:
        if w.endswith(ending) and len(w) >= least and not (ending == "s" and w.endswith("ss")):
            return w[: len(w) - gone] + instead
    return w


def title_verdict(
    title: Column,
    include_stems: Sequence[str] = INCLUDE_STEMS,
    include_terms: Sequence[str] = INCLUDE_TERMS,
    shared_terms: Sequence[str] = SHARED_INCLUDE_TERMS,
    exclude_terms: Sequence[str] = EXCLUDE_TERMS,
    exclude_phrases: Sequence[str] = EXCLUDE_PHRASES,
) -> Column:
    """struct(verdict, includes, excludes): the rule for a title whose verdict is missing.

    An exclusion alone, or beside mere stems, says no; any inclusion otherwise says yes; nothing says no. Terms match
    as substrings, stems as whole stems. Lists that the verdict does not rest on are empty.
    """
    hay = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), f"{SPACE}+", " ")
    words = tokens(title)
    by_stem = F.array_intersect(strings(list(dict.fromkeys(map(stem_text, include_stems)))), stems(title))
    by_term = held(hay, [*include_terms, *shared_terms])
    by_word = F.filter(words, lambda t: t.isin([x.lower() for x in include_terms])) if include_terms else strings([])
    terms = F.array_distinct(F.concat(by_term, by_word))
    includes = F.array_distinct(F.concat(by_stem, by_term, by_word))
    excludes = F.concat(held(hay, exclude_phrases), held(hay, exclude_terms))
    answer = lambda v, i, e: F.struct(F.lit(v).alias("verdict"), i.alias("includes"), e.alias("excludes"))
    none = F.expr("cast(array() AS array<string>)")
    return (
        F.when((F.size(excludes) > 0) & (F.size(terms) == 0), answer("no", none, excludes))
        .when(F.size(includes) > 0, answer("yes", includes, excludes))
        .otherwise(answer("no", none, none))
    )
