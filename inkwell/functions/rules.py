"""Predicates and classifications of the curation policy as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions import policy
from inkwell.functions.keywords import strings
from inkwell.functions.text import SPACE, blank_to_null, extract_doi, squeeze, trim_space


def present(x: Column) -> Column:
    """Holds something other than white space."""
    return F.coalesce(x.rlike(f"[^{SPACE[1:-1]}]"), F.lit(False))


def is_encoded_notice(title: Column) -> Column:
    return F.coalesce(trim_space(title).rlike(r"(?i)^((Author|Publisher) Correction:|Reply to:)"), F.lit(False))


def is_editorial_item(title: Column, link: Column, guid: Column) -> Column:
    doi = F.coalesce(extract_doi(link), extract_doi(guid))
    return F.coalesce(trim_space(title).rlike(r"(?i)^In This Issue$"), F.lit(False)) | F.coalesce(doi.rlike(r"(?i)/iti\d"), F.lit(False))


def skip_feed_item(source: Column, title: Column, link: Column, guid: Column) -> Column:
    """The source's own skip rule; sources without one skip nothing."""
    return (source.isin(policy.ENCODED_FEEDS) & is_encoded_notice(title)) | (source.isin(policy.EDITORIAL_FEEDS) & is_editorial_item(title, link, guid))


def is_preprint(source: Column, preprints: list[str] | None = None) -> Column:
    return source.isin(policy.PREPRINT_SOURCES if preprints is None else preprints)


def is_non_research_type(kind: Column) -> Column:
    return F.coalesce(F.lower(trim_space(kind)).isin([t.lower() for t in policy.NON_RESEARCH_TYPES]), F.lit(False))


def is_research_page(kind: Column) -> Column:
    """A page whose type is given and is not one of those left out."""
    return present(kind) & ~is_non_research_type(kind)


def skip_in_digest(title: Column, source: Column, kind: Column, matched: Column, family: Column | None = None, primary: list[str] | None = None) -> Column:
    """Not research: by article type, by title, or by a short title of the ``family`` of journals without a primary keyword. Preprints are never skipped."""
    t = trim_space(title)
    by_title = t.rlike(r"(?i)^(editorial(\s+note)?|author correction|publisher correction|corrigendum|erratum|obituary|reply to)\b") | t.rlike(r"(?i)\b(trainee advice|career advice|career column)\b") | t.rlike(r"\(\d{4}\s*[–-]\s*\d{4}\)\s*$")
    words = F.when(F.length(t) > 0, F.size(F.split(t, f"{SPACE}+"))).otherwise(0)
    family = (source == "nature") | F.startswith(source, F.lit("nature-")) if family is None else family
    keyed = F.arrays_overlap(F.transform(F.coalesce(matched, strings([])), F.lower), strings([k.lower() for k in primary or policy.PRIMARY_KEYWORDS]))
    return F.coalesce(~is_preprint(source) & (is_non_research_type(kind) | by_title | (family & (words <= 4) & ~keyed)), F.lit(False))


def is_teaser(abstract: Column) -> Column:
    return F.coalesce(abstract.rlike(rf"(?i)\bet{SPACE}+al\.{SPACE}+({'|'.join(policy.TEASER_VERBS)})\b"), F.lit(False))


def usable_abstract(abstract: Column) -> Column:
    return present(abstract) & ~is_teaser(abstract)


def valid_confidence(c: Column) -> Column:
    return F.coalesce(~F.isnan(c) & c.between(0.0, 1.0), F.lit(False))


def confidence_line(c: Column, threshold: float = policy.CONFIDENCE) -> Column:
    """line-a from the threshold on; a confidence outside 0..1 is an error."""
    return F.when(~valid_confidence(c), F.raise_error(F.concat(F.lit("confidence out of range: "), F.coalesce(c.cast("string"), F.lit("null"))))).when(c >= threshold, "line-a").otherwise("line-b")


def fallback_line(source: Column, section: Column, preprints: list[str] | None = None) -> Column:
    return F.when(is_preprint(source, preprints), "preprint").when(section == "single-cell-spatial", "line-a").otherwise("line-b")


def resolved_line(source: Column, skipped: Column, confidence: Column, section: Column, preprints: list[str] | None = None) -> tuple[Column, Column]:
    """(line, method): preprints are always preprint, then what is skipped is skip, and only then a confidence counts; where there is none, the section does."""
    preprint, known = is_preprint(source, preprints), confidence.isNotNull()
    line = F.when(preprint, "preprint").when(skipped, "skip").when(known, confidence_line(confidence)).otherwise(fallback_line(source, section, preprints))
    return line, F.when(~F.coalesce(preprint, F.lit(False)) & ~F.coalesce(skipped, F.lit(False)) & known, "llm").otherwise("keyword-fallback")


def visible(line: Column) -> Column:
    return F.coalesce(line != "skip", F.lit(False))


def eligible(line: Column, abstract: Column) -> Column:
    return visible(line) & present(abstract)


def line_rank(line: Column) -> Column:
    return F.when(line == "line-a", 0).when(line == "line-b", 1).when(line == "preprint", 2).otherwise(99)


def featured_bucket(line: Column) -> Column:
    """The block of the report; an unknown line goes with line-b."""
    return F.when(line.isin("line-a", "preprint"), line).otherwise("line-b")


def subject(prefix: str, day: Column, papers: Column) -> Column:
    return F.concat(F.lit(f"{prefix} · "), day.cast("string"), F.lit(" ("), papers.cast("string"), F.when(papers == 1, " paper)").otherwise(" papers)"))


def article_label(kind: Column) -> Column:
    return F.coalesce(blank_to_null(trim_space(kind)), F.lit("unknown"))


def key_fingerprint(secret: Column) -> Column:
    return F.left(F.sha2(secret, 256), F.lit(12))


def key_mask(secret: Column) -> Column:
    """The first and last four characters; nothing of a secret of eight or fewer."""
    return F.when(F.length(secret) > 8, F.concat(F.left(secret, F.lit(4)), F.lit("…"), F.right(secret, F.lit(4)))).otherwise(F.when(secret.isNotNull(), "***"))


def shown_doi(doi: Column, id_: Column) -> Column:
    """The DOI as given, else an id that is one; an address is none."""
    own = trim_space(id_)
    return F.coalesce(blank_to_null(trim_space(doi)), F.when(own.rlike(r"(?i)^10\.\d{4,9}/"), own))


def uri_component(x: Column) -> Column:
    """Percent-encoded but for letters, digits and - _ . ! ~ * ' ( )."""
    x = F.url_encode(x)
    for code, char in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        x = F.replace(x, F.lit(code), F.lit(char))
    return x


def sandboxed(sender: Column, to: Column, owner: Column) -> Column:
    """struct(to, skipped, error) of a mail: a sandbox's sender reaches its account's owner alone. Without a known owner one recipient may pass; others, or an owner who is not among them, are an error."""
    sandbox = F.coalesce(F.lower(sender).endswith("@resend.dev"), F.lit(False))
    who, none = blank_to_null(F.lower(trim_space(owner))), F.array().cast("array<string>")
    allowed, skipped = F.filter(to, lambda a: F.lower(a) == who), F.filter(to, lambda a: F.lower(a) != who)
    error = F.when(who.isNull(), F.when(F.size(to) > 1, "several recipients and no owner")).when(F.size(allowed) == 0, "owner is no recipient")
    kept = F.when(~sandbox | who.isNull(), to).otherwise(allowed)
    return F.struct(kept.alias("to"), F.when(sandbox & who.isNotNull(), skipped).otherwise(none).alias("skipped"), F.when(sandbox, error).alias("error"))


def recipients(raw: Column) -> Column:
    """Addresses from a JSON array of strings, else split at , and ;. Trimmed, empty ones gone, the first spelling of each kept."""
    listed = F.coalesce(F.from_json(F.when(F.trim(raw).rlike(r"^\["), raw), "array<string>"), F.split(raw, "[,;]"))
    trimmed = F.filter(F.transform(listed, trim_space), lambda x: F.length(x) > 0)
    low = F.transform(trimmed, F.lower)
    return F.filter(trimmed, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


def authors(raw: Column) -> Column:
    names = F.filter(F.transform(F.split(raw, ";"), squeeze), lambda x: F.length(x) > 0)
    return F.when(F.size(names) > 0, names)


def request_tokens(prompt_chars: Column | int, payload_chars: Column, extra: int = 32) -> Column:
    """About four characters to a token."""
    return F.ceil(((F.lit(prompt_chars) if isinstance(prompt_chars, int) else prompt_chars) + payload_chars + extra) / 4)


#: Tokens that a stage's answer takes, by a constant and per item.
COMPLETION = {"routing": (200, 72), "tagging": (300, 120), "gate": (200, 72), "spatial": (120, 64), "translate": (400, 280), "summarize": (720, 0)}


def completion_tokens(stage: str, items: Column) -> Column:
    base, each = COMPLETION[stage]
    return F.when(items == 0, 0).otherwise(base + items * each)


def completion_cap(estimate: Column, cap: int, floor: int = 640) -> Column:
    """What is asked for: the estimate with headroom, at least the floor, at most the cap."""
    return F.least(F.lit(cap), F.when(estimate <= 0, F.lit(floor)).otherwise(F.greatest(F.ceil(estimate * 1.35), estimate + 400, F.lit(floor))))


def failure_kind(status: Column, name: Column, message: Column, finish: Column) -> Column:
    """Kind of a failed request, most telling sign first: error name, status, message, how the answer ended."""
    said = lambda p: F.coalesce(message.rlike(p), F.lit(False))
    named = lambda *n: F.coalesce(name.isin(*n), F.lit(False))
    is_ = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(named("APIConnectionTimeoutError"), "timeout")
        .when(named("RateLimitError") | is_(status == 429), "rate_limit")
        .when(named("AuthenticationError", "PermissionDeniedError") | is_(status.isin(401, 403)), "auth")
        .when(is_(status >= 500), "server_error")
        .when(named("APIConnectionError"), "network")
        .when(said(r"(?i)is not set|missing api key|not configured"), "config")
        .when(said("Request timed out|ETIMEDOUT"), "timeout")
        .when(said("ECONNRESET|ECONNREFUSED|ENOTFOUND|fetch failed|Connection error"), "network")
        .when(is_(finish == "length"), "length")
        .when(said("(?i)json|unexpected token|no content|missing verdicts"), "parse")
        .otherwise("unknown")
    )


TRANSPORT, FATAL, SPLITTABLE = ["timeout", "network"], ["auth", "config"], ["length", "parse"]


def json_mode_unsupported(status: Column, message: Column) -> Column:
    """A refusal of the JSON answer format: the message says so, and the status is absent or 400 or 422."""
    return F.coalesce(message.rlike(r"(?i)response_format|json_object|json mode"), F.lit(False)) & (status.isNull() | status.isin(400, 422))


def provider(base_url: Column, buckets: dict[str, str]) -> Column:
    """Quota bucket by a part of the address; others have their own host's."""
    out = F.lit(None).cast("string")
    for part, bucket in buckets.items():
        out = F.coalesce(out, F.when(F.contains(F.lower(base_url), F.lit(part.lower())), bucket))
    return F.coalesce(out, F.regexp_extract(base_url, r"^[a-z]+://([^/]+)", 1))
