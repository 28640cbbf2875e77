"""Time stamps of feeds and report days. The session's time zone is taken as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.policy import REPORT_ZONE, WAIT_MAX_MS

#: Spellings of a published date that feeds use, once a leading weekday (which feeds get wrong) is gone.
PATTERNS = ["d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm z", "d MMM yyyy"]


def published(text: Column) -> Column:
    """A date or date-time in ISO or mail spelling as a time stamp; null where it is neither."""
    plain = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9},\s*", "")
    return F.coalesce(F.try_to_timestamp(plain), *[F.try_to_timestamp(plain, F.lit(p)) for p in PATTERNS])


def report_day(ts: Column, zone: str = REPORT_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def default_report_day(now: Column, zone: str = REPORT_ZONE) -> Column:
    """Yesterday, as the report's zone sees it."""
    return F.date_sub(report_day(now, zone), 1)


def is_day_label(text: Column) -> Column:
    """Four, two and two digits that are a day of the calendar."""
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text).isNotNull(), F.lit(False))


def retry_after_ms(header: Column, now: Column) -> Column:
    """A Retry-After header, in seconds or as a date, as milliseconds from ``now`` (not below 0); null if it is neither."""
    raw = F.trim(header)
    seconds = F.when(raw.rlike(r"^\d+(\.\d+)?$"), F.floor(raw.try_cast("double") * 1000 + 0.5).cast("long"))
    until = (F.unix_millis(published(raw)) - F.unix_millis(now)).cast("long")
    return F.coalesce(seconds, F.when(until.isNotNull(), F.greatest(F.lit(0), until)))


def reset_hint_ms(*headers: Column) -> Column:
    """The first header that is a number of seconds; larger than 10^9 is a clock time and not a hint."""
    one = lambda h: F.when(F.trim(h).rlike(r"^\d+(\.\d+)?$") & (F.trim(h).try_cast("double") <= 1e9), F.floor(F.trim(h).try_cast("double") * 1000 + 0.5).cast("long"))
    return F.coalesce(*[one(h) for h in headers])


def wait_plan(retry_after: Column, reset_hint: Column, jitter_ms: Column, default_ms: int, jitter_most: int) -> Column:
    """struct(wait_ms, source): what the provider says, else its hint, else the default with jitter; never over the cap."""
    jitter = F.greatest(F.lit(0), F.least(F.lit(jitter_most), jitter_ms))
    wait = F.coalesce(retry_after, reset_hint, F.lit(default_ms) + jitter)
    source = F.when(retry_after.isNotNull(), "retry-after").when(reset_hint.isNotNull(), "reset-hint").otherwise("default")
    return F.struct(F.least(F.lit(WAIT_MAX_MS), wait).cast("long").alias("wait_ms"), source.alias("source"))
