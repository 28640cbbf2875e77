"""Streaming forms of the batch operators: first of each id, and counts by report day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A report day in a zone eight hours ahead of UTC begins at 16:00 UTC.
DAY_OFFSET = "16 hours"


def first_within(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """The first arrival of each key; a key may come again once ``delay`` has passed, so the state stays bounded."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def report_day_counts(stream: DataFrame, ts: str, by: str, delay: str) -> DataFrame:
    """Rows by report day and ``by``, final once the watermark has passed the day's end."""
    day = F.window(ts, "1 day", "1 day", DAY_OFFSET)
    return stream.withWatermark(ts, delay).groupBy(day.alias("day"), by).agg(F.count(F.lit(1)).alias("rows")).select(F.to_date("day.end").alias("report_date"), by, "rows")
