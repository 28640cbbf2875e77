"""Preprint API pages to papers, live by a Python data source or from saved pages."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from inkwell.functions.keywords import matches, searchable
from inkwell.functions.policy import PRIMARY_KEYWORDS
from inkwell.functions.rules import authors
from inkwell.functions.text import blank_to_null, squeeze, trim_space
from inkwell.sources.scan import fetch

RECORD = "title string, authors string, doi string, date string, version string, type string, category string, abstract string"
MAX_CURSOR = 10_000
#: Categories beyond this number share tasks, which read them one after the other.
TASKS = 128


def number(value: object) -> int:
    """A count given as a number or as text; anything else is 0."""
    digits = ""
    for c in str(value).strip():
        if not (c.isdigit() or (c in "+-" and not digits)):
            break
        digits += c
    return int(digits) if digits.strip("+-") else 0


def pages(fetch: Callable[[int], dict]) -> Iterator[dict]:
    """Records of all pages: the cursor goes on until the total is reached or a page is empty; an answer that is neither ok nor "no posts found" is an error."""
    cursor = 0
    while cursor <= MAX_CURSOR:
        page = fetch(cursor)
        message = (page.get("messages") or [{}])[0]
        status = str(message.get("status", "")).lower()
        if "no posts found" in status:
            return
        if status != "ok":
            raise RuntimeError(f"preprint api: {message.get('status')}")
        rows = page.get("collection") or []
        yield from rows
        got = number(message.get("count")) or len(rows)
        if not rows or not got or cursor + got >= number(message.get("total")):
            return
        cursor += got
    raise RuntimeError("preprint api: cursor out of range")


class PreprintSource(DataSource):
    """``format("preprints")`` with options url (with {category}, {from}, {to}, {cursor}; HTTP or an address in any store), categories (comma-separated), from, to, timeout: a partition per category, or where there are more than ``TASKS`` per several; a category's failure becomes a status row of its own."""

    @classmethod
    def name(cls) -> str:
        return "preprints"

    def schema(self) -> str:
        return f"requested string, status string, {RECORD}"

    def reader(self, schema) -> DataSourceReader:
        return PreprintReader(self.options)


class PreprintReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        names = [c.strip() for c in self.options.get("categories", "").split(",") if c.strip()]
        return [InputPartition(names[i::TASKS]) for i in range(min(TASKS, len(names)))] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for category in partition.value:
            yield from self.records(category)

    def records(self, category: str) -> Iterator[tuple]:
        """A category's records, or one row that says why there are none: what came before a failure does not count (``MAX_CURSOR`` bounds what is held)."""
        blank = (None,) * 8

        def page(cursor: int) -> dict:
            own = {"category": category, "cursor": cursor, **{k: self.options.get(k, "") for k in ("from", "to")}}
            url = self.options["url"]
            for name, value in own.items():
                url = url.replace(f"{{{name}}}", str(value))
            return json.loads(fetch(url, float(self.options.get("timeout", 30))))

        names = [x.split()[0] for x in RECORD.split(", ")]
        try:
            rows = [tuple(None if r.get(k) is None else str(r[k]) for k in names) for r in pages(page)]
        except Exception as e:
            yield (category, f"skipped: {type(e).__name__}", *blank)
            return
        for r in rows:
            yield (category, "ok", *r)
        if not rows:
            yield (category, "empty", *blank)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Records of saved pages."""
    saved = spark.read.schema(f"collection array<struct<{RECORD.replace(' string', ': string')}>>").json(path, multiLine=True)
    return saved.select(F.explode("collection").alias("r")).select("r.*")


def to_papers(records: DataFrame, source: str = "biorxiv", journal: str = "bioRxiv", base: str = "https://www.biorxiv.org/content/") -> DataFrame:
    """Records with title, DOI and date to papers."""
    doi, version = trim_space(F.coalesce("doi", F.lit(""))), trim_space(F.coalesce("version", F.lit("")))
    url = F.concat(F.lit(base), doi, F.when(F.length(version) > 0, F.concat(F.lit("v"), version)).otherwise(""))
    kind = F.coalesce(blank_to_null(trim_space(F.col("category"))), blank_to_null(trim_space(F.col("type"))))
    out = records.select(
        F.lower(doi).alias("id"), squeeze(F.coalesce("title", F.lit(""))).alias("title"), F.lit(journal).alias("journal"), trim_space(F.coalesce("date", F.lit(""))).alias("published"),
        url.alias("url"), doi.alias("doi"), blank_to_null(squeeze(F.col("abstract"))).alias("abstract"), kind.alias("articleType"), authors(F.col("authors")).alias("authors"), F.lit(source).alias("source"),
    )
    return out.filter((F.length("title") > 0) & (F.length("doi") > 0) & (F.length("published") > 0))


def screen(papers: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """Papers whose title or abstract has a primary keyword."""
    return papers.filter(F.size(matches(searchable(F.col("title"), F.col("abstract")), keywords or PRIMARY_KEYWORDS)) > 0)
