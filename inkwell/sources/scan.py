"""Feeds as a data source: a partition per source, a status row per source, filters that reach the reader."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterator
from datetime import date, datetime, timezone
from email.utils import parsedate_to_datetime
from urllib.error import HTTPError
from urllib.parse import urlsplit
from urllib.request import Request, urlopen
from xml.parsers import expat
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from inkwell.functions.policy import REPORT_ZONE
from inkwell.sources.feeds import ITEM

PARTS = [p.split()[0] for p in ITEM.split(", ")]
SCHEMA = f"source string, status string, reason string, items long, ord int, day date, {ITEM}"
TIMEOUT_S, CHUNK = 15.0, 1 << 16
HEADERS = {"User-Agent": "inkwell", "Accept": "application/rss+xml, application/atom+xml, application/xml;q=0.9, */*;q=0.5"}


def _located(url: str):
    """The store of an address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", url) if url.startswith("file:") else url)


def put(url: str, body: bytes) -> None:
    """``body`` as a file of any store, there as a whole or not at all; one that a repeated task wrote before is replaced."""
    store, path = _located(url)
    new = f"{path}.{uuid.uuid4().hex}"
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(new) as f:
        f.write(body)
    store.move(new, path)


def fetch(url: str, timeout: float) -> bytes:
    """The body behind an address within ``timeout`` seconds in all. Addresses other than http(s) are files of any store; a folder's files count as one, in order of name."""
    until = time.monotonic() + timeout
    if urlsplit(url).scheme in ("http", "https"):
        body = b""
        with urlopen(Request(url, headers=HEADERS), timeout=timeout) as f:  # noqa: S310
            while part := f.read1(CHUNK):
                body += part
                if time.monotonic() > until:
                    raise TimeoutError(f"no end after {timeout:g} s")
        return body
    from pyarrow import fs

    store, path = _located(url)
    info = store.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(url)
    names = [path] if info.type == fs.FileType.File else sorted(x.path for x in store.get_file_info(fs.FileSelector(path)) if not x.base_name.startswith(("_", ".")))
    return b"".join(store.open_input_stream(n).readall() for n in names)


def looks_like_feed(text: str) -> bool:
    head = text.lstrip()[:800].lower()
    return not head.startswith(("<!doctype", "<html")) and (head.startswith("<?xml") or any(x in head for x in ("<rss", "<rdf:rdf", "<feed")))


def repaired(xml: str) -> str:
    """As in ``feeds.repaired``: empty prism elements written out, attributes without a value given an empty one."""
    return re.sub(r"(\s)([\w:-]+)=\s*(/|>)", r'\1\2=""\3', re.sub(r"(?i)<prism:(\w+)\s*/>", r"<prism:\1></prism:\1>", xml))


class _Items:
    """Items of a feed while its elements pass by: the text of each part by its name, a prefix joined on; the first of a name counts, and an address given as an attribute."""

    def __init__(self) -> None:
        self.found: list[dict[str, str]] = []
        self.item: dict[str, str] | None = None
        self.name, self.depth, self.text = "", 0, []

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if self.item is None:
            if tag.rpartition(":")[2] in ("item", "entry"):
                self.item, self.depth = {}, 0
            return
        self.depth += 1
        if self.depth == 1:
            self.name, self.text = tag.replace(":", "_"), []
            if self.name == "link" and attributes.get("href") and attributes.get("rel", "alternate") == "alternate":
                self.item.setdefault("link", attributes["href"])

    def data(self, text: str) -> None:
        if self.depth:
            self.text.append(text)

    def end(self, tag: str) -> None:
        if self.item is None:
            return
        if self.depth == 0:
            self.found.append(self.item)
            self.item = None
            return
        if self.depth == 1 and (self.name != "link" or self.text):
            self.item.setdefault(self.name, "".join(self.text))
        self.depth -= 1


def _parsed(xml: str) -> list[dict[str, str]]:
    own, parser = _Items(), expat.ParserCreate("utf-8")
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = own.start, own.end, own.data
    parser.Parse(xml.encode("utf-8", "replace"), True)
    return own.found


def parse(body: bytes) -> list[dict[str, str]]:
    """The items of a feed's body, read once; if that fails, once more after a repair, where there is something to repair."""
    xml = body.decode("utf-8", "replace").lstrip("﻿ \t\r\n")
    if not looks_like_feed(xml):
        raise ValueError(f"no feed but {' '.join(xml[:60].split()) or 'nothing'}")
    try:
        return _parsed(xml)
    except expat.ExpatError:
        if (again := repaired(xml)) == xml:
            raise
        return _parsed(again)


def day_of(item: dict[str, str], zone: str = REPORT_ZONE) -> date | None:
    """The report's day of an item's date, in mail or ISO spelling; without a zone it is UTC."""
    raw = next((item[c] for c in ("pubDate", "dc_date", "published", "updated") if item.get(c)), "")
    plain = re.sub(r"^[A-Za-z]{3,9},\s*", "", raw.strip())
    for read in (datetime.fromisoformat, parsedate_to_datetime, lambda x: datetime.strptime(x, "%d %b %Y")):
        try:
            at = read(plain)
        except (ValueError, TypeError):
            continue
        try:
            return (at if at.tzinfo else at.replace(tzinfo=timezone.utc)).astimezone(ZoneInfo(zone)).date()
        except (OverflowError, ValueError):
            return None
    return None


class FeedReader(ds.DataSourceReader):
    def __init__(self, options: dict, fetcher: Callable[[str, float], bytes]):
        self.fetcher, self.timeout, self.catalog = fetcher, float(options.get("timeout", TIMEOUT_S)), options.get("catalog", "[]")
        self.sources: set[str] | None = None
        self.days: list[tuple[str, date]] = []
        self.only: set[str] = set()

    def partitions(self) -> list[ds.InputPartition]:
        """A source each, from ``catalog``: a JSON array of {id, url}, or the address of a folder of such objects, a line each."""
        lines = json.loads(self.catalog) if self.catalog.startswith("[") else [json.loads(x) for x in fetch(self.catalog, TIMEOUT_S).splitlines() if x.strip()]
        own = sorted({(s["id"], s["url"]) for s in lines if self.sources is None or s["id"] in self.sources})
        return [ds.InputPartition(s) for s in own] or [ds.InputPartition(None)]

    def _wanted(self, day: date | None) -> bool:
        if day is None:
            return not self.days and "day" not in self.only
        return all({"=": day == v, ">": day > v, ">=": day >= v, "<": day < v, "<=": day <= v}[op] for op, v in self.days)

    def read(self, partition: ds.InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        source, url = partition.value
        status = lambda status, reason, items: (source, status, reason, items, None, None, *[None] * len(PARTS))
        try:
            items = parse(self.fetcher(url, self.timeout))
        except Exception as e:  # a source never fails the others
            what = f"{e.code} {e.reason}" if isinstance(e, HTTPError) else "404 not found" if isinstance(e, FileNotFoundError) else f"timed out: {e}" if isinstance(e, TimeoutError) else f"{type(e).__name__}: {e}"
            if self._wanted(None):
                yield status("failed", what, None)
            return
        if self._wanted(None):
            yield status("ok" if items else "empty", None, len(items))
        for i, item in enumerate(items):
            day = day_of(item)
            if self._wanted(day):
                lacks = [c for c, have in (("title", item.get("title")), ("link", item.get("link")), ("date", day)) if not have]
                yield (source, "item", f"no {', '.join(lacks)}" if lacks else None, None, i, day, *[item.get(c) for c in PARTS])


class PushedReader(FeedReader):
    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        """Sources that are not asked for get no partition, and rows outside the days asked for do not leave the reader."""
        names = {ds.EqualTo: "=", ds.GreaterThan: ">", ds.GreaterThanOrEqual: ">=", ds.LessThan: "<", ds.LessThanOrEqual: "<="}
        for f in filters:
            column, kind = f.attribute[0] if len(f.attribute) == 1 else "", type(f)
            if column == "source" and kind in (ds.EqualTo, ds.In):
                own = {f.value} if kind is ds.EqualTo else set(f.value)
                self.sources = own if self.sources is None else self.sources & own
            elif column == "day" and kind in names and isinstance(f.value, date):
                self.days.append((names[kind], f.value))
            elif column in ("source", "day") and kind is ds.IsNotNull:
                self.only.add(column)
            else:
                yield f


def feed_source(fetcher: Callable[[str, float], bytes] = fetch, pushed: bool = True) -> type[ds.DataSource]:
    """A data source whose tasks fetch with ``fetcher(url, seconds)``, to be registered with a session."""

    class FeedSource(ds.DataSource):
        """``format("feeds")``, or ``format("all_feeds")``, whose reader takes no filters over, with options catalog (see ``FeedReader.partitions``) and timeout."""

        @classmethod
        def name(cls) -> str:
            return "feeds" if pushed else "all_feeds"

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> FeedReader:
            return (PushedReader if pushed else FeedReader)(dict(self.options), fetcher)

    return FeedSource


def scan(
    spark: SparkSession, catalog: str, sources: list[str] | None = None, since: date | None = None, until: date | None = None, timeout: float = TIMEOUT_S, fetcher: Callable[[str, float], bytes] = fetch
) -> DataFrame:
    """All sources' rows: a status row each (ok, empty or failed, with the reason; ord null), and a row per item (status ``item``; what it lacks as the reason).

    A body is fetched and parsed once, and items are judged in that pass. ``sources`` choose the partitions, ``since`` and
    ``until`` (both included) the rows that leave the reader: plain filters, which it takes over, and with them those that a query adds on
    the same columns. They hold for status rows too, whose day is null. Without any of the three no filter is
    taken over: Spark keeps what a relation's reader has last been told, and would go on with it in a query that tells it nothing.
    """
    pushed = sources is not None or since is not None or until is not None
    if pushed:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    own = feed_source(fetcher, pushed)
    spark.dataSource.register(own)
    d = spark.read.format(own.name()).option("catalog", catalog).option("timeout", str(timeout)).load()
    for wanted, condition in ((sources, F.col("source").isin(sources or [])), (since, F.col("day") >= F.lit(since)), (until, F.col("day") <= F.lit(until))):
        d = d.filter(condition) if wanted is not None else d
    return d


def items(scanned: DataFrame) -> DataFrame:
    """Items as ``feeds.to_papers`` takes them."""
    return scanned.filter("status = 'item'").select("source", "ord", *PARTS)


def statuses(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col("ord").isNull()).select("source", "status", "reason", "items")
