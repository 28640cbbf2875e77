import datetime
import json
import random
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from inkwell.operators import batching, counters, ranking, registry, selection
from inkwell.sources import feeds, scan, snapshot
from tests.test_sources import ATOM, BROKEN, RDF, RSS


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# ---- feeds


class Site(BaseHTTPRequestHandler):
    asked: list = []
    bodies = {"/cell": RSS, "/nature-communications": RDF, "/plos-biology": ATOM, "/nature": BROKEN, "/science": "<!DOCTYPE html><html>down</html>", "/pnas": "<?xml version='1.0'?><rss><channel><item></rss>", "/elife": "<rss><channel/></rss>"}

    def do_GET(self):
        Site.asked.append(self.path)
        if self.path == "/slow":
            for _ in range(50):  # each piece comes in time, the whole does not
                try:
                    self.wfile.write(b"HTTP/1.0 200 OK\r\n\r\n<rss>" if not _ else b" ")
                    self.wfile.flush()
                except OSError:
                    return
                time.sleep(0.2)
            return
        body = self.bodies.get(self.path)
        self.send_response(200 if body else 503 if self.path == "/busy" else 404)
        self.end_headers()
        self.wfile.write((body or "").encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def site():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Site.asked.clear()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def catalog(site, *names):
    return json.dumps([{"id": n, "url": f"{site}/{n}"} for n in names])


def test_a_scan_has_a_status_for_every_source(spark, site):
    d = scan.scan(spark, catalog(site, "cell", "nature", "science", "pnas", "elife", "gone", "busy", "slow"), timeout=1.5)
    got = {r.source: r for r in scan.statuses(d).collect()}
    assert {k: (r.status, r.items) for k, r in got.items()} == {
        "cell": ("ok", 2), "nature": ("ok", 2), "elife": ("empty", 0), "science": ("failed", None), "pnas": ("failed", None), "gone": ("failed", None), "busy": ("failed", None), "slow": ("failed", None),
    }
    assert got["gone"].reason.startswith("404") and got["busy"].reason.startswith("503") and got["slow"].reason.startswith("timed out")
    assert got["science"].reason.startswith("ValueError: no feed") and got["pnas"].reason.startswith("ExpatError")


def test_scanned_items_are_those_of_files(spark, site):
    d = scan.scan(spark, catalog(site, "cell", "nature-communications", "plos-biology"))
    files = feeds.parse(spark.createDataFrame([(n[1:], b) for n, b in Site.bodies.items() if n[1:] in ("cell", "nature-communications", "plos-biology")], "source string, value string"))
    own = registry.sources(spark)
    assert rows(feeds.to_papers(scan.items(d), own), "id", "title", "abstract", "source") == rows(feeds.to_papers(files, own), "id", "title", "abstract", "source")
    assert rows(d.filter("status = 'item'"), "source", "ord", "reason", "day") == sorted([
        ("cell", 0, None, datetime.date(2026, 7, 14)), ("cell", 1, "no link", datetime.date(2026, 7, 14)), ("nature-communications", 0, None, datetime.date(2026, 5, 22)),
        ("nature-communications", 1, None, datetime.date(2026, 5, 22)), ("plos-biology", 0, None, datetime.date(2026, 5, 22)),
    ], key=str)


def test_filters_reach_the_reader(spark, site):
    own = catalog(site, "cell", "nature-communications", "plos-biology")
    day = datetime.date(2026, 7, 14)
    one = scan.scan(spark, own, ["cell"], day)
    assert one.select("source", "ord").collect() == [("cell", 0), ("cell", 1)]
    assert Site.asked == ["/cell"]  # once, and nothing else
    assert "Join" not in one._jdf.queryExecution().toString()
    early = scan.scan(spark, own, until=datetime.date(2026, 7, 13))
    assert early.filter(F.col("source").isin("cell", "plos-biology")).count() == 1 and early.count() == 3  # what one query adds is not kept for the next
    whole = scan.scan(spark, own)
    assert whole.filter(F.col("source") == "cell").count() == 3
    assert whole.filter((F.col("day") == day) | (F.col("source") == "plos-biology")).count() == 4 and whole.count() == 8
    assert scan.scan(spark, own, ["none of them"]).count() == 0


def test_fetching_can_be_replaced(spark, tmp_path):
    def fetcher(url, timeout):
        if url == "b":
            raise TimeoutError("never")
        return ("﻿\n" + ATOM).encode()

    d = scan.scan(spark, json.dumps([{"id": "x", "url": "a"}, {"id": "y", "url": "b"}]), fetcher=fetcher)
    assert rows(scan.statuses(d), "source", "status", "items") == [("x", "ok", 1), ("y", "failed", None)]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "part-0").write_text('{"id": "z", "url": "%s"}\n' % (tmp_path / "z.xml").as_uri())
    (tmp_path / "z.xml").write_text(RDF)
    assert rows(scan.items(scan.scan(spark, f"file://{tmp_path}/c")), "source", "ord", "dc_date", "link") == [("z", 0, "2026-05-22", "https://x.org/c"), ("z", 1, "2026-05-22", "https://x.org/b")]


def test_days_of_items():
    day = lambda **k: str(scan.day_of(k))
    assert day(pubDate="Xxx, 24 May 2026 23:30:00 GMT") == "2026-05-25" and day(published="2026-05-22T01:00:00Z", pubDate="") == "2026-05-22"
    assert day(dc_date="2026-05-22") == "2026-05-22" and day(pubDate="soon") == "None" and day() == "None" and day(updated="9999-12-31T23:59:59Z") == "None"


# ---- snapshots


def test_manifest_and_files(spark, tmp_path):
    d = spark.range(1000, numPartitions=7).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 3)).alias("k"))
    snapshot.write(d, str(tmp_path), "r1", count_by="k")
    snapshot.write(d.filter("id < 10"), f"file://{tmp_path}", "r2")
    m = snapshot.manifests(spark, str(tmp_path))
    assert rows(m.filter("run = 'r1'").groupBy("key").agg(F.sum("key_rows").alias("n")), "key", "n") == [("k1", 333), ("k2", 333), (None, 334)]
    assert sorted(r.id for r in snapshot.read(spark, str(tmp_path), "r1").collect()) == list(range(1000))
    assert not list(tmp_path.glob("_staging*")) and snapshot.damaged(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="there already"):
        snapshot.write(d, str(tmp_path), "r1")
    snapshot.write(d.filter("id = 1"), str(tmp_path), "r1", overwrite=True)
    assert snapshot.read(spark, str(tmp_path), "r1").count() == 1
    snapshot.write(d.filter("id < 0"), str(tmp_path), "none")
    with pytest.raises(ValueError, match="no rows"):
        snapshot.read(spark, str(tmp_path), "none")
    file = next((tmp_path / "r2").glob("*.parquet"))
    file.write_bytes(file.read_bytes()[:-1] + b"!")
    next((tmp_path / "r1").glob("*.parquet")).unlink()
    assert rows(snapshot.damaged(spark, str(tmp_path)), "run", "reason") == [("r1", "missing"), ("r2", "changed")]


def test_failed_and_repeated_tasks_leave_one_copy(spark, tmp_path):
    d = spark.range(100, numPartitions=4)
    bad = d.withColumn("x", F.when(F.col("id") == 70, F.raise_error(F.lit("broken row"))).otherwise(F.lit("y")))
    with pytest.raises(Exception, match="broken row"):
        snapshot.write(bad, str(tmp_path), "r")
    assert not list(tmp_path.glob("r/*")) and snapshot.SnapshotWriter({"path": str(tmp_path), "run": "r"}, d.schema, False)
    w = snapshot.SnapshotWriter({"path": str(tmp_path), "run": "r"}, d.schema, False)
    import pyarrow as pa

    part = pa.RecordBatch.from_pydict({"id": list(range(5))})
    first, again, killed = w.write(iter([part])), w.write(iter([part])), w.write(iter([part, part]))
    assert w.write(iter([])).rows == 0
    assert first.sha256 == again.sha256 and first.file != again.file and killed.rows == 10
    w.commit([again, None])  # of the two attempts one reported; the third was killed after it had written
    assert [p.name for p in (tmp_path / "r").glob("*.parquet")] == [again.file] and not list(tmp_path.glob("_staging*"))
    assert snapshot.read(spark, str(tmp_path), "r").count() == 5


# ---- counters


def test_counters_are_a_monoid():
    r = random.Random(1)
    own = [counters.Counters({("s", k): (kind, r.randrange(50)) for k, kind in (("a", "sum"), ("b", "least"), ("c", "greatest")) if r.random() < 0.8}) for _ in range(8)]
    zero = counters.Counters()
    for a, b, c in zip(own, own[1:], own[2:], strict=False):
        assert (a + b) + c == a + (b + c) and a + b == b + a and a + zero == zero + a == a
    with pytest.raises(ValueError, match="both"):
        counters.Counters({("s", "a"): ("sum", 1)}) + counters.Counters({("s", "a"): ("least", 1)})


def test_stages_count_what_passes(spark):
    spec = {"sums": {"odd": F.col("id") % 2 == 1}, "least": {"low": F.col("id")}, "greatest": {"high": F.col("id")}}
    a, b, none = counters.Stage("a", **spec), counters.Stage("b", **spec), counters.Stage("none", **spec)
    kept = b.of(a.of(spark.range(100, numPartitions=5)).filter("id >= 90"))
    assert kept.collect() and not none.of(spark.range(0)).collect()
    got = a.counters() + b.counters() + none.counters()
    assert {k: v for k, (_, v) in got.values.items()} == {("a", "rows"): 100, ("a", "odd"): 50, ("a", "low"): 0, ("a", "high"): 99, ("b", "rows"): 10, ("b", "odd"): 5, ("b", "low"): 90, ("b", "high"): 99, ("none", "rows"): 0, ("none", "odd"): 0}
    both = got.frame(spark, "1").unionByName(got.frame(spark, "2"))
    assert dict(rows(counters.merged(both).filter("stage = 'b'"), "counter", "value")) == {"rows": 20, "odd": 10, "low": 90, "high": 99}
    assert counters.merged(both, ["run", "stage", "counter"]).count() == both.count()
    clash = both.unionByName(spark.createDataFrame([("3", "a", "odd", "least", 1)], counters.SCHEMA))
    with pytest.raises(Exception, match="two kinds"):
        counters.merged(clash).collect()


# ---- ranks, batches, timing


def test_ranks_over_all_rows(spark, tmp_path):
    r = random.Random(2)
    lines = ["line-a", "line-b", "preprint", "skip", None]
    d = spark.createDataFrame([(i, r.choice(lines), r.choice([1, 5, None]), r.choice(["b", "B", "ä", "a", "", None])) for i in range(500)], "ord int, line string, priority int, title string").repartition(6)
    whole = selection.display_order(d)
    own = ranking.global_display_order(d, str(tmp_path / "a"))
    assert own.columns == whole.columns and rows(own, "ord", "position") == rows(whole, "ord", "position")
    assert "Window" not in own._jdf.queryExecution().toString()
    groups = ranking.ranked_in_groups(d, "line", [F.col("title"), F.col("ord")], str(tmp_path / "b"))
    expected = {}
    for x in sorted(d.collect(), key=lambda x: (x.title is not None, x.title or "", x.ord)):
        expected.setdefault(x.line, []).append(x.ord)
    assert {(x.line, x.n): x.ord for x in groups.collect()} == {(k, i + 1): o for k, v in expected.items() for i, o in enumerate(v)}
    assert ranking.global_display_order(d.filter("false"), str(tmp_path / "c")).count() == 0


def test_batches_across_ranges(spark, tmp_path):
    """A hot group over many ranges, groups of a row, sizes that fit, fill and burst a batch."""
    r = random.Random(3)
    for turn, (most, tokens, cap, hot) in enumerate([(5, 400, None, 300), (1, 400, None, 60), (7, 300, 900, 200), (40, 3000, None, 400)]):
        data = [(i, "hot", r.choice([0, 10, 200, 700, 1400, 5000, None])) for i in range(hot)] + [(1000 + i, r.choice(["a", "b", None, f"g{i}"]), r.randrange(900)) for i in range(80)]
        d = spark.createDataFrame(data, "i int, g string, n int")
        spec = ("routing", most, tokens, cap)
        one = batching.pack(d, "g", ["i"], "n", *spec, 100)
        many = batching.pack_ranges(d, "g", ["i"], "n", *spec, str(tmp_path / str(turn)), 100)
        assert many.columns == one.columns and rows(many, "i", "batch") == rows(one, "i", "batch")
    empty = batching.pack_ranges(d.filter("false"), "g", ["i"], "n", *spec, str(tmp_path / "none"))
    assert empty.count() == 0


def test_reach_of_a_batch():
    import numpy as np

    r = random.Random(4)
    for _ in range(200):
        chars, most, room = [r.randrange(9) for _ in range(r.randrange(1, 12))], r.randrange(1, 5), r.randrange(20)
        for i, end in enumerate(batching._reach(np.array(chars), most, room)):
            j, size = i + 1, chars[i]
            while j < len(chars) and j - i < most and size + 1 + chars[j] <= room:
                size, j = size + 1 + chars[j], j + 1
            assert end == j


def test_starts_across_ranges(spark, tmp_path):
    r = random.Random(5)
    d = spark.createDataFrame([(i, "hot" if i % 4 else r.choice(["a", "b", None]), r.randrange(4000)) for i in range(400)], "i int, b string, at long")
    one = batching.spaced_starts(d, "b", "at", ["at", "i"], 37, F.lit(500))
    many = batching.spaced_starts_ranges(d, "b", "at", ["at", "i"], 37, str(tmp_path / "s"), F.lit(500))
    assert rows(many, "i", "start_ms") == rows(one, "i", "start_ms")
    t = spark.createDataFrame([(i, "hot" if i % 4 else "cold", r.choice([r.randrange(50_000), 60_000 * r.randrange(40)])) for i in range(400)], "i int, b string, at long")
    t = t.select("i", "b", F.timestamp_millis("at").alias("ts"))
    for windows in (1, 3):
        assert rows(batching.request_rate_slices(t, "ts", ["i"], "b", 60, windows), "i", "recent") == rows(batching.request_rate(t, "ts", "b"), "i", "recent")
    gaps = sorted(x.gap_ms for x in batching.request_rate(t, "ts", "b").collect() if x.gap_ms is not None)
    assert sorted(x.gap_ms for x in batching.request_rate_slices(t, "ts", ["i"], "b", 60, 2).collect() if x.gap_ms is not None) == gaps
    timeless = spark.createDataFrame([(1, "b", None)], "i int, b string, ts timestamp")
    assert rows(batching.request_rate_slices(timeless, "ts", ["i"], "b"), "i", "recent", "gap_ms") == [(1, None, None)]


def test_request_rate_looks_at_no_row_once_a_window(spark):
    r = random.Random(4)
    data = [(i, r.choice(["hot", "hot", "b", None]), None if i % 50 == 0 else datetime.datetime(2024, 1, 1) + datetime.timedelta(milliseconds=r.randrange(-90_000, 90_000) // 500 * 500)) for i in range(1500)]
    got = batching.request_rate_slices(spark.createDataFrame(data, "i int, b string, ts timestamp"), "ts", ["i"], "b", 7, 3)
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rangeframe, unboundedpreceding" in plan and "rangeframe, -" not in plan  # a sliding frame is counted anew for every row
    wanted, own = {}, {}
    for i, b, t in data:
        own.setdefault(b, []).append((t, i)) if t else wanted.update({i: (None, None)})
    for line in own.values():
        line.sort()
        for k, (t, i) in enumerate(line):
            wanted[i] = (sum(t - datetime.timedelta(seconds=7) <= u <= t for u, _ in line), round((t - line[k - 1][0]).total_seconds() * 1000) if k else None)
    assert {x.i: (x.recent, x.gap_ms) for x in got.collect()} == wanted


def test_least_of_each_key(spark):
    r = random.Random(6)
    data = [(i, r.choice(["hot", "hot", "hot", f"k{r.randrange(40)}", None]), r.choice([None, 1, 2, 3])) for i in range(600)]
    d = spark.createDataFrame(data, "i int, k string, o int").repartition(5)
    expected = {}
    for i, k, o in sorted(data, key=lambda x: (x[2] is None, x[2] or 0, x[0])):
        expected.setdefault(k, []).append(i)
    for held in (10, 100_000):
        got = {x.k: [y.i for y in x["sample"]] for x in ranking.least_of_each(d, ["k"], ["o", "i"], 3, ["i"], held).collect()}
        assert got == {k: v[:3] for k, v in expected.items()}
    assert ranking.least_of_each(d.filter("false"), ["k"], ["o"], 3, ["i"]).count() == 0
