from pyspark.sql import functions as F

from inkwell.plans import daily
from inkwell.sources import feeds, preprints
from inkwell.streaming import live
from tests.test_sources import ATOM, RDF, RSS

NATURE = RDF.replace("Nature Communications", "Nature").replace("Reading &amp; more", "Quantum computing with atoms at last")


def inputs(spark):
    items = feeds.parse(spark.createDataFrame([("cell", RSS.replace("14 Jul 2026 07:00:00", "21 May 2026 20:00:00")), ("plos-biology", ATOM), ("nature", NATURE)], "source string, value string"))
    rec = [("Spatial omics of mice", "A, B", "10.1101/1", "2026-05-22", "1", "new", "neuro", "Long text"), ("Roads", "C", "10.1101/2", "2026-05-22", "1", "new", "eco", None), ("Visium now", "D", "10.1101/3", "2026-05-20", "1", "new", "eco", "t")]
    return items, spark.createDataFrame(rec, preprints.RECORD)


def test_day(spark):
    items, records = inputs(spark)
    out = daily.run_day(spark, items, records, "2026-05-22")
    p = {r.id: r for r in out["papers"].collect()}
    assert set(p) == {"10.1016/j.cell.1", "https://p.org/w", "10.1101/1", "https://x.org/c"}.intersection(p) and {"10.1016/j.cell.1", "https://p.org/w", "10.1101/1"} <= set(p)
    assert p["10.1101/1"].line == "preprint" and all("<" not in r.title for r in p.values())
    assert "10.1038/s1" in {r.id for r in out["excluded"].collect()}
    s, r = out["selection"].first(), out["routing"].first()
    assert s.featured + s.overflow == s.candidates and s.featured <= 12 and s.total == len(p)
    assert r.included + r.excluded == r.total
    assert out["document"].first().selection.total == s.total


def test_answers_take_effect(spark):
    items, records = inputs(spark)
    yes = lambda *ids: spark.createDataFrame([(i, "yes") for i in ids], "id string, verdict string")
    whole = daily.run_day(spark, items, records, "2026-05-22")
    lost = whole["papers"].select("id").union(whole["excluded"].select("id")).filter("id <> '10.1038/s1'")
    a = daily.Answers(gate=spark.createDataFrame([("10.1101/1", "no"), ("10.1101/3", "yes")], "id string, verdict string"), routing=yes("10.1038/s1"), degraded=lost, confidence=spark.createDataFrame([("10.1016/j.cell.1", 0.9), ("10.1038/s1", 0.1), ("10.1038/s1", 0.8)], "id string, confidence double"), summary=spark.createDataFrame([("10.1016/j.cell.1", "short")], "id string, summary string"))
    p = {r.id: r for r in daily.run_day(spark, items, records, "2026-05-22", a)["papers"].collect()}
    assert "10.1101/1" not in p and p["10.1038/s1"].verdict == "yes" and p["10.1038/s1"].line_method == "keyword-fallback"
    assert (p["10.1016/j.cell.1"].line, p["10.1016/j.cell.1"].summary) == ("line-a", "short")


def test_empty_day(spark):
    items, records = inputs(spark)
    out = daily.run_day(spark, items, records, "2020-01-01")
    assert out["papers"].count() == 0 and set(out["selection"].first()) == {0}
    assert out["document"].first().papers == []


def test_streams(spark, tmp_path):
    rows = [(1, "2026-01-01 10:00:00", "a"), (2, "2026-01-01 17:00:00", "a"), (1, "2026-01-01 10:00:01", "a"), (3, "2026-01-09 00:00:00", "a")]
    spark.createDataFrame(rows, "id int, ts string, k string").select("id", F.to_timestamp("ts").alias("ts"), "k").write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("id int, ts timestamp, k string").parquet(str(tmp_path / "in"))
    for name, df in (("firsts", live.first_within(stream(), "id", "ts", "1 hour")), ("days", live.report_day_counts(stream(), "ts", "k", "1 hour"))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").start()
        q.processAllAvailable()
        q.stop()
    assert sorted(r.id for r in spark.table("firsts").collect()) == [1, 2, 3]
    assert sorted((str(r.report_date), r.rows) for r in spark.table("days").collect()) == [("2026-01-01", 2), ("2026-01-02", 1)]
