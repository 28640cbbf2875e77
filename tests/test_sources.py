import json

import pytest
from pyspark.sql import functions as F

from inkwell.operators import registry
from inkwell.sources import daily, feeds, preprints, scan

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>J</title>
<item><title>Atlas of &lt;i&gt;Sox9&lt;/i&gt; organs</title><link> https://x.org/a </link><guid>https://x.org/a</guid><dc:identifier>doi:10.1016/J.CELL.1</dc:identifier><pubDate>Fri, 14 Jul 2026 07:00:00 GMT</pubDate><description>Plain &lt;b&gt;text&lt;/b&gt;</description></item>
<item><title>No link</title><pubDate>14 Jul 2026</pubDate></item></channel></rss>"""
RDF = """<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:prism="http://x">
<item rdf:about="u"><title><![CDATA[Author Correction: A]]></title><link>https://x.org/c</link><dc:date>2026-05-22</dc:date></item>
<item rdf:about="v"><title>Reading &amp; more</title><link>https://x.org/b</link><dc:source>Notes, doi:10.1038/s1</dc:source><dc:date>2026-05-22</dc:date><content:encoded><![CDATA[<p>Nature Communications, Published online: 22 May 2026; <a>doi:10.1038/s1</a></p><p>Here we map every cell type of the worm at last.</p>]]></content:encoded></item></rdf:RDF>"""
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Worms</title><link href="https://p.org/w"/><id>i</id><published>2026-05-22T01:00:00Z</published><content>&lt;p&gt;by A. Author&lt;/p&gt;&lt;p&gt;Body.&lt;/p&gt;</content></entry></feed>"""
BROKEN = RSS.replace("<item>", "<item><prism:x/><y a= />", 1)


def test_feeds_of_every_kind(spark):
    files = [("cell", RSS), ("nature-communications", RDF), ("plos-biology", ATOM), ("science", "<!DOCTYPE html><html>down</html>"), ("pnas", "<?xml version='1.0'?><rss><channel><item></rss>"), ("nature", BROKEN)]
    items = feeds.parse(spark.createDataFrame(files, "source string, value string"))
    got = {(p.source, p.title): p for p in feeds.to_papers(items, registry.sources(spark)).collect()}
    a = got["cell", "Atlas of Sox9 organs"]
    assert (a.id, a.doi, a.url, a.abstract, a.journal) == ("10.1016/j.cell.1", "10.1016/J.CELL.1", "https://x.org/a", "Plain text", "Cell")
    b = got["nature-communications", "Reading & more"]
    assert b.doi == "10.1038/s1" and b.abstract == "Here we map every cell type of the worm at last."
    c = got["plos-biology", "Worms"]
    assert (c.id, c.abstract) == ("https://p.org/w", "Body.")
    assert got["nature", "Atlas of Sox9 organs"].abstract is None
    assert len(got) == 4


def test_feed_files(spark, tmp_path):
    (tmp_path / "cell.xml").write_text(RSS)
    assert feeds.read_files(spark, str(tmp_path / "*.xml")).select("source").first().source == "cell"


def test_pages_follow_the_cursor():
    answers = {0: {"messages": [{"status": "ok", "count": "1", "total": "2"}], "collection": [{"doi": "a"}]}, 1: {"messages": [{"status": "ok", "count": 1, "total": "2"}], "collection": [{"doi": "b"}]}}
    assert [r["doi"] for r in preprints.pages(answers.__getitem__)] == ["a", "b"]
    assert not list(preprints.pages(lambda c: {"messages": [{"status": "No posts found"}]}))
    with pytest.raises(RuntimeError):
        list(preprints.pages(lambda c: {"messages": [{"status": "error"}]}))
    with pytest.raises(RuntimeError, match="range"):
        list(preprints.pages(lambda c: {"messages": [{"status": "ok", "count": 5000, "total": 10**9}], "collection": [{}]}))
    assert [preprints.number(x) for x in (" 12a", None, "-3", 4, "x")] == [12, 0, -3, 4, 0]


def test_a_failing_category_leaves_the_others(spark, tmp_path):
    (tmp_path / "good0.json").write_text(json.dumps({"messages": [{"status": "ok", "count": 1, "total": 1}], "collection": [{"title": "T", "doi": "10.1/x", "date": "2026-01-01"}]}))
    (tmp_path / "none0.json").write_text(json.dumps({"messages": [{"status": "no posts found"}]}))
    spark.dataSource.register(preprints.PreprintSource)
    d = spark.read.format("preprints").option("url", f"file://{tmp_path}/{{category}}{{cursor}}.json").option("categories", "good, none, bad").load()
    got = {r.requested: r for r in d.collect()}
    assert (got["good"].status, got["good"].doi, got["none"].status) == ("ok", "10.1/x", "empty")
    assert got["bad"].status.startswith("skipped")


def test_a_category_that_fails_later_counts_for_nothing(spark, tmp_path):
    for cursor, page in ((0, {"messages": [{"status": "ok", "count": 1, "total": 2}], "collection": [{"title": "T", "doi": "10.1/x", "date": "2026-01-01"}]}), (1, {"messages": [{"status": "error"}]})):
        (tmp_path / f"bad-{cursor}.json").write_text(json.dumps(page))
    spark.dataSource.register(preprints.PreprintSource)
    read = lambda names: spark.read.format("preprints").option("url", f"file://{tmp_path}/{{category}}-{{cursor}}.json").option("categories", names).load()
    assert [(r.requested, r.status, r.doi) for r in read("bad").collect()] == [("bad", "skipped: RuntimeError", None)]
    assert not read("").collect()


def test_many_categories_share_tasks(spark, tmp_path):
    names = [f"c{i}" for i in range(3 * preprints.TASKS + 5)]
    for n in names[:-1]:
        page = {"messages": [{"status": "ok", "count": 1, "total": 1}], "collection": [{"title": n, "doi": n}]}
        scan.put(f"file://{tmp_path}/api/{n}/0.json", b"cut off")
        scan.put(f"file:{tmp_path}/api/{n}/0.json", json.dumps(page).encode())
    assert [p.name for p in (tmp_path / "api" / "c0").iterdir()] == ["0.json"]
    spark.dataSource.register(preprints.PreprintSource)
    d = spark.read.format("preprints").option("url", f"file://{tmp_path}/api/{{category}}/{{cursor}}.json").option("categories", ",".join(names)).load()
    assert d.rdd.getNumPartitions() == preprints.TASKS
    assert sorted((r.requested, r.status, r.doi) for r in d.collect()) == sorted([*((n, "ok", n) for n in names[:-1]), (names[-1], "skipped: FileNotFoundError", None)])


def test_records_to_papers(spark, tmp_path):
    records = [
        {"title": " A  spatial omics map ", "authors": "B, A.;  C, D. ;", "doi": " 10.1101/X ", "date": "2026-05-22", "version": "2", "category": " ", "type": "new results", "abstract": " "},
        {"title": "No date", "doi": "10.1101/y"},
        {"title": "Other", "doi": "10.1101/z", "date": "2026-05-22"},
    ]
    (tmp_path / "p.json").write_text(json.dumps({"messages": [], "collection": records}))
    got = preprints.to_papers(preprints.read_pages(spark, str(tmp_path / "p.json")))
    a = got.filter("doi = '10.1101/X'").first()
    assert (a.id, a.title, a.url, a.authors, a.articleType, a.abstract) == ("10.1101/x", "A spatial omics map", "https://www.biorxiv.org/content/10.1101/Xv2", ["B, A.", "C, D."], "new results", None)
    assert got.count() == 2 and preprints.screen(got).count() == 1


def test_daily_documents(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "papers.json").write_text(json.dumps({"reportDate": "2026-05-24", "papers": [{"id": "x", "title": "t", "section": "other", "new": 1}], "digest": {"enabled": True, "selection": {"total": 1}}}, indent=1))
    d = daily.read(spark, str(tmp_path / "a"))
    assert d.select("selection.total", "selection.skip").first() == (1, 0)
    assert daily.papers(d).select("reportDate", "ord", "id", "featured").first() == ("2026-05-24", 0, "x", None)
    (tmp_path / "b.json").write_text(json.dumps({"reportDate": "2026-05-24", "papers": [{"id": "x", "section": "odd"}]}))
    with pytest.raises(Exception, match="out of list"):
        daily.read(spark, str(tmp_path / "b.json")).collect()
    (tmp_path / "c.json").write_text("[")
    with pytest.raises(Exception, match="not a daily document"):
        daily.read(spark, str(tmp_path / "c.json")).collect()
    out = str(tmp_path / "out")
    for day, n in (("2026-05-24", 1), ("2026-05-25", 2), ("2026-05-24", 3)):
        daily.write(spark.createDataFrame([(day, n)], "report_date string, n int"), out)
    assert {tuple(r) for r in spark.read.json(out).select(F.col("report_date").cast("string"), "n").collect()} == {("2026-05-24", 3), ("2026-05-25", 2)}


def test_documents_in_parts(spark, tmp_path):
    from inkwell.operators import selection

    rows = [(day, n, f"{day}-{n}", "line-a" if n % 2 else "skip", n == 1) for day, many in (("2026-05-24", 17), ("2026-05-25", 3), ("2026-05-26", 1)) for n in range(1, many + 1)]
    d = spark.createDataFrame(rows, "report_date string, position long, id string, digestLine string, featured boolean")
    stats = selection.selection_stats(d.withColumn("line", F.col("digestLine")), "report_date")
    empty = stats.limit(1).select(F.lit("2026-05-27").alias("report_date"), *[F.lit(0).cast("long").alias(c) for c in stats.columns[1:]])
    out = spark.createDataFrame([("2026-05-26", n, (f"x{n}",), "r", "no", "llm") for n in range(1, 12)], "report_date string, position long, paper struct<id: string>, reason string, verdict string, method string")
    whole = daily.documents(d.repartition(3), stats.unionByName(empty), out, part=5)
    assert whole.select(F.max(F.size("papers"))).first()[0] == 5 and whole.select(F.max(F.size("excludedPapers"))).first()[0] == 5
    daily.write(whole, str(tmp_path / "d"))
    got = daily.read(spark, str(tmp_path / "d"))
    assert sorted((r.reportDate, r.ord + 1, r.id, r.digestLine, r.featured) for r in daily.papers(got).collect()) == sorted(rows)
    assert {r[0]: tuple(r)[1:] for r in got.filter("digest IS NOT NULL").select("reportDate", "selection.total", "selection.lineA", "selection.featured").collect()} == {"2026-05-24": (17, 9, 1), "2026-05-25": (3, 2, 1), "2026-05-26": (1, 1, 1), "2026-05-27": (0, 0, 0)}
    left = sorted((r.first, [x.paper.id for x in r.excludedPapers]) for r in got.filter("excludedPapers IS NOT NULL").collect())
    assert [i for _, part in left for i in part] == [f"x{n}" for n in range(1, 12)]
    assert not daily.documents(d.filter("false"), stats.filter("false"), out.filter("false")).collect()
    for bad, message in ((d.withColumn("position", F.lit(None).cast("long")), "without a position"), (d.withColumn("report_date", F.lit(None).cast("string")), "without a day")):
        with pytest.raises(Exception, match=message):
            daily.documents(bad, stats).collect()
