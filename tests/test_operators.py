import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.functions.keywords import title_verdict
from inkwell.operators import batching, enrich, identity, provider, registry, report, retention, routing, selection, structured


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_first_and_last(spark):
    d = spark.createDataFrame([("a", 3, "x"), ("a", 1, None), ("b", 2, "z"), (None, 5, "n"), (None, 4, "m")], "k string, ord int, v string")
    assert rows(identity.first_wins(d, ["k"], "ord"), "k", "ord", "v") == sorted([("a", 1, None), ("b", 2, "z"), (None, 4, "m")], key=str)
    assert rows(identity.last_wins(d, ["k"], "ord"), "k", "v") == sorted([("a", "x"), ("b", "z"), (None, "n")], key=str)
    assert rows(identity.drop_repeated(d, "k"), "k") == [("b",)]
    assert identity.first_wins(d.limit(0), ["k"], "ord").count() == 0


def test_two_level_takes_the_groups_first_before_it_filters(spark):
    d = spark.createDataFrame([("s1", "k", 1, False), ("s1", "k", 2, True), ("s2", "k", 3, True)], "s string, k string, ord int, ok boolean")
    assert rows(identity.two_level(d, "s", "k", "ord", F.col("ok")), "ord") == [(3,)]


def test_match_by_id_or_unique_title(spark):
    papers = spark.createDataFrame([("1", "Same"), ("2", "same "), ("3", "Only  one")], "id string, title string")
    got = identity.match_by_id_or_title(spark.createDataFrame([("1", "x"), ("?", "SAME"), ("??", "only ONE")], "rid string, rtitle string"), papers, "rid", "rtitle", "id", "title")
    assert rows(got, "rid", "matched", "matched_by") == [("1", "1", "id"), ("??", "3", "title")]


def test_registry(spark):
    dim = registry.sources(spark)
    assert dim.count() == 17
    with pytest.raises(Exception, match="unknown source: nope"):
        registry.with_scope(spark.createDataFrame([("nope",)], "source string"), dim).collect()
    assert [r.id for r in registry.resolve(spark, ["pnas", "cell"], "rss").orderBy("ord").collect()] == ["pnas", "cell"]
    for bad, kind in (("what", None), ("biorxiv", "rss")):
        with pytest.raises(ValueError):
            registry.resolve(spark, [bad], kind)
    with pytest.raises(ValueError, match="drift: cell"):
        registry.assert_same(dim, dim.withColumn("scope", F.when(F.col("id") == "cell", "x").otherwise(F.col("scope"))), "id", "scope")
    registry.assert_same(dim, dim, "id", "scope")


def papers(spark):
    return spark.createDataFrame([("a", "Roads", "life-science-only"), ("b", "Tumor growth", "broad-science"), ("c", "Quantum dots", "broad-science"), ("d", "x", "broad-science"), ("e", "y", "broad-science")], "id string, title string, scope string")


def test_routing(spark):
    v = spark.createDataFrame([("d", "not_sure"), ("e", "no")], "id string, verdict string")
    lost = spark.createDataFrame([("b",), ("c",), ("c",), ("d",)], "id string")
    routed = routing.route(papers(spark), v.unionByName(v), lost)
    with pytest.raises(Exception, match="no routing verdict for c"):
        routing.route(papers(spark), v, lost.filter("id <> 'c'")).collect()
    assert rows(routed, "id", "verdict", "method", "included") == [
        ("a", "yes", "scope-default", True), ("b", "yes", "routing-keyword-fallback", True), ("c", "no", "routing-keyword-fallback", False), ("d", "not_sure", "llm", True), ("e", "no", "llm", False),
    ]
    s = routing.routing_stats(routed).first().asDict()
    assert s["total"] == s["included"] + s["excluded"] == 5
    assert (s["llm_classified"], s["fallback_classified"], s["passed_by_scope"]) == (2, 2, 1)
    assert set(routing.routing_stats(routed.limit(0)).first()) == {0}
    assert routing.route(papers(spark), None).filter("method = 'llm'").count() == 0
    assert routing.route(papers(spark), None, enabled=False).filter("included").count() == 5
    assert routing.split(routed)[1].select("reason").distinct().count() == 1


def test_gate(spark):
    d = papers(spark)
    v = d.select("id", F.when(F.col("id") == "a", "yes").otherwise("not_sure").alias("verdict"))
    assert rows(routing.gate(d, v), "id") == [("a",)]
    assert routing.gate(d, None).count() == 5
    with pytest.raises(Exception, match="no gate verdict for a"):
        routing.gate(d, v.filter("id <> 'a'")).collect()


def test_retry_overlay_fills_only_what_is_missing(spark):
    first = spark.createDataFrame([("a", "yes"), ("b", None)], "id string, verdict string")
    retry = spark.createDataFrame([("a", "no"), ("b", "no")], "id string, verdict string")
    assert rows(routing.retry_overlay(first, retry), "id", "verdict") == [("a", "yes"), ("b", "no")]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["line-a", "line-b", "preprint", "skip", None]), st.integers(1, 3), st.sampled_from(["a", "B", "é", "b"]), st.sampled_from(["", " ", "text"])), max_size=12), st.integers(0, 5))
def test_featured_pools_are_drained_in_order(spark, items, most):
    d = spark.createDataFrame([(i, *x, i) for i, x in enumerate(items)], "id int, line string, priority int, title string, abstract string, ord int")
    got = {r.id for r in selection.select_featured(d, most).filter("featured").collect()}
    key = {"a": 0, "b": 1, "B": 2, "é": 3}
    wanted = []
    for pool in ("line-a", "line-b", "preprint"):
        own = [(p, key[t], i) for i, (line, p, t, a) in enumerate(items) if line == pool and a.strip()]
        wanted += [i for _, _, i in sorted(own)][: most - len(wanted)]
    assert got == set(wanted)
    s = selection.selection_stats(selection.select_featured(d, most)).first()
    assert s.featured + s.overflow == s.candidates and s.total == len(items)


def test_first_object():
    f = structured.first_object
    assert f('```json\n{"a": "}"}\n```') == '{"a": "}"}'
    assert f('note {x} then {"results": [{"id": "{"}]} end') == '{"results": [{"id": "{"}]}'
    assert f('say \\" {"a": "\\"}{"} tail }') == '{"a": "\\"}{"}'
    assert f("{open") is None and f(None) is None and f("") is None


def test_answer_object(spark):
    d = spark.createDataFrame([(1, ' {"a":1} ', None), (2, "", 'think {"b":2}'), (3, None, " "), (4, "words", None)], "i int, c string, r string")
    got = d.select("i", structured.answer_object(F.col("c"), F.col("r")).alias("a")).orderBy("i").collect()
    assert [(x.a.json, x.a.error) for x in got] == [('{"a":1}', None), ('{"b":2}', None), (None, "no content"), (None, "no json object")]


def test_verdict_rows_are_all_or_nothing(spark):
    good, bad = '{"results":[{"id":"a","verdict":"yes","more":1}]}', '{"results":[{"id":"a","verdict":"yes"},{"id":"b","verdict":"perhaps"}]}'
    d = spark.createDataFrame([(1, good), (2, bad), (3, "{}"), (4, "no")], "batch int, json string")
    assert rows(structured.verdict_rows(d), "batch", "id") == [(1, "a")]


def test_salvage(spark):
    batch = {"results": [{"id": "a", "title": " A "}, {"id": "b", "title": "B"}, {"id": "b", "title": ""}, {"id": "c", "title": 5}, {"id": "z", "title": "Z"}, {"id": " ", "title": "x"}, "row"]}
    answers = spark.createDataFrame([(1, json.dumps(batch)), (2, "oops"), (3, '{"results": 3}')], "batch int, json string")
    asked = spark.createDataFrame([(1, i) for i in "abcd"] + [(2, "e"), (3, "f")], "batch int, id string")
    titles, issues, summary = structured.salvage_titles(answers, asked)
    assert rows(titles, "batch", "id", "title") == [(1, "a", "A")]
    kinds = [r.kind for r in issues.filter("batch = 1").collect()]
    assert sorted(kinds) == ["duplicate_id", "empty_title", "missing_field", "missing_field", "missing_field", "unknown_id"]
    s = {r.batch: r for r in summary.collect()}
    assert (s[1].requested, s[1].salvaged, s[1].missing, s[1].duplicate, s[1].unknown, s[1].invalid) == (4, 1, 3, 1, 1, 4)
    assert s[2].failed and s[3].failed and s[2].missing == 1
    assert rows(issues.filter("batch > 1"), "batch", "kind") == [(2, "json_parse"), (3, "schema_shape")]


def test_summary_fields(value):
    make = lambda j, i: structured.summary_fields(j, i)
    good = json.dumps({"id": "1", "title": " T ", "summary": "s", "tags": [" a ", ""]})
    assert value(make, good, "1").tags == ["a"]
    assert value(make, good, "2") is None
    assert value(make, json.dumps({"id": "1", "title": "T", "summary": "s", "tags": list("abcdefghi")}), "1") is None
    assert value(make, json.dumps({"id": "1", "title": "T", "summary": " ", "tags": ["a"]}), "1") is None


def test_retry_batch(spark):
    items = spark.createDataFrame([(0, i, str(i)) for i in range(5)] + [(1, i, f"b{i}") for i in range(3)], "batch int, ord int, id string")
    ask = lambda *ids: rows(structured.retry_batch(items, spark.createDataFrame([(i,) for i in ids], "id string")), "id")
    assert ask("2") == [("0",), ("1",), ("2",)]
    assert ask("3") == [("3",), ("4",)]
    assert ask("0", "4", "b0") == [("0",), ("4",), ("b0",), ("b1",)]


def next_fit(sizes, cap_items, cap_tokens):
    out, n, items, size = [], 0, 0, 0
    for s in sizes:
        if items and (items + 1 > cap_items or -(-(size + 1 + s + 45) // 4) > cap_tokens):
            n, items, size = n + 1, 1, s
        else:
            items, size = items + 1, size + s + (1 if items else 0)
        out.append(n)
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 400), max_size=25), st.integers(1, 6), st.integers(20, 150))
def test_pack(spark, sizes, cap_items, cap_tokens):
    d = spark.createDataFrame([("g", i, s) for i, s in enumerate(sizes)], "g string, i int, s int")
    got = batching.pack(d, "g", ["i"], "s", "translate", cap_items, cap_tokens, None).orderBy("i").collect()
    assert [r.batch for r in got] == next_fit(sizes, cap_items, cap_tokens)


def test_spacing_and_rate(spark):
    d = spark.createDataFrame([("p", i, a) for i, a in enumerate([0, 10, 20, 5000, 5001])], "b string, i int, at long")
    assert [r.start_ms for r in batching.spaced_starts(d, "b", "at", ["i"], 2000).orderBy("i").collect()] == [0, 2000, 4000, 6000, 8000]
    assert [r.start_ms for r in batching.spaced_starts(d, "b", "at", ["i"], 100, F.lit(1000)).orderBy("i").collect()] == [1000, 1100, 1200, 5000, 5100]
    t = spark.createDataFrame([(0,), (60,), (61,), (121,)], "s int").select("s", F.timestamp_seconds("s").alias("ts"))
    got = batching.request_rate(t, "ts").orderBy("s").collect()
    assert [r.recent for r in got] == [1, 2, 2, 2]
    assert [r.gap_ms for r in got] == [None, 60_000, 1000, 60_000]


def test_retention(spark, tmp_path):
    labels = spark.createDataFrame([(x,) for x in ("2026-08-30", "2026-08-01", "2026-07-31", "2026-02-31", "notes", "2026-08-30")], "label string")
    assert [tuple(r) for r in retention.plan(labels, "2026-08-30", 30).collect()] == [("2026-07-31", False), ("2026-08-01", True), ("2026-08-30", True)]
    for day in ("2026-01-01", "2026-08-29"):
        (tmp_path / f"report_date={day}").mkdir()
    assert retention.prune(spark, str(tmp_path), "2026-08-30") == ["2026-01-01"]
    assert (tmp_path / "report_date=2026-01-01").exists()
    retention.prune(spark, str(tmp_path), "2026-08-30", dry_run=False)
    assert [p.name for p in tmp_path.iterdir()] == ["report_date=2026-08-29"]


class Script:
    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def __call__(self, ids, payload):
        self.asked.append(ids)
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return json.dumps({"results": [{"id": i, "verdict": v} for i, v in a.items()]})


def stage():
    now = [0.0]
    return provider.Stage(60_000, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))


def test_provider_policies():
    items = [(i, "{}") for i in "abcd"]
    E = provider.ProviderError
    ask = Script(E("length"), dict(a="yes", b="no"), dict(c="yes", d="no"))
    assert provider.classify(stage(), ask, items)[0] == dict(a="yes", b="no", c="yes", d="no")
    ask = Script(dict(a="yes", b="no", c="yes"), dict(c="no", d="not_sure"))
    assert provider.classify(stage(), ask, items) == (dict(a="yes", b="no", c="yes", d="not_sure"), {})
    assert ask.asked[1] == ["c", "d"]
    s, ask = stage(), Script(E("rate_limit", wait_ms=5000), dict.fromkeys("abcd", "yes"))
    assert len(provider.classify(s, ask, items)[0]) == 4 and s.left_ms() == 55_000
    s, ask = stage(), Script(E("timeout"), E("network"))
    assert provider.classify(s, ask, items)[1] == dict.fromkeys("abcd", "timeout")
    assert provider.classify(s, ask, items)[1] == dict.fromkeys("abcd", "breaker") and s.open_reason == "timeout"
    ask = Script(E("server_error"), E("server_error"))
    assert set(provider.classify(stage(), ask, items)[1].values()) == {"server_error"} and len(ask.asked) == 2


def test_classify_batches_ends_every_id(spark, tmp_path):
    def ask(ids, payload):
        if "4" in ids:
            raise provider.ProviderError("parse")
        return json.dumps({"results": [{"id": i, "verdict": "yes"} for i in ids if i != "7"]})

    d = spark.range(10).select((F.col("id") % 3).alias("batch"), F.col("id").cast("string").alias("id"), F.lit("{}").alias("payload"))
    got = {r.id: (r.verdict, r.failure) for r in provider.classify_batches(d, ask, str(tmp_path / "v")).collect()}
    assert len(got) == 10 and got["4"] == (None, "parse") and got["7"] == (None, "missing") and got["1"] == ("yes", None)


def test_cascade(spark):
    asked = spark.createDataFrame([(i,) for i in "abc"], "id string")
    first = spark.createDataFrame([("a", "1")], "id string, v string")
    got = provider.cascade(first, lambda rest: rest.filter("id <> 'c'").withColumn("v", F.lit("2")), asked)
    assert rows(got, "id", "v", "by") == [("a", "1", "primary"), ("b", "2", "fallback")]


def test_enrich(spark):
    page = '<meta name="dc.type" content="{}"><meta name="description" content="found">'
    pages = spark.createDataFrame([("u1", page.format("Article")), ("u2", page.format("Editorial")), ("u3", page.format(""))], "url string, html string")
    abstracts = spark.createDataFrame([("10.1/A", "<jats:p>" + "long " * 30 + "</jats:p>")], "doi string, markup string")
    d = spark.createDataFrame(
        [("nature", "u1", None, None), ("nature", "u2", None, "has"), ("nature", "gone", None, "has"), ("nature-methods", "u3", None, "Lee et al. report x"), ("nature-methods", "u3", None, "mine"), ("pnas", "u9", "10.1/a", ""), ("cell", "u1", None, None)],
        "source string, url string, doi string, abstract string",
    ).withColumn("articleType", F.lit(None).cast("string"))
    got = {(r.source, r.url, r.outcome): r.abstract for r in enrich.enrich(d, pages, abstracts).collect()}
    assert got == {("nature", "u1", "enriched"): "found", ("nature", "u2", "excluded"): "has", ("nature", "gone", "passed"): "has", ("nature-methods", "u3", "enriched"): "found", ("nature-methods", "u3", "passed"): "mine", ("pnas", "u9", "enriched"): ("long " * 30).strip(), ("cell", "u1", "passed"): None}


def test_report(spark):
    d = spark.createDataFrame([(1, "a", "<T>", "u", "J", "s", "line-a", True, "abs", None, 1, 1), (2, "b", "U", None, " ", "src", "line-b", False, "", None, 5, 2), (3, "c", "V", None, None, "src", "skip", False, "", None, 5, 3)], "ord int, id string, title string, url string, journal string, source string, line string, featured boolean, abstract string, summary string, priority int, position int")
    html = report.render([r.asDict() for r in report.report_rows(d).collect()], "2026-01-01")
    assert "&lt;T&gt;" in html and "<T>" not in html and "src" in html and ">V<" not in html
    assert "No papers" in report.render([], "2026-01-01")
    doc = report.daily_document(d.select("ord", "id", "title"), d.filter("line = 'skip'").select("ord", "id"), selection.selection_stats(d), "2026-01-01").first()
    assert [p.id for p in doc.papers] == ["a", "b", "c"] and doc.excluded[0].id == "c" and doc.selection.featured == 1
    assert report.daily_document(d.select("ord", "id"), d.limit(0).select("ord", "id"), selection.selection_stats(d), "x").first().excluded is None
    assert report.id_sample(spark.range(12).select("id")) == "0, 1, 2, 3, 4, 5, 6, 7 (+4 more)"


def test_fallback_accuracy_measures(spark):
    d = spark.createDataFrame([("Tumor", True), ("Roads", True), ("Battery", False)], "t string, a boolean")
    c = routing.confusion(d, title_verdict(F.col("t"))["verdict"] == "yes", F.col("a")).first()
    assert (c.tp, c.fp, c.fn, c.tn, c.precision, c.recall) == (1, 0, 1, 1, 1.0, 0.5)


def test_hashes_never_decide(spark, monkeypatch):
    """Keys that share both hashes stay apart, in first and last wins."""
    d = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), ("c", 4), (None, 5), (None, 6)], "k string, ord int")
    monkeypatch.setattr(identity.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    assert rows(identity.first_wins(d, ["k"], "ord"), "k", "ord") == sorted([("a", 1), ("b", 2), ("c", 4), (None, 5)], key=str)
    assert rows(identity.last_wins(d, ["k"], "ord"), "k", "ord") == sorted([("a", 3), ("b", 2), ("c", 4), (None, 6)], key=str)


def test_repeated_answers_count_as_a_whole(spark):
    papers = spark.createDataFrame([("i", "x0", "z0"), ("j", "x0", "z0")], "id string, x string, z string")
    fields = spark.createDataFrame([("i", "x1", "z1", 1), ("i", "y2", "c2", 2), ("j", None, "z9", 1)], "id string, x string, z string, ord int")
    assert rows(identity.overlay(papers, fields, "id", ["x", "z"], "ord"), "id", "x", "z") == [("i", "y2", "c2"), ("j", "x0", "z9")]
    assert rows(identity.overlay(papers, fields.filter("ord = 1 OR x = 'y2'").drop("ord"), "id", ["x", "z"]), "id", "x", "z") == [("i", "y2", "c2"), ("j", "x0", "z9")]
    assert rows(identity.overlay(papers, fields.withColumn("ord", -F.col("ord")), "id", ["x", "z"], "ord"), "id", "x", "z") == [("i", "x1", "z1"), ("j", "x0", "z9")]


def test_the_last_verdict_counts(spark):
    papers = spark.createDataFrame([("a", "t", "broad-science")], "id string, title string, scope string")
    verdicts = spark.createDataFrame([("a", "yes", 1), ("a", "no", 2)], "id string, verdict string, ord int")
    assert routing.route(papers, verdicts).first().verdict == "no"
    assert routing.route(papers, verdicts.drop("ord")).first().verdict == "yes"


def test_readers_of_answers():
    good = lambda rows: "note " + json.dumps({"results": rows})
    assert provider.confidences_of(good([{"id": "a", "confidence": 0.5}, {"id": "b", "confidence": 2}, {"id": "c", "confidence": True}, {"id": "d", "confidence": 1}, {"id": "d", "confidence": 1}])) == {"a": "0.5"}
    assert provider.titles_of(good([{"id": " a ", "title": " T "}, {"id": "b", "title": ""}, {"id": "c", "title": 5}, "row", {"id": "d", "title": "x"}, {"id": "d", "title": ""}])) == {"a": "T"}
    for read, text in ((provider.confidences_of, good([{"confidence": 1}])), (provider.titles_of, "words"), (provider.titles_of, '{"results": 3}'), (provider.verdicts_of, good([{"id": "a", "verdict": "maybe"}]))):
        with pytest.raises(provider.ProviderError):
            read(text)


def test_starts_are_spaced_and_end_with_the_budget():
    s, at = stage(), []
    s.spacing_ms = 20_000

    def ask(ids, payload):
        at.append(60_000 - s.left_ms())
        return json.dumps({"results": [{"id": i, "verdict": "yes"} for i in ids]})

    got = [provider.classify(s, ask, [(x, "{}")]) for x in "abcd"]
    assert at == [0, 20_000, 40_000] and [len(g[0]) for g in got] == [1, 1, 1, 0] and got[3][1] == {"d": "breaker"} and s.open_reason == "budget exhausted"


def test_json_mode_is_given_up_once():
    asked = []

    def strict(ids, payload):
        asked.append("strict")
        raise provider.ProviderError("json_mode")

    ask = provider.json_mode(strict, lambda ids, payload: asked.append("plain") or "{}")
    assert ask([], "") == ask([], "") == "{}" and asked == ["strict", "plain", "plain"]

    def busy(ids, payload):
        raise provider.ProviderError("rate_limit")

    with pytest.raises(provider.ProviderError, match="rate_limit"):
        provider.json_mode(busy, strict)([], "")


def test_stage_drivers(spark, tmp_path):
    d = spark.createDataFrame([(i // 4, f"p{i}", "{}") for i in range(18)], "batch int, id string, payload string")

    def spatial(ids, payload):
        if "p13" in ids and len(ids) > 1:
            raise provider.ProviderError("length")
        return json.dumps({"results": [{"id": i, "confidence": int(i[1:]) / 10} for i in ids if i != "p2"]})

    got = {r.id: (r.confidence, r.failure) for r in provider.spatial_batches(d, spatial, str(tmp_path / "s"), depth=3).collect()}
    assert got["p4"] == (0.4, None) and got["p2"] == (None, "missing") and got["p13"][0] is None and len(got) == 18 and got["p12"][1] == "missing"
    titles = provider.translate_batches(d, lambda ids, p: json.dumps({"results": [{"id": i, "title": f"t {i}"} for i in ids]}), str(tmp_path / "t"), concurrency=3)
    assert {r.title for r in titles.collect()} == {f"t p{i}" for i in range(18)}
    n = provider.stage_counts(provider.spatial_batches(d, spatial, str(tmp_path / "s2")), "confidence").first()
    assert (n.requested, n.answered, n.failed, sum(n.kinds.values())) == (18, 10, 8, 8)
    none = provider.stage_counts(titles.filter("false"), "title").first()
    assert (none.requested, none.answered, none.failed, none.kinds) == (0, 0, 0, {})


def test_cards_and_files_of_the_report(spark, tmp_path):
    d = spark.createDataFrame([(1, "10.1234/x y", "<T>", "u&", "J", "s", "line-a", True, "abs", None, 1, ["<a>", None, "b"])], "ord int, id string, title string, url string, journal string, source string, line string, featured boolean, abstract string, summary string, position int, tags array<string>")
    html = report.render([r.asDict() for r in report.report_rows(d).collect()], "2026-01-01")
    for part in ('<a href="u&amp;">&lt;T&gt;</a>', '<p class="journal">J · <a href="https://doi.org/10.1234%2Fx%20y">10.1234/x y</a></p>', '<div><span class="tag">&lt;a&gt;</span><span class="tag">b</span></div>', "<p>abs</p>", "<h2>Preprints</h2><p>None today.</p>"):
        assert part in html
    bare = d.select("title").select(report.card(["title"]).alias("c")).first().c
    assert bare == '<article><h3><a href="">&lt;T&gt;</a></h3><p class="journal"></p><p></p></article>'
    paths = report.publish(spark, html, str(tmp_path / "site"), "2026-01-01", True)
    assert [p.split("site")[1] for p in paths] == ["/index.html", "/archive/2026-01-01.html"]
    assert (tmp_path / "site" / "archive" / "2026-01-01.html").read_text() == (tmp_path / "site" / "index.html").read_text() == html
