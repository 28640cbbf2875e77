import pytest
from pyspark.sql import functions as F

from inkwell.functions import dates, html, keywords, rules, text


@pytest.mark.parametrize(
    ("make", "given", "wanted"),
    [
        (text.squeeze, " a  \n b﻿", "a b"),
        (text.decode_entities, "&amp;lt;&NBSP;x&#65;&#8211;&#x3b1;&#9", "< x" + "A–&#x3b1;&#9"),
        (text.decode_entities, "plain", "plain"),
        (text.decode_entities, "&#55357;&#56832;&#65;", "\U0001f600A"),
        (text.decode_entities, "&#55357;", "\ufffd"),
        (text.decode_entities, "&#56832;&#55357;x&#55357; &#56832;", "\ufffd\ufffdx\ufffd \ufffd"),
        (text.decode_entities, "&#55357;&#55357;&#56832;&#56832;&#1048576;&#0;", "\ufffd\U0001f600\ufffd\0\0"),
        (text.strip_tags, "<p>&#55357;</p>&#55357;&#56832;", "\ufffd \U0001f600"),
        (text.decode_entities, "&#4294967361;&#0000000000000065;", "AA"),
        (text.decode_entities, "&#" + "9" * 400 + ";x", "\0x"),
        (text.title_text, "a " + "<i><b>" * 30 + "deep" + "</b></i>" * 30 + " <sub>2</sub>", "a deep 2"),
        (text.strip_tags, "<style>p{}</style><p>a<b>b</b></p><SCRIPT>x\ny</SCRIPT>&lt;i&gt;c", "a b c"),
        (text.title_text, "Role of <i>Meg3<sup>+</sup></i>  cells", "Role of Meg3+ cells"),
        (text.title_text, "p < 0.05 and q > 1", "p < 0.05 and q > 1"),
        (text.title_text, "A <i>b</i> <span>c</span>", "A b c"),
        (text.extract_doi, "https://x.org/doi/10.1038/S41586-026-1.a?x=1", "10.1038/S41586-026-1.a"),
        (text.extract_doi, "10.12/short", None),
        (text.escape_html, "<a href=\"x\">&'", "&lt;a href=&quot;x&quot;&gt;&amp;'"),
        (text.jats_abstract, "<jats:p>too short</jats:p>", None),
        (text.jats_abstract, "&lt;jats:p&gt;" + "word " * 20 + "&lt;/jats:p&gt;", ("word " * 20).strip()),
        (html.article_type, '<meta content="News &amp; Views" name="dc.type">', "News & Views"),
        (html.page_abstract, '<meta name="description" content=" "><meta property=\'og:description\' content=\'og\'>', "og"),
        (html.page_abstract, "<META content='a &amp;#64; b' NAME='Description'><meta name=description>", "a @ b"),
        (html.page_abstract, '<meta name="description" content=""><meta name="description" content="x>y"><meta name="DC.Description" content="third">', "third"),
        (html.page_abstract, "<div id='Abs1-section'><div>a</div><div class='c-article-section__content'>in \n <b>it</b></div>\n</div><div class='c-article-section__content'>not it</div></div>", "in it"),
        (html.page_abstract, "<div id='Abs1-section'><div>a</div></div><div class='c-article-section__content'>outside</div></div>", None),
        (html.page_abstract, "<div id='Abs1-section'><div class='c-article-section__content'>never closed</div>", None),
        (html.page_abstract, "no markup", None),
        (rules.present, "\n \u3000\ufeff", False),
        (rules.present, " \nx", True),
        (rules.present, None, False),
        (html.page_abstract, '<div id="Abs1-section"><div class="x c-article-section__content y"><p>In <i>vivo</i></p></div></div>', "In vivo"),
        (rules.is_teaser, "Lee et al.  Report a map", True),
        (rules.is_teaser, "Lee et al. reported", False),
        (rules.usable_abstract, "  ", False),
        (rules.article_label, " ", "unknown"),
        (dates.is_day_label, "2024-02-30", False),
        (dates.is_day_label, "2024-02-29", True),
        (dates.is_day_label, "2024-2-9", False),
    ],
)
def test_expressions(value, make, given, wanted):
    assert value(make, given) == wanted


def test_identity_prefers_doi_then_url_then_title(value):
    assert value(text.paper_id, "10.1/AbC", "https://X", "T") == "10.1/abc"
    assert value(text.paper_id, "", "https://X", "T") == "https://X"
    assert value(text.paper_id, None, None, " A  Title ") == "a title"


@pytest.mark.parametrize(
    ("given", "utc"),
    [("Sun, 25 May 2026 07:00:00 GMT", "2026-05-25 07:00:00"), ("25 May 2026 07:00:00 +0800", "2026-05-24 23:00:00"), ("2026-05-25", "2026-05-25 00:00:00"), ("2026-05-21T16:00:00Z", "2026-05-21 16:00:00"), ("soon", None), ("", None)],
)
def test_published(value, given, utc):
    got = value(lambda c: dates.published(c).cast("string"), given)
    assert got == utc


def test_report_day_is_the_zones(value):
    day = lambda c: dates.report_day(dates.published(c)).cast("string")
    assert value(day, "2026-05-21T15:59:59Z") == "2026-05-21"
    assert value(day, "2026-05-21T16:00:00Z") == "2026-05-22"


def test_retry_after(value):
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    assert value(lambda c: dates.retry_after_ms(c, now), "1.5") == 1500
    assert value(lambda c: dates.retry_after_ms(c, now), "Thu, 01 Jan 2026 00:00:10 GMT") == 10_000
    assert value(lambda c: dates.retry_after_ms(c, now), "Wed, 31 Dec 2025 00:00:00 GMT") == 0
    assert value(lambda c: dates.retry_after_ms(c, now), "whenever") is None
    assert value(dates.reset_hint_ms, "1700000000", "7") == 7000


@pytest.mark.parametrize(
    ("word", "stem"),
    [("therapies", "therapy"), ("heroes", "hero"), ("leaves", "leaf"), ("processes", "process"), ("branches", "branch"), ("boxes", "box"), ("mice", "mice"), ("genes", "gen"), ("class", "class"), ("cells", "cell"), ("editing", "edit"), ("reportedly", "report"), ("rapidly", "rapid"), ("targeted", "target"), ("frozen", "froz"), ("as", "as"), ("gas", "gas"), ("ring", "ring")],
)
def test_stem(value, word, stem):
    assert value(keywords.stem, word) == stem == keywords.stem_text(word)


def test_tokens(value):
    assert value(keywords.tokens, "The T-cell's 2024 AI of qc-1 in Δ vivo, ox") == ["t-cells", "ai", "qc-1", "vivo"]
    assert value(keywords.tokens, None) == []


@pytest.mark.parametrize(
    ("title", "verdict"),
    [
        ("Quantum error correction in lithium arrays", "no"),
        ("Deep learning maps organoid growth", "yes"),
        ("Gene regulation under climate stress", "no"),
        ("Tumor resistance", "yes"),
        ("A history of roads", "no"),
        ("Diffusion models", "no"),
        ("Malaria and climate", "yes"),
        ("", "no"),
    ],
)
def test_title_verdict(value, title, verdict):
    got = value(keywords.title_verdict, title)
    assert got.verdict == verdict
    assert verdict == "yes" or not got.includes


def test_matching_is_by_substring_in_order(value):
    assert value(lambda c: keywords.matches(c, ["b", "FUSION", "x"]), "Diffusion B") == ["b", "FUSION"]
    assert value(lambda a, b: keywords.searchable(a, b), None, "x") == "x"


def test_digest_skips(spark):
    rows = [
        ("Editorial note: more", "cell", None, None, True),
        ("Editorially yours", "cell", None, None, False),
        ("A life (1920 - 2001) ", "cell", None, None, True),
        ("From reading to writing", "nature", None, None, True),
        ("From reading to writing", "nature-methods", None, ["visium"], False),
        ("From reading to writing at once", "nature", None, None, False),
        ("Editorial", "biorxiv", "Editorial", None, False),
        ("Long enough title for a paper", "cell", " world view ", None, True),
    ]
    d = spark.createDataFrame(rows, "title string, source string, kind string, matched array<string>, wanted boolean")
    assert all(r.got == r.wanted for r in d.withColumn("got", rules.skip_in_digest(*[F.col(c) for c in ("title", "source", "kind", "matched")])).collect())


def test_confidence(spark):
    d = spark.createDataFrame([(0.75,), (0.7499,), (1.0,)], "c double")
    assert [r.v for r in d.select(rules.confidence_line(F.col("c")).alias("v")).collect()] == ["line-a", "line-b", "line-a"]
    with pytest.raises(Exception, match="out of range"):
        spark.createDataFrame([(float("nan"),)], "c double").select(rules.confidence_line(F.col("c"))).collect()


def test_recipients(value):
    assert value(rules.recipients, '["a@x", " A@X ", "b@y"]') == ["a@x", "b@y"]
    assert value(rules.recipients, "a@x; B@y,,b@Y") == ["a@x", "B@y"]
    assert value(rules.recipients, "[not json") == ["[not json"]


@pytest.mark.parametrize(
    ("source", "skipped", "confidence", "section", "wanted"),
    [
        ("src19", True, 0.9, "biology", ("preprint", "keyword-fallback")),
        ("src19", False, 0.9, "biology", ("preprint", "keyword-fallback")),
        ("src1", True, 0.9, "biology", ("skip", "keyword-fallback")),
        ("src1", False, 0.75, "other", ("line-a", "llm")),
        ("src1", False, 0.1, "single-cell-spatial", ("line-b", "llm")),
        ("src1", False, None, "single-cell-spatial", ("line-a", "keyword-fallback")),
        (None, None, None, "biology", ("line-b", "keyword-fallback")),
    ],
)
def test_lines_are_resolved_in_order(spark, source, skipped, confidence, section, wanted):
    row = spark.createDataFrame([(source, skipped, confidence, section)], "source string, skipped boolean, confidence double, section string")
    line, method = rules.resolved_line(F.col("source"), F.col("skipped"), F.col("confidence"), F.col("section"), ["src19"])
    assert tuple(row.select(line, method).first()) == wanted


def test_every_surrogate(spark):
    """Alone each becomes U+FFFD; every high one makes a character with a low one."""
    from pyspark.sql import functions as F

    n = spark.range(0xD800, 0xE000).select(F.col("id"), text.decode_entities(F.concat(F.lit("a&#"), F.col("id").cast("string"), F.lit(";b"))).alias("t"))
    assert n.filter(F.col("t") != "a\ufffdb").count() == 0
    pair = spark.range(0xD800, 0xDC00).select(F.col("id"), text.decode_entities(F.concat(F.lit("&#"), F.col("id").cast("string"), F.lit(";&#57000;"))).alias("t"))
    assert all(r.t == (r.id.to_bytes(2, "big") + (57000).to_bytes(2, "big")).decode("utf-16be") for r in pair.collect())


@pytest.mark.parametrize(
    ("content", "wanted"),
    [
        ("<p>Letters &amp; Notes, Published online: 5 May; <a>doi:1</a></p> <p>Body " + "b" * 40 + "</p>", "Body " + "b" * 40),
        ("<P> letters & notes, PUBLISHED online: 5 May</P>Body " + "b" * 40, "Body " + "b" * 40),
        ("Letters &amp; Notes, Published online: 5 May 2026; doi:10.1/x Body " + "b" * 40, "Body " + "b" * 40),
        ("Letters & Notes, Published online:; " + "b" * 40, "Letters & Notes, Published online:; " + "b" * 40),
        ("<p>Other, Published online: 5 May</p>" + "b" * 40, "Other, Published online: 5 May " + "b" * 40),
        ("<p>Letters &amp; Notes, Published online: 5 May " + "b" * 40, "Letters & Notes, Published online: 5 May " + "b" * 40),
        ("<p>Letters &amp; Notes, Published online: x</p>short", None),
        (None, None),
    ],
)
def test_headers_of_encoded_feeds(value, content, wanted):
    from inkwell.sources.feeds import encoded_abstract

    assert value(encoded_abstract, content, "Letters & Notes") == wanted


@pytest.mark.parametrize(
    ("given", "wanted"),
    [("By A, B\n\nThe text\n \nmore  of it", "The text more of it"), ("by A\nThe text", "The text"), ("By A alone", "By A alone"), (" Bypass  of it ", "Bypass of it"), ("", None), (None, None), (" \n", None)],
)
def test_snippets_without_their_authors(value, given, wanted):
    from inkwell.sources.feeds import snippet_abstract

    assert value(snippet_abstract, given) == wanted


@pytest.mark.parametrize(
    ("sender", "to", "owner", "wanted"),
    [
        ("a@x.org", "p,q", None, (["p", "q"], [], None)), ("a@RESEND.dev", "p", None, (["p"], [], None)), ("a@resend.dev", "p,q", " ", (["p", "q"], [], "several recipients and no owner")),
        ("a@resend.dev", "p,Q", " q ", (["Q"], ["p"], None)), ("a@resend.dev", "p", "q", ([], ["p"], "owner is no recipient")), (None, "p", "q", (["p"], [], None)),
    ],
)
def test_sandbox(value, sender, to, owner, wanted):
    from pyspark.sql import functions as F

    assert tuple(value(lambda s, t, o: rules.sandboxed(s, F.split(t, ","), o), sender, to, owner)) == wanted
