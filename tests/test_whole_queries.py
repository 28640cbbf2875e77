"""Queries over whole texts against brute force, on texts with late markup and in any language."""

import re

import pytest

from inkwell.plans import catalog

TITLE = "A title, {}"
ROWS = [(i, TITLE.format(i) + ". " + "word " * n + late, lang) for i, (n, late, lang) in enumerate([(60, "<b>late</b> &lt;i&gt;x&lt;/i&gt; end", "en"), (60, "late &amp; <i>last</i>", "fr"), (400, "<style>p</style> tail", None), (2, "short", "de"), (60, "a < b &quot;q&quot;", None), (9000, "<p>far</p> end", "zh")] * 2)]


def plain(x):
    for name, char in (("nbsp", " "), ("amp", "&"), ("lt", "<"), ("gt", ">"), ("quot", '"')):
        x = re.sub(f"&{name};", char, x)
    for p in ("(?s)<style.*?</style>", "<[^>]+>"):
        x = re.sub(p, " ", x)
    return " ".join(x.split())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame([(i, t, lang, "src1", len(t)) for i, t, lang in ROWS], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return path


def by_id(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_jats_abstract(spark, folder):
    wanted = {i: plain(t + "</jats:p>") for i, t, _ in ROWS}
    assert by_id(catalog.jats_abstract(spark, folder)) == {i: (t if len(t) >= 80 and not re.search("(?i)</?[a-z]", t) else None,) for i, t in wanted.items()}


def test_encoded_abstract(spark, folder):
    wanted = {i: plain(t.split(".", 1)[1] + "</p>") for i, t, _ in ROWS}
    assert by_id(catalog.encoded_abstract(spark, folder)) == {i: (t if i % 3 and len(t) >= 40 else None,) for i, t in wanted.items()}


def test_summary_fields(spark, folder):
    got = by_id(catalog.summary_fields(spark, folder))
    assert got == {i: (TITLE.format(i), "s", ",".join(f"g{k}" for k in range(1, i % 10 + 2))) if i % 7 and i % 10 < 8 else (None, None, None) for i, _, _ in ROWS}
