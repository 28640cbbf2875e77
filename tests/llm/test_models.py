import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.llm import language, quality, toxicity
from tests.llm.conftest import crc

CLEAN, RUDE = ["alpha", "beta", "gamma", "delta", "omega", "kappa"], ["scum", "moronic", "moron"]


@pytest.fixture(scope="module")
def corpus(spark):
    draw = np.random.default_rng(5)
    rows = []
    for i in range(600):
        bad = i % 5 == 0
        sentences = [" ".join(draw.choice(CLEAN, 7)) for _ in range(6)]
        if bad:
            sentences[i % 6] += " " + RUDE[i % 3]
        text = ". ".join(sentences)
        rows.append((i, text.upper() + "!!" * 50 if i % 4 == 1 else text, "en", int(bad), int(i % 4 != 1)))
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int, quality int").cache()
    return d.select("doc_id", "text", "lang"), d.select("doc_id", "toxic", "quality")


def test_toxicity_finds_documents_and_sentences(spark, corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels, "crc32(CAST(doc_id AS string)) % 5 <> 0")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(600) if crc(i) % 5 == 0]
    assert np.mean([(got[i].score >= 0.5) == (i % 5 == 0) for i in held]) > 0.97
    hits = [i for i in held if i % 5 == 0 and got[i].score >= 0.5]
    assert np.mean([got[i].offending == [i % 6] for i in hits]) > 0.9
    kept = toxicity.reject(docs, model, 0.5)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.score < 0.5}
    again = toxicity.fit(docs.repartition(7), labels.repartition(3), "crc32(CAST(doc_id AS string)) % 5 <> 0")
    assert np.allclose(again.weights, model.weights)


def test_noisy_or():
    m = toxicity.Model(np.zeros(toxicity.SLOTS), -1.0)
    z = m.sentence_logits(np.zeros((4, 4), np.int32), np.array([0, 2]))
    assert -np.expm1(-np.logaddexp(0, z).sum()) == pytest.approx(1 - (1 - 1 / (1 + np.e)) ** 2)


def test_quality(spark, corpus):
    docs, labels = corpus
    fold = "crc32(CAST(doc_id AS string)) % 5"
    got = {r.doc_id: r.score for r in quality.score(docs, labels, f"{fold} NOT IN (0, 1)", f"{fold} = 1").collect()}
    held = [i for i in range(600) if crc(i) % 5 == 0]
    assert all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[i] >= 0.5) == (i % 4 != 1) for i in held]) > 0.97


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 4)), min_size=1, max_size=12))
def test_isotonic(points):
    y, w = np.array([float(a) for a, _ in points]), np.array([float(b) for _, b in points])
    got = quality.isotonic(np.arange(len(y)), y, w)
    n = len(y)
    mean = lambda a, b: (y[a:b] * w[a:b]).sum() / w[a:b].sum()
    assert np.allclose(got, [max(min(mean(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)])


def test_fourier_features_approximate_the_kernel():
    x = np.random.default_rng(1).normal(size=(40, len(quality.STATS)))
    f = quality.Fourier(np.zeros(x.shape[1]), np.ones(x.shape[1]), 3, features=20_000)
    z = f(x)[:, 1:]
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-d2 / (2 * x.shape[1]))).max() < 0.05


def test_language(spark):
    draw = np.random.default_rng(2)
    kinds = {"en": "the of and ing tion er", "de": "der und sch keit ung lich", "fr": "le eau des eux ment que", "es": "los cion ado que mente rr", "zz": "qa xo vu wip kaz zub"}
    rows = []
    for i in range(500):
        lang = list(kinds)[i % 5]
        rows.append((i, " ".join("".join(draw.choice(kinds[lang].split(), 2)) for _ in range(30)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, "crc32(CAST(doc_id AS string)) % 4 <> 2")
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    held = [i for i in range(500) if crc(i) % 4 == 2]
    assert np.mean([got[i].lang_pred == list(kinds)[i % 5] for i in held]) > 0.97
    assert sorted({k[0] for k in model.machines}) == ["family", "germanic", "romance"]


def test_odd_rows(odd, empty):
    labels = odd.select("doc_id", F.lit(1).alias("toxic"), F.lit(1).alias("quality"))
    for data in (odd, empty):
        n = data.count()
        model = toxicity.fit(data, labels, "true")
        tox = toxicity.score(data, model, carry=("n_chars",)).collect()
        assert len(tox) == n and all(0 <= r.score <= 1 for r in tox)
        assert toxicity.reject(data, model, 2.0).count() == n
        q = quality.score(data, labels, "true", "true").collect()
        assert len(q) == n and all(0 <= r.score <= 1 for r in q)
        lang = language.predict(data, language.fit(data, "true")).collect()
        assert len(lang) == n
    got = [(r.lang_pred, r.score) for r in language.predict(odd, language.fit(odd, "true")).filter("doc_id IN (1, 2, 3, 10)").collect()]
    assert got == [("und", 0.0)] * 4
    none = labels.filter("false")
    assert {r.score for r in quality.score(odd, none, "true", "true").collect()} == {0.5}
    assert toxicity.score(odd, toxicity.fit(odd, none, "true")).filter("score >= 0.5").count() == 0
