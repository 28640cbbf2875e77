"""The registered queries as they stand: their SQL in DuckDB over the smallest tables, columns, folds and thresholds."""

from pathlib import Path

import duckdb
import numpy as np
import pytest

from inkwell.llm import language, quality, toxicity
from inkwell.llm.registry import ORACLES, QUERIES
from tests.llm.conftest import crc
from tests.test_catalog import plain

DATA = Path("/root/testdata/sf0.001")
COLUMNS = {
    "op1": "doc_id size source_size target taken", "op2": "page_id payload_bytes payload_digest record_type refers_to", "op3": "doc_id held_out score predicted offending", "op4": "doc_id keep_id group_size kept text_sha256",
    "op5": "doc_id n_words n_hit n_items items_sha256 contaminated", "op6": "doc_id n_shingles component_id", "op8": "doc_id held_out score predicted", "op9": "doc_id held_out lang_pred score",
    "op10": "doc_id held_out n_tokens n_known train_tokens base_score score", "op11": "click_id kind n median2 mad4 far", "op12": "vec_id component n deviation whitened explained identity_error", "op13": "doc_id fingerprint component_id",
}
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, duck, name):
    df, answer = QUERIES[name](spark, str(DATA)), duck.sql(ORACLES[name])
    assert sorted(answer.columns) == sorted(df.columns)
    order = [answer.columns.index(c) for c in df.columns]
    assert sorted(tuple(map(plain, r)) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in order) for r in answer.fetchall())


@pytest.mark.parametrize(("name", "fold", "least"), [("op3", (5, 0), 0.5), ("op8", (5, 0), 0.3), ("op9", (4, 2), None), ("op10", (7, 2), None)])
def test_folds_and_thresholds(spark, duck, name, fold, least):
    query = next(q for n, q in QUERIES.items() if n.startswith(f"{name}_"))
    got = query(spark, str(DATA)).collect()
    assert len(got) == duck.sql("SELECT count(*) FROM documents").fetchall()[0][0]
    assert all(r.held_out == (crc(r.doc_id) % fold[0] == fold[1]) for r in got)
    if least is not None:
        assert all(r.predicted == int(r.score >= least) for r in got)
    if name == "op10":
        own = duck.sql(r"""WITH d AS (SELECT doc_id, list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), chr(10)) AS w FROM documents) SELECT doc_id, w FROM d""").fetchall()
        counts: dict = {}
        for i, w in own:
            if crc(i) % 7 != 2:
                for x in w:
                    counts[x] = counts.get(x, 0) + 1
        total = sum(counts.values())
        base = {i: (len(w), sum(x in counts for x in w), sum(np.log10((counts.get(x, 0) + 1) / (total + len(counts) + 1)) for x in w)) for i, w in own}
        for r in got:
            assert (r.n_tokens, r.n_known, r.train_tokens) == (*base[r.doc_id][:2], total) and r.base_score == pytest.approx(base[r.doc_id][2])


def test_columns(spark):
    for name, query in QUERIES.items():
        op = name.split("_")[0]
        if op in COLUMNS and op not in ("op1", "op2", "op4", "op5", "op6", "op11"):  # those are compared as a whole
            assert query(spark, str(DATA)).columns == COLUMNS[op].split(), name


def test_normal_equations(spark):
    """Sums gathered in tasks give the coefficients of all rows at once."""
    r = np.random.default_rng(2)
    x = r.normal(size=(300, len(quality.STATS)))
    y = (x[:, 0] + 0.3 * r.normal(size=300) > 0).astype(float)
    stats = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "doc_id long, " + ", ".join(f"{c} double" for c in quality.STATS)).repartition(5)
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)] + [(900, 1), (None, 1)], "doc_id long, quality int")
    model = quality.fit(stats, labels, "doc_id % 2 = 0", "doc_id % 2 = 1")
    own, k = np.arange(0, 300, 2), quality.FEATURES + 1
    z = quality.Fourier(x[own].mean(0), x[own].std(0), 7)(x[own])
    wanted = np.linalg.solve(z.T @ z + quality.PENALTY * len(own) * np.eye(k) / k, z.T @ y[own])
    assert np.allclose(z @ model.beta, z @ wanted, atol=1e-6)
    score = model(x[1::2])
    assert np.all((score >= 0) & (score <= 1)) and np.mean((score >= 0.5) == y[1::2]) > 0.6


def test_gradient_of_the_noisy_or(monkeypatch):
    """Training ends where the documents' likelihood is better than on either side, along weights and bias."""
    r = np.random.default_rng(3)
    slots = [np.full((12, 1), 1, np.int32) if i % 3 == 0 and j < 1 else r.integers(10, 40, (12, 1)).astype(np.int32) for i in range(60) for j in range(1)]
    for i in range(0, 60, 3):
        slots[i] = np.concatenate([r.integers(10, 40, (8, 1)), np.full((4, 1), 1)]).astype(np.int32)
    first = [np.array([0, 4, 8]) for _ in range(60)]
    y = np.array([float(i % 3 == 0) for i in range(60)])
    y[[3, 7]] = 1 - y[[3, 7]]  # so that the best weight is finite
    monkeypatch.setattr(toxicity, "ROUNDS", 4000)
    model = toxicity.train(slots, first, y)
    pull = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) ** 0.5

    def loss(weight, bias):
        total = 0.0
        for s, f, label, p in zip(slots, first, y, pull, strict=True):
            weights = np.zeros(toxicity.SLOTS)
            weights[1] = weight
            clean = np.logaddexp(0, np.add.reduceat(weights[s].sum(1), f) + bias).sum()
            total += p * (-np.log(-np.expm1(-clean)) if label else clean)
        return total / len(y) + toxicity.DECAY * weight**2 / 2

    w, b = float(model.weights[1]), model.bias
    assert set(np.flatnonzero(model.weights)) == {1} and w > 1
    best = loss(w, b)
    assert all(loss(w + dw, b + db) > best for dw, db in ((0.2, 0), (-0.2, 0), (0, 0.1), (0, -0.1)))


def test_votes():
    """One-versus-one votes against counting by hand."""
    r = np.random.default_rng(4)
    names = ["a", "b", "c", "d"]
    machines = {(p, q): r.normal(size=4) for i, p in enumerate(names) for q in names[i + 1 :]}
    x = r.normal(size=(50, 3))
    best, sure = language.Model._vote(x, names, machines)
    for row, k, s in zip(x, best.tolist(), sure.tolist(), strict=True):
        won, margins = dict.fromkeys(names, 0.0), {n: [] for n in names}
        for (p, q), w in machines.items():
            m = row @ w[:-1] + w[-1]
            for n, v in ((p, m), (q, -m)):
                won[n] += (v >= 0) + 1e-3 * np.tanh(v)
                margins[n].append(v)
        top = max(names, key=lambda n: won[n])
        assert names[k] == top and s == pytest.approx(1 / (1 + np.exp(-3 * min(margins[top]))))
