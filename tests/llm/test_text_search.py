import hashlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import backoff, decontaminate, ngram_join
from inkwell.llm.scratch import Scratch
from inkwell.llm.words import U64
from tests.llm.conftest import crc, words
from tests.llm.test_words import thue_morse

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
few = st.lists(st.sampled_from("abc"), max_size=25).map(" ".join)


def windows(text, n):
    w = words(text, ALNUM)
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def brute(text, items, n):
    w, hit, own = words(text, ALNUM), set(), set()
    for item, t in items:
        for p in windows(t, n):
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    own |= {str(item)} - {"None"}
    return len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), hit


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(few, st.just("a x b"), st.just("x")), min_size=1, max_size=6), st.lists(few, max_size=3), st.integers(1, 4))
def test_fm_index_finds_all_occurrences(texts, items, n):
    p = decontaminate.phrases(list(range(len(items))), items, n)

    class Part:
        value = p

    hit, first, own = decontaminate._hits(pa.array(texts), [Part])
    for k, t in enumerate(texts):
        n_words, n_hit, n_items, _, where = brute(t, list(enumerate(items)), n)
        assert first[k + 1] - first[k] == n_words
        assert set(np.flatnonzero(hit[first[k] : first[k + 1]]).tolist()) == where
        assert len(own.get(k, ())) == n_items


def test_words_with_a_structure(spark):
    """Texts whose words a weak hash would take for one another have nothing in common."""
    a, b = thue_morse(1024), thue_morse(1024, 1)
    docs = spark.createDataFrame([(1, f"{a} x y z"), (2, f"{b} x y z"), (3, f"{a} {b}")], "doc_id long, text string")
    found = decontaminate.find_contamination(docs, spark.createDataFrame([(7, a)], "item_id long, text string"))
    assert sorted((r.doc_id, r.n_hit) for r in found.collect()) == [(1, 1), (2, 0), (3, 1)]
    assert {r.doc_id: r.component_id for r in ngram_join.near_components(docs).collect()} == {1: 1, 2: 2, 3: 3}
    scored = {r.doc_id: r for r in backoff.score_texts(docs, "doc_id = 1").collect()}
    assert (scored[2].n_tokens, scored[2].n_known, scored[3].n_known, scored[1].train_tokens) == (5, 4, 2, 5)


def test_decontamination(spark, odd, empty):
    rows = [(i, r.text) for i, r in enumerate(odd.collect())] + [(50, "clean " * 600 + "Word word word."), (51, "x " * 10 + "no id at all " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(1, "same TEXT here with idiot words"), (2, None), (3, "... "), (None, "clean clean"), (4, "no-id at all no id at all no id at all no id at"), (12, "word"), (12, "at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.find_contamination(docs, bench).collect()}
    for i, t in rows:
        n_words, n_hit, n_items, sha, where = brute(t, items, 13)
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n_words, n_hit, n_items, sha)
        assert r.contaminated == (n_hit > 0 and 20 * n_hit >= n_words)
        assert {x for s in r.spans for x in range(s["from"], s["to"])} == where
    rest = decontaminate.reject(docs, bench)
    assert sorted(r.doc_id for r in rest.collect()) == sorted(i for i, r in got.items() if not r.contaminated)
    assert decontaminate.find_contamination(empty, bench).count() == 0
    assert decontaminate.find_contamination(docs, bench.filter("false")).filter("contaminated").count() == 0
    assert decontaminate.reject(odd, bench).columns == odd.columns


def grams(text, n):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))) if w else frozenset()


def brute_components(rows, n, percent):
    sets = [grams(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k][0])
    least = {k: min((i for i in ids if i is not None), default=None) for k, ids in groups.items()}
    return sorted(((i, len(s), i if not s else least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def family(draw, size, count, edits):
    base = [f"w{draw.integers(400)}" for _ in range(size)]
    out = []
    for _ in range(count):
        w = list(base)
        for _ in range(int(draw.integers(edits + 1))):
            w[draw.integers(len(w))] = f"w{draw.integers(400)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("n", "percent", "members", "part"), [(4, 85, 4000, 2000), (5, 80, 4000, 2000), (3, 60, 6, 2000), (4, 85, 3, 8)])
def test_components(spark, monkeypatch, n, percent, members, part):
    draw = np.random.default_rng(n * percent)
    sizes, count = ((5, 9, 14, 30, 60, 150, 400), 14) if members > 10 else ((5, 14, 60), 8)
    texts = [t for size in sizes for t in family(draw, size, count, max(2, size // 20))]
    passage = " ".join(f"p{i}" for i in range(25))
    texts += [passage + " " + " ".join(f"q{draw.integers(50)}" for _ in range(8)) for _ in range(20)]
    texts += [None, "", " ", "a", "A", "a b", "a b", texts[3].upper(), texts[-30] + " tail"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[5]), (None, "alone here"), (7, texts[7])]
    monkeypatch.setattr(ngram_join, "CELL_MEMBERS", members)
    monkeypatch.setattr(ngram_join, "PART_MEMBERS", part)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in ngram_join.near_components(d, shingle=n, percent=percent).collect()), key=str)
    assert got == brute_components(rows, n, percent)


def watch_tables(monkeypatch, spark):
    """Names of the tables that the join writes, and the bytes that stand written after each."""
    seen, save = [], Scratch.save

    def watched(self, df, name):
        out = save(self, df, name)
        root = Path(self.root.removeprefix("file://").removeprefix("file:"))
        seen.append((name, sum(f.stat().st_size for f in root.rglob("*") if f.is_file())))
        return out

    monkeypatch.setattr(Scratch, "save", watched)
    return seen


def test_cells_are_not_written_before_they_meet(spark, monkeypatch):
    draw = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in draw.integers(10**6, size=600)) for _ in range(900)]
    texts += [texts[0] + " more", texts[1].upper()]
    seen = watch_tables(monkeypatch, spark)
    got = ngram_join.near_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got if r.component_id != r.doc_id} == {900: 0, 901: 1} and len(got) == 902
    assert max(b for _, b in seen) < 0.5 * sum(map(len, texts))


def test_rounds(spark, monkeypatch):
    """Points, texts and sets that go in several rounds change no component."""
    draw = np.random.default_rng(9)
    rows = list(enumerate(t for size in (14, 60, 150) for t in family(draw, size, 12, max(2, size // 20))))
    monkeypatch.setattr(ngram_join, "ROUND_SHARE", 0)
    monkeypatch.setattr(ngram_join, "ROUND_BYTES", 1_500)
    seen = watch_tables(monkeypatch, spark)
    d = spark.createDataFrame([*rows, (None, ""), (70, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in ngram_join.near_components(d, shingle=5, percent=80).collect()), key=str)
    assert got == brute_components([*rows, (None, ""), (70, None)], 5, 80)
    assert {"near_hubs-1", "links1-1"} <= {name for name, _ in seen}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pairs_around_an_unlinked_hub(spark, seed):
    """Short texts that share a long beginning: in a cell, one linked pair among variants that link with nothing."""
    draw = np.random.default_rng(seed)
    texts = []
    for k, variants in enumerate([2, 4, 8] * 10 + [200]):
        start = " ".join(f"s{k}_{draw.integers(10**6)}" for _ in range(12))
        pair = f"{start} x{draw.integers(10**6)}"
        texts += [pair, f"{pair} y{draw.integers(10**6)}"] + [f"{start} v{draw.integers(10**9)}" for _ in range(variants)]
    rows = list(enumerate(texts))
    got = sorted((tuple(r) for r in ngram_join.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_components(rows, 4, 85)


def test_representatives(spark, odd, empty):
    got = ngram_join.representatives(odd)
    assert got.columns == odd.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted({(r.doc_id, r.text) for r in odd.collect() if r.doc_id != 5 and not (r.doc_id is None and r.text is None)} | {(None, None)}, key=str)
    assert ngram_join.representatives(empty).count() == 0 and ngram_join.near_components(empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(60, 95))
def test_linked_sets_share_a_cell(seed, percent):
    draw = np.random.default_rng(seed)
    size = int(draw.integers(1, 300))
    a = draw.integers(0, 2**63, size).astype(U64)
    gone = int(draw.integers(0, size * (100 - percent) // 100 + 1))
    b = np.concatenate([a[gone:], draw.integers(0, 2**63, int(draw.integers(0, 3))).astype(U64)])
    a, b = np.unique(a), np.unique(b)
    if len(b) and ngram_join._linked(a, b, percent) and not np.array_equal(a, b):
        for seed_ in (0, 1):
            key, text = ngram_join.cells(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), percent, seed_)
            assert set(key[text == 0].tolist()) & set(key[text == 1].tolist())


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000))
def test_tree_search_is_the_bound(seed):
    draw = np.random.default_rng(seed)
    m = int(draw.integers(1, 120))
    points = (draw.integers(0, 4, 16) + draw.integers(0, 3, (m, 16))).astype(np.uint16)
    n = points.sum(1).astype(np.int64)
    tree = ngram_join.RTree(points, n)
    near = ngram_join.RTree.may(points[:, None], n[:, None], points[None], n[None], n[None], 80)
    for k in range(m):
        assert sorted(tree.search(points[k], int(n[k]), 80)) == np.flatnonzero(near[k]).tolist()


class Model:
    """The model token by token: counts of n-grams in dictionaries, probabilities by recursion."""

    def __init__(self, train, order, mass):
        self.order, self.mass, self.count = order, mass, defaultdict(int)
        for t in train:
            w = [*words(t), None]
            for i in range(len(w)):
                for k in range(min(order, i + 1)):
                    self.count[tuple(w[i - k : i + 1])] += 1
        self.n, self.v = sum(c for g, c in self.count.items() if len(g) == 1), sum(len(g) == 1 for g in self.count)

    def p(self, history, word):
        if not history:
            return (self.count.get((word,), 0) + 1) / (self.n + self.v + 1)
        seen, shorter = self.count.get(history, 0), self.p(history[1:], word)
        return (self.count.get((*history, word), 0) + self.mass * shorter) / (seen + self.mass) if seen else shorter

    def row(self, text):
        w = [*words(text), None]
        base, score = (sum(np.log10(self.p(tuple(w[max(i - k, 0) : i]), x)) for i, x in enumerate(w)) for k in (0, self.order - 1))
        return len(w), sum((x,) in self.count for x in w), self.n, base, score


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_backoff(spark, odd, empty, monkeypatch, order):
    draw = np.random.default_rng(3)
    rows = [(i, " ".join(f"V{draw.integers(12)}" if i % 9 else f"U{i % 40}_{k}" for k in range(int(draw.integers(0, 30))))) for i in range(150)]
    rows += [(r.doc_id, r.text) for r in odd.collect()] + [(900 + i, " ".join(f"L{draw.integers(300) ** 2}" for _ in range(700))) for i in range(3)]
    monkeypatch.setattr(backoff, "LANE", 7)
    monkeypatch.setattr(backoff, "BLOCK_BYTES", 4000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    model = Model([t for i, t in rows if i is not None and crc(i) % 7 != 2], order, backoff.MASS)
    got = backoff.score_texts(docs, "crc32(CAST(doc_id AS string)) % 7 <> 2", order=order, bucket_grams=500).collect()
    wanted = sorted(((i, *model.row(t)) for i, t in rows), key=str)
    have = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=str)
    assert [x[:4] for x in have] == [x[:4] for x in wanted]
    assert np.allclose([x[4:] for x in have], [x[4:] for x in wanted])
    if order == 3:
        assert backoff.score_texts(empty, "true").count() == 0
        assert {r.n_known for r in backoff.score_texts(docs, "false").collect()} == {0}
        assert backoff.score_texts(odd, "true").count() == odd.count()


def machine(tokens, first, order, kinds, train=slice(None)):
    """An automaton of the given texts, all of them or of those that train."""
    grams = backoff.Grams(kinds, tokens, first, order)
    keep = np.zeros(len(first) - 1, bool)
    keep[train] = True
    keep = np.repeat(keep, np.diff(first))
    totals = [np.bincount(ids[keep & (ids >= 0)], minlength=len(w)) for ids, w in zip(grams.ids, grams.word, strict=True)]
    return backoff.Automaton(grams, totals, 0, int(totals[0].sum()), int((totals[0] > 0).sum()), 2.0), totals


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=12), min_size=1, max_size=8), st.integers(1, 4))
def test_probabilities_of_every_state_sum_to_one(texts, order):
    """What a state's arcs and, by its failure arc, all shorter states' arcs give to the words, with one word never seen."""
    tokens = np.array([x for t in texts for x in (*t, 0)] + [5, 0])
    first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts] + [2])])
    m, _ = machine(tokens, first, order, 6, slice(0, len(texts)))
    absent = set(range(6)) - set(tokens[:-2].tolist())

    def p(state, word):
        at = np.searchsorted(m.keys, state * 6 + word)
        if at < len(m.keys) and m.keys[at] == state * 6 + word:
            return 10 ** m.weight[at]
        return 10 ** m.failed[state] * p(m.fail[state], word)

    for state in range(len(m.fail)):
        assert sum(p(state, w) for w in set(range(6)) - absent) + p(state, 5) == pytest.approx(1)


def test_states_do_not_know_what_the_text_was_before():
    draw = np.random.default_rng(0)
    tokens = np.append(draw.integers(1, 5, 500), 0)
    m, _ = machine(tokens, np.array([0, 501]), 3, 5)
    whole = m.walk(tokens, np.array([0]), np.array([501]), np.array([0]))
    assert np.allclose(m.walk(tokens, *backoff.lanes(np.array([0, 501]), 3)), whole)
