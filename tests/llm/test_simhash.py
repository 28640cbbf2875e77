import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import simhash
from inkwell.llm.scratch import Scratch
from tests.llm.conftest import words


def brute_print(text, n=4):
    w = words(text)
    s = [" ".join(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius=4):
    """Of ids by fingerprint, least id reachable."""
    fps = sorted(set(prints))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "é", "漢", "a\tb", " ", "\n\x0b", " x"]), max_size=12).map(" ".join))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_print(text)


def test_fingerprint_of_a_long_text():
    text = " ".join(str(i * i % 977) for i in range(70_000))
    assert simhash.fingerprint(text.encode()) == brute_print(text)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 6))
def test_forest_finds_what_is_near(seed, radius):
    r = random.Random(seed)
    units, fp = [], []
    for u in range(4):
        base = [r.getrandbits(64) for _ in range(2)]
        own = {b ^ sum(1 << r.randrange(64) for _ in range(r.randrange(5))) & (1 << 64) - 1 for b in base * 8}
        fp += sorted(own)
        units += [u] * len(own)
    fp, units = np.array(fp, np.uint64), np.array(units)
    tree = np.array([r.random() < 0.8 for _ in fp])
    query = np.flatnonzero([r.random() < 0.8 for _ in fp])
    got = {(int(a), int(b)) for q, m in simhash.Forest(fp, units, tree).search(query, radius) for a, b in zip(q, m, strict=True)}
    near = {(int(a), b) for a in query for b in range(len(fp)) if tree[b] and a != b and units[a] == units[b] and (int(fp[a]) ^ int(fp[b])).bit_count() <= radius}
    assert got == near


def test_blocks_lose_no_pair():
    r = random.Random(1)
    for agree in (1, 2, 3):
        masks = simhash.blocks_of(4, agree)
        for _ in range(300):
            bits = sum(1 << b for b in r.sample(range(64), 4))
            assert any(bits & m == 0 for m in masks)
    assert [simhash.agreement(n, 4) for n in (0, 250_000, 10**6, 10**9, 10**11)] == [1, 1, 2, 3, 4]


def crowd(seed, many):
    """Fingerprints in a crowd that hardly differ, and strangers."""
    r = random.Random(seed)
    base = r.getrandbits(64)
    return sorted({base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(many)} | {r.getrandbits(64) for _ in range(40)} | {base ^ 0b11111111 << 20, base ^ 0b1111111111 << 40, 0, 7})


def test_links_with_and_without_parts(spark, monkeypatch):
    for seed, part, agree in ((1, 2048, 1), (2, 16, 1), (3, 16, 2)):
        fps = crowd(seed, 150)
        signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
        monkeypatch.setattr(simhash, "agreement", lambda count, radius, agree=agree: agree)
        with Scratch(spark, "test") as scratch:
            links = simhash._links(scratch, spark.createDataFrame(signed, "fp long"), 4, part).collect()
        assert len(links) < 60 * len(fps)
        unsigned = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in links]
        assert all((a ^ b).bit_count() <= 200 for a, b in unsigned)
        root = {f: f for f in fps}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in unsigned:
            root[find(a)] = find(b)
        expected = brute_components(fps)
        assert len({(expected[f], find(f)) for f in fps}) == len(set(expected.values())) == len({find(f) for f in fps})


def test_components_of_texts(spark, odd, empty):
    r = random.Random(9)
    base = [r.choice("abcdefgh") * r.randrange(1, 4) for _ in range(400)]
    rows = [(i, x.text) for i, x in enumerate(odd.collect())]
    for i in range(60):
        own = list(base)
        for _ in range(r.randrange(4)):
            own[r.randrange(400)] = "new"
        rows.append((100 + i, " ".join(own)))
    rows += [(None, " ".join(base)), (None, "alone and without id"), (300, ""), (301, None), (302, "IDIOT same text")]
    prints = [brute_print(t) for _, t in rows]
    label = brute_components(prints)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[label[p]] = min(i, least.get(label[p], i))
    got = simhash.near_components(spark.createDataFrame([(*x, "f", 1, 2) for x in rows], "doc_id long, text string, fp string, key int, part int"), part=16)
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted((tuple(x) for x in got.collect()), key=key) == sorted(((i, f"{p:016x}", least.get(label[p])) for (i, _), p in zip(rows, prints, strict=True)), key=key)
    assert simhash.near_components(empty).collect() == []
    assert simhash.near_components(odd).count() == odd.count()
