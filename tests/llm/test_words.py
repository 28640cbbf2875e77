import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import words as W
from tests.llm.conftest import words

texts = st.lists(st.text(st.sampled_from("aB z\t\n\x0b\x1c\x85é\xa0漢🙂1!{`"), max_size=30), max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts, st.integers(1, 40))
def test_words_are_those_of_the_patterns(items, most):
    for kind, pattern in ((W.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (W.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        seen = {}
        for i, j, w in W.scan_batch(pa.array(items, pa.string()), kind, most):
            for k in range(i, j):
                own = words(items[k], pattern)
                got = w.hashes[w.first[k - i] : w.first[k - i + 1]].tolist()
                assert len(own) == len(got)
                for a, b in zip(own, got, strict=True):
                    assert seen.setdefault(a, b) == b
        assert len(set(seen.values())) == len(seen)


@settings(max_examples=40, deadline=None)
@given(texts, st.integers(1, 5))
def test_shingles(items, n):
    w = W.scan_all(pa.array(items, pa.string()))
    h, first = W.shingles(w, n)
    seen = {}
    for k, t in enumerate(items):
        own = words(t)
        grams = [tuple(own[i : i + n]) for i in range(max(len(own) - n + 1, 1))] if own else []
        got = h[first[k] : first[k + 1]].tolist()
        assert len(got) == len(grams)
        assert all(seen.setdefault(a, b) == b for a, b in zip(grams, got, strict=True))
    assert len(set(seen.values())) == len(seen)


def test_regroup_keeps_rows():
    b = pa.RecordBatch.from_pydict({"i": list(range(50)), "t": ["x" * (i % 7) for i in range(49)] + [None]})
    got = list(W.regroup(iter([b, b]), 1, 20))
    assert [i for g in got for i in g.column(0).to_pylist()] == list(range(50)) * 2 and len(got) > 3


def test_long_words():
    w = W.scan_all(pa.array(["a" * 5000 + " " + "a" * 4999, "a" * 5000]))
    assert w.hashes[0] == w.hashes[2] != w.hashes[1]
    assert W.powers(3).dtype == np.uint64


def thue_morse(n, flip=0):
    return "".join("ab"[(i.bit_count() + flip) & 1] for i in range(n))


def test_words_with_a_structure():
    """A word of a and b and its mirror image, which polynomials over 2^64 take for one another."""
    for n in (256, 1024, 2048, 8192):
        pair = [thue_morse(n), thue_morse(n, 1)]
        h = W.scan_all(pa.array([" ".join(pair)])).hashes
        assert h[0] != h[1]
    r = np.random.default_rng(0)
    many = {"".join(map(chr, r.integers(97, 99, 12))) for _ in range(4096)} | {"x" * i for i in range(1, 1500)}
    assert len(set(W.scan_all(pa.array([" ".join(many)])).hashes.tolist())) == len(many)
