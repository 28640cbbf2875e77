from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import tokens as T

needs = pytest.mark.skipif(not Path(T.TOKENIZER).exists(), reason="needs the tokenizer's file")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700), st.integers(0, 2**40))
def test_feistel_is_a_permutation(n, key):
    assert sorted(T.feistel(np.arange(n), n, key).tolist()) == list(range(n))


@needs
@settings(max_examples=40, deadline=None)
@given(st.text(st.sampled_from("ab 1'é\n.漢"), max_size=60))
def test_long_texts_are_cut_where_nothing_is_lost(text):
    enc, piece = T.encoder(T.load_ranks()), T.PIECE
    try:
        T.PIECE = 7
        assert T.encode(enc, text) == enc.encode_ordinary(text)
    finally:
        T.PIECE = piece


@needs
def test_shards(spark, odd, empty, tmp_path):
    path, enc = f"file://{tmp_path}/shards", T.encoder(T.load_ranks())
    rows = T.write_training_order(odd, path, length=64, shard_places=900).collect()
    stored = dict(T.read_sequences(path))
    assert sorted(stored) == sorted(r.slot for r in rows) == list(range(len(rows)))
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    got = {}
    for r in sorted(rows, key=lambda r: r.piece):
        got.setdefault(r.doc_id, []).append((r.piece, stored[r.slot][: r.n_tokens].tolist()))
    for doc_id in {i for i, _ in texts}:
        wanted = sorted([*enc.encode_ordinary(t or ""), T.END] for i, t in texts if i == doc_id)
        copies = sum(i == doc_id for i, _ in texts)
        assert sum(len(p) for _, p in got[doc_id]) == sum(map(len, wanted))
        if copies == 1:
            assert [x for _, p in got[doc_id] for x in p] == wanted[0]
    assert [s for s, _ in T.read_sequences(path, 5)] == list(range(5, len(rows)))
    assert [tuple(r) for r in T.write_training_order(odd, path, length=64, shard_places=900).orderBy("slot").collect()] == sorted(map(tuple, rows))
    assert T.write_training_order(empty, f"file://{tmp_path}/none").count() == 0 and not list(T.read_sequences(f"file://{tmp_path}/none"))
