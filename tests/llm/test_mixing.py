from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.llm import mixing
from tests.llm.conftest import words


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = 2 * sizes[s]
        left, free = left - sum(target[s] for s in over), free - set(over)
    return target


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from(["a", "B", "é", "c", None, "d"]), st.integers(0, 500), min_size=1))
def test_targets(spark, sizes):
    d = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(d, (5, 2, 1), (3, 2), 2).collect()}
    assert got == pytest.approx(brute_targets(sizes))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 60), min_size=1, max_size=7), st.integers(0, 40))
def test_seats_go_to_the_highest_quotients(spark, votes, seats):
    d = spark.createDataFrame([(f"p{i}", v, seats, "g") for i, v in enumerate(votes)], "name string, votes long, seats long, g string")
    got = {r.name: r.won for r in mixing.sainte_lague(d, ["g"], "votes", "seats", ["name"]).collect()}
    quotients = sorted(((-v / (2 * k + 1), f"p{i}", k) for i, v in enumerate(votes) if v for k in range(seats)))[:seats]
    won = Counter(name for _, name, _ in quotients)
    assert got == {f"p{i}": won[f"p{i}"] for i in range(len(votes))}


def test_mix(odd):
    got = mixing.mix(odd).collect()
    rows = odd.collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert sorted(r.size for r in got) == sorted(len(words(r.text)) for r in rows)
    by, want, size = Counter(), {}, {}
    for r, source in ((r, next(x.source for x in rows if x.doc_id == r.doc_id and len(words(x.text)) == r.size)) for r in got):
        by[source] += r.taken
        want[source], size[source] = r.target, r.source_size
    assert all(abs(by[s] - want[s]) <= max(1, min(mixing.BLOCK_WORDS, size[s] // mixing.LEAST_BLOCKS)) for s in want)
    assert sorted(map(str, mixing.mix(odd).collect())) == sorted(map(str, got))


def test_small_sources_meet_their_targets(spark):
    """Every source of 1 to 200 words, to within a word; larger ones to within a block."""
    rows = [(i, "w " * n, f"s{i:03}") for i, n in enumerate([*range(1, 201), 700, 5000])]
    rows += [(1000 + i, "v " * 7, "many") for i in range(90)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target, source = Counter(), {}, {i: s for i, _, s in rows}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.taken <= 2 * r.size
    for s, t in target.items():
        assert abs(taken[s] - t) <= (mixing.BLOCK_WORDS if s == "s201" else 4 if s in ("many", "s200") else 1), s


def test_taken_rows_are_the_mix(spark):
    d = spark.createDataFrame([(i, f"d{i} " + "a  b\nc " * (i % 40), "fr", f"s{i % 5}", 0) for i in range(200)], "doc_id long, text string, lang string, source string, n_chars long").withColumn("row", F.lit(1))
    plan = {r.doc_id: r for r in mixing.mix(d, shard_rows=10).collect()}
    out = mixing.take(d, shard_rows=10)
    assert out.columns == d.columns
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text)
    assert got == Counter({i: r.taken for i, r in plan.items() if r.taken})


def test_empty(empty):
    assert mixing.mix(empty).count() == 0 and mixing.take(empty).count() == 0
