import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import rolling

SCHEMA = "click_id long, ts timestamp_ntz, kind string, value double, n long, series string, slice int, t string, cents string, id string"
START = datetime(2024, 1, 1)


def doubled(values):
    v = sorted(values)
    return v[(len(v) - 1) // 2] + v[len(v) // 2]


def brute(rows, minutes=360):
    """By id: every window looked through as a whole."""
    first = {}
    for i, ts, kind, value in rows:
        cents = None if value is None or not abs(value) < 1e15 else int((100 * value + 0.5) // 1)
        key = (ts is None, ts or START, kind is not None, kind or "", cents is not None, cents or 0)
        if i not in first or key < first[i][0]:
            first[i] = (key, ts, kind, cents)
    live = {i: r[1:] for i, r in first.items() if r[1] is not None}
    out = {}
    for i, (ts, kind, cents) in live.items():
        window = [c for t, k, c in live.values() if k == kind and c is not None and ts - timedelta(minutes=minutes) <= t <= ts]
        if len(window) < 5:
            out[i] = (kind, len(window), None, None, None)
            continue
        m = doubled(window)
        mad = doubled([abs(2 * c - m) for c in window])
        out[i] = (kind, len(window), m, mad, None if cents is None else 2 * abs(2 * cents - m) > 5 * mad)
    return out


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "x", 2, "y", "z", "w") for r in rows], SCHEMA)
    out = rolling.rolling_mad(df, **more)
    assert out.columns == ["click_id", "kind", "n", "median2", "mad4", "far"]
    return [(r.click_id, tuple(r)[1:]) for r in out.collect()]


@settings(max_examples=120, deadline=None)
@given(st.integers(2, 8), st.lists(st.tuples(st.integers(-6, 6), st.booleans()), max_size=90), st.integers(0, 9))
def test_skip_list_is_a_sorted_multiset(most, steps, seed):
    s, held, pick = rolling.SkipList(most, seed), [], random.Random(seed)
    for value, out in steps:
        if out and held:
            s.remove(held.pop(pick.randrange(len(held))))
        else:
            s.insert(value)
            held.append(value)
        assert s.size == len(held)
        assert [s.at(i) for i in range(len(held))] == sorted(held)
        if len(held) > 1:
            m = doubled(held)
            assert (s.median2(), s.mad4(m)) == (m, doubled([abs(2 * v - m) for v in held]))


def test_a_value_that_is_not_there():
    s = rolling.SkipList()
    with pytest.raises(KeyError):
        s.remove(1)


def test_windows_against_brute_force(spark):
    pick, rows = random.Random(5), []
    for i in range(700):
        ts = START + timedelta(minutes=pick.choice([pick.randrange(5000), 360 * pick.randrange(6), 720]), microseconds=pick.choice([0, 0, 1, 999_999]))
        value = pick.choice([None, float("nan"), float("inf"), 1e300, *[round(pick.lognormvariate(3, 1), 2)] * 12, 5.0, -2.345, 1.005])
        rows.append((i, None if pick.random() < 0.03 else ts, pick.choice(["a", "a", "a", "", None, "b"]), value))
    rows += pick.sample(rows, 60)  # repeated rows
    rows += [(3, START + timedelta(days=1), "a", 9.0), (3, None, "b", 1.0), (None, START, "a", 1.0), (None, START + timedelta(hours=1), "a", 2.0)]
    expected = brute(rows)
    for slices in (1, 2, 5):
        got = run(spark, rows, slice_windows=slices)
        assert len(got) == len(expected)
        assert dict(got) == expected


def test_hot_time_and_batches(spark):
    """Most rows at one time, over the edges of Arrow batches."""
    rows = [(i, START + timedelta(hours=7 if i % 3 else i % 11), "k", float(i % 50)) for i in range(900)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        assert dict(run(spark, rows)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_zone_of_the_session_has_no_say(spark):
    rows = [(i, datetime(2024, 3, 31, 0, 30) + timedelta(minutes=30 * i), "k", float(i)) for i in range(12)]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # which leaves an hour of that night out
    try:
        assert dict(run(spark, rows, minutes=60)) == brute(rows, 60)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_and_timeless(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, "k", 1.0)]) == []
    assert run(spark, [(1, datetime(1969, 12, 31, 23, 59), None, None)]) == [(1, (None, 0, None, None, None))]
