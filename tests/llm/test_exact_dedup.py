import hashlib
from collections import defaultdict

from inkwell.llm import exact_dedup
from tests.llm.conftest import LOWER


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r.text or "").translate(LOWER)].append(r.doc_id)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_groups(odd):
    assert sorted((tuple(r) for r in exact_dedup.exact_groups(odd).collect()), key=str) == brute(odd.collect())


def test_long_common_beginnings(spark):
    base = "x" * 300
    rows = [(i, base + "é" * (i % 3) * 3000 + "tail" * (i % 2)) for i in range(60)] + [(100, base), (101, base.upper()), (102, base[:-1]), (103, base[:256]), (104, base[:256])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in exact_dedup.exact_groups(d).collect()), key=str) == brute(d.collect())


def test_empty(empty):
    assert exact_dedup.exact_groups(empty).count() == 0
