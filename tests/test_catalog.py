"""Every query with an oracle against DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
QUERIES = {k: v for k, v in entry.queries().items() if k != "pipeline" and not k.startswith("op")}
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for p in DATA.glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "None"
    return f"{v:.9g}" if isinstance(v, float) else str(int(v)) if isinstance(v, int) and not isinstance(v, bool) else str(v)


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    got = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    if name not in ORACLES:
        assert got
        return
    answer = duck.sql(ORACLES[name])
    assert sorted(answer.columns) == sorted(df.columns)
    order = [answer.columns.index(c) for c in sorted(df.columns)]
    wanted = [tuple(r[i] for i in order) for r in answer.fetchall()]
    assert sorted(tuple(map(plain, r)) for r in got) == sorted(tuple(map(plain, r)) for r in wanted)


def test_entry(spark):
    assert entry.entry(spark).count() <= 12
