import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from inkwell.session import local_session

    session = local_session("4", 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """The value of an expression over one row of strings."""

    def of(make, *args):
        from pyspark.sql import functions as F

        row = spark.createDataFrame([args], ", ".join(f"c{i} string" for i in range(len(args))))
        return row.select(make(*[F.col(f"c{i}") for i in range(len(args))]).alias("v")).first().v

    return of
