"""Source dimensions: joins with a default or a check, and drift between two of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import policy


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(policy.SOURCES, "id string, name string, kind string, priority int, scope string")


def with_dimension(df: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: dict[str, object]) -> DataFrame:
    """Left join of a dimension that is unique in its key; absent rows take the default in ``columns`` (name to default)."""
    d = dim.select(F.col(dim_key).alias("_dim"), *[F.col(c).alias(f"_d_{c}") for c in columns])
    met = df.join(d, F.col(key) == F.col("_dim"), "left")
    return met.select(*df.columns, *[F.coalesce(F.col(f"_d_{c}"), F.lit(v)).alias(c) for c, v in columns.items()])


def with_scope(df: DataFrame, dim: DataFrame, key: str = "source", dim_key: str = "id") -> DataFrame:
    """Scope of each row's source; an unknown source is an error."""
    d = dim.select(F.col(dim_key).alias("_dim"), F.col("scope").alias("_scope"))
    checked = F.coalesce("_scope", F.raise_error(F.concat(F.lit("unknown source: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))))
    return df.join(d, F.col(key) == F.col("_dim"), "left").select(*df.columns, checked.alias("scope"))


def resolve(spark: SparkSession, wanted: list[str], kind: str | None = None) -> DataFrame:
    """The catalogue's rows of the wanted sources, in the order asked for; an unknown one, or one of another kind, is an error."""
    known = {s[0]: s for s in policy.SOURCES}
    for name in wanted:
        if name not in known:
            raise ValueError(f"unknown source: {name}")
        if kind and known[name][2] != kind:
            raise ValueError(f"source {name} is {known[name][2]}, not {kind}")
    return spark.createDataFrame([(i, *known[n]) for i, n in enumerate(wanted)], "ord int, id string, name string, kind string, priority int, scope string")


def drift(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose value differs between two dimensions, or that only one has: key, left_value, right_value."""
    x, y = (d.select(F.col(key).alias(f"{s}_key"), F.col(value).alias(f"{s}_value")) for d, s in ((a, "left"), (b, "right")))
    met = x.join(y, F.col("left_key") == F.col("right_key"), "full_outer").filter(~F.col("left_value").eqNullSafe(F.col("right_value")) | F.col("left_key").isNull() | F.col("right_key").isNull())
    return met.select(F.coalesce("left_key", "right_key").alias("key"), "left_value", "right_value")


def assert_same(a: DataFrame, b: DataFrame, key: str, value: str) -> None:
    """Raise if the dimensions differ; a few of the keys stand in the message."""
    if rows := drift(a, b, key, value).orderBy("key").limit(8).collect():
        raise ValueError("drift: " + ", ".join(f"{r.key}: {r.left_value} / {r.right_value}" for r in rows))
