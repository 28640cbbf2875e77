"""Reading the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm.scratch import BATCH, BATCH_BYTES


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of a bounded size for the session: texts can be long, and a worker holds a batch as a whole."""
    if int(spark.conf.get(BATCH, str(1 << 30))) > BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
