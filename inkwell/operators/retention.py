"""How long daily outputs are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.dates import is_day_label
from inkwell.functions.policy import RETENTION_DAYS


def plan(labels: DataFrame, base: str, days: int = RETENTION_DAYS, label: str = "label") -> DataFrame:
    """``label, keep`` in order: the last ``days`` days up to ``base`` and later ones stay; labels that are no day are not listed."""
    if days < 1:
        raise ValueError("days must be at least 1")
    oldest = F.date_sub(F.lit(base).cast("date"), days - 1)
    return labels.select(label).distinct().filter(is_day_label(F.col(label))).select(F.col(label).alias("label"), (F.to_date(label) >= oldest).alias("keep")).orderBy("label")


def partitions(spark: SparkSession, root: str) -> DataFrame:
    """Labels of the folders ``report_date=...`` under ``root``, in whatever store it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return spark.createDataFrame([(n.split("=", 1)[1],) for n in names if n.startswith("report_date=")], "label string")


def prune(spark: SparkSession, root: str, base: str, days: int = RETENTION_DAYS, dry_run: bool = True) -> list[str]:
    """Delete the partitions that the plan does not keep; returns their labels. Only listed days are touched."""
    gone = [r.label for r in plan(partitions(spark, root), base, days).filter("NOT keep").collect()]
    if not dry_run:
        for label in gone:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/report_date={label}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone
