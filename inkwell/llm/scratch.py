"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import gc
import pickle
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from inkwell.session import shared_dir


BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


class Shipped:
    """A value broadcast with its classes and functions, so that executors need no copy of the package."""

    def __init__(self, spark: SparkSession, value: object):
        self.data, self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __reduce__(self):
        return _shipped, (self.data,)

    @property
    def value(self):
        if self.held is None:
            self.held = pickle.loads(self.data.value)  # noqa: S301  the driver's own
        return self.held

    def drop(self) -> None:
        """Forget the value, which is read again when it is next asked for."""
        self.held = None
        if getattr(self.data, "_path", None):
            vars(self.data).pop("_value", None)


def _shipped(data) -> Shipped:
    out = Shipped.__new__(Shipped)
    out.data, out.held = data, None
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lives in."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def store(path: str):
    """The file system of a folder's URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:") else f"file://{path}")


class Scratch:
    """Tables written while an operator runs, and gone with the block; ``result`` keeps one until the session's process ends. Inside the block, Arrow batches are bounded in bytes, since rows can be whole blocks of text."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/inkwell-{tag}-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        self.batch = self.spark.conf.get(BATCH, None)
        self.spark.conf.set(BATCH, str(BATCH_BYTES))
        return self

    def __exit__(self, *_: object) -> None:
        remove(self.spark, self.root)
        if self.batch is None:
            self.spark.conf.unset(BATCH)
        else:
            self.spark.conf.set(BATCH, self.batch)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back, which cuts its lineage: a lost executor costs a reread, not a recomputation."""
        schema = df.schema
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        remove(self.spark, self.path(name))

    def release(self) -> None:
        """Let go of the shuffle files of what has been saved: the driver drops them with the plans, once these are collected as garbage. The last plan run is held until another is."""
        self.spark.range(1).count()
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def result(self, df: DataFrame, name: str = "result") -> DataFrame:
        """As ``save``, in a folder of its own that outlives this block."""
        path, schema = f"{self.root}-{name}", df.schema
        df.write.mode("overwrite").parquet(path)
        forget_at_exit(self.spark, path)
        return self.spark.read.schema(schema).parquet(path)


def forget_at_exit(spark: SparkSession, path: str) -> None:
    atexit.register(_forget, spark, path)


def _forget(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the session may have ended before the process
        return
