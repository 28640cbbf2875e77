"""Session defaults shared by the tests, the bench and the command-line tools."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share. Only a local session, whose executors are the driver itself, gets one made where that is unset."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = sc._jsc.sc().getCheckpointDir()
        base = base.get() if base.isDefined() else None
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="inkwell-shared-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder's address below ``shared_dir``, removed when the session's process ends."""
    path = f"{shared_dir(spark)}/inkwell-{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the session may have ended before the process
        return


def saved(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written to ``path`` (else a folder that goes with the process) and read back: a lost executor costs a reread, not a recomputation."""
    schema, path = df.schema, path or shared_folder(df.sparkSession, "table")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session; a cluster brings its own and never calls this."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("inkwell")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="inkwell-checkpoints-"))
        .getOrCreate()
    )
