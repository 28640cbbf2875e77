"""Snapshots: a sink whose files count only once a manifest names them, and their readers.

Every task writes its rows to a file of its own in the run's staging folder and tells the driver what is in it. The driver commits in
two steps: files that were told of move to the run's folder, then the manifest is written under its final name. What
killed or repeated attempts have left is in no message and goes with the staging folder (of a run that fails, a task that is still
at work may leave its file there until the run is written again); a reader takes its files from a manifest, so it sees a run whole or not at all.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "manifest.json"
#: Rows of a file are written as they come, so many bytes at a time.
GROUP_BYTES = 8 << 20
ENTRY = "run string, file string, rows long, bytes long, sha256 string, key string, key_rows long"


def store(url: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, and the path in it."""
    if url.startswith("file:"):
        url = re.sub(r"^file:/*", "file:///", url)
    return fs.FileSystem.from_uri(url if "://" in url else f"file://{url}")


@dataclass
class Written(ds.WriterCommitMessage):
    """A task's file: name, rows, bytes, digest, and rows by the counted column. A task without rows has none."""

    file: str
    rows: int
    bytes: int
    sha256: str
    counts: list[tuple[str | None, int]] = field(default_factory=list)


class SnapshotWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.root, self.count_by, self.label = options["path"].rstrip("/"), options.get("countby"), options.get("label", "")
        self.run, self.overwrite = options.get("run") or uuid.uuid4().hex, overwrite
        if self.count_by and self.count_by not in schema.names:
            raise ValueError(f"no column {self.count_by} to count by")
        files, root = store(self.root)
        if not overwrite and files.get_file_info(f"{root}/{self.run}/{MANIFEST}").type != fs.FileType.NotFound:
            raise FileExistsError(f"run {self.run} is there already")

    def _staging(self, root: str) -> str:
        return f"{root}/_staging-{self.run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = store(self.root)
        name, counts, rows, writer, out = f"part-{uuid.uuid4().hex}.parquet", {}, 0, None, None
        path = f"{self._staging(root)}/{name}"
        held: list[pa.RecordBatch] = []

        def put() -> None:
            nonlocal writer, out
            if writer is None:
                files.create_dir(self._staging(root), recursive=True)
                out = files.open_output_stream(path)
                writer = pq.ParquetWriter(out, held[0].schema)
            writer.write_table(pa.Table.from_batches(held))
            held.clear()

        for batch in iterator:
            if not batch.num_rows:
                continue
            rows += batch.num_rows
            if self.count_by:
                for v in batch.column(self.count_by).value_counts().to_pylist():
                    key = None if v["values"] is None else str(v["values"])
                    counts[key] = counts.get(key, 0) + v["counts"]
            held.append(batch)
            if sum(b.nbytes for b in held) >= GROUP_BYTES:
                put()
        if not rows:
            return Written("", 0, 0, "")
        if held:
            put()
        writer.close()
        out.close()
        digest, size = hashlib.sha256(), 0
        with files.open_input_stream(path) as f:
            while part := f.read(1 << 20):
                digest.update(part)
                size += len(part)
        return Written(name, rows, size, digest.hexdigest(), sorted(counts.items(), key=lambda c: (c[0] is None, c[0] or "")))

    def commit(self, messages: list[Written | None]) -> None:
        files, root = store(self.root)
        run, told = f"{root}/{self.run}", sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.file)
        if self.overwrite and files.get_file_info(run).type != fs.FileType.NotFound:
            files.delete_dir(run)
        files.create_dir(run, recursive=True)
        for m in told:
            files.move(f"{self._staging(root)}/{m.file}", f"{run}/{m.file}")
        body = {"run": self.run, "label": self.label, "rows": sum(m.rows for m in told), "bytes": sum(m.bytes for m in told), "files": [asdict(m) for m in told]}
        with files.open_output_stream(f"{run}/{MANIFEST}.new") as f:
            f.write(json.dumps(body, indent=1).encode())
        files.move(f"{run}/{MANIFEST}.new", f"{run}/{MANIFEST}")
        self._clear(files, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*store(self.root))

    def _clear(self, files: fs.FileSystem, root: str) -> None:
        if files.get_file_info(self._staging(root)).type != fs.FileType.NotFound:
            files.delete_dir(self._staging(root))


class SnapshotSource(ds.DataSource):
    """``format("snapshot")`` with options path, run (else a new name), countBy (a column whose values the manifest counts) and label."""

    @classmethod
    def name(cls) -> str:
        return "snapshot"

    def writer(self, schema: StructType, overwrite: bool) -> SnapshotWriter:
        return SnapshotWriter(dict(self.options), schema, overwrite)


def write(df: DataFrame, path: str, run: str, count_by: str | None = None, label: str = "", overwrite: bool = False) -> None:
    """``df`` as one run of the snapshots in ``path``. A run that is there already is an error, unless it may be overwritten. A table without rows is a manifest without files."""
    df.sparkSession.dataSource.register(SnapshotSource)
    own = df.write.format("snapshot").option("path", path).option("run", run).option("label", label).mode("overwrite" if overwrite else "append")
    (own.option("countBy", count_by) if count_by else own).save()


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file and counted value of all runs: run, file, rows, bytes, sha256, key, key_rows (one row with neither where nothing was counted)."""
    spec = "run string, files array<struct<file: string, rows: bigint, bytes: bigint, sha256: string, counts: array<array<string>>>>"
    d = spark.read.schema(spec).json(f"{path}/*/{MANIFEST}", multiLine=True)
    d = d.select("run", F.explode("files").alias("f")).select("run", "f.*", F.explode_outer("f.counts").alias("c"))
    return d.select("run", "file", "rows", "bytes", "sha256", F.get("c", F.lit(0)).alias("key"), F.get("c", F.lit(1)).cast("long").alias("key_rows"))


def read(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The rows of a run, from the files that its manifest names. A run without a manifest is an error."""
    files, root = store(path)
    with files.open_input_stream(f"{root}/{run}/{MANIFEST}") as f:
        body = json.loads(f.readall())
    names = [posixpath.join(path, run, m["file"]) for m in body["files"]]
    if not names:
        raise ValueError(f"run {run} has no rows")
    return spark.read.parquet(*names)


def damaged(spark: SparkSession, path: str) -> DataFrame:
    """``run, file, reason`` of files that are missing, or whose bytes are no longer those of the manifest. Files are read in tasks, a piece at a time."""
    listed = manifests(spark, path).select("run", "file", "sha256").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(path)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                digest = hashlib.sha256()
                try:
                    with files.open_input_stream(f"{root}/{r['run']}/{r['file']}") as f:
                        while part := f.read(1 << 20):
                            digest.update(part)
                except FileNotFoundError:
                    out.append((r["run"], r["file"], "missing"))
                    continue
                if digest.hexdigest() != r["sha256"]:
                    out.append((r["run"], r["file"], "changed"))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in range(3)], names=["run", "file", "reason"])

    return listed.mapInArrow(run, "run string, file string, reason string")
