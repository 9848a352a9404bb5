"""Run log with whole appends: a Spark data source whose writer commits.

An append is one write job with many tasks. Each task writes a file of its own
under a name that nobody reads; when all tasks are done, the commit writes one
manifest that lists the files, under another name first, and moves it into
place. Readers list manifests and read the files these name, so that a job that
fails, is aborted or is still running shows nothing, a task that was repeated
counts once, and appends of several drivers never meet. An abort removes what
its tasks wrote.

    runs.write.format("committed_runs").option("path", folder).mode("append").save()
    read_committed(spark, folder)
"""

from __future__ import annotations

import json
import sys
import threading
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .runs import RUN_COLUMNS, RUNS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "committed_runs"
_registering = threading.Lock()
PARTS, MANIFESTS = "parts", "_manifests"


def _filesystem(path: str):
    """The filesystem of a path (local or shared folder, HDFS, object store)."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: a file below the log, or none for no rows."""

    file: str | None
    rows: int


class CommittedWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq

        batches = [b for b in iterator if b.num_rows]
        if not batches:
            return Written(None, 0)
        files, root = _filesystem(self.path)
        name = f"{PARTS}/{uuid.uuid4().hex}.parquet"
        files.create_dir(f"{root}/{PARTS}", recursive=True)
        table = pa.Table.from_batches(batches)
        with files.open_output_stream(f"{root}/{name}") as out:
            pq.write_table(table, out)
        return Written(name, table.num_rows)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None and m.file]
        files, root = _filesystem(self.path)
        files.create_dir(f"{root}/{MANIFESTS}", recursive=True)
        name = uuid.uuid4().hex
        text = "".join(json.dumps({"file": m.file, "rows": m.rows}) + "\n" for m in done)
        with files.open_output_stream(f"{root}/{MANIFESTS}/_{name}") as out:  # a name that Spark doesn't read
            out.write(text.encode())
        files.move(f"{root}/{MANIFESTS}/_{name}", f"{root}/{MANIFESTS}/{name}.json")

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _filesystem(self.path)
        for m in messages:
            if m is not None and m.file:
                files.delete_file(f"{root}/{m.file}")


class CommittedRuns(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return RUNS

    def writer(self, schema: StructType, overwrite: bool) -> CommittedWriter:
        if overwrite:
            raise ValueError("a run log is only appended to")
        return CommittedWriter(self.options["path"])


def append_committed(runs: DataFrame, path: str) -> None:
    """Append run rows; readers see all of them or none."""
    spark = runs.sparkSession
    with _registering:  # fits append from several threads
        spark.dataSource.register(CommittedRuns)
    runs.select(*RUN_COLUMNS).write.format(FORMAT).option("path", path).mode("append").save()


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed appends. The manifests name the files (a line a
    task); only names reach the driver, as for any listing of files."""
    root = path.rstrip("/")
    files, at = _filesystem(root)
    if files.get_file_info(f"{at}/{MANIFESTS}").type.name == "NotFound":
        return spark.createDataFrame([], RUNS)
    listed = spark.read.schema("file string, rows long").json(f"{root}/{MANIFESTS}")
    names = [r["file"] for r in listed.select("file").distinct().orderBy("file").collect()]
    if not names:
        return spark.createDataFrame([], RUNS)
    return spark.read.schema(RUNS).parquet(*[f"{root}/{n}" for n in names]).select(*[F.col(c) for c in RUN_COLUMNS])
