"""Intermediate tables in the folder that all executors share, and their removal."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
# While a table is written: shuffle files go when it stands, and what Python is handed at once stays small.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="churnkit-")


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that all executors see; in local mode a temporary folder if none is set."""
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder that every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/churnkit-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it is stored; one that is not there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Workspace:
    """Tables written once and read many times, until they are dropped or the workspace is closed.

    A written table cuts lineage: a lost executor costs no more than the tasks it was running. The shuffle files of
    the plan that made it go as soon as it stands. What is still there when the program ends is deleted then.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, str] = {}
        self._tables: list[DataFrame] = []  # referenced, as a path is known by its table's identity
        _open.add(self)

    def folder(self) -> str:
        """A new path that goes with the workspace."""
        path = shared_folder(self.spark)
        self._paths[id(path)] = path
        return path

    def write(self, df: DataFrame, partition_by: Sequence[str] = (), file_rows: int | None = None) -> DataFrame:
        """The rows of a plan as a table; filters and column choices still reach its files.

        With ``file_rows`` no file has more rows than that.
        """
        path = shared_folder(self.spark)
        before = {k: self.spark.conf.get(k) for k in _WRITING}
        for k, v in _WRITING.items():
            self.spark.conf.set(k, v)
        try:
            writer = df.write if file_rows is None else df.write.option("maxRecordsPerFile", file_rows)
            writer.partitionBy(*partition_by).parquet(path)
        except BaseException:
            remove(self.spark, path)
            raise
        finally:
            for k, v in before.items():
                self.spark.conf.set(k, v)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(table)] = path
        self._tables.append(table)
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of this workspace that nothing later reads; others are left alone."""
        for table in tables:
            path = self._paths.pop(id(table), None)
            if path is not None:
                remove(self.spark, path)

    def close(self) -> None:
        """Delete everything that is left."""
        while self._paths:
            remove(self.spark, self._paths.popitem()[1])

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *failure) -> None:
        self.close()


# Strong references: the tables of a workspace that nobody holds may still be read by a frame that somebody does.
_open: set[Workspace] = set()


@atexit.register
def _close_all() -> None:
    for workspace in _open:
        try:
            workspace.close()
        except Exception:  # the session is gone, and with it the way to its store
            return
