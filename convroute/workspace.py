"""Shared working folder for tables that a job writes and reads again.

Lineage is cut by writing Parquet below the folder named in ``spark.checkpoint.dir``, which every
executor can reach, so a lost executor never costs more than its running tasks.  Only a local session
without that setting falls back to a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_fallback: dict[str, str] = {}
_open_scopes: list[list[Workspace]] = []


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_fallback:
        _local_fallback[app] = tempfile.mkdtemp(prefix="convroute-")
    return _local_fallback[app]


@contextmanager
def arrow_batches(spark: SparkSession, rows: int | None) -> Iterator[None]:
    if rows is None:
        yield
        return
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Workspace:
    """A uniquely named subfolder of the shared folder."""

    def __init__(self, spark: SparkSession, name: str = "run"):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/convroute/{name}-{uuid.uuid4().hex}"
        if _open_scopes:
            _open_scopes[-1].append(self)

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def save(self, df: DataFrame, name: str, arrow_rows: int | None = None) -> DataFrame:
        """Write ``df`` once and return the stored table; readers prune its columns.

        ``arrow_rows`` bounds the rows of one Arrow batch sent to Python while writing.
        """
        path = self.folder(name)
        with arrow_batches(self.spark, arrow_rows):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete everything written here; call once results derived from it are stored elsewhere."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary_workspaces() -> Iterator[None]:
    """Drop every workspace made inside, once a result that derives from them is stored elsewhere."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for workspace in _open_scopes.pop():
            workspace.drop()
