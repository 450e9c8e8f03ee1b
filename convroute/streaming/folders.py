"""Numbered folders that micro-batches write."""

from __future__ import annotations

from pyspark.sql import SparkSession


def numbered_folders(spark: SparkSession, folder: str, kind: str) -> list[str]:
    """Finished subfolders ``kind=<number>`` of a folder, in order of number."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    numbers = sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}="))
    done = [n for n in numbers if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/{kind}={n}/_SUCCESS"))]
    return [f"{folder}/{kind}={n}" for n in done]
