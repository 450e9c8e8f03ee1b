"""Write labels and thread summaries."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convroute.operators.merge import KEY
from convroute.streaming.folders import numbered_folders

BOM = "﻿"

_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def in_corpus_order(df: DataFrame) -> DataFrame:
    return df.orderBy(*[k for k in KEY if k in df.columns])


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV that spreadsheet programs read as Unicode: each part file starts with a byte order mark.

    ``single_file`` funnels everything through one task; leave it off for large results.
    """
    first = df.columns[0]
    marked = in_corpus_order(df).withColumnRenamed(first, BOM + first)
    if single_file:
        marked = marked.coalesce(1)
    marked.write.options(**_CSV).mode("overwrite").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what ``write_csv`` wrote; blanks become ''.  Line breaks inside a field are kept."""
    raw = spark.read.schema(schema).options(**_CSV, multiLine=True, enforceSchema=True).csv(path)
    blank = {f.name: F.coalesce(f.name, F.lit("")) for f in schema if isinstance(f.dataType, T.StringType)}
    return raw.withColumns(blank)


def write_outputs(labels: DataFrame, summary: DataFrame, path: str, format: str = "parquet") -> None:
    """Labels and thread summary side by side below ``path``, each sorted in corpus order."""
    for name, df in (("labels", labels), ("thread_summary", summary)):
        if format == "csv":
            write_csv(df, f"{path}/{name}")
        else:
            in_corpus_order(df).write.mode("overwrite").format(format).save(f"{path}/{name}")


def publish_outputs(labels: DataFrame, summary: DataFrame, path: str, format: str = "parquet") -> str:
    """Labels and thread summary as one new version below ``path``; returns its folder.

    Nothing is overwritten: the version becomes the current one by a mark that is written after both tables are
    complete, so readers of ``current_outputs`` see both tables of one run or both of another, whenever a job dies.
    """
    number = time.time_ns()
    folder = f"{path}/version={number}"
    write_outputs(labels, summary, folder, format)
    named = labels.sparkSession.createDataFrame([(f"version={number}", format)], "folder string, format string")
    named.coalesce(1).write.json(f"{path}/_published/version={number}")
    return folder


def current_outputs(spark: SparkSession, path: str) -> str | None:
    """The folder that holds ``labels`` and ``thread_summary`` of the latest complete version; None if there is none."""
    published = numbered_folders(spark, f"{path}/_published", "version")[-1:]
    return f"{path}/{published[0].rsplit('/', 1)[1]}" if published else None


def drop_older_outputs(spark: SparkSession, path: str) -> None:
    """Delete versions before the current one, and what jobs that died before its publication left.

    Run it when no job reads an older version.
    """
    current = current_outputs(spark, path)
    if current is None:
        return
    number = int(current.rsplit("=", 1)[1])
    jvm = spark.sparkContext._jvm
    for below in (path, f"{path}/_published"):
        at = jvm.org.apache.hadoop.fs.Path(below)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.listStatus(at):
            name = status.getPath().getName()
            if name.startswith("version=") and int(name.split("=")[1]) < number:
                fs.delete(status.getPath(), True)
