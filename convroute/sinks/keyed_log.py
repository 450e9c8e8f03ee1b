"""The compacted result log: runs of answers bucketed by question, beside the slices that are not merged yet.

Slices are cheap to append, but a job that looks up its questions has to shuffle all of them.  ``compact`` merges them
into *runs*, in which a question has one row, in the bucket of its hash and in order.  A look-up then moves the
questions to the buckets once and reads the runs where they lie; only slices written since are shuffled.

A run is merged with the next larger one once the rows to be merged, times ``fanout``, reach its size.  So sizes of
runs grow geometrically, there are at most some log(rows) of them, and a row is rewritten as often at most.

``_manifest/version=<time>`` names the runs and the slices they hold, and is written last: until it is complete,
readers use what the version before it names, and all of that is still there.  So a merge that dies, or two at a time,
lose nothing.  ``vacuum`` deletes what the latest version does not name; run it while no other job uses the log.
"""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convroute.operators.merge import KEY
from convroute.sources.result_log import LOG_SCHEMA
from convroute.streaming.folders import numbered_folders

QUESTION = (*KEY, "asked")
BUCKETS = 64
FANOUT = 4

_MANIFEST = "kind string, name string, number bigint, buckets int"
_AGE = ("sequence", "slice")


@dataclass(frozen=True)
class Run:
    """A merged part of the log: its folder below ``_runs``, its rows, and the buckets it is dealt to."""

    name: str
    rows: int
    buckets: int


@dataclass(frozen=True)
class LogParts:
    """What a reader has to look at: ``merged`` slices, with the times they were finished, are in the runs."""

    runs: tuple[Run, ...]
    fresh: tuple[tuple[str, int], ...]
    merged: tuple[tuple[str, int], ...]


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _finished_slices(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Finished slices, by their names below the log, with the times they were finished."""
    fs, marks = _hadoop(spark, f"{path}/fingerprint=*/slice=*/_SUCCESS")
    found = []
    for status in fs.globStatus(marks) or []:
        folder = status.getPath().getParent()
        found.append((f"{folder.getParent().getName()}/{folder.getName()}", status.getModificationTime()))
    return sorted(found)


def log_parts(spark: SparkSession, path: str) -> LogParts:
    """The parts of the log under its latest finished manifest.  A slice written again counts as fresh again."""
    versions = numbered_folders(spark, f"{path}/_manifest", "version")[-1:]
    # One row per run and per slice that is not deleted yet.
    entries = spark.read.schema(_MANIFEST).json(versions[0]).collect() if versions else []
    runs = tuple(Run(e["name"], e["number"], e["buckets"]) for e in entries if e["kind"] == "run")
    merged = {(e["name"], e["number"]) for e in entries if e["kind"] == "slice"}
    there = _finished_slices(spark, path)
    return LogParts(
        tuple(sorted(runs, key=lambda run: (run.rows, run.name))),
        tuple(s for s in there if s not in merged),
        tuple(s for s in there if s in merged),
    )


def _run_folder(path: str, run: str) -> str:
    return f"{path.rstrip('/')}/_runs/{run}"


def _table_name(folder: str) -> str:
    return f"convroute_log_{hashlib.md5(folder.encode()).hexdigest()}"


def read_run(spark: SparkSession, path: str, run: Run) -> DataFrame:
    """A run as a bucketed table.  Sessions whose catalog does not know it yet register it by its folder."""
    folder = _run_folder(path, run.name)
    name = _table_name(folder)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LOG_SCHEMA)
        keys, quoted = ", ".join(QUESTION), folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {run.buckets} BUCKETS LOCATION '{quoted}'"
        )
    return spark.table(name)


def read_slices(spark: SparkSession, path: str, slices: tuple[tuple[str, int], ...]) -> DataFrame:
    if not slices:
        return spark.createDataFrame([], LOG_SCHEMA)
    folders = [f"{path}/{name}" for name, _ in slices]
    return spark.read.schema(LOG_SCHEMA).option("basePath", path).parquet(*folders).select(*LOG_SCHEMA.names)


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the log, from its runs and its fresh slices; a missing log is empty."""
    parts = log_parts(spark, path)
    tables = [read_run(spark, path, run) for run in parts.runs]
    return reduce(DataFrame.unionByName, [read_slices(spark, path, parts.fresh), *tables])


def _latest_answers(rows: DataFrame, *more: str) -> DataFrame:
    """One row per question: the latest."""
    keys = [*more, *QUESTION]
    rest = [c for c in LOG_SCHEMA.names if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*_AGE)).alias("__row")
    return rows.groupBy(*keys).agg(last).select(*keys, "__row.*").select(*LOG_SCHEMA.names)


def compact(
    spark: SparkSession,
    path: str,
    buckets: int = BUCKETS,
    fanout: int = FANOUT,
    at_least: int = 1,
    everything: bool = False,
) -> None:
    """Merge the fresh slices, if there are ``at_least`` so many, into a run, and with it runs that it has caught up with.

    The rows are shuffled once, each task writes the one file of its bucket, and the manifest is switched last.  Choose
    ``buckets`` so that a bucket of the whole log fits a task; ``everything`` merges all runs, of whatever size, which
    also moves them to a new number of buckets.
    """
    parts = log_parts(spark, path)
    if not everything and len(parts.fresh) < max(1, at_least):
        return
    fresh = read_slices(spark, path, parts.fresh)
    taken, rows = [], fresh.count()
    for run in parts.runs:
        if everything or rows * fanout >= run.rows:
            taken.append(run)
            rows += run.rows
    kept = [run for run in parts.runs if run not in taken]
    whole = reduce(DataFrame.unionByName, [fresh, *(read_run(spark, path, run) for run in taken)])
    dealt = whole.repartition(buckets, *QUESTION)
    name = f"run={time.time_ns()}"
    folder = _run_folder(path, name)
    table = _table_name(folder)
    (
        _latest_answers(dealt, "fingerprint")
        .write.format("parquet")
        .bucketBy(buckets, *QUESTION)
        .sortBy(*QUESTION)
        .option("path", folder)
        .saveAsTable(table)
    )
    kept.append(Run(name, spark.table(table).count(), buckets))
    _switch(spark, path, kept, [*parts.merged, *parts.fresh])


def _switch(spark: SparkSession, path: str, runs: list[Run], merged: list[tuple[str, int]]) -> None:
    entries = [("run", run.name, run.rows, run.buckets) for run in runs]
    entries += [("slice", name, finished, None) for name, finished in merged]
    manifest = spark.createDataFrame(entries, _MANIFEST).coalesce(1)
    manifest.write.json(f"{path}/_manifest/version={time.time_ns()}")


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete merged slices, and runs and versions that the latest manifest replaced.  No other job may use the log."""
    parts = log_parts(spark, path)
    named = {run.name for run in parts.runs}
    for name, _ in parts.merged:
        fs, at = _hadoop(spark, f"{path}/{name}")
        fs.delete(at, True)
    fs, runs = _hadoop(spark, f"{path}/_runs")
    for status in fs.listStatus(runs) if fs.exists(runs) else []:
        if status.getPath().getName() not in named:
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(_run_folder(path, status.getPath().getName()))}")
            fs.delete(status.getPath(), True)
    for version in numbered_folders(spark, f"{path}/_manifest", "version")[:-1]:
        fs, at = _hadoop(spark, version)
        fs.delete(at, True)


# --- Look-ups -------------------------------------------------------------------------------------


def _fresh(spark: SparkSession, path: str, parts: LogParts, dealt: int | None) -> DataFrame:
    """Rows of the fresh slices, dealt like the questions: else these would be moved again to meet them."""
    rows = read_slices(spark, path, parts.fresh)
    return rows if dealt is None else rows.repartition(dealt, *QUESTION)


def _of(rows: DataFrame, fingerprint: str, but: str | None) -> DataFrame:
    mine: Column = F.col("fingerprint") == fingerprint
    return rows.where(mine if but is None else mine & (F.col("slice") != but))


def pending(messages: DataFrame, path: str, fingerprint: str, but: str | None = None) -> DataFrame:
    """Messages without an answer to the same question under the same run settings.  They carry ``asked``.

    ``but`` names a slice that does not count.  Messages are moved once for all runs of the same buckets, runs never.
    """
    spark = messages.sparkSession
    parts = log_parts(spark, path)
    dealt = None
    for run in parts.runs:
        if run.buckets != dealt:
            messages, dealt = messages.repartition(run.buckets, *QUESTION), run.buckets
        done = _of(read_run(spark, path, run), fingerprint, but).select(*QUESTION)
        messages = messages.join(done, list(QUESTION), "left_anti")
    if parts.fresh:
        done = _of(_fresh(spark, path, parts, dealt), fingerprint, but).select(*QUESTION)
        messages = messages.join(done, list(QUESTION), "left_anti")
    return messages


def answered(messages: DataFrame, path: str, fingerprint: str) -> DataFrame:
    """The latest answer to each of these messages, if its question is still the same.

    A question has one row at most in each run, so the runs are laid beside the questions without a shuffle of theirs.
    """
    spark = messages.sparkSession
    parts = log_parts(spark, path)
    rest = [c for c in LOG_SCHEMA.names if c not in QUESTION and c not in _AGE]
    # Later answers are greater: their age comes first.
    answer = F.struct(*_AGE, *rest)
    wanted, dealt, found = messages.select(*QUESTION), None, []
    if not parts.runs:
        wanted = wanted.distinct()
    for n, run in enumerate(parts.runs):
        if run.buckets != dealt:
            wanted, dealt = wanted.repartition(run.buckets, *QUESTION), run.buckets
        wanted = wanted.distinct() if n == 0 else wanted
        rows = _of(read_run(spark, path, run), fingerprint, None).select(*QUESTION, answer.alias(f"__answer{n}"))
        wanted = wanted.join(rows, list(QUESTION), "left")
        found.append(F.col(f"__answer{n}"))
    latest = _latest_answers(_of(_fresh(spark, path, parts, dealt), fingerprint, None))
    wanted = wanted.join(latest.select(*QUESTION, answer.alias("__fresh")), list(QUESTION), "left")
    best = F.greatest(*found, F.col("__fresh")) if found else F.col("__fresh")
    hit = wanted.select(*QUESTION, best.alias("__best")).where(F.col("__best").isNotNull())
    return hit.select(*QUESTION, "__best.*").select(*LOG_SCHEMA.names).withColumnRenamed("frm", "author")
