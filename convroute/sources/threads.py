"""Read conversation threads, number them by position and flatten them to messages.

A thread is one record.  A thread too long for one row may be continued in further records, which say where in the
thread they begin (``first_turn``), carry the turns just before (``prior``), and name the thread by its position in
the file (``thread``); all records of such a file do the latter.  The result is that of the undivided thread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convroute.config import RoutingConfig
from convroute.sources.json_array import read_objects
from convroute.workspace import Workspace

MESSAGE_TYPE = T.StructType([T.StructField("from", T.StringType()), T.StructField("text", T.StringType())])

THREAD_SCHEMA = T.StructType(
    [
        T.StructField("seed_id", T.LongType()),
        T.StructField("platform", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("messages", T.ArrayType(MESSAGE_TYPE)),
        # Only in files with continued threads.
        T.StructField("thread", T.LongType()),
        T.StructField("first_turn", T.LongType()),
        T.StructField("prior", T.ArrayType(MESSAGE_TYPE)),
    ]
)


def _required(column: str) -> Column:
    return F.coalesce(F.col(column), F.raise_error(F.lit(f"thread without required key {column!r}")))


def read_threads(spark: SparkSession, path: str, format: str = "json", multi_line: bool = False) -> DataFrame:
    """Read threads with a fixed schema.

    ``format`` is ``json`` (one thread per line), ``json_array`` (files that each hold one array of threads; also
    ``json`` with ``multi_line``) or ``parquet``.  All are read in splits.  Malformed input and missing required keys
    fail the job; optional keys default to ''.
    """
    reader = spark.read.schema(THREAD_SCHEMA)
    if format == "json_array" or (format == "json" and multi_line):
        parsed = F.from_json("value", THREAD_SCHEMA, {"mode": "FAILFAST"})
        raw = read_objects(spark, path).select(parsed.alias("t"), "file_path", "file_block_start", "row_index")
        raw, place = raw.select("t.*", "file_path", "file_block_start", "row_index"), [F.col("row_index")]
        source = [F.col("file_path"), F.col("file_block_start")]
    else:
        if format == "json":
            reader = reader.option("mode", "FAILFAST").option("encoding", "UTF-8")
        raw = reader.format(format).load(path)
        # Parquet and arrays tell each row's place in its file, so numbering needs no copy.
        place = [F.col("_metadata.row_index").alias("row_index")] if format == "parquet" else []
        source = [F.col(f"_metadata.{name}").alias(name) for name in ("file_path", "file_block_start")]
    return raw.select(
        _required("seed_id").alias("seed_id"),
        F.coalesce("platform", F.lit("")).alias("platform"),
        F.coalesce("customer_name", F.lit("")).alias("customer_name"),
        _required("messages").alias("messages"),
        "thread",
        F.coalesce("first_turn", F.lit(0)).cast("bigint").alias("first_turn"),
        F.coalesce("prior", F.array().cast(T.ArrayType(MESSAGE_TYPE))).alias("prior"),
        *source,
        *place,
    )


def number_threads(threads: DataFrame, workspace: Workspace) -> DataFrame:
    """Add ``thread_idx``: the 0-based position of the thread over all files in path order.

    Rows of Parquet and of JSON arrays know their place in the file, so only one count per file is needed.  Lines of text do not:
    they are stored once with a row marker, and counted per split.  Threads are never shuffled by key.
    """
    begins = (F.col("first_turn") == 0).cast("bigint")
    if "row_index" in threads.columns:
        rows, place = threads, F.col("row_index")
        per_file = rows.groupBy("file_path").agg(F.sum(begins).alias("__threads"))
        before = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
        offsets = per_file.select("file_path", F.coalesce(F.sum("__threads").over(before), F.lit(0)).alias("__file"))
        numbered = rows.join(workspace.save(offsets, "threads-offsets"), "file_path")
        position = F.col("__file") + F.coalesce("thread", place)
    else:
        split = ["file_path", "file_block_start"]
        rows = workspace.save(threads.withColumn("__row", F.monotonically_increasing_id()), "threads")
        per_split = rows.groupBy(*split).agg(F.sum(begins).alias("__threads"), F.min("__row").alias("__first"))
        before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
        offsets = per_split.withColumn("__offset", F.coalesce(F.sum("__threads").over(before), F.lit(0)))
        in_file = Window.partitionBy("file_path")
        offsets = offsets.withColumn("__file", F.min("__offset").over(in_file)).drop("__threads")
        numbered = rows.join(workspace.save(offsets, "threads-offsets"), split)
        own = F.col("__offset") + F.col("__row") - F.col("__first")
        position = F.coalesce(F.col("__file") + F.col("thread"), own)
    return numbered.select(
        position.alias("thread_idx"), "seed_id", "platform", "customer_name", "messages", "first_turn", "prior"
    )


def flatten_threads(threads: DataFrame, config: RoutingConfig = RoutingConfig()) -> DataFrame:
    """One row per message, with its context taken from the thread's own record: no shuffle.

    Threads without messages give no rows.  A null text reads '' in its own row and ``None`` where it
    is another message's context.  Records without ``first_turn`` and ``prior`` hold whole threads.
    """
    turns = config.context_turns
    if "first_turn" not in threads.columns:
        none = F.array().cast(T.ArrayType(MESSAGE_TYPE))
        threads = threads.withColumns({"first_turn": F.lit(0).cast("bigint"), "prior": none})

    def rendered(prior: Column) -> Column:
        return F.concat(
            F.coalesce(prior["from"], F.lit("None")), F.lit(": "), F.coalesce(prior["text"], F.lit("None"))
        )

    def message(m: Column, i: Column) -> Column:
        at = i + F.size("prior")
        prior = F.slice("__all", F.greatest(at - F.lit(turns), F.lit(0)) + F.lit(1), F.least(at, F.lit(turns)))
        author = F.coalesce(m["from"], F.raise_error(F.lit("message without required key 'from'")))
        return F.struct(
            (F.col("first_turn") + i).alias("turn_index"),
            author.alias("author"),
            F.coalesce(m["text"], F.lit("")).alias("text"),
            F.transform(prior, rendered).alias("context"),
        )

    rows = threads.withColumn("__all", F.concat("prior", "messages")).select(
        "thread_idx", "seed_id", "platform", "customer_name", F.inline(F.transform("messages", message))
    )
    return rows.select(
        message_id().alias("id"),
        "thread_idx",
        "seed_id",
        F.col("turn_index").cast("bigint").alias("turn_index"),
        "platform",
        "author",
        "text",
        "customer_name",
        "context",
    )


def message_id() -> Column:
    """The key of a message.  ``seed_id`` is no key: several threads may share one."""
    return F.concat_ws(":", F.col("thread_idx"), F.col("turn_index"))


def first_threads(df: DataFrame, n: int | None) -> DataFrame:
    """Keep the first ``n`` whole threads; None or 0 keeps all.  The filter reaches the scan."""
    return df.where(F.col("thread_idx") < n) if n else df
