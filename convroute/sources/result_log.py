"""The result log: labelled rows of finished batches, kept for resuming a run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("thread_idx", T.LongType()),
        T.StructField("seed_id", T.LongType()),
        T.StructField("turn_index", T.LongType()),
        T.StructField("platform", T.StringType()),
        T.StructField("frm", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("confidence", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)

# What a Parquet log adds: a hash of the question, a number that later writes exceed, the run's fingerprint and the
# name of the write.
LOG_SCHEMA = T.StructType(
    [
        *RESULT_SCHEMA.fields,
        T.StructField("asked", T.StringType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("slice", T.StringType()),
    ]
)

_CORRUPT = "_corrupt_line"


def _or_empty(spark: SparkSession, schema: T.StructType, read: Callable[[], DataFrame]) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_json_log(spark: SparkSession, path: str) -> DataFrame:
    """Read a JSON-lines log; blank, malformed and cut-off lines are skipped, a missing log is empty.

    A line with a value that its column cannot hold is skipped by readers of that column only: Spark parses the columns
    that are wanted.  ``read_json_log_rejects`` lists all such lines.
    """
    reader = spark.read.schema(RESULT_SCHEMA).option("mode", "DROPMALFORMED")
    return _or_empty(spark, RESULT_SCHEMA, lambda: reader.json(path))


def read_json_log_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, reason``: the lines that ``read_json_log`` leaves out, blank ones aside.

    Reasons: ``not an object``; ``cut off`` (no closing brace); ``wrong type: <columns>`` (a value that its column
    cannot hold); ``not JSON``.  All columns are parsed, as a value is only judged by a reader that wants it.
    """
    schema = T.StructType([*RESULT_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).options(mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT)
    empty = f"file string, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)}"
    try:
        read = reader.json(path).select(F.col("_metadata.file_path").alias("file"), *schema.names)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        read = spark.createDataFrame([], empty)
    line = F.trim(_CORRUPT)
    wrong = F.array_compact(
        F.array(
            *[
                F.when(F.col(c).isNull() & F.get_json_object(_CORRUPT, f"$.{c}").isNotNull(), F.lit(c))
                for c in RESULT_SCHEMA.names
            ]
        )
    )
    reason = (
        F.when(~line.startswith("{"), "not an object")
        .when(~line.endswith("}"), "cut off")
        .when(F.size(wrong) > 0, F.concat(F.lit("wrong type: "), F.array_join(wrong, ", ")))
        .otherwise("not JSON")
    )
    rejects = read.where(F.col(_CORRUPT).isNotNull() & (line != ""))
    return rejects.select("file", F.col(_CORRUPT).alias("line"), reason.alias("reason"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Read the Parquet log that ``sinks.result_log`` appends to; a missing log is empty."""
    return _or_empty(spark, LOG_SCHEMA, lambda: spark.read.schema(LOG_SCHEMA).parquet(path))
