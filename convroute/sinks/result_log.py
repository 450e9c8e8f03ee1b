"""Append finished batches to the result log."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convroute.sources.result_log import RESULT_SCHEMA


def log_rows(model_rows: DataFrame) -> DataFrame:
    """Classifier rows in the layout that both forms of the log share."""
    return model_rows.withColumnRenamed("author", "frm").select(*RESULT_SCHEMA.names)


def append_slice(model_rows: DataFrame, path: str, fingerprint: str, slice_name: str) -> None:
    """Write one slice of a run.  Writing the same slice again replaces it, so a repeat adds nothing.

    ``sequence`` is the time of the write in nanoseconds, so later answers can be told from earlier ones.
    """
    folder = f"{path}/fingerprint={fingerprint}/slice={slice_name}"
    numbered = model_rows.withColumnRenamed("author", "frm").withColumn("sequence", F.lit(time.time_ns()))
    numbered.select(*RESULT_SCHEMA.names, "asked", "sequence").write.mode("overwrite").parquet(folder)


def write_json_log(rows: DataFrame, path: str) -> None:
    """Result rows as JSON lines, the exchange form of the log."""
    names = RESULT_SCHEMA.names
    rows.select(F.to_json(F.struct(*names)).alias("value")).write.mode("append").text(path)
