"""Bring the labels of all stages together, one per message."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convroute.config import CUSTOMER
from convroute.operators.stages import LABEL_COLUMNS, is_undecided

KEY = ("thread_idx", "turn_index")
RESULT_COLUMNS = (
    "id", "thread_idx", "seed_id", "turn_index", "platform", "author", "label", "confidence", "source", "reason",
    "batch",
)
OUTPUT_COLUMNS = (
    "id", "thread_idx", "seed_id", "turn_index", "platform", "from", "text", "label", "confidence", "source", "reason",
)


def results(df: DataFrame) -> DataFrame:
    """Labelled rows in the result layout; ``batch`` is null for rows that needed no classifier."""
    batch = F.col("batch") if "batch" in df.columns else F.lit(None).cast("bigint").alias("batch")
    return df.where(F.col("label").isNotNull()).select(*RESULT_COLUMNS[:-1], batch)


def union_results(*parts: DataFrame) -> DataFrame:
    """Append result tables; ``pass_no`` is the position of the table in the call."""
    out = None
    for pass_no, part in enumerate(parts):
        numbered = part.withColumn("pass_no", F.lit(pass_no))
        out = numbered if out is None else out.unionByName(numbered, allowMissingColumns=True)
    return out


def latest(first: DataFrame, *later: DataFrame) -> DataFrame:
    """One row per message out of tables that each hold a message once: that of the last table that has it.

    Only keys of the later tables, which are far smaller, are looked up.
    """
    for part in later:
        first = first.join(part.select(*KEY), list(KEY), "left_anti").unionByName(part)
    return first


def last_wins(rows: DataFrame, order: str | Column = "pass_no") -> DataFrame:
    """Keep one row per message: the one of the latest pass.  Combines before it shuffles."""
    order = F.col(order) if isinstance(order, str) else order
    rest = [c for c in rows.columns if c not in KEY]
    latest = F.max_by(F.struct(*rest), order).alias("__row")
    return rows.groupBy(*KEY).agg(latest).select(*KEY, "__row.*").select(*rows.columns)


def attach_labels(
    staged: DataFrame, model_rows: DataFrame, attach: Callable[[DataFrame, DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Fill labels from classifier rows, which win over what the message already carries.

    All messages stay.  The key is unique on both sides, so no key is hot; only classifier rows take part
    in the join, the other stages' labels travel with the message.  ``attach`` makes the left join by another way
    than a shuffle of both sides: ``MessageStore.attach_rows``, for messages of a store.
    """
    found = model_rows.select(*KEY, F.struct(*LABEL_COLUMNS).alias("__found"))
    merged = staged.join(found, list(KEY), "left") if attach is None else attach(staged, found)
    hit = F.col("__found").isNotNull()
    return merged.withColumns(
        {c: F.when(hit, F.col(f"__found.{c}")).otherwise(F.col(c)) for c in LABEL_COLUMNS}
    ).drop("__found")


def labels_output(labelled: DataFrame) -> DataFrame:
    """The eleven output columns, blank where a message has no label.  Sort at the sink."""
    blank = {c: F.coalesce(c, F.lit("")) for c in LABEL_COLUMNS}
    return labelled.withColumns(blank).withColumnRenamed("author", "from").select(*OUTPUT_COLUMNS)


def refine_candidates(labelled: DataFrame) -> DataFrame:
    """Low-confidence customer messages, for a second pass with another model."""
    return labelled.where((F.col("confidence") == "low") & (F.col("author") == CUSTOMER))


def pending(messages: DataFrame, log: DataFrame, fingerprint: str) -> DataFrame:
    """Messages without an answer to the same question under the same run settings.  They carry ``asked``."""
    done = log.where(F.col("fingerprint") == fingerprint).select(*KEY, "asked")
    return messages.join(done, [*KEY, "asked"], "left_anti")


def answered(messages: DataFrame, log: DataFrame, fingerprint: str) -> DataFrame:
    """The latest answer to each of these messages, if its question is still the same."""
    wanted = messages.select(*KEY, "asked").distinct()
    rows = log.where(F.col("fingerprint") == fingerprint).join(wanted, [*KEY, "asked"], "left_semi")
    return last_wins(rows, F.struct("sequence", "slice")).withColumnRenamed("frm", "author")


def undecided(staged: DataFrame) -> DataFrame:
    return staged.where(is_undecided())
